import pytest
from pyspark.sql import functions as F

from reportloom.operators.derive import derive

BASE = {"priority": 70, "finding": "other", "database_name": "db1", "details": "", "usage": "", "more_info": "",
        "create_tsql": ""}
CALL = "EXEC dbo.sp_Show @DatabaseName='{}', @SchemaName='{}', @TableName='{}';"
WIDE = "Index Hoarder: Wide Tables: 35+ cols or > 2000 non-LOB bytes"
KEYS = "Abnormal Psychology: Unindexed Foreign Keys"


def run(spark, **values):
    row = BASE | values
    df = spark.createDataFrame([row], "priority int, " + ", ".join(f"{c} string" for c in row if c != "priority"))
    return derive(df).first()


@pytest.mark.parametrize("values, expected", [
    ({"more_info": CALL.format("db1", "dbo", "T7")}, "dbo.T7"),
    ({"more_info": CALL.format("db1", "s", "My Table")}, "s.My Table"),
    ({"more_info": CALL.format("DB1", "dbo", "T7")}, "dbo.T7"),
    ({"more_info": "exec dbo.sp_Show @databasename='db1', @SchemaName='dbo', @tablename='T7';"}, "dbo.T7"),
    ({"more_info": CALL.format("a$(b)", "dbo", "T7"), "database_name": "a$(b)"}, "dbo.T7"),
    ({"more_info": CALL.format("db2", "dbo", "T7")}, "EXEC dbo.sp_Show @DatabaseName='db2', @SchemaName='dbo.T7"),
    ({"more_info": ""}, ""), ({"more_info": None}, None),
    ({"finding": KEYS, "details": "Foreign key [fk] on [dbo.T7] has no supporting index."}, "dbo.T7"),
    ({"finding": KEYS, "details": "Foreign key [fk] on [dbo.My Table] has no index."}, "dbo.My Table"),
    ({"finding": KEYS, "details": "Foreign key [fk] on [dbo].[T7] has no index."}, "dbo.[T7"),
    ({"finding": KEYS, "more_info": CALL.format("db1", "dbo", "T9")}, "dbo.T9")])
def test_table_name(spark, values, expected):
    assert run(spark, **values).table_name == expected


@pytest.mark.parametrize("values, expected", [
    ({"finding": WIDE, "details": "dbo.T has 40 total columns with a max possible width of 5000 bytes.3 columns are "
                                  "LOB types."}, "40 5000.3"),
    ({"finding": WIDE, "details": "dbo.T has 40 total columns with a max possible width of 5000 bytes. 3 columns are "
                                  "LOB types."}, "40 5000.3"),
    ({"finding": WIDE, "details": "dbo.T has 40 total columns with a max possible width of 5000 bytes."}, "40 5000"),
    ({"finding": "Index Hoarder: ADDICTED to nulls", "details": "dbo.T allows null in 18 of 20 columns."}, "18 20"),
    ({"finding": "x Wide Clustered Index (> 3 columns OR > 16 bytes)",
      "details": "4 columns with potential size of 40 bytes in clustered index:dbo.T"}, "4 40"),
    ({"finding": "x High Value Missing Index", "priority": 50,
      "usage": "1,234 uses; Impact: 99.5%; Avg query cost: 12.3456"}, "1,234;99.5%12.3456"),
    ({"finding": "x High Value Missing Index", "priority": 50,
      "usage": "1 use; Impact: 99.5%; Avg query cost: 12.3456"}, "1;99.5%12.3456"),
    ({"finding": "x High Value Missing Index", "priority": 51, "usage": "1 use; Impact: 9%"}, ""),
    ({"finding": "x Wide Indexes (7 or More Columns)", "priority": 150, "details": "9 columns on dbo.T"}, "9"),
    ({"finding": "x Wide Indexes (7 or More Columns)", "priority": 10, "details": "9 columns on dbo.T"}, "")])
def test_data_prep(spark, values, expected):
    assert run(spark, more_info=CALL.format("db1", "dbo", "T"), **values).data_prep == expected


@pytest.mark.parametrize("values, expected", [
    ({"create_tsql": "CREATE UNIQUE INDEX [ix7] ON [db1].[dbo].[T7] ([a]);"}, "ix7"),
    ({"create_tsql": "CREATE NONCLUSTERED INDEX [ix7] ON [x]"}, "ix7"),
    ({"create_tsql": "CREATE UNIQUE CLUSTERED INDEX [my index] ON [x]"}, "my index"),
    ({"create_tsql": "CREATE CLUSTERED COLUMNSTORE INDEX [cci] ON [x]"}, "cci"),
    ({"create_tsql": "ALTER TABLE [db1].[dbo].[T7] ADD CONSTRAINT [pk7] PRIMARY KEY CLUSTERED ([a]);"}, "pk7"),
    ({"create_tsql": "DROP INDEX [a]"}, ""),
    ({"finding": KEYS, "details": "Foreign key [fk7] on [dbo.T7] has no supporting index."}, "fk7"), ({}, "")])
def test_object_name(spark, values, expected):
    assert run(spark, **values).object_name == expected


def test_heap_title(spark):
    assert run(spark, priority=100, finding="Self Loathing Indexes: Large active HEAP").finding == \
        "Self Loathing Indexes: Large Active Heap"
    assert run(spark, priority=90, finding="Large active heap").finding == "Large active heap"


def test_derivations_stay_in_one_stage_of_generated_code(spark):
    df = spark.createDataFrame([BASE], "priority int, " + ", ".join(f"{c} string" for c in BASE if c != "priority"))
    plan = derive(df.union(df)).where(F.col("priority") == 70)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_sentences_are_read_whole_or_not_at_all(spark):
    from reportloom.operators.derive import read_sentences
    call = "EXEC dbo.sp_X @DatabaseName='a', @SchemaName='dbo', @TableName='it''s';"
    rows = [
        (150, "x: Wide Tables: 35+ cols or > 2000 non-LOB bytes", "dbo.T has 40 total columns with a max possible width of 2,100 bytes.", "", call, ""),
        (150, "x: wide tables: 35+ cols or > 2000 non-LOB bytes", "dbo.T has 40 total columns with a max possible width of 2100 bytes.3 columns are LOB types.", "", call, ""),
        (150, "x: Wide Tables: 35+ cols or > 2000 non-LOB bytes", "dbo.T has many columns.", "", call, ""),
        (50, "x: High Value Missing Index", None, "1 use; Impact: 9.5%; Avg query cost: 2.25", "EXEC dbo.other", "CREATE INDEX [a b] ON [T]"),
        (50, "x: High Value Missing Index", None, None, "", "ALTER TABLE [T] ADD CONSTRAINT [c] x"),
        (150, "x: Unindexed Foreign Keys", "Foreign key [f k] on [dbo.T] has no supporting index.", "", "", ""),
        (150, "x: Unindexed Foreign Keys", "Foreign key f", "", "", "CREATE STATISTICS s"),
        (None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "priority int, finding string, details string, usage string, more_info string, create_tsql string")
    found = [(r.data_prep, r.object_name, r.table_name, r.unread) for r in read_sentences(df, "unread").collect()]
    assert found == [
        ("40 2,100", "", "dbo.it''s", []), ("40 2100.3", "", "dbo.it''s", []), ("", "", "dbo.it''s", ["wide_tables"]),
        ("1;9.5%2.25", "a b", "", ["table_call"]), ("", "c", "", ["missing_index"]), ("", "f k", "dbo.T", []),
        ("", "", "", ["created_index", "foreign_key_table"]), ("", "", "", [])]
