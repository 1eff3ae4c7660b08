"""Reading report files: whole documents, or row by row where a file is too large to be one value."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reportloom.operators.markup import same_headings
from reportloom.operators.pieces import rows_of_tables
from reportloom.schema import Field
from reportloom.sources.scratch import materialise

# A larger file is read row by row. A whole document must fit one task's memory several times over.
WHOLE_FILE_LIMIT = 64 * 1024 * 1024
FILE_NAME = r"([^/]+)\.html?$"
FOLDER_NAME = r"([^/]+)/[^/]*$"


def report_id_of(path: Column, pattern: str | None) -> Column:
    """The report id a path holds, by the pattern's first group; the path itself where there is none.

    Report files of different servers often share a name, so only the whole path is unique without knowing more.
    """
    if pattern is None:
        return path
    found = F.regexp_extract(path, pattern, 1)
    return F.when(found == "", path).otherwise(found)


def html_files(source, glob: str):
    return source.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")


def read_reports(spark: SparkSession, path: str | list[str], glob: str = "*.html", id_pattern: str | None = None,
                 size_limit: int | None = None) -> DataFrame:
    """``report_id, source_path, html``, one row per file under a folder, a glob or a list of them.

    ``size_limit`` leaves larger files to ``read_report_rows``; the scan checks it before it opens a file.
    """
    files = html_files(spark.read, glob).load(path)
    if size_limit is not None:
        files = files.where(F.col("length") <= size_limit)
    return documents(files, id_pattern)


@contextmanager
def _stray_bytes_replaced(spark: SparkSession) -> Iterator[None]:
    """While columns are built, ``decode`` is told to replace what it cannot read; the setting is kept in the expression."""
    name = "spark.sql.legacy.codingErrorAction"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def encoding_of(start: bytes) -> str:
    """UTF-16 by its byte order mark or by a first character that has one byte only, else UTF-8."""
    first = start[:2]
    if first == b"\xff\xfe" or len(first) == 2 and first[0] and not first[1]:
        return "UTF-16LE"
    return "UTF-16BE" if first == b"\xfe\xff" or len(first) == 2 and first[1] and not first[0] else "UTF-8"


def _utf16(content: str) -> tuple[Column, Column]:
    """Whether binary text is UTF-16, with the lower byte first or the higher one, as ``encoding_of`` says."""
    one, two = (F.substring(F.hex(F.substring(content, 1, 2)), at, 2) for at in (1, 3))
    return (one == "FF") & (two == "FE") | (one != "00") & (two == "00"), (one == "FE") & (two == "FF") | (one == "00") & (two != "00")


def documents(files: DataFrame, id_pattern: str | None = None) -> DataFrame:
    """Binary file rows to documents, their text read as ``encoding_of`` says.

    A stray byte is replaced, so that it does not fail the whole load.
    """
    little, big = _utf16("content")
    with _stray_bytes_replaced(files.sparkSession):
        return files.select(report_id_of(one_spelling(F.col("path")), id_pattern).alias("report_id"),
                            one_spelling(F.col("path")).alias("source_path"),
                            F.when(little, F.decode("content", "UTF-16LE")).when(big, F.decode("content", "UTF-16BE"))
                            .otherwise(F.make_valid_utf8(F.col("content").cast("string"))).alias("html"))


def one_spelling(path: Column) -> Column:
    """Local paths come with one slash or with three, depending on the source that names them."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def plain_path(encoded: Column) -> Column:
    """The path that the binary source gives, out of the URL-encoded one in the metadata of other sources."""
    return one_spelling(F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B"))))


SPELLINGS = ("</tr", "</TR", "</Tr", "</tR")  # a row end as far as its name; the rest is cut off the piece behind it
FIRST_PIECES, LONGEST_PIECE, FIRST_BYTES = 4_096, 1 << 20, 1 << 18
UNSPLIT = str(1 << 50)


def literal_path(path: str) -> str:
    """A path that Spark takes as it is, although it may hold signs that stand for others in a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def file_forms(spark: SparkSession, path: str | list[str], glob: str = "*", size_above: int = -1) -> dict[tuple[str, str], list[str]]:
    """``(encoding, row end): files`` of the files above a size, with their paths as the text source names them.

    Files up to ``WHOLE_FILE_LIMIT`` are looked at as whole values, many in a task and without Python. For larger ones a task
    takes one file and ends after its first pieces, cut at ``>``, which every encoding spells with one byte of that value: they
    show the byte order and how the first row end is spelled. Only paths come to the driver, which holds all of them as
    Spark's own listing anyway.
    """
    forms = defaultdict(list)
    if size_above < WHOLE_FILE_LIMIT:
        whole = html_files(spark.read, glob).load(path).where(F.col("length").between(max(size_above + 1, 1), WHOLE_FILE_LIMIT))
        little, big = _utf16("content")
        text = F.replace(F.substring("content", 1, FIRST_BYTES).cast("string"), F.lit("\0"), F.lit(""))
        found = F.nullif(F.regexp_extract(text, "(?i)</tr", 0), F.lit(""))
        for row in whole.select(F.col("_metadata.file_path").alias("path"), F.when(little, "UTF-16LE").when(big, "UTF-16BE").otherwise("UTF-8").alias("encoding"),
                                F.coalesce(found, F.lit(SPELLINGS[0])).alias("row_end")).collect():
            forms[row.encoding, row.row_end].append(row.path)
        size_above = WHOLE_FILE_LIMIT
    session = spark.newSession()  # so that settings for this one scan change no other
    for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        session.conf.set(name, UNSPLIT)
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "256")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, text, encoding, seen = None, "", "", 0
        for batch in batches:
            pieces = batch.column(1).to_pylist()
            if path is None and pieces:
                path, encoding = batch.column(0)[0].as_py(), encoding_of(pieces[0] + b">")
            text += b">".join(pieces).replace(b"\0", b"").decode("ascii", "ignore")
            seen += len(pieces)
            if seen >= FIRST_PIECES or re.search("</tr", text, re.IGNORECASE):
                break
        if path is not None:
            found = re.search("</tr", text, re.IGNORECASE)
            yield pa.record_batch([pa.array([path]), pa.array([encoding]), pa.array([found[0] if found else SPELLINGS[0]])], ["path", "encoding", "row_end"])

    start = (session.read.option("lineSep", ">").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
             .option("mapreduce.input.linerecordreader.line.maxlength", str(LONGEST_PIECE)).text(path).where(F.col("_metadata.file_size") > size_above)
             .select(F.col("_metadata.file_path").alias("path"), F.col("value").cast("binary").alias("value")))
    for row in start.mapInArrow(look, "path string, encoding string, row_end string").collect():
        forms[row.encoding, row.row_end].append(row.path)
    return dict(forms)


def file_pieces(spark: SparkSession, path: str | list[str], glob: str = "*", size_above: int = -1) -> DataFrame | None:
    """``source_path, block, at, value``: the text of files up to each row end, cut by many tasks; None if there are no files.

    Each encoding and spelling of the row end is a scan of its own, so that its separator is right; other spellings are cut
    within its pieces. ``at`` is the block's start plus the order within the block: it grows along the file and leaves gaps.
    """
    forms, scans = file_forms(spark, path, glob, size_above), []
    for (encoding, row_end), names in forms.items():
        files = (spark.read.option("lineSep", row_end).option("encoding", encoding).option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
                 .text(path).where(F.col("_metadata.file_size") > size_above))
        if len(forms) > 1:
            files = files.where(F.col("_metadata.file_path").isin(names))
        with _stray_bytes_replaced(spark):
            raw = F.col("value").cast("binary")
            text = F.make_valid_utf8("value") if encoding == "UTF-8" else F.decode(raw, encoding)
            bare = F.regexp_replace(text, "^\ufeff?\\s*>?", "")
            scans.append(files.select(plain_path(F.col("_metadata.file_path")).alias("source_path"), F.col("_metadata.file_block_start").alias("block"),
                                      F.explode(F.split(bare, r"(?i)</tr\s*>")).alias("value")))
    if not scans:
        return None
    # numbered scan by scan: a scan's tasks read whole blocks, in their order
    numbered = [s.withColumn("at", F.col("block") + F.monotonically_increasing_id() % (1 << 33)) for s in scans]
    pieces = numbered[0]
    for other in numbered[1:]:
        pieces = pieces.unionByName(other)
    return pieces.select("source_path", "block", "at", "value")


def read_report_rows(spark: SparkSession, path: str | list[str], id_pattern: str | None = None, fields: Sequence[Field] | None = None,
                     all_tables: bool = False, each_parent: bool = False, glob: str = "*", size_above: int = -1) -> DataFrame:
    """``report_id, source_path, row_pos, tr`` for files of any size and encoding, with the rows that ``shred_rows`` finds in
    whole documents; with ``fields``, ``header_ok`` too.

    A row's place grows along its file and leaves gaps, which numbering by ``row_pos`` allows. Files with one table, which
    most are, need no more than a look at where it starts and ends, which is counted first; the others go through
    ``rows_of_tables``. ``size_above`` leaves smaller files out at the listing.
    """
    lines = file_pieces(spark, path, glob, size_above)
    if lines is None:  # no more jobs for files that are all small, as in most batches of a stream
        head = "" if fields is None else "header_ok boolean, "
        return spark.createDataFrame([], f"report_id string, source_path string, {head}row_pos long, tr string")
    tags = F.size(F.regexp_extract_all("value", F.lit(r"(?i)<table\b"), F.lit(0)))
    starts, ends = tags > 0, F.col("value").rlike(r"(?i)</table\b")
    row = F.col("value").rlike(r"(?i)<tr\b") & ~starts
    start, extra = F.when(starts, F.col("at")), []
    facts = [F.sum(tags).alias("_tables"), F.min(start).alias("_start"), F.min(F.when(ends, F.col("at"))).alias("_end")]
    if fields is not None:
        head = F.regexp_replace("value", r"(?is)^.*?<table\b[^>]*>", "")
        facts.append(F.min_by(same_headings(head, fields), start).alias("header_ok"))
        extra = ["header_ok"]
    per_file = materialise(lines.groupBy("source_path").agg(*facts))
    one = per_file.where("_tables = 1").drop("_tables")
    # the piece at the table's end may hold a last row without an end; an end before the start is a stray one
    inside = (F.col("at") > F.col("_start")) & (F.col("_end").isNull() | (F.col("_end") < F.col("_start")) | (F.col("at") <= F.col("_end")))
    tr = F.regexp_extract(F.when(ends, F.get(F.split("value", r"(?i)</table\b", 2), F.lit(0))).otherwise(F.col("value")), r"(?is)(<tr\b.*)", 1)
    kept = lines.where(row).join(one, "source_path").where(inside).where(tr != "").select(
        "source_path", *extra, F.col("at").alias("row_pos"), F.concat(tr, F.lit("</tr>")).alias("tr"))
    n_one, n_several = per_file.agg(F.count_if(F.col("_tables") == 1), F.count_if(F.col("_tables") > 1)).first()
    if n_several:
        several = rows_of_tables(lines.join(per_file.where("_tables > 1").select("source_path"), "source_path", "left_semi"), fields, all_tables, each_parent)
        kept = kept.unionByName(several) if n_one else several.select(*kept.columns)  # else all files would be read for nothing
    return kept.select(report_id_of(F.col("source_path"), id_pattern).alias("report_id"), "*")
