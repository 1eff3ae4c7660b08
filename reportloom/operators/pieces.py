"""Tables of documents that come in pieces, cut at row ends, because one value could not hold them.

Nothing here puts a document into one task: depths and places are running sums over bounded blocks of it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from reportloom.operators.markup import TABLE_TAG, level_change, row_starts, same_headings
from reportloom.operators.numbering import latest, running
from reportloom.schema import Field
from reportloom.sources.scratch import materialise

DOCUMENT = "source_path"
BEFORE_TABLE_TAG = r"(?i)(?=</?table\b[^>]*>)"


def _first_of_parents(marked: DataFrame) -> DataFrame:
    """``source_path, owner`` of the tables that are the first one right inside their parent element.

    One row per table holds the number of open elements around it and the least that number gets to before the next
    table. Where that is below an earlier table's number, the parent of that one has ended.
    """
    deep = running(marked, [DOCUMENT], "block", "at", {"depth": F.col("net"), "nth": F.col("opens").cast("int")})
    before = F.col("depth") - F.col("net")
    tables = deep.groupBy(DOCUMENT, "nth").agg(F.max(F.when(F.col("opens"), F.col("at"))).alias("owner"), F.max(F.when(F.col("opens"), before)).alias("around"),
                                               F.min(before + F.col("low")).alias("least"), F.max("depth").alias("most"))
    found = tables.where("nth > 0").select(DOCUMENT, F.col("around").alias("d"), F.struct("nth", F.lit(0).alias("kind")).alias("when"), "owner")
    reach = F.sequence(F.col("least") + 1, F.greatest("most", "around", F.col("least") + 1))
    ended = tables.where("nth > 0").select(DOCUMENT, F.explode(reach).alias("d"), F.struct("nth", F.lit(1).alias("kind")).alias("when"),
                                              F.lit(None).cast(marked.schema["at"].dataType).alias("owner"))
    events = found.unionByName(ended)
    last = F.lag(F.struct("owner")).over(Window.partitionBy(DOCUMENT, "d").orderBy("when"))
    return events.withColumn("_last", last).where("owner IS NOT NULL AND _last.owner IS NULL").select(DOCUMENT, "owner")


def rows_of_tables(pieces: DataFrame, fields: Sequence[Field] | None = None, all_tables: bool = False, each_parent: bool = False) -> DataFrame:
    """``source_path, row_pos, tr`` out of ``source_path, block, at, value``, as ``shred_rows`` finds them in whole documents.

    A piece is the text up to a row end; ``at`` grows along a document, ``block`` names the bounded part of it that a piece
    is in. With ``fields``, ``header_ok`` is added. Pieces are cut again at table tags and written once. A row's place is that
    of the piece it ends with, which is no other row's.
    """
    cut = pieces.select(DOCUMENT, "block", "at", F.posexplode(F.split("value", BEFORE_TABLE_TAG)).alias("i", "_cut"), F.size(F.split("value", BEFORE_TABLE_TAG)).alias("_n"))
    tag = F.regexp_extract("_cut", "^" + TABLE_TAG, 0)
    opens = (tag != "") & ~F.startswith(tag, F.lit("</"))
    closes = F.startswith(tag, F.lit("</"))
    text = F.substr("_cut", F.length(tag) + 1)
    change = level_change(F.col("_cut")) if each_parent and not all_tables else F.struct(F.lit(0).alias("net"), F.lit(0).alias("low"))
    parts = cut.select(DOCUMENT, "block", F.struct("at", "i").alias("at"), opens.alias("opens"), closes.alias("closes"), text.alias("text"),
                       (F.col("i") == F.col("_n") - 1).alias("ends"), change.alias("to"))
    # the row end that a piece was cut at closes an element too
    net = F.col("to.net") - F.col("ends").cast("int")
    marked = materialise(parts.select("*", net.alias("net"), F.least("to.low", net).alias("low")).drop("to"))
    marked = marked.withColumn("step", F.when(F.col("opens"), 1).when(F.col("closes"), -1).otherwise(0))
    levels = running(marked, [DOCUMENT], "block", "at", {"level": F.col("step")}).where("level > 0")
    owned = materialise(latest(levels, [DOCUMENT, "level"], "block", "at", F.when(F.col("opens"), F.col("at")), "owner").where("owner IS NOT NULL"))
    counted = running(owned, [DOCUMENT, "owner"], "block", "at", {"row": F.col("ends").cast("int")})
    row = F.col("row") - F.col("ends").cast("int")
    texts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "text"))), lambda x: x["text"]), "")
    rows = materialise(counted.groupBy(DOCUMENT, "owner", row.alias("row")).agg(texts.alias("value"), F.max("at.at").alias("row_pos")))
    if all_tables:
        wanted = rows.where("row = 0").select(DOCUMENT, "owner")
    elif each_parent:
        wanted = _first_of_parents(marked)
    else:
        wanted = rows.where("row = 0").groupBy(DOCUMENT).agg(F.min("owner").alias("owner"))
    extra = []
    if fields is not None:
        heads = rows.where("row = 0").select(DOCUMENT, "owner", same_headings(F.col("value"), fields).alias("header_ok"))
        wanted, extra = wanted.join(heads, [DOCUMENT, "owner"]), ["header_ok"]
    starts_at = row_starts("value")
    body = rows.where(F.col("row") > 0).where(starts_at > 0).join(wanted, [DOCUMENT, "owner"])
    return body.select(DOCUMENT, *extra, "row_pos", F.concat(F.substr("value", starts_at), F.lit("</tr>")).alias("tr"))
