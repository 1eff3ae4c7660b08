"""HTML text to table rows, rows to cells, cells to typed columns.

Everything here is narrow: a scan, one generator and projections, with no shuffle. A document is split into rows
before any cell is looked at, so the widest value after the first step is one table row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame, functions as F

from reportloom.functions.convert import empty_kept, empty_to_null, to_datetime
from reportloom.schema import Field

# Markup that reports carry around their tables, and what takes its place.
TOP_LINK = ('<a href="#top">Jump to top</a>', "")
LINE_BREAK = ("<br>", "")
EMPTY_CELL = ("<td></td>", "<td>x</td>")
STYLESHEET = ('<link rel="stylesheet" href="styles.css">', "")
SEARCH_BOX = ('<input type="text" id="SearchBox" class="SearchBox" onkeyup="SearchIndexUsage()" '
              'placeholder=" Filter by object name...">', "")
USAGE_TABLE = ("<table id='IndexUsgTable' class='IndexUsageTable sortable'>", "<table>")
USAGE_REPLACEMENTS = (TOP_LINK, LINE_BREAK, EMPTY_CELL, STYLESHEET, SEARCH_BOX, USAGE_TABLE)

TABLE_TAG = r"(?i)<(/?)table\b[^>]*>"
ANY_TAG = r"</?[A-Za-z][^<>]*>"
# The elements of HTML that have no content and so no end tag.
NO_CONTENT = r"(?i)^<(?:area|base|br|col|embed|hr|img|input|link|meta|param|source|track|wbr)\b|/>$"
ROW_END = r"(?i)</tr\s*>"
ROW_START = "<tr"
HEADING = r"(?is)<t[hd]\b[^>]*>(.*?)</t[hd]\s*>"
INNER_TAG = r"(?i)<(?!/?t[dhr]\b)[^>]*>"
UPPER_TAGS = ("<T", "</T")

REFERENCE = r"&(?:[A-Za-z][A-Za-z0-9]*|#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6});"
CELL_START = r"(?is)<td\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>"
CELL_END = r"(?i)</td\s*>"
# What a row of bare cells is cut at: its start, its end and what is between two cells. A cell that begins with a blank is not cut off.
PLAIN_CUT = r"^<tr>[ \t\n]*<td>(?![ \t\n])|</td>[ \t\n]*(?:<td>(?![ \t\n])|</tr>\z)"
# Signs that XML changes or refuses, and references that are none of its own.
ODD_SIGN = r"[\x00-\x08\x0b-\x1f\ufffe\uffff]"
ODD_REFERENCE = r"&(?!(?:amp|lt|gt|quot|apos);)"
XML_SIGNS = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&"))
CELLS_XML = "td array<string>, _corrupt_record string"
XML_OPTIONS = {"ignoreSurroundingSpaces": "false", "columnNameOfCorruptRecord": "_corrupt_record",
               "mode": "PERMISSIVE", "nullValue": "\u0000"}


def clean_markup(df: DataFrame, column: str, replacements: Sequence[tuple[str, str]]) -> DataFrame:
    """Literal replacements in the given order, in one projection."""
    cleaned = reduce(lambda text, pair: F.replace(text, F.lit(pair[0]), F.lit(pair[1])), replacements, F.col(column))
    return df.withColumn(column, cleaned)


def _plain_heading(text: Column) -> Column:
    return F.lower(F.regexp_replace(text, r"<[^>]*>|&[A-Za-z0-9#]+;|[^A-Za-z0-9]", ""))


def same_headings(first_row: Column, fields: Sequence[Field]) -> Column:
    """Whether a heading row names the fields in their order; case, blanks, marks and inner markup do not matter."""
    wanted = "|".join("".join(ch for ch in f.title if ch.isascii() and ch.isalnum()).lower() for f in fields)
    found = F.transform(F.regexp_extract_all(first_row, F.lit(HEADING), F.lit(1)), _plain_heading)
    return F.array_join(found, "|") == wanted


def _empty(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def level_change(segment: Column) -> Column:
    """``net, low`` of the tags in a piece of markup: how the number of open elements ends, and the least it gets to."""
    tags = F.regexp_extract_all(segment, F.lit(ANY_TAG), F.lit(0))
    step = lambda tag: F.when(F.startswith(tag, F.lit("</")), -1).when(tag.rlike(NO_CONTENT), 0).otherwise(1)
    zero = F.struct(F.lit(0).alias("net"), F.lit(0).alias("low"))
    return F.aggregate(tags, zero, lambda at, tag: F.struct(
        (at["net"] + step(tag)).alias("net"), F.least(at["low"], at["net"] + step(tag)).alias("low")))


def own_tables(html: Column, parents: bool = False) -> Column:
    """Array of ``no, first, text``: each table of a document with its own markup, nested tables cut out of it.

    Tables are numbered from 1 as they start. A stack holds those that are open; what follows a table's end belongs to the
    one around it again. With ``parents``, ``first`` says whether a table is the first one right inside its parent element,
    for which the open elements are counted; without, it is true of the first table alone. Arrays are copied at each table,
    so one document's work grows with the square of its number of tables, by eight bytes for each.
    """
    piece = "struct<no:int,first:boolean,parts:array<string>>"
    starts = F.regexp_extract_all(html, F.lit(TABLE_TAG), F.lit(1))
    segments = F.split(html, TABLE_TAG)
    between = F.arrays_zip(starts.alias("mark"), F.slice(segments, F.lit(2), F.greatest(F.size(starts), F.lit(1))).alias("text"))
    none = F.struct(F.lit(0).alias("net"), F.lit(0).alias("low"))
    change = level_change if parents else lambda _: none
    steps = F.transform(between, lambda x: F.struct(x["mark"].alias("mark"), x["text"].alias("text"), change(x["text"]).alias("to")))
    start = F.struct(_empty(piece).alias("open"), _empty(piece).alias("done"), F.lit(0).alias("n"),
                     change(F.get(segments, F.lit(0)))["net"].alias("depth"), _empty("int").alias("seen"))

    def table(no: Column, first: Column, parts: Column) -> Column:
        return F.struct(no.alias("no"), first.alias("first"), parts.alias("parts")).cast(piece)

    def merge(at: Column, x: Column) -> Column:
        opens = x["mark"] == ""
        first = ~F.array_contains(at["seen"], at["depth"]) if parents else at["n"] == 0
        top, around = F.element_at(at["open"], -1), F.slice(at["open"], F.lit(1), F.size(at["open"]) - 1)
        outer = F.element_at(around, -1)
        longer = table(outer["no"], outer["first"], F.concat(outer["parts"], F.array(x["text"])))
        back = F.when(F.size(around) == 0, around).otherwise(F.concat(F.slice(around, F.lit(1), F.size(around) - 1), F.array(longer)))
        some, inside = F.size(at["open"]) > 0, at["depth"] + F.when(opens, 1).otherwise(-1)
        seen = F.when(opens & first, F.concat(at["seen"], F.array(at["depth"]))).otherwise(at["seen"])
        return F.struct(
            F.when(opens, F.concat(at["open"], F.array(table(at["n"] + 1, first, F.array(x["text"]))))).when(some, back).otherwise(at["open"]).alias("open"),
            F.when(opens | ~some, at["done"]).otherwise(F.concat(at["done"], F.array(top))).alias("done"),
            F.when(opens, at["n"] + 1).otherwise(at["n"]).alias("n"),
            (inside + x["to"]["net"]).alias("depth"),
            F.filter(seen, lambda depth: depth <= F.least(inside, inside + x["to"]["low"])).alias("seen") if parents else at["seen"].alias("seen"))

    whole = lambda t: F.struct(t["no"].alias("no"), t["first"].alias("first"), F.array_join(t["parts"], "").alias("text"))
    found = F.transform(F.aggregate(steps, start, merge, lambda at: F.concat(at["done"], at["open"])), whole)
    one = F.array(F.struct(F.lit(1).alias("no"), F.lit(True).alias("first"), F.get(F.split(html, TABLE_TAG, 3), F.lit(1)).alias("text")))
    # most documents have one table, which is cut out at once
    return (F.when((F.regexp_count(html, F.lit(r"(?i)<table\b")) == 1) & (F.startswith(F.regexp_extract(html, TABLE_TAG, 0), F.lit("</")) == F.lit(False))
                   & (F.regexp_extract(html, TABLE_TAG, 0) != ""), one)
            .when(F.size(starts) > 0, found))


def row_starts(piece: str) -> Column:
    """Where the first row of a piece begins, from 1, 0 if there is none. Most pieces begin with it, and are not put in lower case."""
    return F.when(F.startswith(piece, F.lit(ROW_START)), 1).otherwise(F.locate(ROW_START, F.lower(piece)))


def shred_rows(docs: DataFrame, html: str = "html", fields: Sequence[Field] | None = None,
               all_tables: bool = False, each_parent: bool = False) -> DataFrame:
    """One output row per table row after the first, as ``table_pos, row_pos, tr``; other columns are kept.

    A row belongs to the innermost table around it, and the text of a nested table is none of the cell's that holds it. Only
    the first table of a document counts; ``each_parent`` takes every table that is the first one right inside its parent
    element, ``all_tables`` every one. A document without a table, or with a heading row alone, gives nothing. With
    ``fields``, ``header_ok`` says whether a table's heading row names those fields.

    A table is cut at its row end tags. The generators are outer ones with a filter on their position: for inner ones
    Catalyst would test the array's size below the generator and so cut every document a second time.
    """
    kept = [c for c in docs.columns if c != html]
    found = docs.select(*kept, own_tables(F.col(html), parents=each_parent and not all_tables).alias("_tables"))
    if all_tables or each_parent:
        tables = found.select(*kept, F.explode_outer("_tables").alias("_table"))
        tables = tables if all_tables else tables.where("_table.first")
    else:
        tables = found.select(*kept, F.get(F.filter("_tables", lambda t: t["first"]), F.lit(0)).alias("_table"))
    pieces = tables.select(*kept, (F.col("_table.no") - 1).alias("table_pos"), F.split("_table.text", ROW_END).alias("_pieces"))
    if fields is not None:
        pieces = pieces.select(*kept, "table_pos", "_pieces", same_headings(F.get("_pieces", F.lit(0)), fields).alias("header_ok"))
        kept = [*kept, "header_ok"]
    starts_at = row_starts("_piece")
    return (pieces.select(*kept, "table_pos", F.posexplode_outer("_pieces").alias("_pos", "_piece"))
            .where((F.col("_pos") > 0) & (starts_at > 0))
            .select(*kept, "table_pos", F.col("_pos").cast("bigint").alias("row_pos"),
                    F.concat(F.substr("_piece", starts_at), F.lit("</tr>")).alias("tr")))


def _named_references() -> Column:
    """Map of the character references that HTML has names for, as the standard library lists them."""
    pairs = [F.lit(x) for name, code in sorted(name2codepoint.items()) for x in (name, chr(code))]
    return F.create_map(*pairs)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it stands there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _decoded(text: Column) -> Column:
    """Character references by name, number or hexadecimal number, each once. One that is none stays as it is."""
    names = _named_references()

    def numbered(number: Column) -> Column:
        # a character's number as four bytes of UTF-32, which is the one encoding that every number fits
        return F.when((number > 0) & (number <= 0x10FFFF) & ~number.between(0xD800, 0xDFFF), F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))

    def meant(reference: Column) -> Column:
        # digits only, since a cast that fails costs an exception
        digits = F.nullif(F.regexp_extract(reference, "^&#([0-9]{1,7});$", 1), F.lit(""))
        hexadecimal = F.nullif(F.regexp_extract(reference, "(?i)^&#x([0-9a-f]{1,6});$", 1), F.lit(""))
        number = F.coalesce(digits, F.conv(hexadecimal, 16, 10)).try_cast("int")
        sign = F.when(F.startswith(reference, F.lit("&#")), _once(number, numbered)).otherwise(
            F.try_element_at(names, F.substr(reference, F.lit(2), F.length(reference) - 2)))
        return F.coalesce(sign, reference)

    between, found = F.split(text, REFERENCE), F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0))
    both = F.arrays_zip(between.alias("text"), F.transform(found, meant).alias("sign"))
    decoded = F.array_join(F.transform(both, lambda x: F.concat(x["text"], F.coalesce(x["sign"], F.lit("")))), "")
    return F.when(F.contains(text, F.lit("&")), decoded).otherwise(text)


def loose_cells(row: Column) -> Column:
    """Cells of a row as browsers read it, NULL if it cannot be cut safely.

    Attributes may lack quotes or values, a cell's end tag may be missing, ``&`` may stand alone and references may have any
    name of HTML. A cell reaches to its end tag, the next cell or the row's end. A row is not cut if a cell's start tag does
    not end, or if there is text outside its cells.
    """
    inside = F.regexp_replace(F.regexp_replace(row, r"(?is)^\s*<tr\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>", ""), r"(?is)</tr\s*>\s*$", "")
    without_tags = lambda x: F.regexp_replace(x, r"</?[A-Za-z!][^>]*>", "")
    behind_end = lambda x: F.regexp_replace(x, f"(?s)^.*?{CELL_END}", "")

    def cut(inside: Column, parts: Column) -> Column:
        starts = F.regexp_count(inside, F.lit(r"(?i)<td\b"))
        bodies = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))
        outside = F.exists(bodies, lambda x: x.rlike(CELL_END) & without_tags(behind_end(x)).rlike(r"\S"))
        texts = F.transform(bodies, lambda x: _once(without_tags(F.get(F.split(x, CELL_END, 2), F.lit(0))), _decoded))
        lost = (starts != F.size(parts) - 1) | without_tags(F.get(parts, F.lit(0))).rlike(r"\S") | outside
        return F.when(~lost, texts)

    return _once(inside, lambda text: _once(F.split(text, CELL_START), lambda parts: cut(text, parts)))


def _with_plain_cells(rows: DataFrame, tr: str) -> DataFrame:
    """Adds ``_plain``, the cells of a row that is nothing but ``<td>`` elements with text, as an XML parser reads them; else NULL."""
    whole = F.startswith(tr, F.lit("<tr>")) & F.endswith(tr, F.lit("</tr>"))
    cut = rows.withColumn("_parts", F.when(whole, F.split(tr, PLAIN_CUT)))
    n = F.size("_parts")
    odd = F.contains(tr, F.lit("]]>")) | F.col(tr).rlike(ODD_SIGN) | F.contains(tr, F.lit("&")) & F.col(tr).rlike(ODD_REFERENCE)
    sound = (n > 2) & (F.get("_parts", F.lit(0)) == "") & (F.get("_parts", n - 1) == "") & ~F.contains(F.array_join("_parts", ""), F.lit("<")) & ~odd
    inside = F.slice("_parts", F.lit(2), n - 2)
    decoded = F.transform(inside, lambda x: F.when(F.contains(x, F.lit("&")), reduce(
        lambda text, pair: F.replace(text, F.lit(pair[0]), F.lit(pair[1])), XML_SIGNS, x)).otherwise(x))
    return cut.withColumn("_plain", F.when(sound, F.when(F.contains(tr, F.lit("&")), decoded).otherwise(inside))).drop("_parts")


def cells(rows: DataFrame, tr: str = "tr", loose: bool = False) -> DataFrame:
    """Adds ``cells``, the text of every ``<td>`` in order, and ``problem``, NULL for a sound row.

    Cells are counted, not text nodes, so an empty cell never shifts its neighbours. Markup inside a cell is dropped
    before the row is read as XML and its text kept; entities are decoded once. A row that is not well formed gives
    no cells and a problem, or, if ``loose``, the cells that ``loose_cells`` finds; only such rows are read that way.
    Rows without any other markup are cut at their tags, which gives what the parser would.

    The result passes through a one-row generator. A filter on ``problem`` then stays above it; without it Catalyst
    would push the filter down and read every row twice.
    """
    other = F.col("_plain").isNull()
    bare = F.when(other, F.regexp_replace(F.replace(F.col(tr), F.lit(TOP_LINK[0]), F.lit("")), INNER_TAG, ""))
    lower = reduce(lambda text, tag: F.regexp_replace(text, f"(?i)(</?){tag}\\b", f"$1{tag}"), ("td", "tr"),
                   F.col("_bare"))
    has_upper = reduce(lambda a, b: a | b, [F.contains("_bare", F.lit(tag)) for tag in UPPER_TAGS])
    read = (_with_plain_cells(rows, tr).withColumn("_bare", bare)
            .withColumn("_row", F.when(other, F.from_xml(F.when(has_upper, lower).otherwise(F.col("_bare")), CELLS_XML,
                                                         XML_OPTIONS))))
    broken = F.col("_row._corrupt_record").isNotNull()
    found = F.when(~broken, F.coalesce("_plain", "_row.td", F.array().cast("array<string>")))
    if loose:
        link = F.replace(F.col(tr), F.lit(TOP_LINK[0]), F.lit(""))
        found = F.when(broken, loose_cells(link)).otherwise(found)
        result = F.transform(F.array(found), lambda x: F.struct(x.alias("cells"), F.when(x.isNull(), "malformed row").alias("problem")))
    else:
        result = F.array(F.struct(found.alias("cells"), F.when(broken, "malformed row").alias("problem")))
    return read.select(*rows.columns, F.inline(result))


def typed(rows: DataFrame, fields: Sequence[Field], keep: Sequence[str], empty_as_null: bool = True,
          failed: str | None = None) -> DataFrame:
    """Binds cells to columns by position and converts them.

    A cell beyond the end of its row is NULL. Blank text is NULL as well, or stays empty text when
    ``empty_as_null`` is off; blank numbers and dates are NULL in both cases. Numbers may have thousands separators.
    ``failed`` names a column for the positions of cells that hold something which does not convert; they are NULL.
    Blanks and dates are each settled by one pass over an array, which keeps a sixty-column projection small.
    """
    kept = [f for f in fields if f.kept]
    dates = [f for f in kept if f.type == "timestamp_ntz"]
    texts = F.transform("cells", empty_to_null if empty_as_null else empty_kept).alias("_texts")
    found = rows.select(*keep, texts)
    if dates:
        cells_of = F.array(*[F.get("_texts", F.lit(f.position - 1)) for f in dates])
        found = found.select(*keep, "_texts", F.transform(cells_of, to_datetime).alias("_dates"))

    def column(field: Field) -> Column:
        if field in dates:
            return F.get("_dates", F.lit(dates.index(field))).alias(field.name)
        text = F.get("_texts", F.lit(field.position - 1))
        if field.type != "string":
            text = F.replace(text, F.lit(","), F.lit("")).try_cast(field.type)
        return text.alias(field.name)

    if failed is None:
        return found.select(*keep, *[column(f) for f in kept])

    def unread(field: Field) -> Column:
        """NULL text makes the first comparison NULL, which counts as converted."""
        return F.when((F.get("_texts", F.lit(field.position - 1)) != "") & F.col(field.name).isNull(), field.position)

    marks = F.array_compact(F.array(*[unread(f) for f in kept if f.type != "string"])).cast("array<int>").alias(failed)
    return found.select(*keep, "_texts", *[column(f) for f in kept]).select(*keep, marks, *[f.name for f in kept])
