"""Text and layout as rows: lines of texts, characters to lines, words to row markers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import squeeze


def text_lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, line_no (from 1), line (squeezed, not empty)."""
    lines = df.select(key, F.posexplode(F.split(text, r"\r?\n")).alias("n", "raw"))
    return lines.select(key, (F.col("n") + 1).alias("line_no"), squeeze(F.col("raw")).alias("line")).filter("line <> ''")


def layout_lines(chars: DataFrame, keys: list[str]) -> DataFrame:
    """chars: keys, seq, ch, top. Characters whose tops agree to a tenth make a line, in order of seq."""
    rows = chars.groupBy(*keys, F.round("top", 1).alias("top")).agg(F.array_sort(F.collect_list(F.struct("seq", "ch"))).alias("c"))
    return rows.select(*keys, "top", squeeze(F.array_join(F.transform("c", lambda x: x["ch"]), "")).alias("line"))


def row_markers(words: DataFrame, keys: list[str], x_below: float = 43, number_below: int = 10_000, bottom: float = 20) -> DataFrame:
    """words: keys, text, x0, top, page_height. Small numbers at the left edge, not in the footer; each once per page."""
    ok = F.col("text").rlike(r"^\d+$") & (F.col("x0") < x_below) & (F.col("text").try_cast("long") < number_below) & (F.col("top") < F.col("page_height") - bottom)
    return words.filter(ok).groupBy(*keys, "text").agg(F.min("top").alias("top"))


def box_text(chars: DataFrame, keys: list[str], x0: float, x1: float, top: float, bottom: float) -> DataFrame:
    """The text inside a box, by line and place."""
    inside = chars.filter(F.col("x0").between(x0, x1) & F.col("top").between(top, bottom))
    g = inside.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.round("top", 1).alias("t"), "x0", "ch"))).alias("c"))
    return g.select(*keys, squeeze(F.array_join(F.transform("c", lambda x: x["ch"]), "")).alias("text"))


def literal_map(df: DataFrame, text: str, name: str) -> DataFrame:
    """key, value pairs of an object literal assigned to a constant in a script's text."""
    body = F.regexp_extract(text, rf"(?s)const\s+{name}\s*=\s*\{{(.*?)\n?\}};", 1)
    pairs = F.regexp_extract_all(body, F.lit(r"""(["']?[\w]+["']?\s*:\s*"[^"]*")"""), F.lit(1))
    return df.select(F.explode(pairs).alias("p")).select(F.regexp_extract("p", r"""^["']?(\w+)""", 1).alias("key"), F.regexp_extract("p", r':\s*"([^"]*)"$', 1).alias("value"))


def fingerprint(df: DataFrame, content: str, name: str = "sha256") -> DataFrame:
    return df.withColumn(name, F.sha2(F.col(content).cast("binary"), 256))


def cell_grid(words: DataFrame, keys: list[str], row_gap: float = 3.0, column_gap: float = 6.0) -> DataFrame:
    """keys, cells (array<array<string>>): the table that words on a page form. words: keys, text, x0, x1, top. A row
    begins where tops leave a gap, a column where no word of the page reaches over a gap; the words of a cell are joined
    in reading order, and a cell without words is empty. A page is worked out by windows over its words."""
    down, along = W.partitionBy(*keys).orderBy("top"), W.partitionBy(*keys).orderBy("x0", "x1")
    reached = F.max("x1").over(along.rowsBetween(W.unboundedPreceding, -1))
    new_row = F.when(F.col("top") - F.lag("top").over(down) > row_gap, 1).otherwise(0)
    new_column = F.when(F.col("x0") > reached + column_gap, 1).otherwise(0)
    marked = words.select(*keys, "text", "x0", "x1", "top", new_row.alias("__r"), new_column.alias("__c"))
    placed = marked.select(*keys, "text", "x0", "top", F.sum("__r").over(down).alias("row"), F.sum("__c").over(along).alias("col"))
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("top", "x0", "text"))), lambda x: x["text"])
    cells = placed.groupBy(*keys, "row", "col").agg(F.array_join(in_order, " ").alias("cell"))
    wide = cells.withColumn("last", F.max("col").over(W.partitionBy(*keys)))
    filled = wide.groupBy(*keys, "row").agg(F.map_from_entries(F.collect_list(F.struct("col", "cell"))).alias("m"), F.max("last").alias("last"))
    lined = filled.withColumn("cells", F.transform(F.sequence(F.lit(0).cast("long"), "last"), lambda c: F.coalesce(F.try_element_at("m", c), F.lit(""))))
    return lined.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("row", "cells"))), lambda x: x["cells"]).alias("cells"))


def accreditation_rows(tables: DataFrame, rows: str) -> DataFrame:
    """array<array<string>> to official_name, level of its rows: English, B2 to C2, not excluded, named. The header is the
    first row that names a first surname and a name; columns go by what a header's cell holds. Rows that end before a
    column that is needed are left out."""
    from ..functions.text import folded, header_key, official_name

    r = F.col(rows)
    keys = F.transform(r, lambda row: F.transform(row, lambda c: header_key(F.coalesce(c, F.lit("")))))
    holds = lambda row, *names: F.transform(row, lambda c: F.greatest(*[c.contains(n) for n in (*names, names[0])]))
    names_both = lambda row: F.array_contains(holds(row, "apellido1"), True) & F.array_contains(holds(row, "nombre"), True)
    headed = tables.select(r.alias("r"), keys.alias("keys")).withColumn("h", F.array_position(F.transform("keys", names_both), True).cast("int")).filter("h > 0")
    at = lambda *names: F.nullif(F.array_position(holds(F.element_at("keys", F.col("h")), *names), True), F.lit(0))
    cell = lambda i: F.trim(squeeze(F.try_element_at("row", F.col(i).cast("int"))))
    opened = headed.select(
        at("apellido1", "cognom1").alias("a"), at("apellido2", "cognom2").alias("b"), at("nombre", "nom").alias("n"),
        at("idioma", "llengua").alias("i"), at("nivel", "nivell").alias("l"), at("motivos", "motius", "exclusion").alias("x"), F.explode(F.slice("r", F.col("h") + 1, F.size("r"))).alias("row"),
    )
    surnames = F.trim(F.concat_ws(" ", F.nullif(cell("a"), F.lit("")), F.nullif(cell("b"), F.lit(""))))
    english = folded(cell("i"), True).rlike("angles|ingles|english")
    level = F.regexp_replace(F.upper(cell("l")), "[^A-Z0-9]", "")
    ok = english & level.isin("B2", "C1", "C2") & (F.coalesce(cell("x"), F.lit("")) == "") & (cell("n") != "") & cell("a").isNotNull() & (surnames != "")
    return opened.filter(ok).select(official_name(F.concat(surnames, F.lit(", "), cell("n"))).alias("official_name"), level.alias("level"))
