"""Annex tables kept in long form: one row per table row, cells and header as arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vigora.operators.lines import strip

TABLE = ("slug", "csv")


def clean_cells(cells: Column) -> Column:
    """Null cells become empty, outer white space goes; a null row is an empty one."""
    return F.transform(F.coalesce(cells, F.array().cast("array<string>")), lambda c: strip(F.coalesce(c, F.lit(""))))


def distinct_rows(annexes: DataFrame) -> DataFrame:
    """One row per key ``(slug, csv, row_no)``: of rows repeated with other content the greatest."""
    placed = annexes.where(F.col("slug").isNotNull() & F.col("csv").isNotNull() & F.col("row_no").isNotNull())
    rows = placed.select("slug", "csv", "row_no", clean_cells(F.col("header")).alias("header"), clean_cells(F.col("cells")).alias("cells"))
    return rows.groupBy("slug", "csv", "row_no").agg(F.max(F.struct("header", "cells")).alias("r")).select("slug", "csv", "row_no", "r.*")


def fill_header(header: Column) -> Column:
    return F.transform(header, lambda h, i: F.when(h == "", F.concat(F.lit("col"), i)).otherwise(h))


def fit(cells: Column, header: Column) -> Column:
    """Cells padded with empty ones or cut to the width of the header."""
    n = F.size(header)
    return F.slice(F.concat(cells, F.array_repeat(F.lit(""), n)), F.lit(1), n)


def routing(rows: DataFrame, min_rows: int = 8, min_cols: int = 3) -> DataFrame:
    """``(slug, csv, body, cols, to_csv)``: a table is kept apart if long enough, or wide and of four rows."""
    size = rows.groupBy(*TABLE).agg(
        F.count("*").alias("body"), F.max(F.greatest(F.size("header"), F.size("cells"))).cast("bigint").alias("cols")
    )
    return size.withColumn("to_csv", (F.col("body") >= min_rows) | ((F.col("cols") >= min_cols) & (F.col("body") >= 4)))


def numbering(routed: DataFrame) -> DataFrame:
    """Accepted tables of each norm, numbered in order: ``anexo_NN.csv``."""
    order = W.partitionBy("slug").orderBy("csv")
    kept = routed.where("to_csv").withColumn("n", F.row_number().over(order))
    return kept.select("slug", "csv", F.format_string("anexo_%02d.csv", "n").alias("arquivo"))


def without_contents(rows: DataFrame, last_page: int = 2) -> DataFrame:
    """Drops tables of contents: on the first pages, rows that speak of items or a summary; ``page`` may be null."""
    toc = F.exists("cells", lambda c: c.rlike("Item|Sum")) | F.exists("header", lambda c: c.rlike("Item|Sum"))
    marked = rows.groupBy(*TABLE).agg(F.max((toc & (F.col("page") <= last_page)).cast("int")).alias("toc"))
    return rows.join(marked.where("coalesce(toc, 0) = 0").select(*TABLE), list(TABLE), "left_semi")


def markdown_rows(rows: DataFrame) -> DataFrame:
    """``(slug, csv, row_no, line)``: each body row as a row of a Markdown table of its header's width."""
    line = F.concat(F.lit("| "), F.array_join(fit(F.col("cells"), F.col("header")), " | "), F.lit(" |"))
    return rows.select("slug", "csv", "row_no", line.alias("line"))


def markdown_head(header: Column) -> Column:
    rule = F.array_join(F.transform(header, lambda _: F.lit("---")), " | ")
    return F.concat(F.lit("| "), F.array_join(header, " | "), F.lit(" |\n| "), rule, F.lit(" |"))


def stitch(rows: DataFrame) -> DataFrame:
    """``(slug, csv, table_no)``: consecutive tables of a norm that continue one another.

    A table continues the one before it if their headers are equal, or its header is as wide and looks
    like data (a cell with digits, or an unnamed column).
    """
    tables = rows.groupBy(*TABLE).agg(F.min_by("header", "row_no").alias("header"))
    order = W.partitionBy("slug").orderBy("csv")
    before = F.lag("header").over(order)
    data = F.exists("header", lambda h: h.rlike(r"^\d|\d{4}|^col\d+$|^$"))
    goes_on = (F.col("header") == before) | ((F.size("header") == F.size(before)) & data)
    marked = tables.withColumn("new", (~F.coalesce(goes_on, F.lit(False))).cast("int"))
    return marked.select("slug", "csv", F.sum("new").over(order).alias("table_no"))


def code_lookup(rows: DataFrame, pattern: str = r"\d{4}\.\d{2}\.\d{2}") -> DataFrame:
    """``(code, slug, csv, row_no)``: where each full code stands, in any cell."""
    each = rows.select("slug", "csv", "row_no", F.explode("cells").alias("cell"))
    found = each.select("slug", "csv", "row_no", F.explode(F.regexp_extract_all("cell", F.lit(f"({pattern})"), F.lit(1))).alias("code"))
    return found.select("code", "slug", "csv", "row_no").distinct()


def from_page_tables(tables: DataFrame, last_contents_page: int = 0) -> DataFrame:
    """Rows ``(slug, csv, row_no, header, cells, page, to_csv)`` of tables as an extractor finds them: ``(slug, page, table_no, rows)``.

    ``rows`` is an array of arrays of cells, the first of them the header. Tables of fewer than two rows are skipped, as are
    tables of contents up to ``last_contents_page``; of the others those that are kept apart are numbered in order of page
    and table (``anexo_NN.csv``), the small ones keep ``page_table`` as their name. Null ids and null tables are left out.
    """
    clean = F.transform("rows", clean_cells)
    held = tables.where(F.col("slug").isNotNull()).select("slug", "page", "table_no", clean.alias("rows")).where(F.size("rows") >= 2)
    speaks = F.exists("rows", lambda r: F.exists(r, lambda c: c.rlike("Item|Sum")))
    held = held.where(~(speaks & F.coalesce(F.col("page") <= last_contents_page, F.lit(False))))
    body = F.size("rows") - 1
    cols = F.array_max(F.transform("rows", lambda r: F.size(r)))
    routed = held.withColumn("to_csv", (body >= 8) | ((cols >= 3) & (body >= 4)))
    order = W.partitionBy("slug", "to_csv").orderBy("page", "table_no")
    named = routed.withColumn("_n", F.row_number().over(order))
    csv = F.when(F.col("to_csv"), F.format_string("anexo_%02d.csv", "_n")).otherwise(F.concat_ws("_", "page", "table_no"))
    each = named.select("slug", csv.alias("csv"), F.get("rows", F.lit(0)).alias("header"), F.posexplode("rows").alias("row_no", "cells"), "page", "to_csv")
    header = F.when(F.col("to_csv"), fill_header(F.col("header"))).otherwise(F.col("header"))
    return each.where("row_no > 0").select("slug", "csv", "row_no", header.alias("header"), "cells", "page", "to_csv")
