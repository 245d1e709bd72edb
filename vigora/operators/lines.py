"""From pages to clean lines: repeated headers and footers, noise, hyphens, paragraphs, titles.

Within a page everything but the count of repeated lines is a projection on arrays or text, so a page is cleaned
where it is read; the lines that repeat in a document come back to its pages as one small array. A document stays
rows of lines: what joins a line to the one before is decided by windows over the lines in order, joined runs are
aggregated on the same partitioning, and no row holds more than a paragraph.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vigora.operators import dialect as D


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(D.SPACES))


def rstrip(c: Column) -> Column:
    return F.rtrim(c, F.lit(D.SPACES))


def split_lines(text: Column) -> Column:
    """Lines of a text at any line end; a trailing line end makes no line; null gives null."""
    parts = F.split(text, D.BREAK, -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)


def ci(c: Column, pattern: str) -> Column:
    return c.rlike(f"(?iu){pattern}")


def is_noise(line: Column, patterns: Sequence[str]) -> Column:
    """One anchor for all patterns: a long line is told by its start and not tried anew at each sign."""
    start = f"^{D.S}*"
    return ci(line, start + "(?:" + "|".join(p.removeprefix(start).removeprefix("^") for p in patterns) + ")")


def repeated_lines(pages: DataFrame, band: int = 3, min_ratio: float = 0.5) -> DataFrame:
    """``(doc_id, line, n)``: lines in the first or last ``band`` lines of at least half of a document's pages.

    On a page of fewer than two bands the bands overlap and a line counts twice. Lines count from 3 to
    120 characters, and from the second time on. Pages of a null ``doc_id`` or null text have no lines.
    """
    said = F.filter(F.transform(split_lines("text"), strip), lambda x: x != "")
    # a page's lines are bound once, to the variable of an outer transform, and not made anew for each use
    ends = lambda x: F.concat(F.slice(x, F.lit(1), F.lit(band)), F.slice(x, F.greatest(F.size(x) - band + 1, F.lit(1)), F.lit(band)))
    placed = pages.where(F.col("doc_id").isNotNull())
    total = placed.groupBy("doc_id").agg(F.count("*").alias("pages"))
    bands = F.flatten(F.transform(F.array(said), ends))
    each = placed.where(F.col("text").isNotNull()).select("doc_id", F.explode(bands).alias("line")).where(F.length("line").between(3, 120))
    counted = each.groupBy("doc_id", "line").agg(F.count("*").alias("n")).where("n >= 2")
    return counted.join(total, "doc_id").where(F.col("n") / F.col("pages") >= min_ratio).select("doc_id", "line", "n")


def kept_lines(pages: DataFrame, how: D.Dialect) -> DataFrame:
    """``(doc_id, page_no, lines)``: the lines of each page without repeated ones and noise; blank lines stay, empty."""
    again = repeated_lines(pages).groupBy("doc_id").agg(F.collect_set("line").alias("again"))
    lines = F.transform(split_lines("text"), lambda x: F.struct(rstrip(x).alias("r"), strip(x).alias("s")))
    quiet = F.filter(lines, lambda x: (x["s"] == "") | ~is_noise(x["s"], how.noise))
    texts = F.transform(quiet, lambda x: F.when(x["s"] == "", "").otherwise(x["r"]))
    # noise goes where a page is read; after the exchange by document only the few repeated lines are looked for
    each = pages.select("doc_id", "page_no", F.coalesce(texts, F.array().cast("array<string>")).alias("lines"))
    known = each.join(again, "doc_id", "left")
    kept = F.when(F.col("again").isNull(), F.col("lines")).otherwise(F.filter("lines", lambda x: ~F.array_contains(F.col("again"), strip(x))))
    return known.select("doc_id", "page_no", kept.alias("lines"))


def dehyphenate(text: Column) -> Column:
    return F.regexp_replace(text, r"([\p{L}\p{N}_])-\n([\p{L}\p{N}_])", "$1$2")


def merge_orphans(text: Column) -> Column:
    """A line that is only a number goes before the next non-blank line, which is taken even if it is one itself."""
    number = rf"(?:\d+[A-Z]?\.|\d+(?:\.\d+)+[A-Z]?|[A-Z]\.?\d+(?:\.\d+)*[A-Z]?\.?)"
    line = rf"(?m)^(?:(?!\n){D.S})*(?=[^\n]{{1,12}}(?:(?!\n){D.S})*$)({number})(?:(?!\n){D.S})*\n(?:(?:(?!\n){D.S})*\n)*(?:(?!\n){D.S})*({D.NOT_S}[^\n]*?)(?:(?!\n){D.S})*$"
    return F.regexp_replace(text, line, "$1 $2")


TITLE = rf"^[{D.CAPS}](?:[{D.CAPS}0-9\-]|{D.S}){{2,79}}$"
#: Possessive, since a line has no greatest length and each turn of a group that may go back takes stack; it never has to.
SPACED_TITLE = rf"^(?:[{D.CAPS}]{D.S}+){{2,}}+[{D.CAPS}]$"


def merge_titles(lines: Column) -> Column:
    """Adjacent lines in capitals become one title; letter-spaced titles close up, but for continuation lines."""
    told = F.transform(lines, lambda x: F.struct(x.alias("raw"), strip(x).alias("s"), strip(x).rlike(TITLE).alias("title")))

    def whole(said: Column) -> Column:
        def piece(x: Column, i: Column) -> Column:
            follows = (i > 0) & x["title"] & F.coalesce(F.get(said, i - 1)["title"], F.lit(False))
            led = x["title"] & F.coalesce(F.get(said, i + 1)["title"], F.lit(False))
            shut = F.when(x["s"].rlike(SPACED_TITLE), F.regexp_replace(x["s"], f"{D.S}+", "")).when(led, x["s"]).otherwise(x["raw"])
            return F.concat(F.when(i == 0, "").when(follows, " ").otherwise("\n"), F.when(follows, x["s"]).otherwise(shut))

        return F.array_join(F.transform(said, piece), "")

    return F.get(F.transform(F.array(told), whole), F.lit(0))


def rejoin(text: Column, how: D.Dialect) -> Column:
    """A line goes on the one before unless that is blank or ends a sentence, or the line starts a unit."""

    def whole(said: Column) -> Column:
        def piece(x: Column, i: Column) -> Column:
            before = F.get(said, i - 1)
            start = ci(x, how.start) if how.start_ci else x.rlike(how.start)
            goes_on = F.coalesce((before != "") & (x != "") & ~F.right(before, F.lit(1)).isin(".", ":", ";") & ~start, F.lit(False))
            return F.concat(F.when(i == 0, "").when(goes_on, " ").otherwise("\n"), x)

        return F.array_join(F.transform(said, piece), "")

    return F.get(F.transform(F.array(F.transform(F.split(text, "\n", -1), strip)), whole), F.lit(0))


def tidy(text: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(text, r"[ \t]+", " "), r"\n{3,}", "\n\n"))


def in_order(column: Column) -> Column:
    """``column`` over the rows of a document up to this one, by their place ``at``."""
    return column.over(W.partitionBy("doc_id").orderBy("at"))


def join_runs(rows: DataFrame, goes_on: Column, piece: Column) -> DataFrame:
    """Rows ``(doc_id, at, line)``, those that go on appended to the row before them; pieces may use ``_on`` and ``_next_on``."""
    told = rows.withColumn("_on", F.coalesce(goes_on, F.lit(False)))
    runs = told.select("*", in_order(F.sum((~F.col("_on")).cast("bigint"))).alias("_run"), in_order(F.lead("_on", 1, False)).alias("_next_on"))
    made = runs.groupBy("doc_id", "_run").agg(F.array_sort(F.collect_list(F.struct("at", piece.alias("p")))).alias("l"))
    return made.select("doc_id", F.col("_run").alias("at"), F.array_join(F.transform("l", lambda x: x["p"]), "").alias("line"))


def join_hyphens(rows: DataFrame) -> DataFrame:
    """A word cut at the end of a line is closed up; a single letter between two hyphens joins both sides."""
    before = in_order(F.lag("line"))
    cut = before.endswith("-") & before.rlike(r"[\p{L}\p{N}_]-$") & F.col("line").rlike(r"^[\p{L}\p{N}_]")
    return join_runs(rows, cut, F.when(F.col("_next_on"), F.expr("left(line, length(line) - 1)")).otherwise(F.col("line")))


ORPHAN = r"^(?:\d+[A-Z]?\.|\d+(?:\.\d+)+[A-Z]?|[A-Z]\.?\d+(?:\.\d+)*[A-Z]?\.?)$"


def join_orphans(rows: DataFrame) -> DataFrame:
    """As ``merge_orphans`` over rows: of consecutive lone numbers the odd ones take the next non-blank line."""
    bare = strip(F.col("line"))
    told = rows.withColumn("_s", bare).withColumn("_said", F.col("_s") != "")
    told = told.withColumn("_number", F.col("_said") & (F.length("_s") <= 12) & F.col("_s").rlike(ORPHAN))
    counted = told.select("*", in_order(F.sum(F.col("_said").cast("bigint"))).alias("_k"), F.sum(F.col("_said").cast("bigint")).over(W.partitionBy("doc_id")).alias("_all"))
    run = counted.withColumn("_since", F.coalesce(in_order(F.last(F.when(F.col("_said") & ~F.col("_number"), F.col("_k")), ignorenulls=True)), F.lit(0)))
    heads = run.withColumn("_head", F.col("_number") & ((F.col("_k") - F.col("_since")) % 2 == 1) & (F.col("_k") < F.col("_all")))
    up_to = W.partitionBy("doc_id").orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    before = F.last(F.when(F.col("_said"), F.col("_head")), ignorenulls=True).over(up_to)
    piece = F.when(F.col("_head"), F.col("_s")).when(F.col("_on") & ~F.col("_said"), "").when(F.col("_on"), F.concat(F.lit(" "), F.col("_s"))).otherwise(F.col("line"))
    return join_runs(heads.withColumn("_taken", before), F.col("_taken"), piece)


def join_titles(rows: DataFrame) -> DataFrame:
    """As ``merge_titles`` over rows."""
    told = rows.withColumn("_s", strip(F.col("line"))).withColumn("_title", F.col("_s").rlike(TITLE))
    follows = in_order(F.lag("_title", 1, False)) & F.col("_title")
    shut = F.when(F.col("_s").rlike(SPACED_TITLE), F.regexp_replace("_s", f"{D.S}+", ""))
    alone = F.when(F.col("_next_on"), F.coalesce(shut, F.col("_s"))).otherwise(F.coalesce(shut, F.col("line")))
    return join_runs(told, follows, F.when(F.col("_on"), F.concat(F.lit(" "), F.col("_s"))).otherwise(alone))


def join_paragraphs(rows: DataFrame, how: D.Dialect) -> DataFrame:
    """As ``rejoin`` over rows."""
    told = rows.withColumn("line", strip(F.col("line")))
    before = in_order(F.lag("line"))
    start = ci(F.col("line"), how.start) if how.start_ci else F.col("line").rlike(how.start)
    goes_on = (before != "") & (F.col("line") != "") & ~F.right(before, F.lit(1)).isin(".", ":", ";") & ~start
    return join_runs(told, goes_on, F.when(F.col("_on"), F.concat(F.lit(" "), F.col("line"))).otherwise(F.col("line")))


def clean_lines(pages: DataFrame, how: D.Dialect = D.LAW) -> DataFrame:
    """``(doc_id, line_no, line)``: the cleaned lines of each document, its pages in order of ``page_no``.

    Blank lines stay, one of several in a row, none at either end. Pages of a null ``doc_id`` or null text have no lines;
    a document without lines has no rows.
    """
    kept = kept_lines(pages.where(F.col("doc_id").isNotNull()), how)
    rows = kept.select("doc_id", "page_no", F.posexplode("lines").alias("i", "line")).select("doc_id", F.struct("page_no", "i").alias("at"), "line")
    rows = join_hyphens(rows)
    if how.orphans:
        rows = join_orphans(rows)
    if how.titles:
        rows = join_titles(rows)
    rows = join_paragraphs(rows, how)
    thin = rows.select("doc_id", "at", F.regexp_replace("line", r"[ \t]+", " ").alias("line"))
    last = F.max(F.when(F.col("line") != "", F.col("at"))).over(W.partitionBy("doc_id"))
    told = thin.select("*", in_order(F.lag("line", 1, "")).alias("_before"), last.alias("_last"))
    held = told.where((F.col("line") != "") | ((F.col("_before") != "") & (F.col("at") < F.col("_last"))))
    return held.select("doc_id", F.col("at").alias("line_no"), "line")


def needs_ocr(text: Column, min_chars: int = 40) -> Column:
    return F.length(strip(text)) < min_chars


def choose_text(text: Column, ocr: Column, mode: str = "auto") -> Column:
    """The text read by recognition only where asked for and strictly longer; modes auto, force, off."""
    asked = {"auto": F.coalesce(needs_ocr(text), F.lit(True)), "force": F.lit(True), "off": F.lit(False)}[mode]
    longer = F.coalesce(F.length(ocr) > F.coalesce(F.length(text), F.lit(0)), F.lit(False))
    return F.when(asked & longer, ocr).otherwise(text)
