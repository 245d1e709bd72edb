"""Splitting oversized texts at natural boundaries, with overlap.

White space counts by runs: a run is one character of the measured text, a line feed where it holds a
line break, else a blank; outer white space does not count. The measured text is cut by prefix sums of token lengths and a sorted array
of boundaries: binary search finds the last boundary under the limit, the next piece starts the overlap
before the cut, and where no boundary fits the cut is hard. In the second half of the window the strongest kind
of boundary wins, else the last paragraph, item or sentence of the first half; a word only where there is none.

Defined results
---------------
* null, empty and blank texts have no pieces; a text within the limit is its own single piece;
* every piece has at most ``limit`` characters; each but the first repeats at most ``overlap`` last
  characters of the one before, from the start of a token where one fits;
* pieces without their overlaps, joined, are the measured text; repeated rows give repeated pieces;
* a text without any boundary (one token longer than the limit) is cut hard.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT, OVERLAP = 2_400, 200

#: White space that counts by runs (blank, tab, line feed, carriage return, no-break space).
SPACE = " \t\n\r "
RUN = re.compile(f"[{SPACE}]+")
BLANK_LINE = re.compile(r"\r\n[ \t ]*\r\n|\n[ \t ]*\n|\r[ \t ]*\r")
#: Start of a list item or paragraph sign behind a line break or a semicolon.
ITEM = re.compile(r"(?:[IVXLCDM]+|[a-z]{1,2}|\d{1,3}(?:\.\d+)*)\s?[-–—).]\s|§|Parágrafo\b|Art\.|[•\-–*]\s")
SENTENCE = re.compile(r"[.!?;:][\"'”’)\]]*$")


def measured(text: str | None) -> tuple[str, list[int]]:
    """The text with each run of white space as one character, and the places of its paragraph breaks."""
    text = (text or "").strip(SPACE)
    out: list[str] = []
    paragraphs: list[int] = []
    at = last = 0
    for m in RUN.finditer(text):
        out.append(text[last : m.start()])
        at += m.start() - last
        run = m[0]
        line = "\n" in run or "\r" in run
        out.append("\n" if line else " ")
        at += 1
        if line and BLANK_LINE.search(run):
            paragraphs.append(at)
        last = m.end()
    out.append(text[last:])
    return "".join(out), paragraphs


def tokens_and_boundaries(text: str, paragraphs: list[int]) -> tuple[np.ndarray, tuple[list[int], ...]]:
    """Starts of tokens (prefix sums of their lengths) and sorted boundaries: paragraphs, items, sentences, words."""
    parts = re.split(r"(?<=[ \n])", text)
    starts = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
    items, sentences = [], []
    at = 0
    before = ""
    for p in parts:
        if at and before:
            line = before.endswith("\n")
            if line and ITEM.match(text, at) or (before.rstrip().endswith((";", ":")) and ITEM.match(text, at)):
                items.append(at)
            elif line or SENTENCE.search(before.rstrip()) and not re.search(r"\b(?:art|arts|n|nº|inc|al|p|cf|ex)\.\s*$", before, re.I):
                sentences.append(at)
        at += len(p)
        before = p
    return starts, (paragraphs, items, sentences, [int(s) for s in starts[1:-1]])


def cuts(text: str, paragraphs: list[int], limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int, str]]:
    """``(start, end, boundary)`` of each piece of a measured text."""
    if not text:
        return []
    if len(text) <= limit:
        return [(0, len(text), "end")]
    starts, kinds = tokens_and_boundaries(text, paragraphs)
    words = kinds[3]
    pieces: list[tuple[int, int, str]] = []
    start = 0
    done = 0
    while True:
        if len(text) - start <= limit:
            pieces.append((start, len(text), "end"))
            return pieces
        end, kind = start + limit, "hard"
        least = max(done, start + limit // 2)
        fits = []
        for name, marks in zip(("paragraph", "item", "sentence", "word"), kinds, strict=True):
            k = bisect_right(marks, start + limit) - 1
            if k >= 0 and marks[k] > done:
                fits.append((marks[k], name))
        natural = [x for x in fits if x[1] != "word"]
        if late := [x for x in natural if x[0] > least]:
            end, kind = late[0]
        elif natural:
            end, kind = max(natural, key=lambda x: x[0])
        elif fits:
            end, kind = fits[0]
        pieces.append((start, end, kind))
        done = end
        k = bisect_left(words, max(end - overlap, start + 1))
        start = words[k] if k < len(words) and words[k] < end else (end - overlap if kind == "hard" else end)
        start = max(start, pieces[-1][0] + 1)


PIECES = "piece_no int, start int, end int, overlap int, boundary string, piece string"


def _split(key: str, text: str, limit: int, overlap: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            take: list[int] = []
            cols: dict[str, list] = {c: [] for c in ("piece_no", "start", "end", "overlap", "boundary", "piece")}
            for row, raw in enumerate(batch.column(text).to_pylist()):
                whole, paragraphs = measured(raw)
                done = 0
                for n, (a, b, kind) in enumerate(cuts(whole, paragraphs, limit, overlap), 1):
                    take.append(row)
                    for c, v in zip(cols, (n, a, b, done - a if n > 1 else 0, kind, whole[a:b]), strict=True):
                        cols[c].append(v)
                    done = b
            kept = batch.select([key]).take(pa.array(take, pa.int64()))
            kinds = [pa.int32()] * 4 + [pa.string()] * 2
            arrays = [pa.array(v, k) for v, k in zip(cols.values(), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*kept.columns, *arrays], names=[key, *cols])

    return run


def split_texts(docs: DataFrame, key: str, text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """``(key, piece_no, start, end, overlap, boundary, piece)`` of every text of ``docs``; a narrow map."""
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).where(F.col(text).isNotNull()).mapInArrow(_split(key, text, limit, overlap), f"`{key}` {kind}, {PIECES}")


def oversized(docs: DataFrame, key: str, text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """Pieces of the texts above the limit; only texts of more raw characters than the limit reach Python."""
    pieces = split_texts(docs.where(F.length(text) > limit), key, text, limit, overlap)
    return pieces.where((F.col("piece_no") > 1) | (F.col("boundary") != "end"))


def rejoined(pieces: DataFrame, key: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """``(key, whole, kept)``: MD5 of the pieces of each text joined without their overlaps; whether every piece keeps the limit and the overlap.

    A text is gathered again, as it was before it was cut. Keys stand for one text each; rows of a null key are left out.
    """
    fresh = F.struct("piece_no", F.expr("substring(piece, overlap + 1)").alias("t"))
    fits = (F.length("piece") <= limit) & F.col("overlap").between(0, overlap) & (F.length("piece") == F.col("end") - F.col("start"))
    each = pieces.where(F.col(key).isNotNull()).groupBy(key).agg(F.array_sort(F.collect_list(fresh)).alias("l"), F.min(fits).alias("kept"))
    return each.select(key, F.md5(F.array_join(F.transform("l", lambda x: x["t"]), "")).alias("whole"), "kept")
