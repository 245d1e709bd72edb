"""Several values packed in one field: a parsing expression grammar over cells of codes.

Grammar (ordered alternatives; the first that matches wins, else the parser backtracks):

    cell      <- (filler / item)*
    item      <- quoted / bracketed / bare
    quoted    <- OPEN (!CLOSE .)* CLOSE      its inside is a cell; without CLOSE: backtrack, skip the quote, error flag
    bracketed <- '(' ... ')' / '[' ... ']'   by nesting; its inside is a cell if it holds nothing but codes, else a note
    bare      <- note / date / quantity / marker / code exception? / word
    exception <- (',' / '-')? 'Ex' '.'? '-'? NUMBER

Defined results
---------------
* null, empty and filler cells, and cells without a code, give no rows;
* positions count codes from 1 in order of writing, repeated codes included;
* ``flags`` of a row tells of a malformed quote or bracket in its cell; parsing goes on behind it;
* very long and deeply nested cells are parsed in one pass; repeated rows of a key count once.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: An opening quote and the marks that may close it.
QUOTES = {'"': '"', "'": "'", "“": "”", "”": "”", "‘": "’", "«": "»"}
BRACKETS = {"(": ")", "[": "]", "{": "}"}

DATE = re.compile(r"(?:at[ée]|desde|de|em|a\s+partir\s+de)?\s*(?:3[01]|[12]\d|0?[1-9])([./-])(?:1[0-2]|0?[1-9])\1(?:19|20)\d{2}(?![\d.])", re.I)
NOTE = re.compile(r"(?:nota|notas|obs|item|itens|art|arts|lei|decreto|cap[íi]tulo|anexo)\b\.?\s*(?:n[ºo°]\s*)?\d*(?:\.\d+)*(?:/\d+)?", re.I)
CODE = re.compile(r"\d+(?:\.\d+)*")
SHAPE = re.compile(
    r"\d{4}(?:\.\d{1,2}){0,3}|\d{2}\.\d{2}(?:\.\d{1,2}){0,2}|\d{4}\.\d{3,4}|\d{5,10}"  # NCM/SH
    r"|\d\.\d{4}(?:\.\d{1,2}){0,3}|\d\.\d{2}(?:\.\d{2}){1,3}|\d{9}"  # NBS
)
EXCEPTION = re.compile(r"[\s,;]*(?:[-–—]\s*)?\(?\bex\b\.?\s*[-–—]?\s*(?:n[ºo°]\s*)?(\d{1,3})(?![\d.]*\d)\)?", re.I)
QUANTITY = re.compile(r"\d[\d.,]*\s*(?:un|unid|unidades?|kg|g|t|l|ml|m|m2|m³|m²|cm|mm|%|p[çc]s?|cx|dz|par|pares|kwh|anos?|meses|dias?)\b\.?(?!\))|\d[\d.,]*\s*%", re.I)
MARKER = re.compile(r"(?:[a-z]{1,2}|[ivx]+|\d{1,2})\s*\)(?=\s)|[a-z]\.(?=\s\d)", re.I)
WORD = re.compile(r"[^\W\d_]+(?:[-'][^\W\d_]+)*\.?")
MONEY = re.compile(r"R\$\s*[\d.,]+")

Parsed = tuple[list[str], int]
MALFORMED_QUOTE, MALFORMED_BRACKET = 1, 2


def parse(cell: str | None) -> Parsed:
    """Codes of a cell in order of writing, and flags: 1 malformed quote, 2 malformed bracket.

    The inside of a quote is read on as a cell; that of a bracket counts as a whole, with what it nests, if it holds
    nothing but codes, else it is a note. Quotes and brackets may nest to any depth.
    """
    if not cell:
        return [], 0
    codes: list[str] = []
    flags = _cell(cell, 0, len(cell), codes, _matched(cell))
    return codes, flags


def _matched(s: str) -> dict[int, int]:
    """Place of the closing mark of each bracket that has one; an unmatched mark inside a bracket does not hide it."""
    found: dict[int, int] = {}
    open_: list[int] = []
    for i, c in enumerate(s):
        if c in BRACKETS:
            open_.append(i)
        elif c in BRACKETS.values():
            k = next((k for k in range(len(open_) - 1, max(-1, len(open_) - 65), -1) if BRACKETS[s[open_[k]]] == c), None)
            if k is not None:
                found[open_[k]] = i
                del open_[k:]
    return found


def _cell(s: str, i: int, end: int, codes: list[str], matched: dict[int, int]) -> int:
    flags = 0
    closing: set[int] = set()
    none: set[str] = set()
    while i < end:
        c = s[i]
        if i in closing:
            i = _tail(s, i + 1, end, codes)
        elif c in QUOTES:
            close = -1 if QUOTES[c] in none else s.find(QUOTES[c], i + 1, end)
            if close < 0:
                none.add(QUOTES[c])
                if QUOTES[c] != c:
                    close = s.find('"', i + 1, end)
            if close > i:
                closing.add(close)
            else:
                flags |= MALFORMED_QUOTE  # no closing mark: backtrack and read on behind it
            i += 1
        elif c in BRACKETS:
            close = matched.get(i, -1)
            if close < 0 or close >= end:
                flags |= MALFORMED_BRACKET
                i += 1
                continue
            inside = " ".join(s[i + 1 : close].translate(FLAT).split())
            if _only_codes(inside):
                flags |= _cell(inside, 0, len(inside), codes, {})
            i = close + 1
        else:
            i = _bare(s, i, end, codes)
    return flags


#: Marks within a bracket of codes read as blanks.
FLAT = str.maketrans(dict.fromkeys("()[]{}\"'“”‘’«»", " "))


def _only_codes(inside: str) -> bool:
    """Nothing but codes, exceptions and separators, and at least one code that is no lone number."""
    return bool(re.fullmatch(r"[\s,;/|e]*(?:\d[\d.]{3,}\d[\s,;/|e]*)+", EXCEPTION.sub(" ", inside)))


def _tail(s: str, i: int, end: int, codes: list[str]) -> int:
    """An exception that stands behind the closing quote of its code."""
    m = EXCEPTION.match(s, i, end)
    if m and codes and " Ex " not in codes[-1]:
        codes[-1] += f" Ex {int(m[1]):02d}"
        return m.end()
    return i


def _bare(s: str, i: int, end: int, codes: list[str]) -> int:
    fresh = i == 0 or not (s[i - 1].isalnum() or s[i - 1] == ".")
    if fresh:
        for skip in (MONEY, MARKER, DATE, NOTE, QUANTITY):
            if m := skip.match(s, i, end):
                return max(m.end(), i + 1)
        if m := CODE.match(s, i, end):
            code = m[0]
            if SHAPE.fullmatch(code) and not s[m.end() : m.end() + 1].isalpha():
                if x := EXCEPTION.match(s, m.end(), end):
                    codes.append(f"{code} Ex {int(x[1]):02d}")
                    return x.end()
                codes.append(code)
            return m.end()
        if m := WORD.match(s, i, end):
            return m.end()
    return i + 1


SPLIT = "slug string, csv string, row_no int, col int, pos int, code string, flags int"


def _split(at_least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parsed = [parse(c) for c in batch.column("cell").to_pylist()]
            take = [i for i, (codes, _) in enumerate(parsed) if len(codes) >= at_least for _ in codes]
            hits = [p for p in parsed if len(p[0]) >= at_least]
            keys = batch.select(["slug", "csv", "row_no", "col"]).take(pa.array(take, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [
                    *keys.columns,
                    pa.array([n for codes, _ in hits for n in range(1, len(codes) + 1)], pa.int32()),
                    pa.array([c for codes, _ in hits for c in codes], pa.string()),
                    pa.array([f for codes, f in hits for _ in codes], pa.int32()),
                ],
                names=["slug", "csv", "row_no", "col", "pos", "code", "flags"],
            )

    return run


def packed_cells(annexes: DataFrame, header_like: str = "NCM|NBS", at_least: int = 2) -> DataFrame:
    """``(slug, csv, row_no, col, cell)``: distinct cells of the wanted columns, with as many numbers as codes are asked for (one or more).

    Rows shorter than their header, null headers and null cells are read as far as they go.
    """
    placed = annexes.where(F.col("slug").isNotNull() & F.col("csv").isNotNull() & F.col("row_no").isNotNull())
    each = placed.select("slug", "csv", "row_no", "cells", F.posexplode("header").alias("col", "head"))
    wanted = each.where(F.upper("head").rlike(header_like))
    cells = wanted.select("slug", "csv", "row_no", "col", F.get("cells", F.col("col")).alias("cell"))
    return cells.where(F.col("cell").rlike(r"\d[^\d]*[^\d.][^\d]*\d" if at_least > 1 else r"\d")).distinct()


def split_codes(annexes: DataFrame, at_least: int = 2) -> DataFrame:
    """``(slug, csv, row_no, col, pos, code, flags)``: one row per code of the cells with ``at_least`` codes."""
    return packed_cells(annexes, at_least=at_least).mapInArrow(_split(at_least), SPLIT)
