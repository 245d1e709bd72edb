"""Keyword-stuffed and link-list pages, by collocations against the counts of the whole corpus.

Every page is read as lines, sentences and delimited items; its words stand in items of a list, runs without
any punctuation, sentences, or addresses and tags with their captions. Numbered items, tables, summaries and
the like are content. A link that follows a link and a tag that follows a tag are neighbours like two words.
Neighbours are counted over the whole corpus; from the counts come

* the mean pointwise mutual information (PMI) of a page's neighbouring words: a page whose words meet no
  more often than by chance is incoherent word salad;
* its excessively repeated collocations: each word stands for the most repeated pair of neighbours that
  it is part of (items of a list, parts of a sentence, links and tags as a whole for the most repeated pair in
  them), and counts as stuffed if that pair takes too large a share of the page against its rate on other pages,
  or, in lists and unpunctuated runs, recurs in the page or is a collocation known to the corpus.

A page is spam if more than half of its words are stuffed, or if it is word salad.

Counts are exact and distributed. Each batch of pages adds up its own pairs and words first; its sums go to
buckets of hashed keys, where they are added up over the corpus, and come back to the batch, whose pages waited
for them packed. A pair or word that stands on every page is one entry of each batch, so no bucket is hot, and
what is shuffled grows with the text, not with the number of buckets. Nothing is broadcast.

Defined results
---------------
* null, empty and blank texts and pages below ``min_words`` words are never spam, nor are rows of a null id;
* repeated rows of a page count as further copies of it and are scored each; invisible characters are dropped, decomposed
  accents composed; very long texts are read whole; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigora.llm.neardup import M1, WordHash, mix
from vigora.llm.packing import first_batch, spread, squeeze
from vigora.sources.tables import cut_lineage

INVISIBLE = re.compile("[­​-‏‪-‮⁠-⁤﻿\x00-\x08\x0b\x0c\x0e-\x1f]")
URL = re.compile(r"(?:h(?:tt|xx)ps?\s?:\s?//|www\.|(?<=[\"'(])//)[^\s\"'<>)\]]+")
MARKUP = re.compile(r"</?(?:li|ul|ol|p|br|div|tr|td|a|span)\b[^<>]*>")
TAG = re.compile(r"#\w[\w-]*")
WORD = re.compile(r"[^\W\d_]+|\d[\d.,]*")
#: Start of a numbered item, article, question, table row or the like: content, not stuffing.
CONTENT = re.compile(
    r"\s*(?:[-*•]\s*)?(?:arts?\.|§|par[áa]grafo|pergunta|resposta|pregunta|respuesta|question|answer|anexo|ementa|assunto"
    r"|\d{1,4}(?:\.\d+)*\s?[.)ºª–—-]|[ivxlcdm]+\s*(?:[–—.)-]|â)|[a-z]\s?\))",
)
INLINE_ITEM = re.compile(r"(?<=\s)(?=(?:art\. \d|§ \d|[ivxlcdm]{1,6} [–—-] |\d{1,3}\. [^\W\d_]))")
IS_INLINE = re.compile(r"\s(?:art\. \d|§ \d|[ivxlcdm]{1,6} [–—-] |\d{1,3}\. [^\W\d_])")
LEADER = re.compile(r"\.{4,}\s*\d+\s*$")
SENTENCES = re.compile(r"[.!?]\s+")
ITEMS = re.compile(r";|\||•|·|»|>|/|,(?!\d)| [-–—] |\t")
CLOSED = re.compile(r"[.!?][\"')\]]*\s*$")

#: Kinds of words: counted only, item of a list, unpunctuated run, sentence.
PLAIN, LIST, RUN, SENTENCE = range(4)
SHORT, LONG_RUN, LEAST_ITEMS = 14, 40, 8
#: Links and tags in the stream of words, and how many other words may stand between two that follow each other.
LINK, TAGGED, GAP = "<link>", "<tag>", 14
#: Where an address stood in its line (a sign of private use, no letter).
PLACE = "\ue000"
#: Mean PMI below which neighbours meet by chance.
SALAD_PMI = 0.5


#: Signs that stand for letters in disguised words, and a quick look for them.
DISGUISE = re.compile(r"(?<=[a-zà-ú])[0@](?=[a-zà-ú\s,;]|$)|(?<![\w.,@])[0@](?=[a-zà-ú])|(?<=[a-zà-ú])[0@](?=[0@])")
DISGUISED = re.compile(r"0[a-zà-ú]")
#: Words written letter by letter with blanks or dots, and a quick look for them.
SPACED = re.compile(r"(?<!\w)\w([ .])\w(?:\1\w)+(?!\w)")
IS_SPACED = re.compile(r"[ .,;\n]\w([ .])\w\1\w(?!\w)")
DOT_GAP = re.compile(r"\.\s\.(?=\w)")


def plain(text: str) -> str:
    """Lower case, composed, without invisible characters; doubly encoded text and disguised letters mended."""
    if "Ã" in text or "â\x80" in text:
        try:
            text = text.encode("latin-1").decode("utf-8")
        except (UnicodeEncodeError, UnicodeDecodeError):
            pass
    text = INVISIBLE.sub("", unicodedata.normalize("NFC", text)).lower().replace("\xa0", " ")
    if IS_SPACED.search(" " + text):
        text = SPACED.sub(lambda m: m[0].replace(m[1], ""), DOT_GAP.sub(" ", text))
    if "@" in text or DISGUISED.search(text):
        text = DISGUISE.sub(lambda m: "o" if m[0] == "0" else "a", text)
    return text


class PlainHash(WordHash):
    """As WordHash, 0 for a number."""

    def __missing__(self, word: str) -> int:
        if word[0].isdigit():
            return 0
        return super().__missing__(word)


WORDS = PlainHash()


def read_page(text: str) -> tuple[int, list[tuple[int, list[str]]], dict[str, tuple[int, int]]]:
    """``(words, segments, runs)`` of a page: ``runs`` has, for links and for tags, how often one follows another
    with at most ``GAP`` other words between, and the words (of addresses, captions, tags) that stand in such runs."""
    text = plain(text)
    words = others = 0
    segments: list[tuple[int, list[str]]] = []
    pending: list[list[str]] = []
    units: dict[str, list[tuple[int, int]]] = {LINK: [], TAGGED: []}
    linked = 0  # items of the open list that are links

    def close() -> None:
        nonlocal linked
        kind = LIST if len(pending) + linked >= LEAST_ITEMS else SENTENCE
        segments.extend((kind, item) for item in pending)
        pending.clear()
        linked = 0

    for line in text.splitlines():
        if not line or line.isspace():
            continue
        if "//" in line or "www." in line:
            urls = URL.findall(line)
            if urls:
                sizes = [len(WORD.findall(u)) for u in urls]
                line = MARKUP.sub(" ", URL.sub(f" {PLACE} ", line))
                rest = WORD.findall(line)
                captions = len(rest) <= 12 * len(urls) and len(ITEMS.split(line)) < LEAST_ITEMS
                if captions:
                    sizes[0] += len(rest)
                    segments.append((PLAIN, rest))
                words += sum(sizes)
                units[LINK].extend((others, n) for n in sizes)
                if captions:
                    continue
        if "#" in line:
            sizes = [len(WORD.findall(t.replace("_", " "))) for t in TAG.findall(line)]
            words += sum(sizes)
            units[TAGGED].extend((others, n) for n in sizes)
            line = TAG.sub(" ", line)
        for part in INLINE_ITEM.split(line) if IS_INLINE.search(line) else (line,):
            if CONTENT.match(part) or LEADER.search(part) or (part.count("|") > 1 and 3 * sum(any(c.isdigit() for c in x) for x in part.split("|")) >= part.count("|")):
                close()
                found = WORD.findall(part)
                words += len(found)
                others += len(found)
                segments.append((PLAIN, found))
                continue
            sentences = SENTENCES.split(part)
            for m, sentence in enumerate(sentences, 1):
                ended = m < len(sentences) or CLOSED.search(sentence) is not None
                items = ITEMS.split(sentence)
                for k, item in enumerate(items):
                    found = WORD.findall(item)
                    if PLACE in item:
                        linked += 1
                    if not found:
                        continue
                    words += len(found)
                    others += len(found)
                    if len(found) <= SHORT and not (ended and k == len(items) - 1):
                        pending.append(found)
                    else:
                        close()
                        segments.append((RUN if len(found) > LONG_RUN else SENTENCE, found))
                if ended:
                    close()
    close()
    return words, segments, {kind: follow for kind, at in units.items() if (follow := follows(at))[0]}


def follows(units: list[tuple[int, int]]) -> tuple[int, int]:
    """How often one of the placed units follows another closely, and the words of those that do or are followed."""
    near = [b[0] - a[0] <= GAP for a, b in zip(units, units[1:], strict=False)]
    held = (n for k, (_, n) in enumerate(units) if (k and near[k - 1]) or (k < len(near) and near[k]))
    return sum(near), sum(held)


class Pairs(NamedTuple):
    """Distinct pairs of neighbours of a page, their words, how often each stands there, the words it owns by kind
    (list, run, sentence, links and tags); the page's distinct words and in how many of the pairs each stands."""

    keys: np.ndarray
    first: np.ndarray
    second: np.ndarray
    times: np.ndarray
    owned: np.ndarray
    words: np.ndarray
    seen: np.ndarray


def page_pairs(segments: list[tuple[int, list[str]]], runs: dict[str, tuple[int, int]] | None = None) -> Pairs:
    """Pairs do not reach over segments or numbers; links and tags that follow each other are pairs of their own kind."""
    segments = [x for x in segments if x[1]]
    flat = list(chain.from_iterable(ws for _, ws in segments))
    n = len(flat)
    sizes = np.fromiter((len(ws) for _, ws in segments), np.int64, len(segments))
    kinds = np.fromiter((k for k, _ in segments), np.int64, len(segments))
    seg = np.repeat(np.arange(len(segments)), sizes)
    kind = kinds[seg]
    h = np.fromiter(map(WORDS.__getitem__, flat), np.uint64, n)
    word = h != 0
    joined = (seg[1:] == seg[:-1]) & word[1:] & word[:-1]
    first, second = h[:-1][joined], h[1:][joined]
    keys, where, at, times = np.unique(pair_key(first, second), return_index=True, return_inverse=True, return_counts=True)
    owned = np.zeros((len(keys), 4), np.int64)
    if len(keys):
        which = np.full(n + 1, -1, np.int64)  # pair to the left of each word, by its second word
        which[1:n][joined] = at
        count = np.append(times, 0)[which]
        take_right = count[1:] > count[:-1]
        owner = np.where(take_right, which[1:], which[:-1])
        # items of a list and parts of a sentence go to their most repeated pair as a whole, the first of equals
        score = np.where(take_right, count[1:], count[:-1]) * (n + 1) + np.arange(n, 0, -1)
        lead = score == np.maximum.reduceat(score, np.cumsum(sizes) - sizes)[seg]
        owner = np.where((kind == LIST) | (kind == SENTENCE), owner[lead][seg], owner)
        has = (owner >= 0) & (kind != PLAIN)
        owned = np.bincount(owner[has] * 4 + kind[has] - 1, minlength=4 * len(keys)).reshape(-1, 4)
    x, y = first[where], second[where]
    if runs:
        own = np.array([WORDS[k] for k in runs], np.uint64)
        keys, x, y = np.append(keys, pair_key(own, own)), np.append(x, own), np.append(y, own)
        times = np.append(times, [t for t, _ in runs.values()])
        owned = np.concatenate((owned, [(0, 0, 0, w) for _, w in runs.values()]))
    ends, of = np.unique(np.concatenate((x, y)), return_inverse=True)
    return Pairs(keys, x, y, times, owned, ends, np.bincount(of, weights=np.concatenate((times, times)), minlength=len(ends)).astype(np.int64))


def pair_key(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(mix(first + M1) + second)


#: Pages and words that are packed at once.
BATCH_PAGES, BATCH_WORDS = 8_192, 4_000_000


PACKED = "batch bigint, bucket int, payload binary, words bigint, pairs bigint"


def _pack(buckets: int, share: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows ``(batch, bucket, payload, words, pairs)`` of batches of pages.

    A row of a bucket from 0 on has the batch's distinct keys (pairs and words) of that bucket with their sums over
    the batch; a key that stands on every page is one entry of a batch. The row of bucket -1 has the batch's pages and
    which pair stands how often on which page, pairs by their place in the order of buckets; it waits for the counts.
    """

    def flush(batch: int, ids: list[int], pages: list[Pairs], sizes: list[int]) -> pa.RecordBatch:
        size = np.array(sizes, np.int64)
        page = np.repeat(np.arange(len(pages)), [len(p.keys) for p in pages])
        times = np.concatenate([p.times for p in pages])
        keys, where, at = np.unique(np.concatenate([p.keys for p in pages]), return_index=True, return_inverse=True)
        words, of = np.unique(np.concatenate([p.words for p in pages]), return_inverse=True)
        fills = (times >= 3) & (times >= share * size[page])
        k, w = len(keys), len(words)
        total = lambda where, x, n: np.bincount(where, weights=x, minlength=n).astype(np.int64)
        sums = np.zeros((k + w, 3), np.int64)  # occurrences; pair: those that fill, word: pages; words of filled pages
        sums[:k, 0], sums[k:, 0] = total(at, times, k), total(of, np.concatenate([p.seen for p in pages]), w)
        sums[:k, 1], sums[k:, 1] = total(at, times * fills, k), np.bincount(of, minlength=w)
        sums[:k, 2] = total(at, size[page] * fills, k)
        every = np.concatenate((keys, words))
        bucket = ((every >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((every, bucket))
        place = np.empty(k + w, np.int64)
        place[order] = np.arange(k + w)
        ends = [place[k + np.searchsorted(words, np.concatenate([getattr(p, f) for p in pages])[where])] for f in ("first", "second")]
        by_key = np.argsort(at, kind="stable")
        owned = np.concatenate([p.owned for p in pages])[by_key]
        rows = (np.bincount(at, minlength=k), page[by_key], times[by_key], *owned.T)
        held = squeeze(np.array(ids, np.int64).view(np.uint64), size, place[:k], *ends, *rows)
        used, edges = np.unique(bucket[order], return_index=True)
        edges = np.append(edges, k + w)
        every, sums = every[order], sums[order]
        parts = [squeeze(every[a:b], *sums[a:b].T) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        n = len(used) + 1
        cols = ([batch] * n, [-1, *used.tolist()], [held, *parts], [int(size.sum())] + [0] * (n - 1), [int(times.sum())] + [0] * (n - 1))
        kinds = (pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64())
        names = ["batch", "bucket", "payload", "words", "pairs"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = first_batch()
        ids: list[int] = []
        pages: list[Pairs] = []
        sizes: list[int] = []
        held = 0
        for rows in batches:
            for i, t in zip(rows.column("doc_id").to_pylist(), rows.column("text").to_pylist(), strict=True):
                words, segments, runs = read_page(t)
                if not words:
                    continue
                ids.append(i)
                sizes.append(words)
                pages.append(page_pairs(segments, runs))
                held += words
                if len(ids) == BATCH_PAGES or held >= BATCH_WORDS:
                    yield flush(batch, ids, pages, sizes)
                    ids, pages, sizes, held = [], [], [], 0
                    batch += 1
        if ids:
            yield flush(batch, ids, pages, sizes)

    return run


COUNTED = "batch bigint, bucket int, payload binary"


def _count(table: pa.Table) -> pa.Table:
    """Sums over the corpus of one bucket's keys, sent back to each batch in the order of its keys."""
    parts = [spread(p) for p in table.column("payload").to_pylist()]
    keys, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    sums = [np.bincount(at, weights=np.concatenate([p[c] for p in parts]), minlength=len(keys)).astype(np.int64) for c in (1, 2, 3)]
    edges = np.cumsum([0] + [len(p[0]) for p in parts])
    back = [squeeze(*(s[at[a:b]] for s in sums)) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return pa.table([table.column("batch"), table.column("bucket"), pa.array(back, pa.binary())], names=["batch", "bucket", "payload"])


SCORED = "doc_id bigint, words bigint, stuffed bigint, pairs bigint, informative bigint, pmi double"


def _score(words: int, pairs: int, share: float, excess: float, link_excess: float, known: float) -> Callable[[pa.Table], pa.Table]:
    """A row for each page of a batch, from its pairs and their counts over the corpus."""
    floor = max(2.0, known * words)

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table.column("bucket").to_pylist(), table.column("payload").to_pylist(), strict=True), key=lambda r: r[0])
        ids, size, place, first, second, runs, page, times, listed, run_on, sentence, linked = spread(rows[0][1])
        count, filled, fullness = (np.concatenate(c).astype(np.int64) for c in zip(*(spread(p) for _, p in rows[1:]), strict=True)) if len(rows) > 1 else (np.zeros(0, np.int64),) * 3
        n, t = len(ids), times.astype(np.int64)
        at = np.repeat(place.astype(np.int64), runs)
        size = size.astype(np.int64)
        c = count[at]
        # background of a pair: how often it stands on the pages that it does not fill, and the words of these
        fills = (t >= 3) & (t >= share * size[page])
        often = t * (words - fullness[at]) / np.maximum(size[page] * (c - filled[at]), 1e-9)
        stuffed = listed * ((t >= 2) | (c >= floor)) + run_on * (t >= 3) + sentence * (fills & (often >= excess)) + linked * (fills & (often >= link_excess))
        by_chance = count[first].astype(np.float64) * count[second] / (4.0 * max(pairs, 1))
        met = np.repeat(np.minimum(filled[first], filled[second]) >= 3, runs)  # both words stand on two other pages at least
        pmi = np.log((c - t + 1) / (np.repeat(by_chance, runs) + 1))
        add = lambda x: np.bincount(page, weights=x, minlength=n)
        told = add(t * met)
        mean = np.divide(add(t * met * pmi), told, out=np.zeros(n), where=told > 0)
        cols = (ids.astype(np.uint64).view(np.int64), size, *(add(x).astype(np.int64) for x in (stuffed, t)), told.astype(np.int64), mean)
        return pa.table(list(cols), names=["doc_id", "words", "stuffed", "pairs", "informative", "pmi"])

    return run


def page_scores(docs: DataFrame, buckets: int, share: float = 0.06, excess: float = 60.0, link_excess: float = 8.0, known: float = 2e-6) -> DataFrame:
    """``(doc_id, words, stuffed, pairs, informative, pmi)`` of every page with words.

    A pair stuffs what it leads if it makes up ``share`` of the page's words and is ``excess`` times as frequent
    there as on the pages that it does not so fill, so copies of a page and pages that share its phrase do not hide
    each other. Links that follow links, and tags that follow tags, need ``link_excess`` times the rate of other pages,
    since any page may end in a few of them. Items of a list are stuffed by a pair that recurs in the page or makes up ``known`` of all words.

    ``pmi`` is the mean of log (c(xy) + 1) / (e(xy) + 1) over the page's ``informative`` pairs, those whose two words
    stand on other pages too: c(xy) is how often the pair stands on other pages, e(xy) how often it would by chance.
    """
    read = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text")
    packed = cut_lineage(read.mapInArrow(_pack(buckets, share), PACKED))
    total = packed.agg(F.sum("words").alias("words"), F.sum("pairs").alias("pairs")).first()
    counted = packed.where("bucket >= 0").select("batch", "bucket", "payload").groupBy("bucket").applyInArrow(_count, COUNTED)
    held = packed.where("bucket < 0").select("batch", "bucket", "payload")
    return held.unionByName(counted).groupBy("batch").applyInArrow(_score(total["words"] or 0, total["pairs"] or 0, share, excess, link_excess, known), SCORED)


def spam_pages(docs: DataFrame, buckets: int, min_words: int = 8, salad_pmi: float = SALAD_PMI, least_pairs: int = 30) -> DataFrame:
    """``(doc_id, share, mean_pmi, spam)`` of every page with words; ``mean_pmi`` is null without informative pairs.

    Short pages and pages in a language that the corpus hardly holds have few informative pairs and are never salad.
    """
    scores = page_scores(docs, buckets)
    share = F.col("stuffed") / F.col("words")
    salad = (F.col("informative") >= least_pairs) & (2 * F.col("informative") >= F.col("pairs")) & (F.col("pmi") < salad_pmi)
    spam = (F.col("words") >= min_words) & ((share > 0.5) | salad)
    return scores.select("doc_id", share.alias("share"), F.when(F.col("informative") > 0, F.col("pmi")).alias("mean_pmi"), spam.alias("spam"))
