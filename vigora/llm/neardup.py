"""Near-duplicate records with small edits: fast similarity sketching, banding, exact verification.

Sketching places the hashed shingles of a text into ``bins`` coordinates over rounds: in round i of the
first ``bins`` rounds a shingle falls into a hashed bin, in the later ones into bin i, so every coordinate
fills; a coordinate keeps the least value of the first round that reached it. Two sketches agree in a
coordinate with the probability of the Jaccard similarity, with concentration as of independent samples.
Bands of coordinates are the join keys, their number and width follow from the threshold; classes (groups of
equal texts) that share one are candidates and are verified on their exact shingle sets.

Scale: texts travel as band keys of four bytes and a place in their batch, packed by bucket of key, so the bytes
do not depend on the number of buckets. Keys that meet are sent back to their batches and come out as classes;
exact copies meet as one class. Small groups of a key are paired where they are; a hot key's classes are cut into
blocks, pairs of blocks are spread over tasks and compare short sketches before any pair is made, so a hot key
neither gathers in a task nor is capped.

Defined results
---------------
* null texts and texts of fewer than ``min_words`` words take no part; neither do null ids;
* repeated rows of an id with the same text count once; an id with several texts is alike another if one
  of its texts is;
* ids with equal texts have similarity 1; pairs have ``id_a < id_b``; an empty table gives no pairs;
* very long texts are sketched and compared whole.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigora.llm.packing import first_batch, spread, squeeze
from vigora.sources.tables import cut_lineage

#: Words: the longest runs of letters (ª and º included) and digits.
WORD = re.compile(r"[^\W_]+")

#: Most coordinates of a sketch, and how often a pair at the threshold may share no band.
BINS, MISS = 672, 0.005
#: Odd multipliers of a 64-bit mixing function.
M1, M2, M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Classes of a key up to which they are paired at once; classes of a block of a hot key.
HOT, BLOCK = 256, 8_192
#: Classes and shingles that are packed at once.
BATCH_CLASSES, BATCH_SHINGLES = 8_192, 4_000_000
#: Most classes (8 bytes each) that are sent to every executor to pick out their texts.
BROADCAST_ROWS = 1_000_000
#: Coordinates whose lowest byte is kept for a first look at a candidate pair.
MINI = 64


def bands(threshold: float, miss: float = MISS, bins: int = BINS) -> tuple[int, int]:
    """``(bands, rows)``: the widest bands of which a pair at the threshold shares none with a probability of ``miss``.

    At 0.6 these are 111 bands of 6: a pair of similarity 0.65 is missed with a probability of 0.02 %.
    """
    best = None
    for rows in range(1, bins + 1):
        hit = threshold**rows
        need = 1 if hit >= 1 else math.ceil(math.log(miss) / math.log1p(-hit)) if hit > 1e-9 else bins + 1
        if need * rows <= bins:
            best = (max(need, -(-MINI // rows)), rows)
    if best is None:
        raise ValueError(f"a threshold of {threshold} needs more than {bins} coordinates")
    return best


def least_agree(threshold: float) -> int:
    """Of ``MINI`` coordinates, how many must agree: a pair at the threshold falls below once in some millions, an
    unrelated one nearly always."""
    return max(1, int(MINI * threshold - 5 * math.sqrt(MINI * threshold * (1 - threshold))))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * M2
    x = (x ^ (x >> np.uint64(27))) * M3
    return x ^ (x >> np.uint64(31))


class WordHash(dict):
    """64-bit hash by word, filled on demand; bounded."""

    def __missing__(self, word: str) -> int:
        import xxhash

        h = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        if len(self) >= 500_000:
            self.clear()
        self[word] = h
        return h


WORDS = WordHash()


def shingles(text: str, width: int, min_words: int) -> np.ndarray | None:
    """Sorted distinct 64-bit hashes of the word sequences of a text; null below ``min_words`` words."""
    words = WORD.findall(text.lower())
    if len(words) < max(min_words, width):
        return None
    h = np.fromiter(map(WORDS.__getitem__, words), np.uint64, len(words))
    s = h[: len(h) - width + 1].copy()
    for k in range(1, width):
        s = mix(s + M1) + h[k : len(h) - width + 1 + k]
    return np.unique(mix(s))


def sketch(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """Fast similarity sketches, one row of ``bins`` 64-bit values per set of hashes.

    A hash of 64 bits places its shingle in three rounds, by 21 bits each.
    """
    n = len(sets)
    sizes = np.fromiter(map(len, sets), np.int64, n)
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(n, dtype=np.int32) * np.int32(bins), sizes)
    out = np.full(n * bins, np.iinfo(np.uint64).max, np.uint64)
    open_bins = np.ones(n * bins, bool)

    def drop(place: np.ndarray, h: np.ndarray) -> None:
        fits = open_bins[place]
        place = place[fits]
        np.minimum.at(out, place, mix(h[fits] + M1))
        open_bins[place] = False

    for i in range(0, bins, 3):
        h = mix(values ^ mix(np.full(1, i + 1, np.uint64) * M1))
        for k, shift in enumerate((np.uint64(43), np.uint64(22), np.uint64(1))):
            part = ((h >> shift) & np.uint64(0x1FFFFF)).astype(np.uint32)
            drop(owner + (part * np.uint64(bins) >> np.uint64(21)).astype(np.int32), h + np.uint64(k))
        live = open_bins.reshape(n, bins).any(axis=1)
        if not live.any():
            return out.reshape(n, bins)
        keep = live[owner // bins]
        if keep.mean() < 0.7:
            values, owner = values[keep], owner[keep]
    for b in range(bins):  # every shingle of a text falls into bin b: what is still open fills
        drop(owner + np.int32(b), mix(values ^ mix(np.full(1, bins + b + 1, np.uint64) * M1)))
    return out.reshape(n, bins)


def band_keys(sketches: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` coordinates; the band's number is part of the key."""
    n, bins = sketches.shape
    count = bins // rows
    cut = sketches[:, : count * rows].reshape(n, count, rows)
    key = np.broadcast_to(mix((np.arange(count, dtype=np.uint64) + np.uint64(1)) * M1), (n, count)).copy()
    for k in range(rows):
        key = mix(key + cut[:, :, k])
    return key


PACKED = "batch bigint, bucket int, payload binary"


def _batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    cols = zip(*rows, strict=True) if rows else ((), (), ())
    made = [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.binary()), strict=True)]
    return pa.RecordBatch.from_arrays(made, names=["batch", "bucket", "payload"])


def _by_bucket(bucket: np.ndarray, *arrays: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The slices of the arrays for each bucket that has any entry; in order of the entries within a bucket."""
    order = np.argsort(bucket, kind="stable")
    used, edges = np.unique(bucket[order], return_index=True)
    arrays = [a[order] for a in arrays]
    for b, start, end in zip(used.tolist(), edges, np.append(edges[1:], len(order)), strict=True):
        yield b, [a[start:end] for a in arrays]


def _banded(width: int, min_words: int, count: int, rows: int, buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows ``(batch, bucket, payload)`` of batches of classes.

    A row of a bucket from 0 on holds band keys (their low 32 bits; the bucket is taken from the high ones) and the
    places of their classes in the batch, as steps; that of bucket -1 - batch holds the classes of the batch, the sizes
    of their sets and short sketches.
    """

    def pack(batch: int, classes: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
        parts = [sketch(sets[i : i + 128], count * rows) for i in range(0, len(sets), 128)]
        keys = np.concatenate([band_keys(p, rows) for p in parts])
        mini = np.concatenate([p[:, :MINI].astype(np.uint8) for p in parts])
        bucket = ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32).ravel()
        place = np.repeat(np.arange(len(sets), dtype=np.uint16), keys.shape[1])
        sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        out = [(batch, -1, squeeze(np.array(classes, np.int64).view(np.uint64), sizes, mini.ravel()))]
        for b, (low, at) in _by_bucket(bucket, keys.ravel().astype(np.uint32), place):
            out.append((batch, b, squeeze(low, np.diff(at, prepend=np.uint16(0)))))
        return _batch(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = first_batch()
        classes: list[int] = []
        sets: list[np.ndarray] = []
        seen: set[int] = set()
        held = 0
        for rows_ in batches:
            for c, t in zip(rows_.column("class").to_pylist(), rows_.column("text").to_pylist(), strict=True):
                if c in seen:
                    continue
                s = shingles(t, width, min_words)
                if s is None:
                    continue
                seen.add(c)
                classes.append(c)
                sets.append(s)
                held += len(s)
                if len(sets) == BATCH_CLASSES or held >= BATCH_SHINGLES:
                    yield pack(batch, classes, sets)
                    classes, sets, seen, held = [], [], set(), 0
                    batch += 1
        if sets:
            yield pack(batch, classes, sets)

    return run


def _collide(table: pa.Table) -> pa.Table:
    """Of one bucket's band keys those that stand more than once: per batch the keys and the places of their classes.

    The classes of a batch pass unchanged.
    """
    names, buckets, payloads = (table.column(c).to_pylist() for c in ("batch", "bucket", "payload"))
    if buckets[0] < 0:
        return table
    parts = [spread(p) for p in payloads]
    low = np.concatenate([p[0] for p in parts]).astype(np.uint32)
    place = np.concatenate([np.cumsum(p[1], dtype=np.int64) for p in parts])
    batch = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
    order = np.argsort(low, kind="stable")
    same = low[order][1:] == low[order][:-1]
    many = np.sort(order[np.concatenate((same, [False])) | np.concatenate(([False], same))])
    out = [(names[b], buckets[0], squeeze(k, at)) for b, (k, at) in _by_bucket(batch[many], low[many], place[many])]
    return pa.Table.from_batches([_batch(out)])


def _resolve(buckets: int) -> Callable[[pa.Table], pa.Table]:
    """Keys that meet, with the classes and sizes of one batch in place of their places, by bucket of key; and (bucket -1)
    the short sketches of these classes."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("bucket", "batch", "payload")), strict=True), key=lambda r: r[0])
        batch = rows[0][1]
        classes, sizes, mini = spread(rows[0][2])
        met = [(b, *spread(p)) for b, _, p in rows[1:]]
        if not met:
            return pa.Table.from_batches([_batch([])])
        keys = np.concatenate([(np.uint64(b) << np.uint64(32)) | k.astype(np.uint64) for b, k, _ in met])
        at = np.concatenate([p.astype(np.int64) for _, _, p in met])
        used = np.unique(at)
        out = [(batch, -1, squeeze(classes[used], mini.reshape(-1, MINI)[used].ravel()))]
        bucket = (mix(keys) % np.uint64(buckets)).astype(np.int32)
        out += [(batch, b, squeeze(k, c, s)) for b, (k, c, s) in _by_bucket(bucket, keys, classes[at], sizes[at])]
        return pa.Table.from_batches([_batch(out)])

    return run


PAIRED = "a bigint, b bigint, hot bigint, size bigint"


def _pair(threshold: float, hot: int) -> Callable[[pa.Table], pa.Table]:
    """Distinct pairs ``(a, b)`` of the classes that share a key of this bucket and whose sizes allow the threshold.

    The classes of a key with more than ``hot`` come singly instead: ``(a, null, key, size)``.
    """

    def run(table: pa.Table) -> pa.Table:
        parts = [spread(p) for p in table.column("payload").to_pylist()]
        key, cls, size = (np.concatenate([p[k] for p in parts]).astype(np.uint64) for k in range(3))
        order = np.lexsort((cls, size, key))
        key, cls, size = key[order], cls[order].view(np.int64), size[order].astype(np.int64)
        fresh = np.concatenate(([True], (key[1:] != key[:-1]) | (cls[1:] != cls[:-1]))) if len(key) else np.zeros(0, bool)
        key, cls, size = key[fresh], cls[fresh], size[fresh]
        _, of, n = np.unique(key, return_inverse=True, return_counts=True)
        big = n[of] > hot
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        at = np.flatnonzero(~big)
        step = 1
        while len(at):
            at = at[at + step < len(key)]
            at = at[(key[at] == key[at + step]) & (size[at] >= threshold * size[at + step])]
            a.append(np.minimum(cls[at], cls[at + step]))
            b.append(np.maximum(cls[at], cls[at + step]))
            step += 1
        x, y = np.concatenate(a), np.concatenate(b)
        order = np.lexsort((y, x))
        x, y = x[order], y[order]
        once = np.concatenate(([True], (x[1:] != x[:-1]) | (y[1:] != y[:-1]))) if len(x) else np.zeros(0, bool)
        x, y = x[once], y[once]
        none = pa.nulls(len(x), pa.int64())
        single = (pa.array(cls[big]), pa.nulls(int(big.sum()), pa.int64()), pa.array(key[big].view(np.int64)), pa.array(size[big]))
        cols = [pa.concat_arrays(c) for c in zip((pa.array(x), pa.array(y), none, none), single, strict=True)]
        return pa.table(cols, names=["a", "b", "hot", "size"])

    return run


def _minis(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for p in batch.column("payload").to_pylist():
            cls, mini = spread(p)
            bits = pa.array([m.tobytes() for m in mini.astype(np.uint8).reshape(-1, MINI)], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(cls.astype(np.uint64).view(np.int64)), bits], names=["class", "mini"])


def _look(agree: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Keep the pairs whose short sketches agree well enough to be worth an exact look."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, MINI) for c in ("ma", "mb"))
            yield batch.select(["a", "b"]).filter(pa.array((x == y).sum(axis=1) >= agree))

    return run


def _block(table: pa.Table) -> pa.Table:
    """One block of a hot key as one row: its classes, sizes and short sketches in order of size."""
    rows = table.sort_by([("size", "ascending"), ("class", "ascending")])
    cls, size = rows.column("class").to_numpy(), rows.column("size").to_numpy()
    mini = np.frombuffer(b"".join(rows.column("mini").to_pylist()), np.uint8)
    raw = squeeze(cls.view(np.uint64), size, mini)
    cols = [rows.column("hot").slice(0, 1), rows.column("block").slice(0, 1), pa.chunked_array([pa.array([raw], pa.binary())])]
    return pa.table(cols, names=["hot", "block", "payload"])


def _blocks_look(threshold: float, agree: int, tile: int = 512) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pairs of classes of two blocks (or of one with itself) whose sizes and short sketches allow the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for left, right in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist(), strict=True):
                (ca, sa, ma), (cb, sb, mb) = spread(left), spread(right)
                ca, cb = ca.astype(np.uint64).view(np.int64), cb.astype(np.uint64).view(np.int64)
                sa, sb = sa.astype(np.int64), sb.astype(np.int64)
                ma, mb = (np.ascontiguousarray(m.astype(np.uint8).reshape(-1, MINI).T) for m in (ma, mb))
                for i in range(0, len(ca), tile):
                    for j in range(0, len(cb), tile):
                        p, q = slice(i, i + tile), slice(j, j + tile)
                        if sb[q][0] * threshold > sa[p][-1] or sa[p][0] * threshold > sb[q][-1]:
                            continue
                        same = np.zeros((len(ca[p]), len(cb[q])), np.uint8)
                        for k in range(MINI):
                            same += ma[k, p][:, None] == mb[k, q][None, :]
                        x, y = np.nonzero(same >= agree)
                        least, most = np.minimum(sa[p][x], sb[q][y]), np.maximum(sa[p][x], sb[q][y])
                        fits = (least >= threshold * most) & (ca[p][x] != cb[q][y])
                        x, y = ca[p][x[fits]], cb[q][y[fits]]
                        if len(x):
                            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])

    return run


def sketched(classes: DataFrame, width: int, min_words: int, threshold: float, buckets: int) -> DataFrame:
    """Keys that meet and the classes of each batch, packed (``batch``, ``bucket``, ``payload``); kept once."""
    count, rows = bands(threshold)
    packed = classes.mapInArrow(_banded(width, min_words, count, rows, buckets), PACKED)
    own = F.when(F.col("bucket") < 0, -1 - F.col("batch")).otherwise(F.col("bucket").cast("bigint"))
    return cut_lineage(packed.groupBy(own.alias("_own")).applyInArrow(_collide, PACKED))


def hot_pairs(single: DataFrame, mini: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    """Pairs ``(a, b)`` of the classes of hot keys whose sizes and short sketches allow the threshold.

    ``single`` has ``(hot, class, size)``. Classes are cut into blocks by hash; pairs of blocks are made from their
    numbers alone, spread, and only then joined with what they hold.
    """
    counted = single.groupBy("hot").agg(F.ceil(F.count("*") / block).alias("n"))
    placed = single.join(counted, "hot").select("hot", "class", "size", F.pmod(F.xxhash64("class"), F.col("n")).alias("block"))
    made = cut_lineage(placed.join(mini, "class").groupBy("hot", "block").applyInArrow(_block, "hot bigint, block bigint, payload binary"))
    held = lambda s, name: made.select("hot", F.col("block").alias(s), F.col("payload").alias(name))
    both = made.select("hot", F.col("block").alias("i")).join(made.select("hot", F.col("block").alias("j")), "hot").where("i <= j")
    full = both.join(held("i", "left"), ["hot", "i"]).join(held("j", "right"), ["hot", "j"])
    return full.select("left", "right").mapInArrow(_blocks_look(threshold, least_agree(threshold)), "a bigint, b bigint")


def candidates(found: DataFrame, threshold: float, buckets: int, hot: int = HOT, block: int = BLOCK) -> DataFrame:
    """Distinct pairs ``(a, b)``, a < b, of classes that share a band, whose sizes and short sketches allow the threshold."""
    met = found.groupBy("batch").applyInArrow(_resolve(buckets), PACKED)
    mini = met.where("bucket < 0").select("payload").mapInArrow(_minis, "class bigint, mini binary").dropDuplicates(["class"])
    paired = cut_lineage(met.where("bucket >= 0").select("bucket", "payload").groupBy("bucket").applyInArrow(_pair(threshold, hot), PAIRED))
    pairs = paired.where("b IS NOT NULL").select("a", "b").distinct()
    left = pairs.join(mini.select(F.col("class").alias("a"), F.col("mini").alias("ma")), "a")
    seen = left.join(mini.select(F.col("class").alias("b"), F.col("mini").alias("mb")), "b").select("a", "b", "ma", "mb")
    out = seen.mapInArrow(_look(least_agree(threshold)), "a bigint, b bigint")
    single = paired.where("hot IS NOT NULL").select("hot", F.col("a").alias("class"), "size")
    if single.isEmpty():
        return out
    return out.unionByName(hot_pairs(single, mini, threshold, block)).distinct()


def parts(found: DataFrame) -> DataFrame:
    """``class`` of every text that takes part; a class may come several times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.column("payload").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(spread(p)[0].astype(np.uint64).view(np.int64))], names=["class"])

    return found.where("bucket < 0").select("payload").mapInArrow(run, "class bigint")


def pack_set(s: np.ndarray) -> bytes:
    """The high 40 bits of each hash; two shingles of a pair of texts meet by chance once in some 10^7 pairs."""
    v = s >> np.uint64(24)
    return v.astype(np.uint32).tobytes() + (v >> np.uint64(32)).astype(np.uint8).tobytes()


def unpack_set(b: bytes) -> np.ndarray:
    n = len(b) // 5
    return np.frombuffer(b, np.uint32, n).astype(np.uint64) | (np.frombuffer(b, np.uint8, n, 4 * n).astype(np.uint64) << np.uint64(32))


def _sets(width: int, min_words: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1_000):
                part = batch.slice(at, 1_000)
                made = [shingles(t, width, min_words) for t in part.column("text").to_pylist()]
                sets = pa.array([None if s is None else pack_set(s) for s in made], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("class"), sets], names=["class", "shingles"])

    return run


def _verify(threshold: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sa, sb = batch.column("sa").to_pylist(), batch.column("sb").to_pylist()
            similar = np.zeros(batch.num_rows)
            for i, (x, y) in enumerate(zip(sa, sb, strict=True)):
                x, y = unpack_set(x), unpack_set(y)
                both = np.concatenate((x, y))
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                similar[i] = shared / (len(both) - shared)
            keep = pa.array(similar >= threshold)
            made = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(similar)], names=["a", "b", "similarity"])
            yield made.filter(keep)

    return run


def classes_of(docs: DataFrame, key: str, text: str, min_words: int) -> DataFrame:
    """``(key, class, text)``: the class is a hash of the text as it stands, made where the text is read."""
    long_enough = docs.where(F.col(key).isNotNull() & (F.length(text) >= 2 * min_words - 1))
    return long_enough.select(key, F.xxhash64(text).alias("class"), F.col(text).alias("text"))


def verified(docs: DataFrame, found: DataFrame, key: str, text: str, threshold: float, width: int, min_words: int, buckets: int, hot: int = HOT) -> DataFrame:
    """Pairs ``(a, b, similarity)`` of classes of different texts that reach the threshold on their exact shingle sets."""
    placed = classes_of(docs, key, text, min_words).select("class", "text")
    pairs = cut_lineage(candidates(found, threshold, buckets, hot))
    needed = cut_lineage(pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct())
    if needed.count() <= BROADCAST_ROWS:  # beyond it, texts are exchanged by class
        needed = F.broadcast(needed)
    sets = placed.join(needed, "class", "left_semi").dropDuplicates(["class"]).mapInArrow(_sets(width, min_words), "class bigint, shingles binary")
    sets = sets.where(F.col("shingles").isNotNull())
    left = pairs.join(sets.select(F.col("class").alias("a"), F.col("shingles").alias("sa")), "a")
    both = left.join(sets.select(F.col("class").alias("b"), F.col("shingles").alias("sb")), "b").select("a", "b", "sa", "sb")
    return both.mapInArrow(_verify(threshold), "a bigint, b bigint, similarity double")


def membership(docs: DataFrame, found: DataFrame, key: str, text: str, min_words: int) -> DataFrame:
    """Distinct ``(key, class)`` of the texts that take part."""
    return classes_of(docs, key, text, min_words).select(key, "class").distinct().join(parts(found), "class", "left_semi").select(key, "class")


def similar_pairs(docs: DataFrame, key: str, text: str, threshold: float = 0.8, width: int = 5, min_words: int = 0, buckets: int = 24, hot: int = HOT) -> DataFrame:
    """``(id_a, id_b)`` of all different keys whose texts reach the threshold, copies expanded."""
    found = sketched(classes_of(docs, key, text, min_words).select("class", "text"), width, min_words, threshold, buckets)
    members = cut_lineage(membership(docs, found, key, text, min_words))
    alike = verified(docs, found, key, text, threshold, width, min_words, buckets, hot)
    many = members.groupBy("class").agg(F.count("*").alias("n")).where("n > 1").select("class")
    links = alike.select("a", "b").unionByName(many.select(F.col("class").alias("a"), F.col("class").alias("b")))
    left = links.join(members.select(F.col("class").alias("a"), F.col(key).alias("x")), "a")
    both = left.join(members.select(F.col("class").alias("b"), F.col(key).alias("y")), "b").where(F.col("x") != F.col("y"))
    return both.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).distinct()


def similar_groups(docs: DataFrame, key: str, text: str, threshold: float = 0.8, width: int = 5, min_words: int = 0, buckets: int = 24, hot: int = HOT) -> DataFrame:
    """``(key, class, group_id, links)``: one row per key and class of equal texts, its group, and the class's links to other texts."""
    found = sketched(classes_of(docs, key, text, min_words).select("class", "text"), width, min_words, threshold, buckets)
    links = cut_lineage(verified(docs, found, key, text, threshold, width, min_words, buckets, hot))
    grouped = groups(membership(docs, found, key, text, min_words), links, key)
    n = links.select(F.explode(F.array("a", "b")).alias("class")).groupBy("class").agg(F.count("*").alias("links"))
    return grouped.join(n, "class", "left").select(key, "class", "group_id", F.coalesce("links", F.lit(0)).alias("links"))


def groups(members: DataFrame, links: DataFrame, key: str) -> DataFrame:
    """``(key, class, group_id)``: the connected component of each class, by its least class.

    Labels spread along links and by pointer jumping until none changes; links hold pairs of classes
    only, so copies of a text cost one row each.
    """
    edges = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    edges = cut_lineage(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    labels = edges.groupBy("u").agg(F.least("u", F.min("v")).alias("label"))
    while True:
        labels = cut_lineage(labels)
        near = edges.join(labels.select(F.col("u").alias("v"), "label"), "v").groupBy("u").agg(F.min("label").alias("near"))
        low = labels.join(near, "u").select("u", "label", F.least("label", "near").alias("low"))
        jump = low.join(labels.select(F.col("u").alias("low"), F.col("label").alias("root")), "low", "left")
        step = cut_lineage(jump.select("u", "label", F.least("low", F.coalesce("root", "low")).alias("next")))
        if step.where("next < label").isEmpty():
            break
        labels = step.select("u", F.col("next").alias("label"))
    return members.join(labels.select(F.col("u").alias("class"), "label"), "class", "left").select(
        key, "class", F.coalesce("label", "class").alias("group_id")
    )
