"""Encoding texts with a public byte-level BPE vocabulary through tiktoken.

The rank file is read on each executor once (its path is a parameter). Texts are cut before encoding
where the splitting pattern is sure to cut as well, so calls meet short pieces and the ids stay those of the whole
text; a run without any such place passes uncut. The ids of short pieces are kept by the worker, as most recur.

Defined results
---------------
* null and empty texts give an empty list of ids, and the count 0;
* blank, broken or invisible characters are ordinary text; marker strings of language models are
  ordinary text too (no special tokens);
* an empty table gives an empty table; a column that has the name of the result is replaced by it.
"""

from __future__ import annotations

import base64
import functools
import re
from array import array
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Folder of the public vocabularies on every executor.
VOCABULARIES = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Fixed value: the splitting pattern that belongs to the vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Safe boundary of the pattern: before white space that follows other characters, whatever stands further on.
PIECE = re.compile(r"\s*\S+|\s+")
#: Ids of pieces up to this length are kept by a worker, for so many pieces at most.
KEPT_CHARS, KEPT_PIECES = 24, 300_000


@functools.lru_cache(maxsize=4)
def encoder(path: str):  # noqa: ANN201
    """The vocabulary at ``path``, loaded once per worker."""
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, Path(path).read_bytes().splitlines())}
    return tiktoken.Encoding(Path(path).stem, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class PieceIds(dict):
    """Packed ids by piece, filled on demand; bounded, so a worker's memory does not follow the corpus."""

    def __init__(self, enc) -> None:  # noqa: ANN001
        self.encode = enc.encode_ordinary

    def __missing__(self, piece: str) -> bytes:
        ids = array("i", self.encode(piece)).tobytes()
        if len(piece) <= KEPT_CHARS:
            if len(self) >= KEPT_PIECES:
                self.clear()
            self[piece] = ids
        return ids


@functools.lru_cache(maxsize=4)
def piece_ids(path: str) -> PieceIds:
    return PieceIds(encoder(path))


def pieces(text: str) -> list[str]:
    """Cuts of a text at safe boundaries; joined they are the text, encoded apart they give its ids."""
    return PIECE.findall(text)


def encode(text: str | None, known: PieceIds) -> bytes:
    """Packed 32-bit ids of one text, of any length."""
    return b"".join(map(known.__getitem__, pieces(text))) if text else b""


def decode(ids: np.ndarray, enc) -> bytes:  # noqa: ANN001
    """Raw bytes of a list of ids; exact for every cut of it, also within a character."""
    return enc.decode_bytes([int(i) for i in ids])


def with_field(df: DataFrame, field: str) -> str:
    """Schema string of ``df`` with one more field."""
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema), field])


def _encode(path: str, text: str, count_only: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = piece_ids(path)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                ids = [encode(t, known) for t in part.column(text).to_pylist()]
                sizes = np.fromiter((len(i) // 4 for i in ids), np.int64, len(ids))
                rest = part.drop_columns([text])
                if count_only:
                    made = pa.array(sizes)
                else:
                    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                    made = pa.ListArray.from_arrays(offsets, np.frombuffer(b"".join(ids), np.int32))
                yield pa.RecordBatch.from_arrays([*rest.columns, made], names=[*rest.schema.names, "n_tokens" if count_only else "ids"])

    return run


def encode_texts(docs: DataFrame, text: str = "text", vocabulary: str = f"{VOCABULARIES}/{VOCABULARY}") -> DataFrame:
    """The other columns of ``docs`` with ``ids``, the token ids of ``text``; a narrow map without a shuffle."""
    docs = docs.drop("ids")
    return docs.mapInArrow(_encode(vocabulary, text, False), with_field(docs.drop(text), "ids array<int>"))


def count_tokens(docs: DataFrame, text: str = "text", vocabulary: str = f"{VOCABULARIES}/{VOCABULARY}") -> DataFrame:
    """The other columns of ``docs`` with ``n_tokens`` of ``text``; ids never leave the worker."""
    docs = docs.drop("n_tokens")
    return docs.mapInArrow(_encode(vocabulary, text, True), with_field(docs.drop(text), "n_tokens bigint"))


def decode_ids(encoded: DataFrame, ids: str = "ids", vocabulary: str = f"{VOCABULARIES}/{VOCABULARY}") -> DataFrame:
    """The other columns with ``bytes``, the raw bytes that the ids stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in batches:
            made = pa.array([decode(i, enc) for i in batch.column(ids).to_pylist()], pa.binary())
            rest = batch.drop_columns([ids])
            yield pa.RecordBatch.from_arrays([*rest.columns, made], names=[*rest.schema.names, "bytes"])

    return encoded.mapInArrow(run, with_field(encoded.drop(ids), "bytes binary"))
