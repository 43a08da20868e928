"""Byte-level BPE encoding of a corpus with the rank file of a public tokenizer.

Text is cut by the vocabulary's pattern. A piece's bytes, as Latin-1 characters, run through an Aho-Corasick automaton of
all tokens, which gives the longest token at each place. Encoding takes longest tokens and backtracks to shorter ones until each
two neighbours are compatible, that is until merging by rank would give just these two; such a sequence is the one
that merging gives. Compatibility of a pair of tokens is found once and kept, as are the ids of a piece.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how this vocabulary's tokenizer cuts text before merging
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHE = 400_000


def load_ranks(data: bytes) -> list[bytes]:
    """Token bytes by id of a rank file; ids must run from 0 without gaps."""
    pairs = sorted((int(r), base64.b64decode(t)) for t, r in (line.split() for line in data.splitlines() if line.strip()))
    if [r for r, _ in pairs] != list(range(len(pairs))):
        raise ValueError("ranks have gaps")
    return [t for _, t in pairs]


def merge_by_rank(piece: bytes, rank: dict[bytes, int], below: int | None = None) -> list[bytes]:
    """Plain merging: again and again the adjacent pair whose union has the lowest rank. Slow; used to build tables and in tests."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        r, at = min((rank.get(parts[i] + parts[i + 1], 1 << 40), i) for i in range(len(parts) - 1))
        if r >= (1 << 40 if below is None else below):
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


def split_table(tokens: list[bytes]) -> np.ndarray:
    """For each token the two tokens it is merged from; a single byte is its own two."""
    rank = {t: i for i, t in enumerate(tokens)}
    out = np.empty((len(tokens), 2), dtype=np.int32)
    for i, t in enumerate(tokens):
        parts = [t, t] if len(t) == 1 else merge_by_rank(t, rank, i)
        if len(parts) != 2:
            raise ValueError(f"token {i} isn't a merge of two earlier ones")
        out[i] = rank[parts[0]], rank[parts[1]]
    return out


class Encoder:
    """Encodes texts to ids of one vocabulary."""

    def __init__(self, tokens: list[bytes], split: np.ndarray, pattern: str = PATTERN) -> None:
        self.tokens, self.find = tokens, regex.compile(pattern).findall
        self.left, self.right = split[:, 0].tolist(), split[:, 1].tolist()
        self.length = [len(t) for t in tokens]
        self.merged = {(a, b): i for i, (a, b) in enumerate(zip(self.left, self.right, strict=True)) if len(tokens[i]) > 1}
        self.trie = ahocorasick.Automaton()
        ids = {t: i for i, t in enumerate(tokens)}
        for t, i in ids.items():
            self.trie.add_word(t.decode("latin-1"), (i, len(t)))
        self.trie.make_automaton()
        self.shorter = []  # the longest token that is a proper prefix
        for t in tokens:
            self.shorter.append(next((ids[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in ids), -1))
        self.pairs: dict[tuple[int, int], bool] = {}
        self.pieces: dict[str, list[int]] = {}

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging the bytes of a and b leaves just a and b: undo merges from the latest on, looking for a merge across the border that would have come first."""
        found = self.pairs.get((a, b))
        if found is None:
            if len(self.pairs) > CACHE:
                self.pairs.clear()
            found = self.pairs[a, b] = self._compatible(a, b)
        return found

    def _compatible(self, a: int, b: int) -> bool:
        limit = 1 << 60
        while True:
            across = self.merged.get((a, b))
            if across is not None and across < limit:
                return False
            # the side merged last is undone; a tie goes to the right side, as merging goes from the left
            if a > b:
                limit = a
                a = self.right[a]
                if a == limit:
                    limit = b + 1
                    b = self.left[b]
                    if b + 1 == limit:
                        return True
            else:
                limit = b + 1
                b = self.left[b]
                if b + 1 == limit:
                    limit = a
                    a = self.right[a]
                    if a == limit:
                        return True

    def piece(self, text: str) -> list[int]:
        data = text.encode("utf-8", "replace").decode("latin-1")
        n = len(data)
        longest = [-1] * n
        size = [0] * n
        for end, (i, k) in self.trie.iter(data):
            at = end - k + 1
            if k > size[at]:
                size[at], longest[at] = k, i
        length, shorter = self.length, self.shorter
        out: list[int] = []
        open_at = bytearray(b"\1") * (n + 1)  # places from which the rest may still be encoded
        pos, token = 0, longest[0]
        while pos < n:
            last = out[-1] if out else -1
            while True:
                end = pos + length[token]
                if open_at[end] and (last < 0 or self.compatible(last, token)):
                    out.append(token)
                    pos = end
                    token = longest[pos] if pos < n else -1
                    break
                if shorter[token] >= 0:
                    token = shorter[token]
                    continue
                open_at[pos] = 0
                token = out.pop()
                pos -= length[token]
                break
        return out

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text, all of it ordinary text; none for an empty or null one."""
        out: list[int] = []
        if not text:
            return out
        cache = self.pieces
        for p in self.find(text):
            ids = cache.get(p)
            if ids is None:
                ids = self.piece(p)
                if len(cache) > CACHE:
                    cache.clear()
                if len(p) <= 64:
                    cache[p] = ids
            out += ids
        return out

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(self.tokens[i] for i in ids)


@lru_cache(maxsize=4)
def tables(path: str) -> tuple[bytes, np.ndarray]:
    """Rank file and split table, read and built once in the driver."""
    with open(path, "rb") as f:
        data = f.read()
    return data, split_table(load_ranks(data))


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def _worker_encoder(path: str, pattern: str, shared) -> Encoder:  # noqa: ANN001
    """One encoder for each Python worker, kept from task to task."""
    if (path, pattern) not in _ENCODERS:
        data, split = shared.value
        _ENCODERS[path, pattern] = Encoder(load_ranks(data), split, pattern)
    return _ENCODERS[path, pattern]


def encode_corpus(df: DataFrame, text: str, into: str = "ids", *, vocabulary: str = VOCABULARY, pattern: str = PATTERN, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all but ``text``) and ``into``, the ids of ``text`` as array<int>.

    Empty and null texts give an empty array, never null. Strings that look like special tokens are ordinary text.
    Texts are taken whole; each row comes out once, repeated rows alike; an empty table gives no rows. The vocabulary (under 1 MB) is
    read in the driver and broadcast with its split table.
    """
    spark: SparkSession = df.sparkSession
    shared = spark.sparkContext.broadcast(tables(vocabulary))
    names = [c for c in (keep if keep is not None else df.columns) if c not in (into, text) or (keep is not None and c == text and c != into)]
    slim = df.select(*(F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(names)), F.col(text).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _worker_encoder(vocabulary, pattern, shared)
        for batch in batches:
            offsets, flat = [0], []
            for t in batch.column(batch.num_columns - 1).to_pylist():
                flat += encoder.encode(t)
                offsets.append(len(flat))
            ids = pa.ListArray.from_arrays(pa.array(np.asarray(offsets, dtype=np.int32)), pa.array(np.asarray(flat, dtype=np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], ids], names=[*batch.schema.names[:-1], "ids"])

    schema = ", ".join([*(f"k{i} {slim.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(names))), "ids array<int>"])
    done = slim.mapInArrow(run, schema)
    return done.select(*(F.col(f"k{i}").alias(c) for i, c in enumerate(names)), F.col("ids").alias(into))


def token_counts(df: DataFrame, text: str, into: str = "tokens", *, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """``df`` with ``into``, the number of ids of ``text`` (0 for empty and null texts)."""
    shared = df.sparkSession.sparkContext.broadcast(tables(vocabulary))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = _worker_encoder(vocabulary, pattern, shared)
        for s in batches:
            yield s.map(lambda t: len(encoder.encode(t))).astype("int32")

    return df.withColumn(into, F.pandas_udf(run, "int")(F.col(text)))  # type: ignore[call-overload]
