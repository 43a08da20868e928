"""Same or nearly the same records across splits.

Texts become words; equal word sequences form one class, named by a digest of 128 bits. Each class has shingles (runs of words, a repeated
one numbered by its occurrence) and two kinds of buckets made from them:

* bands of a min-wise signature: several random orders of all shingles, a band being the first shingles of a text in some of them.
  The orders are weighted, so that a shingle of a rare hash cell of the corpus comes first more often and stock phrases make no large bucket;
* a completing pass, as bands miss pairs by chance: the first k shingles in one order that all texts share (rarity, then hash). Two sets
  that share enough of their shingles must have one of these in common, where k follows from the limit asked for, so this pass misses nothing.

Only pairs from different sides (training, evaluation) in a bucket become candidates. Each gets its exact Jaccard similarity, and
where an edit distance is asked for, that decides.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipwright.operators.skew import heavy_keys, salted_join
from clipwright.storage import Scratch

WORD = re.compile(r"[^\W_]+")
CELLS = 1 << 18
BANDS, ROWS = 4, 2
BUCKET_SHARE = 1 / 1000
KNOWN = 500_000
AT_ONCE = 1_000_000


def words_of(text: str) -> list[str]:
    """Runs of letters and digits without regard to case and accents."""
    if text.isascii():
        return WORD.findall(text.lower())
    plain = "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c) and unicodedata.category(c) != "Mn")
    return WORD.findall(unicodedata.normalize("NFC", plain.casefold()))


def digest(words: Sequence[str]) -> bytes:
    """Sixteen bytes that stand for a word sequence."""
    return xxhash.xxh3_128_digest(" ".join(words))


def _mix(h: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of h (64-bit finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class _WordHash(dict):
    """Word → 64-bit hash, found once for each word met."""

    def __missing__(self, word: str) -> int:
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


class Shingles:
    """Shingles of many word sequences at once: ``hashes`` in order of texts, ``of`` the text of each, ``count`` for each text."""

    def __init__(self, texts: Sequence[Sequence[str]], width: int, known: _WordHash) -> None:
        if len(known) > KNOWN:
            known.clear()
        n = np.fromiter((len(w) for w in texts), np.int64, len(texts))
        flat = np.fromiter((known[x] for w in texts for x in w), np.uint64, int(n.sum()))
        of = np.repeat(np.arange(len(texts)), n)
        last = len(flat) - width + 1
        at = np.flatnonzero(of[:last] == of[width - 1 :]) if last > 0 else np.zeros(0, np.int64)
        h = np.zeros(len(at), np.uint64)
        for j in range(width):
            h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + flat[at + j] + np.uint64(j + 1))
        self.of = of[at]
        # the second and later occurrence of a run hash apart
        order = np.lexsort((h, self.of))
        fresh = np.ones(len(h), bool)
        fresh[1:] = (h[order][1:] != h[order][:-1]) | (self.of[order][1:] != self.of[order][:-1])
        place = np.arange(len(h))
        nth = place - np.maximum.accumulate(np.where(fresh, place, 0))
        again = nth > 0
        h[order[again]] = _mix(h[order[again]] + nth[again].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        self.hashes = h
        self.count = np.bincount(self.of, minlength=len(texts))
        self.ends = np.cumsum(self.count)

    def of_text(self, i: int) -> np.ndarray:
        return self.hashes[self.ends[i] - self.count[i] : self.ends[i]]

    def first(self, levels: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
        """Of each text the first ``sizes`` shingles by rarity and hash."""
        order = np.lexsort((self.hashes, levels[self.hashes % np.uint64(CELLS)], self.of))
        rank = np.arange(len(order)) - (self.ends - self.count)[self.of]
        keep = rank < sizes[self.of]
        kept = self.hashes[order[keep]].view(np.int64)
        return np.split(kept, np.cumsum(np.bincount(self.of[keep], minlength=len(self.count)))[:-1]) if len(self.count) else []

    def bands(self, levels: np.ndarray, bands: int, rows: int) -> np.ndarray:
        """(texts, bands): hashes of the min-wise signature's bands; only texts with shingles have meaningful ones."""
        out = np.zeros((len(self.count), bands), np.uint64)
        some = np.flatnonzero(self.count)
        if not len(some):
            return out.view(np.int64)
        starts = (self.ends - self.count)[some]
        weight = np.exp2(levels[self.hashes % np.uint64(CELLS)].astype(np.float64))
        for b in range(bands):
            acc = np.full(len(some), b + 1, np.uint64)
            for r in range(rows):
                u = (_mix(self.hashes ^ _mix(np.asarray([1 + b * rows + r], np.uint64))) >> np.uint64(11)).astype(np.float64)
                draw = -np.log((u + 0.5) / 2.0**53) * weight  # exponential: the smallest is a shingle's with a chance in proportion to 1 / weight
                least = np.minimum.reduceat(draw, starts)
                hit = np.flatnonzero(draw == np.repeat(least, self.count[some]))
                _, one = np.unique(self.of[hit], return_index=True)
                acc = _mix(acc * np.uint64(0x9E3779B97F4A7C15) + self.hashes[hit[one]])
            out[some, b] = acc
        return out.view(np.int64)


def _parts(sizes: np.ndarray, most: int = AT_ONCE) -> Iterator[slice]:
    """Slices of a batch with about ``most`` words each, so that very long texts are taken a few at a time."""
    lo, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield slice(lo, i)
            lo, total = i, 0
        total += n
    if lo < len(sizes):
        yield slice(lo, len(sizes))


def edit_reach(n: int, part: int) -> int:
    """The most edits a text of n words may be away from a partner: d <= longest // part with longest <= n + d."""
    return n // (part - 1)


def within_edits(a: Sequence[str], b: Sequence[str], most: int) -> bool:
    """Whether at most ``most`` words inserted, deleted or replaced turn a into b. Columns of the edit table are bit vectors, so long texts take few steps."""
    if abs(len(a) - len(b)) > most:
        return False
    i = 0
    while i < len(a) and i < len(b) and a[i] == b[i]:
        i += 1
    j = 0
    while j < len(a) - i and j < len(b) - i and a[-1 - j] == b[-1 - j]:
        j += 1
    a, b = a[i : len(a) - j], b[i : len(b) - j]
    if not a or not b:
        return max(len(a), len(b)) <= most
    places: dict[str, int] = {}
    for k, w in enumerate(a):
        places[w] = places.get(w, 0) | 1 << k
    every, top, score = (1 << len(a)) - 1, 1 << (len(a) - 1), len(a)
    up, down = every, 0  # cells one more, one less than the cell above
    for left, w in enumerate(b, 1 - len(b)):
        eq = places.get(w, 0)
        flat = eq | down
        across = (((eq & up) + up) ^ up) | eq
        right_up, right_down = (down | ~(across | up)) & every, up & across
        if right_up & top:
            score += 1
        elif right_down & top:
            score -= 1
        if score + left > most:  # each word still to come takes off one at most
            return False
        right_up, right_down = (right_up << 1 | 1) & every, right_down << 1 & every
        up, down = (right_down | ~(flat | right_up)) & every, right_up & flat
    return score <= most


class Rule:
    """What counts as near. ``edits_part``: edits at most one ``edits_part``-th of the longer text's words; else Jaccard of shingles at least ``jaccard``."""

    def __init__(self, width: int = 5, jaccard: float | None = 0.8, edits_part: int | None = None) -> None:
        if (jaccard is None) == (edits_part is None):
            raise ValueError("give jaccard or edits_part")
        if edits_part is not None and edits_part < 2:
            raise ValueError("edits_part must be at least 2")
        self.width, self.jaccard, self.edits_part = width, jaccard, edits_part

    def sketch_sizes(self, words: np.ndarray, shingles: np.ndarray) -> np.ndarray:
        """k first shingles that suffice; 0 where no different text can be near."""
        if self.edits_part:
            d = words // (self.edits_part - 1)
            return np.where(d > 0, np.minimum(shingles, self.width * d + 1), 0)
        return np.where(shingles > 0, shingles - np.ceil(self.jaccard * shingles - 1e-9).astype(np.int64) + 1, 0)

    def decide(self, a: Sequence[str], b: Sequence[str], p: np.ndarray, q: np.ndarray) -> tuple[float, bool]:
        """Exact Jaccard similarity of the shingles p of words a and q of words b, and whether the two are near."""
        both = len(np.intersect1d(p, q, assume_unique=True))
        alike = both / (len(p) + len(q) - both) if len(p) + len(q) else 0.0
        if not self.edits_part:
            return alike, bool(len(p)) and alike >= self.jaccard - 1e-9
        most = max(len(a), len(b)) // self.edits_part
        # n edits spoil at most width * n shingles, so the overlap has an exact lower bound
        return alike, both >= max(len(p), len(q)) - self.width * most and within_edits(a, b, most)

    def near(self, a: str, b: str) -> bool:
        texts = [a.split(" "), b.split(" ")]
        s = Shingles(texts, self.width, _WordHash())
        return self.decide(*texts, s.of_text(0), s.of_text(1))[1]


def cell_levels(rows: DataFrame, width: int) -> np.ndarray:
    """log2 of the number of shingles by hash cell, over all texts ``t``: one byte for each of ``CELLS`` cells, however large the corpus.

    A phrase that a fixed share of all texts have in common, whose bucket would grow with the corpus, stands out of its cell at any size.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, known = np.zeros(CELLS, dtype=np.int64), _WordHash()
        for pdf in batches:
            texts = [words_of(t) for t in pdf["t"]]
            for part in _parts(np.asarray([len(w) for w in texts])):
                h = Shingles(texts[part], width, known).hashes
                total += np.bincount((h % np.uint64(CELLS)).astype(np.int64), minlength=CELLS)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"cell": at.astype(np.int32), "n": total[at]})

    got = rows.select("t").mapInPandas(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(CELLS, dtype=np.uint8)
    if len(got):
        out[got["cell"].to_numpy()] = np.floor(np.log2(got["n"].to_numpy().astype(np.float64))).astype(np.uint8)
    return out


def sketches(rows: DataFrame, rule: Rule, *, bands: int = BANDS, band_rows: int = ROWS) -> DataFrame:
    """(record, side, h, n, bands, keys): digest and number of a text's words, its bands and its first shingles; texts without words fall out."""
    levels = rows.sparkSession.sparkContext.broadcast(cell_levels(rows, rule.width))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        level, known = levels.value, _WordHash()
        for pdf in batches:
            words = [words_of(t) for t in pdf["t"]]
            sizes = np.asarray([len(w) for w in words], np.int64)
            pdf, words, sizes = pdf[sizes > 0], [w for w in words if w], sizes[sizes > 0]
            keys: list[np.ndarray] = []
            banded: list[np.ndarray] = []
            for part in _parts(sizes):
                n = sizes[part]
                wanted = rule.sketch_sizes(n, np.maximum(n - rule.width + 1, 0)) > 0
                s = Shingles([w if k else () for w, k in zip(words[part], wanted, strict=True)], rule.width, known)
                keys += s.first(level, rule.sketch_sizes(n, s.count))
                signed = s.bands(level, bands, band_rows)
                banded += [r if c else r[:0] for r, c in zip(signed, s.count, strict=True)]
            column = lambda v: pd.Series(v, index=pdf.index, dtype=object)
            digests = column([digest(w) for w in words])
            yield pd.DataFrame({"record": pdf["record"], "side": pdf["side"], "h": digests, "n": sizes.astype(np.int32), "bands": column(banded), "keys": column(keys)})

    kind = rows.schema["record"].dataType.simpleString()
    return rows.mapInPandas(run, f"record {kind}, side int, h binary, n int, bands array<long>, keys array<long>")


def near_pairs(classes: DataFrame, rows: DataFrame, rule: Rule, scratch: Scratch, *, complete: bool = True) -> DataFrame:
    """(a, b, jaccard) of different classes, a with a record on side 0 and b with one on side 1, that are near by ``rule``.

    ``classes`` is a written table. Texts are fetched for candidates only. Buckets above ``BUCKET_SHARE`` of all entries are spread over tasks. Without
    ``complete`` only the bands give candidates.
    """
    buckets = F.concat("bands", "keys") if complete else F.col("bands")
    entries = classes.select("id", "n", "on0", "on1", F.explode(buckets).alias("bucket"))
    a = entries.filter("on0").select("bucket", F.col("id").alias("a"), F.col("n").alias("na"))
    b = entries.filter("on1").select("bucket", F.col("id").alias("b"), F.col("n").alias("nb"))
    longer = F.greatest("na", "nb")
    close = F.abs(F.col("na") - F.col("nb")) <= (F.floor(longer / rule.edits_part) if rule.edits_part else F.floor(longer * (1 - rule.jaccard)) + rule.width)
    met = salted_join(a, b, "bucket", heavy=heavy_keys(entries.select("bucket"), "bucket", BUCKET_SHARE))
    candidates = scratch.keep(met.filter((F.col("a") != F.col("b")) & close).select("a", "b").distinct())
    ids = candidates.select(F.col("a").alias("id")).unionByName(candidates.select(F.col("b").alias("id"))).distinct()
    wanted = classes.select("id", "h", F.col("rep").alias("record")).join(ids, "id", "left_semi")
    fetched = rows.select("record", "t").join(wanted, "record")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A record that comes with several texts is told apart by the digest."""
        for pdf in batches:
            words = [words_of(t) for t in pdf["t"]]
            keep = [digest(w) == bytes(h) for w, h in zip(words, pdf["h"], strict=True)]
            yield pd.DataFrame({"id": pdf["id"][keep], "h": pdf["h"][keep], "words": [" ".join(w) for w, k in zip(words, keep, strict=True) if k]})

    read_texts = fetched.select("id", "h", "t").mapInPandas(read, "id long, h binary, words string")
    texts = scratch.keep(read_texts.groupBy("id").agg(F.any_value("h").alias("h"), F.any_value("words").alias("words")))
    # a text with very many candidates is no hot spot: its pairs are spread
    with_a = salted_join(candidates, texts.select(F.col("id").alias("a"), F.col("h").alias("ha"), F.col("words").alias("wa")), "a", heavy=heavy_keys(candidates, "a"))
    full = salted_join(with_a, texts.select(F.col("id").alias("b"), F.col("h").alias("hb"), F.col("words").alias("wb")), "b", heavy=heavy_keys(candidates, "b"))

    def check(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        known = _WordHash()
        for x, y in batches:
            out: list[tuple[float, bool]] = []
            sizes = (x.str.count(" ") + y.str.count(" ") + 2).to_numpy()
            for part in _parts(sizes):
                mine, theirs = [t.split(" ") for t in x.iloc[part]], [t.split(" ") for t in y.iloc[part]]
                s = Shingles([*mine, *theirs], rule.width, known)
                out += [rule.decide(p, q, s.of_text(i), s.of_text(len(mine) + i)) for i, (p, q) in enumerate(zip(mine, theirs, strict=True))]
            yield pd.DataFrame(out, columns=["jaccard", "near"])

    # declared so that the filter on its result doesn't make Spark run it twice
    judged = full.select(F.col("ha").alias("a"), F.col("hb").alias("b"), F.pandas_udf(check, "jaccard double, near boolean").asNondeterministic()("wa", "wb").alias("c"))  # type: ignore[call-overload]
    found = scratch.keep(judged.filter("c.near").select("a", "b", "c.jaccard"))
    scratch.free(candidates, texts)
    return found


def cross_overlaps(df: DataFrame, rule: Rule, *, record: str, text: str, side: str, complete: bool = True) -> tuple[DataFrame, DataFrame]:
    """Membership (record, side, id) and pairs (a, b, exact, jaccard) of classes across sides; a is on side 0, b on side 1.

    ``side`` is 0 for training, 1 for evaluation, null for neither. Records of one word sequence share a class, whose id is the sequence's
    128-bit digest. A class with records on both sides is the pair (id, id). Null and wordless texts are in no class. Texts of
    any length are taken whole. Repeated rows count once in ``record_pairs``. An empty table, or one side without records, gives no pairs. Without
    ``complete`` near pairs are those of the bands alone, which miss some by chance.
    """
    scratch = Scratch(df.sparkSession, "overlap")
    slim = df.select(F.col(record).alias("record"), F.col(side).cast("int").alias("side"), F.col(text).alias("t"))
    slim = slim.filter("t is not null and side is not null and record is not null")
    rows = scratch.keep(sketches(slim, rule))
    found = rows.groupBy("h").agg(
        F.min("record").alias("rep"), F.max(F.col("side") == 0).alias("on0"), F.max(F.col("side") == 1).alias("on1"), F.max("n").alias("n"), F.any_value("bands").alias("bands"), F.any_value("keys").alias("keys")
    )
    # short numbers stand for digests in the buckets; the written table fixes them
    classes = scratch.keep(found.withColumn("id", F.monotonically_increasing_id()))
    members = rows.select("record", "side", F.col("h").alias("id"))
    same = classes.filter("on0 and on1").select(F.col("h").alias("a"), F.col("h").alias("b"), F.lit(True).alias("exact"), F.lit(1.0).alias("jaccard"))
    near = near_pairs(classes, slim, rule, scratch, complete=complete).select("a", "b", F.lit(False).alias("exact"), "jaccard")
    return members, same.unionByName(near)


def record_pairs(members: DataFrame, pairs: DataFrame) -> DataFrame:
    """(row_id_a, row_id_b, exact, jaccard): the two records of each pair across sides, the smaller first. Classes with very many records are spread over tasks."""
    heavy = heavy_keys(members, "id")
    train = members.filter("side = 0").select(F.col("id").alias("a"), F.col("record").alias("x"))
    held = members.filter("side = 1").select(F.col("id").alias("b"), F.col("record").alias("y"))
    left = salted_join(train, pairs, "a", heavy=heavy)
    both = salted_join(left, held, "b", heavy=heavy)
    return both.select(F.least("x", "y").alias("row_id_a"), F.greatest("x", "y").alias("row_id_b"), "exact", "jaccard").distinct()
