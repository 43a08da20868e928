"""Reading level of each document.

Two interpolated character n-gram models with a word level on top are trained on samples of known level. Each sample counts in both: in the easy
one by how far its level lies below the hardest, in the hard one by how far above the easiest, so no level is a border. A document's words get their surprisal under
both; repeated words count once in each window, so that topic words don't move the result. The distribution of the differences over the
whole document gives a score, the mean of its quantiles without the outermost ones. Isotonic regression maps scores to levels. The scores it
learns from come from models that did not see their sample.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ORDER = 5
WINDOW = 150
QUANTILES = np.linspace(0.05, 0.95, 19)
QUARTILES = np.asarray([0.25, 0.5, 0.75])
POWER = 2.0
MOST_SAMPLES = 20_000
CACHE = 300_000
START, END = "^", "$"
# mark-up, entities, time marks and speaker marks are layout, not wording
LAYOUT = re.compile(r"<[^<>]{0,200}>|&#?\w{1,10};|\[\d[\d:.,]*\]|\bS\d+:")
LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """Words in lower case without accents, digits and layout."""
    if not text.isascii():
        text = "".join(c for c in unicodedata.normalize("NFKD", text) if unicodedata.category(c) not in ("Mn", "Cf"))
    return LETTERS.findall(LAYOUT.sub(" ", text).lower())


class NGrams:
    """Witten-Bell interpolated character n-grams of words, interpolated with word frequencies. Texts may have weights; those of weight 0 don't count at all."""

    def __init__(self, texts: Sequence[Sequence[str]], order: int = ORDER, weights: Sequence[float] | None = None) -> None:
        self.order = order
        grams: dict[str, Counter] = defaultdict(Counter)
        self.words: Counter = Counter()
        for t, weight in zip(texts, weights if weights is not None else [1.0] * len(texts), strict=True):
            if weight > 0:
                for w in t:
                    self.words[w] += weight
        for w, n in self.words.items():
            s = START * (order - 1) + w + END
            for i in range(order - 1, len(s)):
                for k in range(order):
                    grams[s[i - k : i]][s[i]] += n
        self.grams = {h: dict(c) for h, c in grams.items()}
        self.total = {h: (sum(c.values()), len(c)) for h, c in self.grams.items()}
        self.n = sum(self.words.values())

    def surprisal(self, word: str) -> float:
        """Bits of a word."""
        s, log_p = START * (self.order - 1) + word + END, 0.0
        for i in range(self.order - 1, len(s)):
            p = 1 / 64
            for k in range(self.order):
                h = s[i - k : i]
                if h not in self.total:
                    break
                n, kinds = self.total[h]
                p = (self.grams[h].get(s[i], 0) + kinds * p) / (n + kinds)
            log_p += math.log2(p)
        kinds = len(self.words)
        if not kinds:
            return -log_p
        known = self.words.get(word, 0)
        if not known and log_p < -900:  # too small for a float
            return -log_p + math.log2((self.n + kinds) / kinds)
        return -math.log2((known + kinds * 2.0**log_p) / (self.n + kinds))


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: points of the increasing step function nearest to y, for interpolation."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []
    for a, b in zip(x[order], y[order], strict=True):
        blocks.append([float(a), float(a), float(b), 1.0])
        while len(blocks) > 1 and blocks[-2][2] >= blocks[-1][2]:
            lo, hi = blocks[-2], blocks.pop()
            n = lo[3] + hi[3]
            blocks[-1] = [lo[0], hi[1], (lo[2] * lo[3] + hi[2] * hi[3]) / n, n]
    xs = [v for b in blocks for v in ((b[0],) if b[0] == b[1] else (b[0], b[1]))]
    ys = [b[2] for b in blocks for _ in ((0,) if b[0] == b[1] else (0, 1))]
    return np.asarray(xs), np.asarray(ys)


def at_quantiles(values: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Interpolated quantiles of at least one value."""
    v = np.sort(values)
    at = q * (len(v) - 1)
    low = at.astype(np.int64)
    high = np.minimum(low + 1, len(v) - 1)
    return v[low] + (v[high] - v[low]) * (at - low)


class _WordBits(dict):
    """Word → (surprisal under the easy model, that less the one under the hard model), found once for each word met."""

    def __init__(self, easy: NGrams, hard: NGrams) -> None:
        super().__init__()
        self.easy, self.hard = easy, hard

    def __missing__(self, word: str) -> tuple[float, float]:
        e = self.easy.surprisal(word)
        found = self[word] = (e, e - self.hard.surprisal(word))
        return found

    def __reduce__(self) -> tuple:
        return _WordBits, (self.easy, self.hard)


class LevelModel:
    """Scores documents by the surprisal of their words, and maps scores to levels."""

    def __init__(self, texts: Sequence[str], levels: Sequence[int], *, folds: int = 5, window: int = WINDOW, power: float = POWER) -> None:
        if not texts:
            raise ValueError("no samples to learn from")
        words, self.levels = [words_of(t) for t in texts], np.asarray(levels, dtype=float)
        self.window, self.power = window, power
        scores = np.zeros(len(words))
        ordered = np.lexsort((np.arange(len(words)), self.levels))
        fold = np.empty(len(words), int)
        fold[ordered] = np.arange(len(words)) % folds
        held = len(words) >= 2 * folds
        for k in range(folds if held else 0):
            self._fit([w for w, f in zip(words, fold, strict=True) if f != k], self.levels[fold != k])
            for i in np.flatnonzero(fold == k):
                scores[i] = self.score(words[i])[0]
        self._fit(words, self.levels)
        if not held:
            scores = np.asarray([self.score(w)[0] for w in words])
        self.held_out = scores
        self.xs, self.ys = isotonic(scores, self.levels)

    def _fit(self, words: Sequence[Sequence[str]], levels: np.ndarray) -> None:
        low, high = float(levels.min()), float(levels.max())
        up = (levels - low) / (high - low) if high > low else np.full(len(levels), 0.5)
        self.bits = _WordBits(NGrams(words, weights=((1 - up) ** self.power).tolist()), NGrams(words, weights=(up**self.power).tolist()))

    def score(self, words: Sequence[str]) -> tuple[float, np.ndarray]:
        """(score, quartiles of the words' bits): from all windows' different words."""
        if not words:
            return 0.0, np.zeros(len(QUARTILES))
        if len(self.bits) > CACHE:
            self.bits.clear()
        pieces = max(1, round(len(words) / self.window))
        size = math.ceil(len(words) / pieces)
        known = self.bits.__getitem__
        found = np.asarray([x for lo in range(0, len(words), size) for x in map(known, set(words[lo : lo + size]))])
        return float(at_quantiles(found[:, 1], QUANTILES).mean()), at_quantiles(found[:, 0], QUARTILES)

    def level(self, score: float) -> float:
        return float(np.interp(score, self.xs, self.ys))


def train_level_model(samples: DataFrame, *, text: str = "text", level: str = "level", most: int = MOST_SAMPLES) -> LevelModel:
    """Fit on labelled rows with text; at most ``most`` of them, taken by hash if there are more. Null texts or levels are left out."""
    rows = samples.select(F.col(text).alias("t"), F.col(level).cast("int").alias("y")).filter("t is not null and y is not null")
    got = rows.orderBy(F.xxhash64("t"), "t", "y").limit(most).collect()
    return LevelModel([r["t"] for r in got], [r["y"] for r in got])


def reading_levels(df: DataFrame, model: LevelModel, *, text: str = "text") -> DataFrame:
    """``df`` with level_words (words at white space), level_score, level_value (1 to 5, not rounded), reading_level (the nearest whole) and surprisal_q (quartiles of the bits of the windows' different words).

    Null texts and texts without letters have nulls but for level_words, which is 0 for null and empty ones. Whole texts are scored. Rows come out
    once each, repeated rows alike; an empty table gives no rows. Existing columns with these names are replaced. The model, bounded by its samples, is broadcast.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    schema = "level_words int, level_score double, level_value double, surprisal_q array<double>"

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for s in batches:
            out = []
            for t in s:
                words = words_of(t) if t else []
                if not words:
                    out.append((len(t.split()) if t else 0, None, None, None))
                    continue
                score, bits = m.score(words)
                out.append((len(t.split()), score, m.level(score), bits.tolist()))
            yield pd.DataFrame(out, columns=["level_words", "level_score", "level_value", "surprisal_q"]).astype({"level_words": "int32", "level_score": "float64", "level_value": "float64"})

    rated = df.withColumn("_level", F.pandas_udf(run, schema)(F.col(text)))  # type: ignore[call-overload]
    names = ["level_words", "level_score", "level_value", "surprisal_q"]
    nearest = F.floor(F.col("_level.level_value") + 0.5).cast("int")
    return rated.withColumns({n: F.col(f"_level.{n}") for n in names} | {"reading_level": nearest}).drop("_level")
