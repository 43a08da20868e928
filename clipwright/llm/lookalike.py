"""One form for texts that look the same.

A text is compatibility-decomposed, rid of characters that show nothing, and its blanks of all kinds become spaces. Each
character that has look-alikes then stands for its whole class, which makes a token a lattice of spellings; Viterbi
search takes the spelling with the best character bigram score, where a change of script costs extra. Bigrams of the letters themselves are
counted over all tokens of the corpus. Equal-looking texts have the same lattice, hence the same form; different
lattices share no spelling, hence have different forms.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipwright.operators.skew import heavy_keys, salted_join
from clipwright.storage import Scratch

# Letters that can't be told apart in common type faces; the Latin one comes first in each class.
LOOKALIKES = (
    "AΑАᎪꓮ", "BΒВᏴꓐ", "CϹСᏟꓚ", "DꓓᎠ", "EΕЕᎬꓰ", "FϜꓝ", "GԌꓖ", "HΗНᎻꓧ", "IΙІӀꓲ", "JͿЈᎫꓙ", "KΚКᏦꓗ", "LᏞꓡ", "MΜМᎷꓟ", "NΝꓠ", "OΟОՕꓳ", "PΡРᏢꓑ", "QԚ", "RᏒꓣ", "SЅՏᏚꓢ", "TΤТᎢꓔ", "UՍꓴ", "VѴᏙꓦ",
    "WԜᎳꓪ", "XΧХꓫ", "YΥҮꓬ", "ZΖᏃꓜ",
    "aа", "cϲс", "dԁ", "eе", "gɡց", "hһհ", "iі", "jϳј", "lӏ", "nո", "oοоօ", "pρр", "qԛզ", "sѕ", "uս", "vνѵ", "wԝ", "xх", "yуү",
    "-‐‒−⁃",
)
CLASS = {c: k for k, members in enumerate(LOOKALIKES) for c in members}
OPTIONS = {members[0]: members for members in LOOKALIKES}
SKELETON = {ord(c): members[0] for members in LOOKALIKES for c in members[1:]}
# Characters that show nothing though their category is not Cf or Cc
SHOWS_NOTHING = frozenset([0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0, *range(0x180B, 0x1810), *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0)])
# Format characters that can be seen
SEEN_FORMATS = frozenset([*range(0x0600, 0x0606), 0x06DD, 0x070F, 0x0890, 0x0891, 0x08E2, 0x110BD, 0x110CD])
BLANKS = frozenset("\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
ALPHABETS_END = "\u0590"  # after Latin, Greek, Cyrillic and Armenian
CACHE = 500_000
SCRIPT_CHANGE = 8.0
EDGE = "\0"


class _Fold(dict):
    """Character → what is left of it, found once for each character met."""

    def __missing__(self, code: int) -> str | None:
        c = chr(code)
        if c in BLANKS:
            out: str | None = " "
        elif code in SHOWS_NOTHING or (unicodedata.category(c) in ("Cf", "Cc") and code not in SEEN_FORMATS):
            out = None
        elif c in CLASS and unicodedata.normalize("NFKD", c) not in CLASS:  # a decomposition that looks different
            out = LOOKALIKES[CLASS[c]][0]
        else:
            out = c
        self[code] = out
        return out


_FOLD = _Fold()


def fold(text: str) -> str:
    """Compatibility decomposition without characters that show nothing, all blanks as spaces, none at the ends. Look-alikes stay."""
    if text.isascii() and text.isprintable():
        return text.strip(" ")
    # deletion may bring accents together that stood apart, so they are put in order after it
    return unicodedata.normalize("NFKD", unicodedata.normalize("NFKD", text.translate(_FOLD)).translate(_FOLD)).strip(" ")


def skeleton(text: str) -> str:
    """The lattice's name: each look-alike as the first of its class."""
    return text if text.isascii() else text.translate(SKELETON)


def script(c: str) -> str:
    """Coarse script of a letter from its Unicode name; "" for marks, digits and punctuation, which go with any script."""
    return unicodedata.name(c, "").split(" ", 1)[0] if c.isalpha() else ""


def kind(c: str) -> str:
    """The model's symbol: letters and signs of the alphabets that share look-alikes, and look-alikes, stand for themselves, a character of another script for that script. So the alphabet is bounded: some 1,400 symbols."""
    return c if c < ALPHABETS_END or c in CLASS else "*" + script(c)


def token_bigrams(tokens: Iterable[str]) -> Counter:
    out: Counter = Counter()
    for t in tokens:
        symbols = [EDGE, *(kind(c) for c in t if not unicodedata.combining(c)), EDGE]
        out.update(zip(symbols, symbols[1:], strict=False))
    return out


class Model:
    """Add-one smoothed bigram log probabilities with a cost for a change of script, and the best spelling of a lattice."""

    def __init__(self, counts: dict[tuple[str, str], int]) -> None:
        self.counts = counts
        self.row: Counter = Counter()
        for (a, _), n in counts.items():
            self.row[a] += n
        self.size = len({b for _, b in counts}) + 1
        self.steps: dict[tuple[str, str], float] = {}
        self.cache: dict[str, str] = {}

    def cost(self, a: str, b: str) -> float:
        """Negative log probability of b after a, and more if the script changes."""
        ka, kb = (EDGE if x == EDGE else kind(x) for x in (a, b))
        sa, sb = ("" if x == EDGE else script(x) for x in (a, b))
        found = (SCRIPT_CHANGE if sa and sb and sa != sb else 0.0) - math.log((self.counts.get((ka, kb), 0) + 1) / (self.row[ka] + self.size))
        if len(self.steps) > CACHE:
            self.steps.clear()
        self.steps[a, b] = found
        return found

    def best(self, lattice: str) -> str:
        """The best spelling of a skeleton token; of equal scores the one earlier in its class. Accents keep their place behind their letter."""
        found = self.cache.get(lattice)
        if found is not None:
            return found
        steps = self.steps
        options, scores = (EDGE,), [0.0]
        trail: list[tuple[str, list[int]]] = []
        for c in [*lattice, EDGE]:
            if c > "\u02ff" and unicodedata.combining(c):
                trail.append((c, []))
                continue
            choices = OPTIONS.get(c, c)
            new, back = [], []
            for b in choices:
                low, at = math.inf, 0
                for i, a in enumerate(options):
                    step = steps.get((a, b))
                    v = scores[i] + (self.cost(a, b) if step is None else step)
                    if v < low:
                        low, at = v, i
                new.append(low)
                back.append(at)
            trail.append((choices, back))
            options, scores = choices, new
        out, at = [], 0
        for choices, back in reversed(trail):
            if back:
                out.append(choices[at])
                at = back[at]
            else:
                out.append(choices)
        found = "".join(reversed(out[1:]))
        if len(self.cache) > CACHE:
            self.cache.clear()
        self.cache[lattice] = found
        return found

    def canonical(self, text: str) -> str:
        return unicodedata.normalize("NFC", " ".join(self.best(t) if t else "" for t in skeleton(fold(text)).split(" ")))


def count_bigrams(df: DataFrame, text: str) -> dict[tuple[str, str], int]:
    """Character bigrams of all tokens of all texts; the result has a row for each pair of model symbols, a bounded alphabet."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words: Counter = Counter()
        out: Counter = Counter()

        def flush() -> None:
            for w, n in words.items():
                for pair, k in token_bigrams([w]).items():
                    out[pair] += n * k
            words.clear()

        for pdf in batches:
            for t in pdf["t"]:
                if t:
                    words.update(x for x in fold(t).split(" ") if x)
            if len(words) > 200_000:
                flush()
        flush()
        if out:
            yield pd.DataFrame([(a, b, n) for (a, b), n in out.items()], columns=["a", "b", "n"])

    counts = df.select(F.col(text).alias("t")).filter("t is not null").mapInPandas(partial, "a string, b string, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
    return {(r["a"], r["b"]): r["n"] for r in counts.collect()}


def canonical_text(df: DataFrame, text: str, into: str = "canonical", *, counts: dict[tuple[str, str], int] | None = None) -> DataFrame:
    """``df`` with ``into``, the one form of ``text``: null for null, "" where nothing shows.

    Case, accents, punctuation other than hyphens, and the number of blanks inside a text are kept. Each row comes out
    once, repeated rows alike; an empty table gives no rows. A column called ``into`` is replaced, unless it is ``text``, which raises an error.
    Texts of any length are taken whole.
    """
    if text == into:
        raise ValueError("the new column needs a name of its own")
    shared = df.sparkSession.sparkContext.broadcast(count_bigrams(df, text) if counts is None else counts)

    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = Model(shared.value)
        for s in batches:
            yield s.map(lambda t: None if t is None else model.canonical(t)).astype(object)

    # declared so that a filter on the result doesn't make Spark run it twice
    return df.withColumn(into, F.pandas_udf(apply, "string").asNondeterministic()(F.col(text)))  # type: ignore[call-overload]


def lookalike_classes(df: DataFrame, text: str, record: str, *, scratch: Scratch | None = None) -> DataFrame:
    """(record, t, form): membership of records in classes of equal look: digests of 128 bits of the text and of its canonical form, a written table.

    Null records, null texts and texts that show nothing are in no class. So copies of a text and pairs of a large class need not be written out.
    """
    scratch = scratch or Scratch(df.sparkSession, "lookalike")
    slim = df.select(F.col(record).alias("record"), F.col(text).alias("text")).filter("text is not null and record is not null")
    # digests stand for texts and forms, so no text is shuffled
    return scratch.keep(canonical_text(slim, "text", "form").filter("form <> ''").select("record", F.unhex(F.md5("text")).alias("t"), F.unhex(F.md5("form")).alias("form")))


def lookalike_pairs(df: DataFrame, text: str, record: str) -> DataFrame:
    """(row_id_a, row_id_b): records, the smaller first, whose texts are different strings with the same, non-empty canonical form.

    Each different text of a canonical form is joined once with the others of its form, and only the found pairs are spread to
    their records, so copies of one text make no work beyond the result. Forms with very many texts and texts with very many copies are spread over tasks.
    Null ``record`` values are ignored.
    """
    scratch = Scratch(df.sparkSession, "lookalike")
    rows = lookalike_classes(df, text, record, scratch=scratch)
    texts = rows.groupBy("form", "t").agg(F.lit(1).alias("one"))
    several = texts.groupBy("form").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("form")
    variants = scratch.keep(salted_join(rows.select("form", "t"), several, "form", heavy=heavy_keys(rows, "form"), how="left_semi").distinct())
    twins = salted_join(variants, variants.withColumnRenamed("t", "u"), "form", heavy=heavy_keys(variants, "form")).filter("t < u").select("t", "u")
    heavy = heavy_keys(rows, "t")
    few = scratch.keep(salted_join(rows.select("record", "t"), variants.select("t").distinct(), "t", heavy=heavy, how="left_semi"))
    a = salted_join(few.withColumnRenamed("record", "a"), twins, "t", heavy=heavy)
    both = salted_join(a.select("a", "u"), few.select(F.col("t").alias("u"), F.col("record").alias("b")), "u", heavy=heavy).filter("a <> b")
    return both.select(F.least("a", "b").alias("row_id_a"), F.greatest("a", "b").alias("row_id_b")).distinct()
