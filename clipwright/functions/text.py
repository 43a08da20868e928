"""Transcript normalisation and text statistics as column expressions."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Blanks as Python's str.strip and \s see them
BLANK = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
# Quotes that become an apostrophe, dashes that become a space, and what a transcript may hold
QUOTES = "’‘“”`"
DASHES = "—–"
ALLOWED = "A-Za-z0-9.,?!'\" \\-"
PUNCTUATION = ".,?!"
# the audit's set, which leaves out the double quote
EXPECTED = r"[A-Za-z0-9\s.,?!'\-]"


@lru_cache(maxsize=1)
def accent_map() -> tuple[str, str]:
    """(from, to) for ``translate``: what removing accents turns into something the rules keep; marks without a target are deleted."""
    keep = set(QUOTES + DASHES) | {chr(c) for c in range(128)} | {c for c in map(chr, range(0x3001)) if c.isspace()}
    pairs, marks = [], []
    for code in range(0x110000):
        c = chr(code)
        if unicodedata.category(c) == "Mn":
            marks.append(c)
            continue
        if code < 128 or 0xD800 <= code < 0xE000 or 0xAC00 <= code < 0xD7A4:
            continue
        plain = "".join(x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x) != "Mn")
        if plain != c and len(plain) == 1 and plain in keep:
            pairs.append((c, plain))
    return "".join(a for a, _ in pairs) + "".join(marks), "".join(b for _, b in pairs)


def strip(c: Column) -> Column:
    """Without blanks of any kind at the ends."""
    return F.regexp_replace(c, f"^{BLANK}+|{BLANK}+$", "")


def capitalize(c: Column) -> Column:
    """First letter upper, all others lower: not word by word."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 2**31 - 1)))


def normalize_transcript(c: Column) -> Column:
    """Accents off, quotes and dashes made plain, sentences unglued, anything else out of place blanked, blanks single. Null stays null."""
    source, target = accent_map()
    c = F.translate(c, source, target)
    c = F.translate(c, QUOTES, "'" * len(QUOTES))
    c = F.regexp_replace(c, '"{2,}', '"')
    c = F.translate(c, DASHES, " " * len(DASHES))
    c = F.regexp_replace(c, f"{BLANK}+-{BLANK}+", "-")
    c = F.regexp_replace(c, r"([A-Za-z])\.([A-Z])", "$1. $2")
    c = F.regexp_replace(c, f"{BLANK}+([,.])", "$1")
    c = F.regexp_replace(c, f"[^{ALLOWED}]", " ")
    return F.trim(F.regexp_replace(c, " +", " "))


def has_punctuation(c: Column) -> Column:
    return c.rlike(r"[.,?!]")


def with_normalized_transcript(df: DataFrame, text: str = "transcription") -> DataFrame:
    """``text`` normalised in place and ``has_punctuation`` of the result."""
    return df.withColumn(text, normalize_transcript(F.col(text))).withColumn("has_punctuation", has_punctuation(F.col(text)))


def character_counts(df: DataFrame, text: str) -> DataFrame:
    """(char, n) over the corpus; a character outside the basic plane is one character. Partial counts go before the shuffle."""
    chars = df.select(F.explode(F.split(F.col(text), "")).alias("char")).filter(F.col("char") != "")
    return chars.groupBy("char").agg(F.count(F.lit(1)).alias("n"))


def unexpected_characters(df: DataFrame, text: str, limit: int = 20) -> DataFrame:
    """The ``limit`` most frequent characters outside the audit's set, with their code point as ``repr``-like key."""
    found = character_counts(df, text).filter(~F.col("char").rlike(f"^{EXPECTED}$"))
    return found.orderBy(F.desc("n"), "char").limit(limit)


def length_stats(df: DataFrame, text: str) -> DataFrame:
    """One row: rows, empty and null texts, and code point lengths."""
    n = F.length(text)
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col(text).isNull()).alias("nulls"), F.count_if(F.col(text) == "").alias("empty"),
        F.min(n).alias("shortest"), F.max(n).alias("longest"), F.avg(n).alias("mean_length"),
    )


def normalization_diff(df: DataFrame, text: str, row_id: str, limit: int = 10) -> DataFrame:
    """The first ``limit`` rows by ``row_id`` that normalisation changes, before and after."""
    after = normalize_transcript(F.col(text))
    changed = df.select(F.col(row_id).alias("row_id"), F.col(text).alias("before"), after.alias("after")).filter("before <> after")
    return changed.orderBy("row_id").limit(limit)
