"""Embedding of clips by a pluggable encoder, in batches of similar length."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipwright.functions.audio import VAD_RATE, resample, to_mono

BATCH, LEAST_BATCH = 32, 1
BANDS = 24

Encoder = Callable[[np.ndarray, np.ndarray], np.ndarray]


def band_encoder(clips: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A plain stand-in for a trained encoder: mean and spread of log energies in ``BANDS`` bands of a mel-like scale."""
    out = np.zeros((len(clips), 2 * BANDS), np.float32)
    edges = (np.expm1(np.linspace(0, np.log1p(VAD_RATE / 2 / 700), BANDS + 1)) * 700 / (VAD_RATE / 2) * 200).astype(int)
    for i, n in enumerate(lengths):
        x = np.pad(clips[i, :n], (0, max(0, 400 - n)))
        frames = np.lib.stride_tricks.sliding_window_view(x, 400)[::160] * np.hanning(400)
        power = np.abs(np.fft.rfft(frames, axis=1)) ** 2
        bands = np.stack([power[:, a : max(b, a + 1)].mean(axis=1) for a, b in zip(edges, edges[1:], strict=False)], axis=1)
        logs = np.log(bands + 1e-8)
        out[i] = np.concatenate([logs.mean(axis=0), logs.std(axis=0)])
    return out


def in_halving_batches(clips: list[np.ndarray], encoder: Encoder, batch: int = BATCH, least: int = LEAST_BATCH) -> np.ndarray:
    """Encoded clips in their order. They are padded in batches of similar length; a batch too large for memory is halved, down to ``least``."""
    order = np.argsort([len(c) for c in clips], kind="stable")
    parts, at = [], 0
    while at < len(order):
        some = [clips[i] for i in order[at : at + batch]]
        lengths = np.asarray([len(c) for c in some])
        padded = np.zeros((len(some), int(lengths.max())), np.float32)
        for i, c in enumerate(some):
            padded[i, : len(c)] = c
        try:
            parts.append(np.asarray(encoder(padded, lengths), np.float32))
        except MemoryError:
            if len(some) <= least:
                raise
            batch = max(least, len(some) // 2)
            continue
        at += len(some)
    out = np.empty((len(clips), parts[0].shape[1]), np.float32)
    out[order] = np.concatenate(parts)
    return out


def embed(df: DataFrame, samples: str, rate: str, *, encoder: Encoder = band_encoder, batch: int = BATCH, least: int = LEAST_BATCH, strict: bool = False) -> DataFrame:
    """``df`` without its audio columns, with ``embedding`` (length one, by the encoder of mono clips at 16 kHz) and ``embedding_ok``.

    Clips that are null, empty or silent have a null embedding and false, or stop the query if ``strict``.
    """

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for s, r in batches:
            clips: dict[int, np.ndarray] = {}
            for i, (x, k) in enumerate(zip(s, r, strict=True)):
                y = resample(to_mono(x), int(k), VAD_RATE) if x is not None and k and len(x) else np.zeros(0, np.float32)
                if np.any(y):
                    clips[i] = y
                elif strict:
                    raise ValueError("a clip has no audio")
            vectors: list = [None] * len(s)
            if clips:
                found = in_halving_batches(list(clips.values()), encoder, batch, least)
                found = found / (np.linalg.norm(found, axis=1, keepdims=True) + 1e-10)
                for i, v in zip(clips, found, strict=True):
                    vectors[i] = v
            yield pd.DataFrame({"v": pd.Series(vectors, dtype=object), "ok": [v is not None for v in vectors]})

    done = F.pandas_udf(run, "v array<float>, ok boolean").asNondeterministic()  # type: ignore[call-overload]
    out = df.withColumn("_e", done(F.col(samples), F.col(rate))).drop(samples, rate)
    return out.withColumn("embedding", F.col("_e.v")).withColumn("embedding_ok", F.col("_e.ok")).drop("_e")
