"""Waveform kernels in numpy and their vectorised column functions.

Kernels work on one clip; a clip is one row, so nothing grows with the table. Voice activity is pluggable: the default
tells speech by frame energy, as a trained detector is not part of this package.
"""

from __future__ import annotations

import functools
import io
import struct
import wave
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StringType, StructType

RATE, VAD_RATE, FRAME_MS = 24_000, 16_000, 30
FRAME = RATE * FRAME_MS // 1000
BUFFER_SECONDS = 0.4
TARGET_LUFS, TOLERANCE_LU = -23.0, 1.0
FLOOR_DB = -120.0
# Onset rules of a microphone pop, windows in ms and thresholds in dB
POP = {
    "peak_window_ms": 25.0, "early_peak_max_ms": 12.0, "follow_start_ms": 20.0, "follow_end_ms": 120.0, "decay_early_ms": 10.0,
    "decay_late_start_ms": 30.0, "decay_late_end_ms": 100.0, "peak_threshold_dbfs": -3.0, "peak_to_rms_threshold_db": 12.0, "decay_threshold_db": 8.0,
}


def to_mono(x: np.ndarray, channels: int = 1) -> np.ndarray:
    """Channel mean of interleaved samples, NaN as 0."""
    x = np.asarray(x, dtype=np.float32)
    if channels > 1:
        x = x[: len(x) // channels * channels].reshape(-1, channels).mean(axis=1)
    return np.nan_to_num(x)


def whole_frames(x: np.ndarray, frame: int = FRAME) -> np.ndarray:
    """Cut to whole frames and limited to -1..1."""
    return np.clip(x[: len(x) // frame * frame], -1.0, 1.0)


#: numbers in the filters of a block of samples at most; ratios of more are resampled phase by phase
BLOCK = 1 << 18


def _filter(part: float, cut: float, half: int) -> np.ndarray:
    """Taps for a sample that lies ``part`` of a step after the middle of its window."""
    d = part - np.arange(-half + 1, half + 1)
    return cut * np.sinc(cut * d) * (0.5 + 0.5 * np.cos(np.pi * np.clip(d / half, -1, 1)))


@functools.lru_cache(maxsize=16)
def _block_filters(up: int, down: int, cut: float, half: int) -> np.ndarray:
    """Filters of all samples that come of a block: (blocks of input that they reach over, samples in, samples out)."""
    many = -(-2 * half // down)
    h = np.zeros((2, many * down, many * up))
    for q in range(many * up):
        start, part = divmod(q * down, up)
        h.reshape(-1, many * up)[start : start + 2 * half, q] = _filter(part / up, cut, half)
    h.flags.writeable = False
    return h


def resample(x: np.ndarray, source: int, target: int, zeros: int = 16) -> np.ndarray:
    """Windowed-sinc interpolation, low-passed at the lower of both rates, by a bank of filters: one for each phase of the ratio."""
    x = np.asarray(x, dtype=np.float64)
    if source == target or not len(x):
        return x.astype(np.float32)
    up, down = target // np.gcd(source, target), source // np.gcd(source, target)
    n = -(-len(x) * up // down)
    cut = min(1.0, up / down)
    half = int(np.ceil(zeros / cut))
    many = -(-2 * half // down)
    if 2 * many * down * many * up <= BLOCK:
        # whole blocks of samples at once, as matrix products; a block's samples reach into the next block
        blocks = -(-n // (many * up))
        padded = np.zeros(((blocks + 1) * many * down))
        padded[half - 1 : half - 1 + len(x)] = x
        rows, (here, after) = padded.reshape(-1, many * down), _block_filters(int(up), int(down), cut, half)
        return (rows[:-1] @ here + rows[1:] @ after).reshape(-1)[:n].astype(np.float32)
    padded = np.concatenate([np.zeros(half), x, np.zeros(half + down)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, 2 * half)
    out = np.empty(n)
    for phase in range(min(up, n)):
        start, part = divmod(phase * down, up)
        count = -(-(n - phase) // up)
        out[phase::up] = windows[start + 1 :: down][:count] @ _filter(part / up, cut, half)
    return out.astype(np.float32)


def to_pcm16(x: np.ndarray) -> np.ndarray:
    return (np.clip(x, -1.0, 1.0) * 32767).astype(np.int16)


def _percentile(x: np.ndarray, q: float) -> float:
    """numpy's linear percentile of some numbers, which spends most of its time on the forms that it takes."""
    at = q * (len(x) - 1)
    low = int(at)
    a, b = np.sort(x)[[low, min(low + 1, len(x) - 1)]]
    part = at - low
    return float(a + (b - a) * part if part < 0.5 else b - (b - a) * (1 - part))


def energy_vad(frames: np.ndarray, rate: int) -> np.ndarray:
    """Speech where a frame is over -45 dBFS and within 30 dB of the loudest frames."""
    if not len(frames):
        return np.zeros(0, bool)
    power = 10 * np.log10((frames.astype(np.float64) / 32768.0) ** 2 @ np.full(frames.shape[1], 1 / frames.shape[1]) + 1e-12)
    return power > max(-45.0, _percentile(power, 0.95) - 30.0)


def align(mask: np.ndarray, n: int) -> np.ndarray:
    """Cut, or padded with non-speech, to n frames."""
    return mask[:n] if len(mask) >= n else np.concatenate([mask, np.zeros(n - len(mask), bool)])


def _edges(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the true runs."""
    step = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def smooth(mask: np.ndarray, min_speech: int = 3, bridge: int = 2) -> np.ndarray:
    out = np.array(mask, dtype=bool)
    starts, ends = _edges(out)
    for a, b in zip(starts, ends, strict=True):
        if b - a < min_speech:
            out[a:b] = False
    kept = ends - starts >= min_speech
    a, b = starts[kept], ends[kept]
    for end, start in zip(b[:-1], a[1:], strict=True):
        if start - end <= bridge:
            out[end:start] = True
    return out


def vad_mask(x: np.ndarray, vad: Callable[[np.ndarray, int], np.ndarray] = energy_vad) -> np.ndarray:
    """Smoothed speech mask of 30 ms frames of a 24 kHz clip; detection runs at 16 kHz."""
    step = VAD_RATE * FRAME_MS // 1000
    pcm = to_pcm16(resample(x, RATE, VAD_RATE))
    frames = pcm[: len(pcm) // step * step].reshape(-1, step)
    return smooth(align(np.asarray(vad(frames, VAD_RATE), dtype=bool), len(x) // FRAME))


def stays(mask: np.ndarray, max_gap: int = 5, keep: int = 3) -> np.ndarray:
    """Frames that stay when non-speech runs longer than ``max_gap`` are cut to their first ``keep``."""
    out = np.ones(len(mask), bool)
    for a, b in zip(*_edges(~np.asarray(mask, bool)), strict=True):
        if b - a > max_gap:
            out[a + keep : b] = False
    return out


def trim_gaps(x: np.ndarray, mask: np.ndarray, max_gap: int = 5, keep: int = 3, frame: int = FRAME) -> np.ndarray:
    """Audio without the tails of long non-speech runs. An empty mask leaves the audio as it is."""
    if not len(mask):
        return x
    stay = stays(mask, max_gap, keep)
    if stay.all():
        return x[: len(stay) * frame]
    pick = np.repeat(stay, frame)[: len(x)]
    return x[: len(pick)][pick]


def metrics(x: np.ndarray, mask: np.ndarray) -> tuple[float, float, float, float] | None:
    """(quality_score, snr_db, speech_ratio, duration) or None without speech; the array form is ``operators.frames.quality``."""
    n = len(mask)
    power = np.mean(x[: n * FRAME].reshape(n, FRAME).astype(np.float32) ** 2, axis=1)
    speech, quiet = power[mask], np.sort(power[~mask])
    if not len(speech):
        return None
    few = len(quiet) < 4
    pool = np.sort(power) if few else quiet
    noise = float(np.mean(pool[: max(1, int(np.ceil(len(pool) * (0.1 if few else 0.2))))]))
    ratio = len(speech) / n
    snr = float(10 * np.log10((float(np.mean(speech)) + 1e-10) / (noise + 1e-10)))
    penalty = 3.0 * few + max(0.0, 0.35 - ratio) * 20 + max(0.0, ratio - 0.95) * 40
    return snr - penalty, snr, ratio, n * FRAME / RATE


def speech_span(mask: np.ndarray, samples: int) -> tuple[slice, slice] | None:
    """(samples, frames) from the first to the last speech frame, widened by ``BUFFER_SECONDS`` and held inside the clip; None without speech.

    The sample span begins between frames, as the buffer isn't a whole number of them; the frame span holds every frame it touches.
    """
    if not mask.any():
        return None
    buffer = round(BUFFER_SECONDS * RATE)
    begin = max(0, int(mask.argmax()) * FRAME - buffer)
    end = min(samples, (len(mask) - int(mask[::-1].argmax())) * FRAME + buffer)
    return slice(begin, end), slice(begin // FRAME, min(len(mask), end // FRAME + 1))


def cut_clip(samples: np.ndarray, rate: int, vad: Callable[[np.ndarray, int], np.ndarray] = energy_vad) -> tuple[np.ndarray | None, np.ndarray | None, str | None]:
    """(audio at 24 kHz, its speech mask, None) or (None, None, drop reason): edges cut to the speech, long gaps shortened."""
    audio = whole_frames(resample(to_mono(samples), rate, RATE))
    if not len(audio):
        return None, None, "empty_after_trim"
    mask = vad_mask(audio, vad)
    span = speech_span(mask, len(audio))
    if span is None:
        return None, None, "no_speech_detected"
    cut = whole_frames(trim_gaps(audio[span[0]], mask[span[1]]))
    if not len(cut):
        return None, None, "empty_after_trim"
    if len(cut) < len(audio):  # else nothing was cut, and the mask holds
        audio, mask = cut, vad_mask(cut, vad)
    return (audio, mask, None) if mask.any() else (None, None, "no_speech_detected")


def clean_clip(samples: np.ndarray, rate: int, vad: Callable[[np.ndarray, int], np.ndarray] = energy_vad) -> tuple[np.ndarray | None, dict | None, str | None]:
    """(audio at 24 kHz, metrics, None) or (None, None, drop reason): cut by ``cut_clip``, then measured."""
    audio, mask, why = cut_clip(samples, rate, vad)
    if why:
        return None, None, why
    return audio, dict(zip(("quality_score", "snr_db", "speech_ratio", "duration"), metrics(audio, mask), strict=True)), None


def amp_to_db(x: float, floor: float = 1e-8) -> float:
    return float(20 * np.log10(max(float(x), floor)))


def rms(x: np.ndarray) -> float:
    return float(np.sqrt(np.mean(np.asarray(x, dtype=np.float64) ** 2))) if len(x) else 0.0


def peak_dbfs(x: np.ndarray) -> float:
    p = float(np.max(np.abs(x))) if len(x) else 0.0
    return 20 * float(np.log10(p)) if p > 0 else FLOOR_DB


def peak_and_rms(samples: Column) -> dict[str, Column]:
    """``peak_dbfs`` and ``rms_db`` of an array of samples, in the JVM; silence has the floors of ``peak_dbfs`` and ``amp_to_db``."""
    peak = F.array_max(F.transform(samples, lambda x: F.abs(x.cast("double"))))
    square = F.aggregate(samples, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")) / F.size(samples)
    loud = F.when(peak > 0, F.lit(20.0) * F.log10(peak)).otherwise(F.lit(FLOOR_DB))
    return {"peak_dbfs": F.when(samples.isNotNull(), loud), "rms_db": F.lit(20.0) * F.log10(F.greatest(F.sqrt(square), F.lit(1e-8)))}


#: bytes of samples that a task makes at a time; Spark bounds the bytes of the batches that it sends, not of those that come back
PIECE = 4 << 20


def in_pieces(rows: Iterable[tuple], most: int = PIECE) -> Iterator[list[tuple]]:
    """Rows of results in lists of at most some ``most`` bytes of arrays; a larger row is a list of its own."""
    piece: list[tuple] = []
    held = 0
    for row in rows:
        size = sum(x.nbytes for x in row if isinstance(x, np.ndarray))
        if piece and held + size > most:
            yield piece
            piece, held = [], 0
        piece.append(row)
        held += size
    if piece:
        yield piece


def clips_of(lists: pa.Array) -> Iterator[np.ndarray | None]:
    """Each list of floats as float32, null elements as NaN, without a Python object for each sample."""
    for x in lists:
        yield x.values.to_numpy(zero_copy_only=False).astype(np.float32, copy=False) if x.is_valid else None


def lists_of(clips: Sequence[np.ndarray | None]) -> pa.Array:
    """The other way round: array<float> with null for None."""
    ends = np.cumsum([0, *(0 if x is None else len(x) for x in clips)], dtype=np.int32)
    some = [np.asarray(x, dtype=np.float32) for x in clips if x is not None]
    values = pa.array(np.concatenate(some) if some else np.zeros(0, np.float32))
    return pa.ListArray.from_arrays(pa.array(ends), values, mask=pa.array([x is None for x in clips], pa.bool_()))


def _response(b: tuple, a: tuple, n: int) -> np.ndarray:
    z = np.exp(-2j * np.pi * np.fft.rfftfreq(n))
    return (b[0] + b[1] * z + b[2] * z * z) / (a[0] + a[1] * z + a[2] * z * z)


def k_filters(rate: int) -> list[tuple[tuple, tuple]]:
    """The two K-weighting stages of ITU-R BS.1770 for any rate: a high shelf and a high pass."""
    out = []
    for f0, gain, q, shelf in ((1681.974450955533, 3.999843853973347, 0.7071752369554196, True), (38.13547087602444, 0.0, 0.5003270373238773, False)):
        k = np.tan(np.pi * f0 / rate)
        a0 = 1 + k / q + k * k
        a = (1.0, 2 * (k * k - 1) / a0, (1 - k / q + k * k) / a0)
        if shelf:
            vh = 10 ** (gain / 20)
            vb = vh**0.4996667741545416
            b = ((vh + vb * k / q + k * k) / a0, 2 * (k * k - vh) / a0, (vh - vb * k / q + k * k) / a0)
        else:
            b = (1.0, -2.0, 1.0)
        out.append((b, a))
    return out


def loudness(x: np.ndarray, rate: int) -> float | None:
    """Integrated loudness by ITU-R BS.1770-4: 400 ms blocks by 100 ms, gates at -70 LUFS and 10 LU below the ungated mean. None if too short or silent."""
    y = np.nan_to_num(np.asarray(x, dtype=np.float64))
    block, hop = int(0.4 * rate), int(0.1 * rate)
    if len(y) < block:
        return None
    # both stages at once by their frequency response; a second of silence after the clip takes up the filters' decay
    n = 1 << int(np.ceil(np.log2(len(y) + rate)))
    h = np.prod([_response(b, a, n) for b, a in k_filters(rate)], axis=0)
    y = np.fft.irfft(np.fft.rfft(y, n) * h, n)[: len(y)]
    sums = np.concatenate([[0.0], np.cumsum(y * y)])
    starts = np.arange(0, len(y) - block + 1, hop)
    z = (sums[starts + block] - sums[starts]) / block
    level = -0.691 + 10 * np.log10(np.maximum(z, 1e-20))
    z1 = z[level > -70]
    if not len(z1):
        return None
    gate = -0.691 + 10 * np.log10(z1.mean()) - 10
    z2 = z[(level > -70) & (level > gate)]
    return float(-0.691 + 10 * np.log10(z2.mean())) if len(z2) else None


def apply_gain(x: np.ndarray, db: float) -> np.ndarray:
    """Louder or softer by ``db``, limited to -1..1."""
    return np.clip(np.asarray(x, dtype=np.float64) * 10 ** (db / 20), -1, 1).astype(np.float32)


def normalize_loudness(x: np.ndarray, rate: int, target: float = TARGET_LUFS, tolerance: float = TOLERANCE_LU) -> tuple[np.ndarray, str, float | None, float | None]:
    """(audio, status, loudness before, gain): unchanged if unmeasurable or within ``tolerance``."""
    level = loudness(x, rate)
    if level is None:
        return x, "failed_loudness_measurement", None, None
    gain = target - level
    if abs(gain) <= tolerance:
        return x, "skipped_within_tolerance", level, gain
    return apply_gain(x, gain), "normalized", level, gain


def loudness_status(level: Column, target: float = TARGET_LUFS, tolerance: float = TOLERANCE_LU) -> Column:
    """The decision of ``normalize_loudness`` from a measured level."""
    bad = level.isNull() | F.isnan(level)
    return F.when(bad, "failed_loudness_measurement").when(F.abs(F.lit(target) - level) <= tolerance, "skipped_within_tolerance").otherwise("normalized")


def _windows(rate: int, p: dict[str, float]) -> dict[str, slice]:
    """The stretches of a clip's head that the pop features look at, in samples."""
    at = lambda name: int(round(p[name] * rate / 1000))
    return {
        "peak": slice(0, at("peak_window_ms")), "follow": slice(at("follow_start_ms"), at("follow_end_ms")),
        "early": slice(0, at("decay_early_ms")), "late": slice(at("decay_late_start_ms"), at("decay_late_end_ms")),
    }


def pop_features(x: np.ndarray, rate: int, **settings: float) -> dict:
    """Peak of the head, its place in samples and ms, whether that is early (within ``early_peak_max_ms``, in whole samples), and its height over what follows."""
    p = POP | settings
    windows = _windows(rate, p)
    x = np.asarray(x, dtype=np.float64)
    if len(x) < max(w.stop for w in windows.values()):
        return dict.fromkeys(("peak_to_rms_db", "decay_db", "peak_pos_ms"), 0.0) | {"status": "failed_too_short", "peak_start_dbfs": FLOOR_DB, "peak_is_early": False}
    level = {name: amp_to_db(rms(x[w])) for name, w in windows.items()}
    head = np.abs(x[windows["peak"]])
    place, peak = int(head.argmax()), amp_to_db(float(head.max()))
    early = place <= int(round(p["early_peak_max_ms"] * rate / 1000))
    return {"status": "ok", "peak_start_dbfs": peak, "peak_pos_ms": 1000 * place / rate, "peak_is_early": early, "peak_to_rms_db": peak - level["follow"], "decay_db": level["early"] - level["late"]}


def pop_rules(peak: Column, is_early: Column, over_rms: Column, decay: Column, **settings: float) -> dict[str, Column]:
    """The four rules by the name given when one fails. Whether a peak is early is told in whole samples, as ``pop_features`` does."""
    p = POP | settings
    return {
        "peak_below_threshold": peak >= p["peak_threshold_dbfs"], "peak_not_early": is_early,
        "insufficient_peak_to_rms": over_rms >= p["peak_to_rms_threshold_db"], "insufficient_decay": decay >= p["decay_threshold_db"],
    }


def pop_suggestion(flagged_percent: Column) -> Column:
    return F.when(flagged_percent < 5, "leave_as_is").when(flagged_percent < 10, "consider_conditional_fade_for_flagged").otherwise("consider_global_fade_in")


def decode_wav(data: bytes) -> tuple[np.ndarray, int]:
    """(mono float32, rate) of a RIFF file with PCM 8, 16, 24, 32 or float 32, 64 samples."""
    if len(data) < 12 or data[:4] != b"RIFF" or data[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, fmt, body = 12, None, None
    while at + 8 <= len(data):
        name, size = data[at : at + 4], struct.unpack("<I", data[at + 4 : at + 8])[0]
        chunk = data[at + 8 : at + 8 + size]
        if name == b"fmt ":
            fmt = struct.unpack("<HHIIHH", chunk[:16])
            if fmt[0] == 0xFFFE and len(chunk) >= 26:
                fmt = (struct.unpack("<H", chunk[24:26])[0], *fmt[1:])
        elif name == b"data":
            body = chunk
        at += 8 + size + size % 2
    if fmt is None or body is None:
        raise ValueError("no format or data chunk")
    kind, channels, rate, _, _, bits = fmt
    body = body[: len(body) // (bits // 8) * (bits // 8)]
    if kind == 3:
        x = np.frombuffer(body, dtype=f"<f{bits // 8}").astype(np.float32)
    elif kind == 1 and bits == 8:
        x = (np.frombuffer(body, dtype=np.uint8).astype(np.float32) - 128) / 128
    elif kind == 1 and bits in (16, 32):
        x = np.frombuffer(body, dtype=f"<i{bits // 8}").astype(np.float32) / 2 ** (bits - 1)
    elif kind == 1 and bits == 24:
        raw = np.frombuffer(body, dtype=np.uint8).reshape(-1, 3).astype(np.int32)
        x = (((raw[:, 0] | raw[:, 1] << 8 | raw[:, 2] << 16) ^ 0x800000) - 0x800000).astype(np.float32) / 2**23
    else:
        raise ValueError(f"format {kind} with {bits} bits")
    return to_mono(x, channels), rate


def encode_wav(x: np.ndarray, rate: int) -> bytes:
    """A mono float32 WAV file."""
    body = np.asarray(x, dtype="<f4").tobytes()
    head = b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 3, 1, rate, rate * 4, 4, 32) + b"data" + struct.pack("<I", len(body))
    return b"RIFF" + struct.pack("<I", len(head) + len(body)) + head + body


def header_duration(data: bytes) -> float:
    """Seconds by the header, else by decoding, else 0."""
    try:
        with wave.open(io.BytesIO(data)) as w:
            return w.getnframes() / w.getframerate()
    except (wave.Error, EOFError, ZeroDivisionError, RuntimeError, struct.error):
        try:
            x, rate = decode_wav(data)
            return len(x) / rate if rate else 0.0
        except (ValueError, struct.error, ZeroDivisionError):
            return 0.0


def head_duration(head: bytes, size: int) -> float | None:
    """Seconds by the first bytes of a RIFF file and its whole size; None if the data chunk doesn't begin in them or isn't PCM or float."""
    if len(head) < 12 or head[:4] != b"RIFF" or head[8:12] != b"WAVE":
        return None
    at, bytes_a_second = 12, 0
    while at + 8 <= len(head):
        name, length = head[at : at + 4], struct.unpack("<I", head[at + 4 : at + 8])[0]
        if name == b"fmt " and at + 24 <= len(head):
            _, channels, rate = struct.unpack("<HHI", head[at + 8 : at + 16])
            bytes_a_second = rate * channels * (struct.unpack("<H", head[at + 22 : at + 24])[0] // 8)
        elif name == b"data":
            return min(length, max(size - at - 8, 0)) / bytes_a_second if bytes_a_second else None
        at += 8 + length + length % 2
    return None


HEAD = 4096


def wav_seconds(content: Column) -> Column:
    """Seconds of binary WAV content by its head, of all of it where the head doesn't tell. 0 for null or unreadable content.

    One step gets the whole content: it joins other steps on the same content, and rows that wait for it are bounded by the bytes of a batch,
    where a step on heads alone keeps thousands of clips waiting.
    """

    def one(b: pa.Scalar) -> float:
        if not b.is_valid:
            return 0.0
        whole = b.as_buffer()
        found = head_duration(whole.slice(0, min(HEAD, whole.size)).to_pybytes(), whole.size)
        return header_duration(whole.to_pybytes()) if found is None else found

    def run(s: pa.Array) -> pa.Array:
        return pa.array([one(b) for b in s], pa.float64())

    return F.arrow_udf(run, "double")(content)  # type: ignore[call-overload]


def decoded(content: Column, rate: int = VAD_RATE, *, strict: bool = False) -> Column:
    """Binary WAV to array<float> at ``rate``. Null or unreadable content gives null, or stops the query if ``strict``."""

    def one(b: bytes | None) -> np.ndarray | None:
        try:
            if b is None:
                raise ValueError("no audio")
            x, r = decode_wav(b)
            return resample(x, r, rate)
        except (ValueError, struct.error):
            if strict:
                raise
            return None

    def run(s: pa.Array) -> pa.Array:
        return lists_of([one(b.as_py()) for b in s])

    return F.arrow_udf(run, "array<float>")(content)  # type: ignore[call-overload]


def any_audio(df: DataFrame, field: str, *, rate: str | None = None, files: DataFrame | None = None) -> DataFrame:
    """``df`` with ``samples`` and ``sampling_rate`` from an audio field of any of the usual forms; both null where there is none.

    The field may be a struct with some of ``array`` and ``sampling_rate``, ``bytes``, ``path``; an array of samples (its rate in the column ``rate``); binary
    WAV content; or a path as a string. The first form that a row has is taken. Files named by a path come from ``files`` (path, content; see
    ``sources.readers.list_audio``), joined by the path, of which a file scheme is left out.
    """
    kind = df.schema[field].dataType
    parts = kind.fieldNames() if isinstance(kind, StructType) else []
    get = lambda name, typ: (F.col(field)[name] if name in parts else F.lit(None)).cast(typ)
    samples, given = get("array", "array<float>"), get("sampling_rate", "int")
    content, path = get("bytes", "binary"), get("path", "string")
    if isinstance(kind, ArrayType):
        samples, given = F.col(field).cast("array<float>"), F.col(rate).cast("int") if rate else F.lit(None).cast("int")
    elif isinstance(kind, BinaryType):
        content = F.col(field)
    elif isinstance(kind, StringType):
        path = F.col(field)
    rows = df.withColumn("_x", samples).withColumn("_r", given).withColumn("_b", content)
    if files is not None:
        bare = lambda c: F.regexp_replace(c, "^file:/*", "/")
        table = files.select(bare(F.col("path")).alias("_path"), F.col("content").alias("_file"))
        rows = rows.withColumn("_path", F.when(F.col("_x").isNull() & F.col("_b").isNull(), bare(path))).join(table, "_path", "left")
        rows = rows.withColumn("_b", F.coalesce("_b", "_file")).drop("_path", "_file")

    def one(b: bytes | None) -> tuple:
        try:
            return decode_wav(b) if b is not None else (None, None)
        except (ValueError, struct.error):
            return None, None

    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for s in batches:
            for found in in_pieces(one(b.as_py()) for b in s):
                x, r = zip(*found, strict=True)
                yield pa.StructArray.from_arrays([lists_of(x), pa.array(r, pa.int32())], ["x", "r"])

    wav = F.arrow_udf(read, "x array<float>, r int")(F.when(F.col("_x").isNull(), F.col("_b")))  # type: ignore[call-overload]
    out = rows.withColumn("_w", wav).withColumn("samples", F.coalesce("_x", "_w.x")).withColumn("sampling_rate", F.coalesce("_r", "_w.r"))
    return out.drop("_x", "_r", "_b", "_w")


def audio_seconds(samples: Column, rate: Column) -> Column:
    """Length by samples and rate; 0 where either is missing."""
    return F.coalesce(F.when(rate > 0, F.size(samples) / rate), F.lit(0.0))


def encoded(samples: Column, rate: Column) -> Column:
    """array<float> to a binary WAV; null stays null."""

    def run(s: pa.Array, r: pa.Array) -> pa.Array:
        return pa.array([None if x is None else encode_wav(x, int(k)) for x, k in zip(clips_of(s), r.to_pylist(), strict=True)], pa.binary())

    return F.arrow_udf(run, "binary")(samples, rate)  # type: ignore[call-overload]


def measured_loudness(samples: Column, rate: Column) -> Column:
    def run(s: pd.Series, r: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else loudness(np.asarray(x), int(k)) for x, k in zip(s, r, strict=True)], dtype="float64")

    return F.pandas_udf(run, "double")(samples, rate)  # type: ignore[call-overload]


def loudness_gain(df: DataFrame, samples: str, rate: str, target: float = TARGET_LUFS, tolerance: float = TOLERANCE_LU) -> DataFrame:
    """``df`` with ``samples`` at ``target`` loudness, and loudness_status, loudness_before, loudness_gain, loudness_clipped (whether the gain met the limits of -1..1) and peak_dbfs after it.

    Clips that can't be measured or lie within ``tolerance`` stay as they are; null clips fail the measurement.
    """

    def run(s: pd.Series, r: pd.Series) -> pd.DataFrame:
        rows = []
        for x, k in zip(s, r, strict=True):
            if x is None or not k:
                rows.append((x, "failed_loudness_measurement", None, None, False, None))
                continue
            x = np.asarray(x, dtype=np.float32)
            y, status, before, gain = normalize_loudness(x, int(k), target, tolerance)
            clipped = status == "normalized" and bool(np.max(np.abs(x)) * 10 ** (gain / 20) > 1)
            rows.append((y, status, before, gain, clipped, peak_dbfs(y)))
        out = pd.DataFrame(rows, columns=["x", "status", "before", "gain", "clipped", "peak"])
        return out.astype({"before": "float64", "gain": "float64", "peak": "float64"})

    # declared so that picking its fields doesn't make Spark run it once for each
    done = F.pandas_udf(run, "x array<float>, status string, before double, gain double, clipped boolean, peak double").asNondeterministic()  # type: ignore[call-overload]
    names = {samples: "x", "loudness_status": "status", "loudness_before": "before", "loudness_gain": "gain", "loudness_clipped": "clipped", "peak_dbfs": "peak"}
    return df.withColumn("_loud", done(F.col(samples), F.col(rate))).withColumns({n: F.col(f"_loud.{f}") for n, f in names.items()}).drop("_loud")


def loudness_report(df: DataFrame) -> DataFrame:
    """Outcomes of ``loudness_gain``: clips, clipped ones, mean gain of changed ones and highest peak, by status."""
    changed = F.when(F.col("loudness_status") == "normalized", F.col("loudness_gain"))
    return df.groupBy("loudness_status").agg(F.count(F.lit(1)).alias("clips"), F.count_if("loudness_clipped").alias("clipped"), F.avg(changed).alias("mean_gain"), F.max("peak_dbfs").alias("highest_peak"))


CLEAN_SCHEMA = "samples array<float>, sampling_rate int, quality_score double, snr_db double, speech_ratio double, duration double, drop_reason string"


def clean_audio(df: DataFrame, samples: str, rate: str, vad: Callable[[np.ndarray, int], np.ndarray] = energy_vad) -> DataFrame:
    """``df`` without its audio columns, with the cleaned audio at 24 kHz, its metrics, and ``drop_reason`` where a clip can't be used."""

    names = [c.split(" ")[0] for c in CLEAN_SCHEMA.split(", ")]
    types = (pa.int32(), *[pa.float64()] * 4, pa.string())

    def one(x: np.ndarray | None, k: float | None) -> tuple:
        y, m, why = (None, None, "empty_after_trim") if x is None or not k else clean_clip(x, int(k), vad)
        return y, RATE if y is not None else None, *(m.values() if m else (None,) * 4), why

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for s, r in batches:
            for rows in in_pieces(one(x, k) for x, k in zip(clips_of(s), r.to_pylist(), strict=True)):
                y, *rest = zip(*rows, strict=True)
                yield pa.StructArray.from_arrays([lists_of(y), *(pa.array(c, typ) for c, typ in zip(rest, types, strict=True))], names)

    # declared so that a filter on its fields doesn't make Spark run it once more
    done = F.arrow_udf(run, CLEAN_SCHEMA).asNondeterministic()  # type: ignore[call-overload]
    found = df.withColumn("_clean", done(F.col(samples), F.col(rate)))
    return found.drop(samples, rate).select("*", "_clean.*").drop("_clean")


def drop_reasons(df: DataFrame, samples: str, rate: str, vad: Callable[[np.ndarray, int], np.ndarray] = energy_vad) -> DataFrame:
    """``df`` without its audio columns, with the ``drop_reason`` that ``clean_audio`` gives; no audio comes back from Python."""

    def run(s: pa.Array, r: pa.Array) -> pa.Array:
        return pa.array(["empty_after_trim" if x is None or not k else cut_clip(x, int(k), vad)[2] for x, k in zip(clips_of(s), r.to_pylist(), strict=True)], pa.string())

    # declared so that a filter on it doesn't make Spark run it once more
    done = F.arrow_udf(run, "string").asNondeterministic()  # type: ignore[call-overload]
    return df.withColumn("drop_reason", done(F.col(samples), F.col(rate))).drop(samples, rate)


def pop_columns(df: DataFrame, samples: str, rate: str) -> DataFrame:
    """``df`` with the features of ``pop_features`` and ``flagged`` and ``reason`` by ``pop_rules``."""
    from clipwright.operators.cleanup import failed_rules

    names = ("status", "peak_start_dbfs", "peak_pos_ms", "peak_is_early", "peak_to_rms_db", "decay_db")

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for s, r in batches:
            yield pd.DataFrame([pop_features(np.asarray([] if x is None else x, dtype=np.float32), int(k)) for x, k in zip(s, r, strict=True)], columns=list(names))

    schema = "status string, peak_start_dbfs double, peak_pos_ms double, peak_is_early boolean, peak_to_rms_db double, decay_db double"
    out = df.withColumn("_pop", F.pandas_udf(run, schema)(F.col(samples), F.col(rate))).select("*", "_pop.*").drop("_pop")  # type: ignore[call-overload]
    reason = failed_rules(pop_rules(F.col("peak_start_dbfs"), F.col("peak_is_early"), F.col("peak_to_rms_db"), F.col("decay_db")))
    ok = F.col("status") == "ok"
    return out.withColumn("reason", F.when(ok, reason).otherwise("clip_too_short_for_windows")).withColumn("flagged", ok & (F.col("reason") == "all_rules_passed"))
