import random
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from clipwright.functions import audio
from clipwright.functions.text import capitalize, normalize_transcript, strip
from clipwright.operators import classify, cleanup, density, embed, frames, lookups, metadata, profile, sampling, schema, vectors, votes
from clipwright.plans import voices
from tests.helpers import DATA

GOLDEN = [
    ("a—b–c", "a b c"), ("‘x’ “y” `z`", "'x' 'y' 'z'"), ('say """hi""', 'say "hi"'), ("kushi - kushi", "kushi-kushi"), ("x\xa0-　y", "x-y"), ("One.Two A.B.C", "One. Two A. B.C"),
    ("end . then , so ?", "end. then, so ?"), ("café café \U0001f600 K", "cafe cafe K"), ("  two   spaces ", "two spaces"), ("", ""), (None, None), ("\x1c-\x85", "-"),
]


def stdlib_normalize(t):
    import re

    ws = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
    t = unicodedata.normalize("NFC", "".join(c for c in unicodedata.normalize("NFD", t) if unicodedata.category(c) != "Mn"))
    t = re.sub("[’‘“”`]", "'", t)
    t = re.sub('"{2,}', '"', t)
    t = re.sub("[—–]", " ", t)
    t = re.sub(f"{ws}+-{ws}+", "-", t)
    t = re.sub(r"([A-Za-z])\.([A-Z])", r"\1. \2", t)
    t = re.sub(f"{ws}+([,.])", r"\1", t)
    t = re.sub(r"[^A-Za-z0-9.,?!'\" \-]", " ", t)
    return re.sub(" +", " ", t).strip(" ")


def test_transcript_golden(spark):
    df = spark.createDataFrame(GOLDEN, "t string, want string").withColumn("got", normalize_transcript(F.col("t")))
    assert [r["got"] for r in df.collect()] == [w for _, w in GOLDEN]


def test_transcript_equals_stdlib_on_random_text(spark):
    rng = random.Random(3)
    pool = "aB .,-\"'?!`’“—ẹ́́\xa0　 \x1c\x85KÅﬁ1½ßñ\n\tẹ\U0001d165Å"
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", normalize_transcript(F.col("t")).alias("g")).collect()
    assert [(texts[r["i"]], r["g"]) for r in got] == [(texts[r["i"]], stdlib_normalize(texts[r["i"]])) for r in got]


def test_strip_and_capitalize(spark):
    df = spark.createDataFrame([("　 FEMALE\t\xa0",), ("non binary",), (None,), ("",)], "g string").select(capitalize(strip(F.col("g"))).alias("g"))
    assert [r["g"] for r in df.collect()] == ["Female", "Non binary", None, ""]


def test_cleanup_edges(spark):
    data = [(1, "a", 2.999), (2, "a", 3.0), (3, "a", float("nan")), (4, "b", 1.0), (5, "b", 9.0), (6, "c", None), (7, "c", 5.0)]
    df = spark.createDataFrame(data, "row_id int, source_speaker_id string, duration double")
    out = cleanup.cleanup(df)
    assert {(r["row_id"], r["speaker_clip_count"]) for r in out.collect()} == {(2, 2), (3, 2), (6, 2), (7, 2)}
    audit = cleanup.cleanup_audit(df, "source_speaker_id", "duration").first()
    assert (audit["rows_in"], audit["dropped_short"], audit["dropped_singleton"], audit["rows_out"]) == (7, 2, 1, 4)
    assert cleanup.cleanup_audit(df.limit(0), "source_speaker_id", "duration").first()["kept_share"] == 0.0
    with pytest.raises(ValueError):
        cleanup.cleanup(df.withColumn("source_speaker_id", F.lit(None).cast("string")))
    assert cleanup.deny(df, "source_speaker_id", ["a"]).count() == 4
    assert cleanup.drop_noise(spark.createDataFrame([(1,), (-1,), (None,)], "cluster_id int")).count() == 2


def test_index_has_fixed_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("z",), (None,)], "source_speaker_id string")
    assert {r["source_speaker_id"]: r["speaker_idx"] for r in metadata.speaker_index(df).collect()} == {"a": 0, "b": 1, "z": 2}
    got = metadata.add_speaker_index(df).collect()
    assert sorted(((str(r["source_speaker_id"]), r["speaker_idx"]) for r in got), key=str) == [("None", None), ("a", 0), ("a", 0), ("b", 1), ("b", 1), ("z", 2)]


def test_schema_guards(spark):
    df = spark.createDataFrame([("1", "s", 1)], "id string, speaker_id string, x int")
    assert schema.rename_source(df).columns == ["source_id", "source_speaker_id", "x"]
    with pytest.raises(schema.MissingColumns):
        schema.require_columns(df, ["y"])
    with pytest.raises(ValueError):
        schema.require_rows(df.limit(0), "test")
    with pytest.raises(ValueError):
        metadata.union_splits({})


def test_lookup_takes_the_last_and_defaults(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "k string")
    table = spark.createDataFrame([("a", 1.0, 1), ("a", 2.0, 2)], "k string, q double, o int")
    assert sorted((r["k"], r["q"]) for r in lookups.lookup(df, table, "k", {"q": 0.0}, ["o"]).collect()) == [("a", 2.0), ("a", 2.0), ("b", 0.0)]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 19, 20, 21])
def test_thirds_and_samples(spark, n):
    df = spark.createDataFrame([("s", float(i), i) for i in range(n)], "g string, q double, i int")
    got = {r["i"]: r["tier"] for r in sampling.thirds(df, "g", "q", "i").collect()}
    low, high = max(1, n // 3), max(max(1, n // 3) + 1, n - n // 3)
    assert got == {i: "low" if i < low else "mid" if i < high else "high" for i in range(n)}
    assert sampling.sample_thirds(df, "g", "q", "i").count() == min(n, 20)


def test_split_sizes(spark):
    df = spark.createDataFrame([(g, f"{g}{i}") for g, n in (("a", 1), ("b", 2), ("c", 10), ("d", 25)) for i in range(n)], "g string, i string")
    got = {(r["g"], r["split"]): r["count"] for r in sampling.stratified_split(df, "g", "i").groupBy("g", "split").count().collect()}
    assert got == {("a", "train"): 1, ("b", "train"): 1, ("b", "test"): 1, ("c", "train"): 8, ("c", "validation"): 1, ("c", "test"): 1, ("d", "train"): 20, ("d", "validation"): 2, ("d", "test"): 3}
    assert sampling.uniform_sample(df, "i", 5).collect() == sampling.uniform_sample(df.orderBy(F.desc("i")), "i", 5).collect()
    order = list(range(6))
    random.Random(1).shuffle(order)
    assert sampling.replayed_positions([("a", 6)], 1) == {"a": order}


MASKS = ["", "1", "0", "111111", "000000", "0110", "01110", "1110011100", "11100011100", "111000001110", "1110000001110", "0001110000", "1011101", "00000000111"]


@pytest.mark.parametrize("text", MASKS)
def test_masks_equal_kernels(spark, text):
    mask = [c == "1" for c in text]
    df = spark.createDataFrame([(mask,)], "mask array<boolean>")
    want = audio.smooth(np.asarray(mask, bool)).tolist() if mask else []
    got = frames.smooth_mask(df).first()["smooth"]
    assert got == want
    if not mask:
        return
    x = np.repeat(np.arange(len(mask)), audio.FRAME)
    kept = frames.kept_frames(df).first()["kept"]
    assert kept == sorted(set(audio.trim_gaps(x, np.asarray(mask)).tolist()))


def test_quality_equals_kernel(spark):
    rng = np.random.default_rng(0)
    for ratio in (0.1, 0.35, 0.6, 0.96, 1.0, 0.0):
        n = 60
        mask = np.arange(n) < round(n * ratio)
        x = np.concatenate([rng.normal(0, 0.2 if m else 0.01, audio.FRAME) for m in mask]).astype(np.float32)
        power = np.mean(x.reshape(n, -1) ** 2, axis=1)
        r = frames.quality(spark.createDataFrame([(mask.tolist(), [float(p) for p in power])], "mask array<boolean>, power array<double>")).first()
        want = audio.metrics(x, mask)
        if want is None:
            assert r["snr_db"] is None and r["duration"] is None
        else:
            assert np.allclose([r["quality_score"], r["snr_db"], r["speech_ratio"], r["duration"]], want, rtol=1e-4)


def test_votes_edges(spark):
    v = lambda f, m, u: (f + m + u, f, m, u)
    df = spark.createDataFrame([v(3, 1, 0), v(2, 2, 0), v(1, 0, 3), v(2, 0, 1), v(0, 4, 0)], "cluster_size int, female_clips int, male_clips int, unknown_clips int")
    assert [r["cluster_gender"] for r in votes.with_majority(df).collect()] == ["Female", "Mixed", "Unknown", "Unknown", "Male"]
    flags = spark.range(1).select(votes.flag_text(F.lit(True), F.lit(None), F.lit("Mixed"), F.lit(3), F.lit(True)).alias("f"), votes.flag_text(F.lit(False), F.lit(True), F.lit("Male"), F.lit(4), F.lit(False)).alias("g")).first()
    assert (flags["f"], flags["g"]) == ("NOISE|MIXED_GENDER|EMBEDDING_FAILED", "RESCUED|MANY_SOURCES")


def test_vectors_edges(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], True), (2, [0.0, 0.0], True), (3, [float("nan"), 1.0], True), (4, None, True), (5, [1.0, 1.0], False)], "i int, embedding array<float>, embedding_ok boolean")
    assert [r["i"] for r in vectors.usable(df).collect()] == [1]
    cents = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])], "c int, centroid array<double>")
    got = vectors.nearest_centroid(df.filter("i = 1"), cents, "embedding", "c").first()
    assert got["nearest"] == 0 and abs(got["cosine"] - 1) < 1e-6
    rng = np.random.default_rng(5)
    items = spark.createDataFrame([(i, [float(v) for v in rng.normal(size=4)] if i else None, g) for i, g in enumerate(["F", "M", "Unknown", None, "X"] * 8)], "i int, v array<double>, g string")
    cents = spark.createDataFrame([(f"c{k}", [float(v) for v in rng.normal(size=4)], "F" if k % 2 else "M") for k in range(30)], "c string, centroid array<double>, g string")
    for run in (lambda m: vectors.nearest_centroid(items, cents, "v", "c", most=m), lambda m: vectors.rescue(items, cents, "v", "c", "g", most=m)):
        whole, parts = ({r["i"]: (r["nearest"], r["cosine"] and round(r["cosine"], 9)) for r in run(m).collect()} for m in (100, 7))
        assert whole == parts and len(whole) == 40 and whole[0] == (None, None)
    rows = {r["i"]: r for r in vectors.rescue(items, cents, "v", "c", "g").collect()}
    assert rows[3]["nearest"] is None and rows[4]["nearest"] is None and int(rows[6]["nearest"][1:]) % 2 == 0 and rows[3]["rescued"] is False


def test_hdbscan_finds_blobs_and_noise():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(c, 0.05, (60, 4)) for c in (0, 3, 6)] + [rng.uniform(-20, 20, (10, 4))])
    labels, strength = density.hdbscan(x, 20, 5)
    for k in range(3):
        part = labels[60 * k : 60 * k + 60]
        assert len(set(part[part >= 0])) == 1 and (part >= 0).mean() > 0.8
    assert (labels[180:] == -1).all() and (strength >= 0).all() and (strength <= 1).all()
    assert set(density.hdbscan(x[:10], 20, 5)[0]) == {-1}
    assert density.core_distances(np.asarray([[0.0], [1.0], [3.0]]), 2).tolist() == [1.0, 1.0, 2.0]


@pytest.mark.parametrize("block", [2048, 60, 17])
def test_density_in_blocks_equals_the_whole(spark, block):
    rng = np.random.default_rng(3)
    parts = {g: np.concatenate([rng.normal(c, 0.06, (50, 3)) for c in (0, 2, 4)] + [rng.uniform(-9, 9, (12, 3))]) + k for k, g in enumerate(("F", "M"))}
    rows = [(i, g, [float(v) for v in p]) for g, x in parts.items() for i, p in enumerate(x)] + [(999, "one", [0.0, 0.0, 0.0]), (1000, None, [1.0, 1.0, 1.0]), (1001, "F", None)]
    df = spark.createDataFrame(rows, "i int, g string, v array<double>")
    got = density.cluster_partitions(df, record="i", vector="v", partition="g", least=15, samples=4, block=block).collect()
    assert len(got) == len(rows) - 2
    for g, x in parts.items():
        labels, strength = density.hdbscan(x, 15, 4)
        mine = {r["i"]: r for r in got if r["partition"] == g}
        pairs = {(int(labels[i]), mine[i]["raw_label"]) for i in range(len(x))}
        assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs}) and {a for a, b in pairs if b == -1} <= {-1}
        assert np.allclose([mine[i]["cluster_confidence"] for i in range(len(x))], strength)
    assert [r["raw_label"] for r in got if r["partition"] == "one"] == [-1]
    assert density.cluster_partitions(df.limit(0), record="i", vector="v", partition="g").count() == 0


def test_logistic_regression(spark):
    rng = np.random.default_rng(2)
    data = [(i, [float(a) for a in rng.normal(1 if i % 2 else -1, 1, 3)], "Male" if i % 2 else "Female") for i in range(80)]
    df = spark.createDataFrame(data, "i int, v array<double>, g string")
    model = classify.from_json(classify.to_json(classify.train(df, "v", "g")))
    out = classify.score(df, "v", model["weights"], model["bias"], least=0.0)
    assert out.filter("g = gender_predicted").count() > 70
    assert all(x["accuracy"] > 0.8 for x in classify.cross_validate(df, "v", "g", "i", folds=3))
    with pytest.raises(ValueError):
        classify.train(df.limit(3), "v", "g")


def test_loudness_of_a_sine():
    t = np.arange(48_000 * 3) / 48_000
    # a full-scale 997 Hz sine in one channel measures -3.01 LKFS
    assert abs(audio.loudness(np.sin(2 * np.pi * 997 * t), 48_000) + 3.01) < 0.05
    y, status, level, gain = audio.normalize_loudness(0.01 * np.sin(2 * np.pi * 997 * t), 48_000)
    assert status == "normalized" and abs(audio.loudness(y, 48_000) + 23) < 0.1 and abs(level + gain + 23) < 1e-9
    assert audio.loudness(np.zeros(48_000), 48_000) is None and audio.loudness(np.ones(100), 48_000) is None


def test_wav_and_resample():
    x = (np.sin(np.arange(2400) / 10) * 0.5).astype(np.float32)
    y, rate = audio.decode_wav(audio.encode_wav(x, 24_000))
    assert rate == 24_000 and np.array_equal(x, y)
    assert audio.header_duration(audio.encode_wav(x, 24_000)) == 0.1 and audio.header_duration(b"junk") == 0.0
    assert len(audio.resample(x, 24_000, 16_000)) == 1600
    assert np.abs(audio.resample(audio.resample(x, 24_000, 48_000), 48_000, 24_000)[100:-100] - x[100:-100]).max() < 0.01


def test_clip_cleaning_and_pops():
    rng = np.random.default_rng(0)
    speech = rng.normal(0, 0.2, 24_000).astype(np.float32)
    quiet = rng.normal(0, 0.0005, 24_000).astype(np.float32)
    y, m, why = audio.clean_clip(np.concatenate([quiet, speech, quiet, speech, quiet]), 24_000)
    assert why is None and len(y) < 24_000 * 4 and m["speech_ratio"] > 0.7 and m["snr_db"] > 20
    assert audio.clean_clip(np.zeros(24_000), 24_000)[2] == "no_speech_detected"
    assert audio.clean_clip(np.zeros(10), 24_000)[2] == "empty_after_trim"
    pop = np.concatenate([np.ones(50), np.full(24_000, 0.001)])
    assert audio.pop_features(pop, 24_000)["peak_start_dbfs"] == 0.0
    assert audio.pop_features(pop[:100], 24_000)["status"] == "failed_too_short"


def test_profiles_of_empty_tables(spark):
    df = spark.createDataFrame([], "clips long")
    assert profile.clip_histogram(df).agg(F.sum("speakers")).first()[0] == 0
    assert profile.coverage(df).count() == len(profile.THRESHOLDS)
    assert profile.long_tail(df).first()["tail_clip_share"] == 0.0


def test_nan_comes_out_as_null(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1, nan, "a"), (2, 1.5, "NaN"), (3, None, None)], "i int, q double, t string").withColumn("f", F.col("q").cast("float"))
    out = {r["i"]: (r["q"], r["f"], r["t"]) for r in schema.nan_to_null(df).collect()}
    assert out == {1: (None, None, "a"), 2: (1.5, 1.5, "NaN"), 3: (None, None, None)}
    table = spark.createDataFrame([("a", nan, 1), ("b", 2.0, 1)], "k string, q double, o int")
    got = lookups.lookup(spark.createDataFrame([("a",), ("b",), ("c",)], "k string"), schema.nan_to_null(table), "k", {"q": 0.0}, ["o"])
    assert sorted((r["k"], r["q"]) for r in got.collect()) == [("a", 0.0), ("b", 2.0), ("c", 0.0)]


def test_medians(spark):
    nan = float("nan")
    columns = {"even": [4.0, 1.0, 3.0, 2.0, None, nan], "odd": [5.0, 5.0, 1.0, None, nan, None], "ties": [2.0] * 5 + [9.0], "none": [None, nan, None, None, nan, nan], "wide": [-1e9, 1e9, 0.5, 0.25, -3.0, 7.0]}
    df = spark.createDataFrame(list(zip(*columns.values(), strict=True)), ", ".join(f"{c} double" for c in columns))
    want = {c: (lambda v: float(np.median(v)) if v else None)([x for x in values if x is not None and x == x]) for c, values in columns.items()}
    assert {r["metric"]: r["median"] for r in profile.medians(df, list(columns)).collect()} == want
    many = spark.range(5000).select((F.col("id") * 7919 % 5000).cast("double").alias("v"))
    assert profile.medians(many.repartition(7), ["v"]).first()["median"] == 2499.5


def test_renumbering(spark):
    df = spark.createDataFrame([("Male", 0)] * 3 + [("Female", 1)] * 2 + [("Female", 0)] * 2 + [("Female", -1), ("Other", 1), (None, 1)], "g string, c int")
    got = {(r["g"], r["c"]): r["cluster_id"] for r in votes.renumber_clusters(df, "g", "c").collect()}
    assert got == {("Female", 0): 0, ("Female", 1): 1, ("Male", 0): 2}


def test_embedding_in_halving_batches(spark):
    sizes = []

    def small_memory(clips, lengths):
        if len(clips) > 3:
            raise MemoryError
        sizes.append(clips.shape)
        return np.stack([[n, c.sum()] for c, n in zip(clips, lengths, strict=True)])

    clips = [np.full(n, 1.0, np.float32) for n in (5, 1, 9, 2, 7, 3, 8)]
    assert embed.in_halving_batches(clips, small_memory, batch=8).tolist() == [[n, n] for n in (5, 1, 9, 2, 7, 3, 8)] and sizes[0] == (3, 3)
    with pytest.raises(MemoryError):
        embed.in_halving_batches(clips, small_memory, batch=8, least=4)
    df = spark.createDataFrame([(1, [0.1, -0.2] * 900, 16_000), (2, None, 16_000), (3, [], 16_000), (4, [0.0] * 99, 16_000), (5, [0.5], 8_000)], "i int, x array<float>, r int")
    got = {r["i"]: r for r in embed.embed(df, "x", "r").collect()}
    assert {i for i, r in got.items() if r["embedding_ok"]} == {1, 5} and got[2]["embedding"] is None and abs(np.linalg.norm(got[1]["embedding"]) - 1) < 1e-5
    with pytest.raises(Exception, match="no audio"):
        embed.embed(df, "x", "r", strict=True).collect()
    assert embed.embed(df.limit(0), "x", "r").count() == 0


def test_another_scorer(spark):
    df = spark.createDataFrame([(1, [0.9]), (2, [0.1]), (3, [0.5]), (4, None)], "i int, v array<double>")
    got = {r["i"]: r["gender_predicted"] for r in classify.score(df, "v", [], 0.0, scorer=lambda v: F.col(v)[0]).collect()}
    assert got == {1: "Male", 2: "Female", 3: "Unknown", 4: "Unknown"}


def test_lookup_by_file(spark):
    df = spark.createDataFrame([(1, "/a/x.wav"), (2, "y.wav"), (3, None)], "i int, path string")
    old = spark.createDataFrame([("/b/x.wav", 1.0, 1), ("/c/d/x.wav", 2.0, 2), (None, 9.0, 1)], "path string, q double, o int")
    assert {r["i"]: r["q"] for r in lookups.lookup_by_file(df, old, "path", {"q": 0.0}, ["o"]).collect()} == {1: 2.0, 2: 0.0, 3: 0.0}


def test_speech_span_and_early_peaks():
    assert audio.speech_span(np.zeros(9, bool), 9 * audio.FRAME) is None
    mask = np.zeros(100, bool)
    mask[40:60] = True
    span, held = audio.speech_span(mask, 100 * audio.FRAME)
    assert (span.start, span.stop) == (40 * 720 - 9600, 60 * 720 + 9600) and (held.start, held.stop) == (26, 74)
    x = np.full(11_025, 0.001)
    x[132] = 1.0  # 12 ms are 132.3 samples at this rate
    assert audio.pop_features(x, 11_025)["peak_is_early"]
    x[132], x[133] = 0.001, 1.0
    assert not audio.pop_features(x, 11_025)["peak_is_early"]


def test_levelling_clips(spark):
    t = np.arange(24_000) / 24_000
    sine = lambda a: [float(v) for v in a * np.sin(2 * np.pi * 997 * t)]
    df = spark.createDataFrame([(1, sine(0.01), 24_000), (2, sine(10 ** (-20 / 20)), 24_000), (3, [0.0] * 24_000, 24_000), (4, None, 24_000), (5, sine(0.001)[:-1] + [0.9], 24_000)], "i int, x array<float>, r int")
    done = audio.loudness_gain(df, "x", "r")
    got = {r["i"]: r for r in done.collect()}
    assert [got[i]["loudness_status"] for i in (1, 2, 3, 4)] == ["normalized", "skipped_within_tolerance", "failed_loudness_measurement", "failed_loudness_measurement"]
    assert abs(audio.loudness(np.asarray(got[1]["x"]), 24_000) + 23) < 0.1 and not got[1]["loudness_clipped"] and got[5]["loudness_clipped"] and got[5]["peak_dbfs"] == 0.0
    report = {r["loudness_status"]: r for r in audio.loudness_report(done).collect()}
    assert report["normalized"]["clips"] == 2 and report["normalized"]["clipped"] == 1 and report["failed_loudness_measurement"]["mean_gain"] is None


def test_peak_and_rms_equal_the_kernels(spark):
    clips = {1: [0.5, -0.25, 0.1], 2: [0.0, 0.0], 3: None}
    df = spark.createDataFrame(list(clips.items()), "i int, x array<double>")
    got = {r["i"]: r for r in df.select("i", *(c.alias(n) for n, c in audio.peak_and_rms(F.col("x")).items())).collect()}
    for i in (1, 2):
        x = np.asarray(clips[i])
        assert abs(got[i]["peak_dbfs"] - audio.peak_dbfs(x)) < 1e-9 and abs(got[i]["rms_db"] - audio.amp_to_db(audio.rms(x))) < 1e-9
    assert got[3]["peak_dbfs"] is None


def test_cleaned_audio_comes_back_in_pieces(spark, monkeypatch):
    rng = np.random.default_rng(1)
    clips = [None if i % 7 == 3 else np.zeros(4000, np.float32) if i % 7 == 5 else rng.normal(0, 0.2, 4000 + 10 * i).astype(np.float32) for i in range(40)]
    assert [len(p) for p in audio.in_pieces([(x,) for x in clips[:3]], 1)] == [1, 1, 1] and [len(p) for p in audio.in_pieces([(None,)] * 5, 1)] == [5]
    df = spark.createDataFrame([(i, None if x is None else x.tolist(), 8000) for i, x in enumerate(clips)], "i int, s array<float>, r int").coalesce(1)
    sent = []
    monkeypatch.setattr(audio.F, "arrow_udf", lambda f, schema: sent.append(f) or F.udf(lambda s, r: None, schema))
    audio.clean_audio(df, "s", "r")
    monkeypatch.undo()
    lists, rates = audio.lists_of(clips), audio.pa.array([8000] * len(clips))
    # whatever the batch that comes in, what is made at a time is bounded
    pieces = list(sent[0](iter([(audio.pa.concat_arrays([lists] * 10), audio.pa.concat_arrays([rates] * 10))])))
    assert sum(map(len, pieces)) == 400 and len(pieces) > 1 and max(4 * len(p.field("samples").values) for p in pieces) <= audio.PIECE
    got = {r["i"]: r for r in audio.clean_audio(df, "s", "r").collect()}
    for i, x in enumerate(clips):
        y, m, why = audio.clean_clip(x, 8000) if x is not None else (None, None, "empty_after_trim")
        assert got[i]["drop_reason"] == why and (got[i]["samples"] is None) == (y is None)
        assert y is None or (np.array_equal(np.float32(got[i]["samples"]), y) and got[i]["duration"] == m["duration"] and got[i]["sampling_rate"] == audio.RATE)


def test_counting_drops_cleans_each_clip_once(spark):
    df = spark.createDataFrame([(1, [0.1] * 10, 8000)], "i int, s array<float>, r int")
    counts = cleanup.drop_reason_counts(audio.clean_audio(df, "s", "r"))
    assert counts._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    assert [tuple(r) for r in counts.collect()] == [("empty_after_trim", 1)]


@pytest.mark.parametrize("k", [4, 16])
def test_tree_from_near_rows_and_joins_equals_the_whole(k):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(c, 0.05, (70, 5)) for c in (0, 1, 2, 30)] + [rng.uniform(-9, 9, (40, 5)), [[200.0] * 5]])[rng.permutation(321)]
    n, columns = len(x), [(lo, x[lo : lo + 50]) for lo in range(0, 321, 50)]
    core = density.core_distances(x, 4)
    found = [density.nearest_rows(x[lo : lo + 100], iter(columns), k) for lo in range(0, n, 100)]
    at, far = (np.concatenate([f[j] for f in found]) for j in range(2))
    assert np.allclose(far, np.sort(np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)), axis=1)[:, :k], atol=1e-9) and np.allclose(far[:, 3], core, atol=1e-6)
    core = far[:, 3]
    a, b = np.repeat(np.arange(n), k), at.ravel()
    d = np.maximum(np.maximum(far.ravel(), core[a]), core[b])
    kept, comp = density.forest(a, b, d, n, far[:, -1])
    ends, flat = np.unique(comp, return_inverse=True)
    assert 1 < len(ends) < n and len(kept) == n - len(ends)
    # any spanning tree of the components bounds the joins that are looked for
    chain = density.spanning_tree(x, core)[::-1]
    way, _ = density.forest(flat[chain[:, 0].astype(int)], flat[chain[:, 1].astype(int)], 1.05 * chain[:, 2], len(ends))
    ea, eb, ed = flat[chain[way, 0].astype(int)], flat[chain[way, 1].astype(int)], 1.05 * chain[way, 2]
    height = density.heights(ea, eb, ed, len(ends))[flat]
    joins = [density.cross_edges(x[lo : lo + 100], lo, iter(columns), flat, core, height) for lo in range(0, n, 100)]
    a, b, d = (np.concatenate([v[kept], *(j[i] for j in joins)]) for i, v in enumerate((a, b, d)))
    tree, _ = density.forest(a, b, d, n)
    assert len(tree) == n - 1 and np.allclose(np.sort(d[tree]), density.spanning_tree(x, core)[:, 2], atol=1e-6)


def test_drop_reasons_bring_no_audio_back(spark, monkeypatch):
    rng = np.random.default_rng(2)
    clips = [None, np.zeros(4000, np.float32), np.zeros(5, np.float32), *(rng.normal(0, 0.2, 9000) * np.repeat(rng.random(9) < 0.5, 1000) for _ in range(20))]
    df = spark.createDataFrame([(i, None if x is None else x.tolist(), None if i == 4 else 8000) for i, x in enumerate(clips)], "i int, s array<float>, r int")
    sent = []
    monkeypatch.setattr(audio.F, "arrow_udf", lambda f, schema: sent.append((f, schema)) or F.udf(lambda s, r: None, schema))
    audio.drop_reasons(df, "s", "r")
    monkeypatch.undo()
    back = sent[0][0](audio.lists_of(clips), audio.pa.array([8000] * len(clips)))
    assert sent[0][1] == "string" and back.nbytes < 100 * len(clips)
    got = audio.drop_reasons(df, "s", "r")
    want = {r["i"]: r["drop_reason"] for r in audio.clean_audio(df, "s", "r").collect()}
    assert got.columns == ["i", "drop_reason"] and {r["i"]: r["drop_reason"] for r in got.collect()} == want
    assert set(want.values()) == {None, "empty_after_trim", "no_speech_detected"}
    counts = cleanup.drop_reason_counts(got)
    assert counts._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1


def test_audio_drops_takes_only_reasons_from_python(spark):
    plan = voices.audio_drops(spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "samples" not in plan and "Repartition" in plan


@pytest.mark.parametrize("source, target", [(8000, 24_000), (24_000, 16_000), (44_100, 24_000), (16_000, 16_001), (1000, 7)])
def test_resample_equals_the_sum_over_each_window(source, target):
    x = np.random.default_rng(3).normal(0, 0.3, 333)
    for n in (1, 2, 48, 333):
        got, cut = audio.resample(x[:n], source, target), min(1.0, target / source)
        half, at = int(np.ceil(16 / cut)), np.arange(-(-n * target // source)) * source / target
        d = at[:, None] - np.arange(n)
        near = np.abs(d) <= half
        want = np.where(near, cut * np.sinc(cut * d) * (0.5 + 0.5 * np.cos(np.pi * np.clip(d / half, -1, 1))), 0) @ x[:n]
        assert got.shape == want.shape and np.abs(got - want).max() < 1e-6


def test_masks_of_clips_equal_the_plain_forms():
    rng = np.random.default_rng(4)
    for n in (1, 2, 20, 21, 41, 300):
        x = rng.normal(0, 30, n)
        assert audio._percentile(x, 0.95) == np.percentile(x, 95)
    # a clip of which nothing is cut keeps its mask, and a cut one gets a new one
    for x in (rng.normal(0, 0.2, 8000), np.concatenate([rng.normal(0, 0.2, 8000), np.zeros(16_000), rng.normal(0, 0.2, 8000)])):
        cut, mask, why = audio.cut_clip(x, 8000)
        assert why is None and np.array_equal(mask, audio.vad_mask(cut))
