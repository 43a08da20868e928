import pytest
from pyspark.sql import functions as F

from clipwright.functions.audio import encode_wav
from clipwright.plans import pipeline
from clipwright.sources import readers, writers
from clipwright.streaming.ingest import clip_stream, ingest_stream


def test_promote_replaces_a_table_read_from_itself(spark, tmp_path):
    target = f"file://{tmp_path}/t"
    writers.promote(spark.range(5), target)
    writers.promote(spark.read.parquet(target).filter("id > 2"), target)
    assert sorted(r["id"] for r in spark.read.parquet(target).collect()) == [3, 4]
    assert not readers.exists(spark, target + ".backup") and not readers.exists(spark, target + ".tmp")


def test_csv_keeps_ids_and_empty_strings(spark, tmp_path):
    df = spark.createDataFrame([("007", "", 'a "q", b'), ("8", "x", "y"), (" 9\t", " ", "\xa0z ")], "id string, flag string, t string")
    writers.write_csv(df, f"{tmp_path}/c")
    back = readers.read_csv(spark, f"{tmp_path}/c", "id string, flag string, t string")
    assert sorted(map(tuple, back.na.fill("").collect())) == sorted(map(tuple, df.collect()))


def test_documents_lines_splits(spark, tmp_path):
    assert readers.read_document(spark, f"file://{tmp_path}/none.json", "a struct<b:int>").select(F.coalesce("a.b", F.lit(7)).alias("b")).first()["b"] == 7
    writers.write_report(spark.createDataFrame([(1, None)], "a int, b string"), f"{tmp_path}/r")
    line = readers.read_lines(spark, f"{tmp_path}/r").first()["line"]
    assert line == '{"a":1,"b":null}'
    df = spark.createDataFrame([(1, "train"), (2, "test")], "i int, split string")
    writers.write_splits(df, f"file://{tmp_path}/s")
    parts = readers.read_splits(spark, {s: f"{tmp_path}/s/split={s}" for s in ("test", "train")})
    assert sorted(map(tuple, parts.select("i", "split").collect())) == [(1, "train"), (2, "test")]


def test_audio_files_and_archive(spark, tmp_path):
    df = spark.createDataFrame([("a", [0.5, -0.5], 8000), ("b", None, 8000)], "n string, x array<float>, r int")
    got = {r["name"]: r["ok"] for r in writers.write_wavs(df, f"{tmp_path}/w", name="n", samples="x", rate="r").collect()}
    assert got == {"a": True, "b": False}
    (tmp_path / "w" / "c.txt").write_text("no audio")
    files = readers.list_audio(spark, f"{tmp_path}/w", content=True).collect()
    assert len(files) == 1 and bytes(files[0]["content"]) == encode_wav([0.5, -0.5], 8000)
    assert len(writers.zip_folder(f"{tmp_path}/w", f"{tmp_path}/z.zip")) == 64


def test_any_form_of_audio(spark, tmp_path):
    from clipwright.functions.audio import any_audio, audio_seconds, decoded, head_duration, wav_seconds

    wav = encode_wav([0.5, -0.5, 0.25, 0.0], 8000)
    assert all(r["ok"] for r in writers.write_wavs(spark.createDataFrame([("a", [0.5], 8000)], "n string, x array<float>, r int"), f"file://{tmp_path}/w", name="n", samples="x", rate="r").collect())
    files = readers.list_audio(spark, f"{tmp_path}/w", content=True)
    kind = "i int, audio struct<array:array<float>,sampling_rate:int,bytes:binary,path:string>"
    df = spark.createDataFrame([(1, ([1.0, 0.5], 16_000, None, None)), (2, (None, None, wav, "x")), (3, (None, None, None, f"{tmp_path}/w/a.wav")), (4, (None, None, b"junk", None)), (5, None), (6, (None, None, None, "/none.wav"))], kind)
    out = any_audio(df, "audio", files=files).withColumn("s", audio_seconds(F.col("samples"), F.col("sampling_rate")))
    got = {r["i"]: (r["samples"], r["sampling_rate"], r["s"]) for r in out.collect()}
    assert got == {1: ([1.0, 0.5], 16_000, 2 / 16_000), 2: ([0.5, -0.5, 0.25, 0.0], 8000, 0.0005), 3: ([0.5], 8000, 1 / 8000), 4: (None, None, 0.0), 5: (None, None, 0.0), 6: (None, None, 0.0)}
    arrays = any_audio(spark.createDataFrame([([0.1], 8000)], "a array<double>, r int"), "a", rate="r").first()
    assert arrays["sampling_rate"] == 8000 and any_audio(spark.createDataFrame([(wav,)], "a binary"), "a").first()["sampling_rate"] == 8000
    assert any_audio(spark.createDataFrame([(f"{tmp_path}/w/a.wav",)], "a string"), "a", files=files).first()["samples"] == [0.5]
    assert head_duration(wav[:60], len(wav)) == 0.0005 and head_duration(b"junk", 4) is None and head_duration(wav[:20], len(wav)) is None
    late = wav[:12] + b"LIST" + (6000).to_bytes(4, "little") + b"\0" * 6000 + wav[12:]  # the data chunk begins behind the head
    seconds = spark.createDataFrame([(1, wav), (2, late), (3, b"junk"), (4, None)], "i int, b binary").select("i", wav_seconds(F.col("b")).alias("s"))
    assert {r["i"]: r["s"] for r in seconds.collect()} == {1: 0.0005, 2: 0.0005, 3: 0.0, 4: 0.0}
    broken = spark.createDataFrame([(b"junk",)], "b binary")
    assert broken.select(decoded(F.col("b")).alias("x")).first()["x"] is None
    with pytest.raises(Exception, match="not a WAV"):
        broken.select(decoded(F.col("b"), strict=True).alias("x")).collect()


def test_card(spark):
    df = spark.createDataFrame([("train", "s1", "Female", 3600.0), ("train", "s2", None, float("nan")), ("test", "s1", "Female", 1800.0)], "split string, source_speaker_id string, gender string, duration double")
    card = writers.dataset_card(df, "Clips", audits={"speakers": {"count": 7}, "loudness": {"normalized": 0}})
    assert "| train | 2 | 2 | 1.00 |" in card and "| all | 3 | 2 | 1.50 |" in card and "| unknown | 1 |" in card and "- Speakers found: 7" in card
    assert "- Clips levelled: 0" in card and "- Source speakers: not recorded" in card and card.startswith("---\n") and "    num_examples: 1" in card
    assert writers.with_run_time(df).select("run_at").distinct().count() == 1


def test_checkpoints_belong_to_their_input(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "row_id int, id string")
    mark = readers.source_signature(df, "id", "row_id")
    assert mark != readers.source_signature(df.withColumn("row_id", 3 - F.col("row_id")), "id", "row_id")
    writers.append_checkpoint(df, f"{tmp_path}/k", mark)
    assert readers.read_checkpoint(spark, f"{tmp_path}/k", mark).count() == 2
    assert readers.read_checkpoint(spark, f"{tmp_path}/k", "other") is None
    assert readers.read_checkpoint(spark, f"{tmp_path}/none", mark) is None


def test_phases(spark, tmp_path):
    raw = spark.createDataFrame([(f"c{i}", f"s{i % 3}", " FEMALE", "SNA ", f"Kushi - kushi {i}.Zvino", 5.0 + i) for i in range(30)], "id string, speaker_id string, gender string, language string, transcription string, duration double")
    clips = pipeline.refine_text(pipeline.annotate(pipeline.ingest({"train": raw}, "source_id")))
    row = clips.orderBy("row_id").first()
    assert (row["gender"], row["language"], row["speaker_clip_count"], row["has_punctuation"]) == ("Female", "sna", 10, True)
    target = f"file://{tmp_path}/out"
    pipeline.publish(clips.drop("split"), target)
    assert spark.read.parquet(target).groupBy("split").count().count() == 3
    with pytest.raises(ValueError):
        pipeline.ingest({"train": raw.limit(0)})


def test_audio_phase(spark):
    import numpy as np

    x = np.random.default_rng(0).normal(0, 0.2, 24_000).tolist()
    df = spark.createDataFrame([("a", "s", (x, 24_000)), ("b", "bad", (x, 24_000)), ("c", "s", ([0.0] * 24_000, 24_000)), ("d", "s", None)], "source_id string, source_speaker_id string, audio struct<array:array<float>,sampling_rate:int>")
    kept, dropped = pipeline.refine_audio(df, ["bad"])
    assert [r["source_id"] for r in kept.collect()] == ["a"]
    assert {r["source_id"]: r["drop_reason"] for r in dropped.collect()} == {"b": "blacklisted_speaker", "c": "no_speech_detected", "d": "empty_after_trim"}


def test_regroup_and_rebuild(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    rows = []
    for i in range(120):
        c = np.eye(6)[i % 4] + rng.normal(0, 0.05, 6)
        rows.append((f"c{i:03d}", [float(v) for v in c], True, "Female" if i % 4 < 2 else "Male", 0, 0.0, False))
    voices = spark.createDataFrame(rows, "source_id string, embedding array<float>, embedding_ok boolean, gender_predicted string, cluster_id int, cluster_confidence double, noise_rescued boolean")
    out = pipeline.regroup_speakers(voices, dims=6, least=10, samples=3)
    assert {r["cluster_id"] for r in out.collect()} <= {-1, 0, 1, 2, 3} and out.filter("cluster_id >= 0").count() > 100
    clips = spark.createDataFrame([(f"c{i:03d}", "t", "sna", True, 1.0, 1.0, 1.0, 5.0) for i in range(120)], "source_id string, transcription string, language string, has_punctuation boolean, snr_db double, speech_ratio double, quality_score double, duration double")
    mapping = out.withColumn("cluster_gender", F.col("gender_predicted"))
    built = pipeline.rebuild(clips, mapping)
    loud = clips.withColumn("audio", F.struct(F.array_repeat(F.lit(0.0).cast("float"), 100).alias("array"), F.lit(8000).alias("sampling_rate")))
    levelled = pipeline.rebuild(loud, mapping)
    assert levelled.columns == ["audio", *built.columns] and levelled.first()["audio"]["sampling_rate"] == 8000
    assert built.count() == out.filter("cluster_id >= 0").count() and dict(built.dtypes)["snr_db"] == "float"


def test_stream(spark, tmp_path):
    df = spark.createDataFrame([("Ehe.Zvino", 5.0), ("", 5.0), ("x", 1.0)], "transcription string, duration double")
    df.write.parquet(f"{tmp_path}/in")
    q = ingest_stream(clip_stream(spark, f"{tmp_path}/in", "transcription string, duration double"), f"{tmp_path}/out", f"{tmp_path}/ck")
    q.awaitTermination(120)
    got = {r["transcription"]: r["drop_reason"] for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {"Ehe. Zvino": None, "": "empty_text", "x": "short"}


def test_audio_steps_hold_bounded_batches(spark):
    from clipwright.plans.voices import wav_round_trip
    from clipwright.shipping import BATCH_BYTES, MOST_BYTES, ship
    from tests.helpers import DATA

    ship(spark)
    assert int(spark.conf.get(BATCH_BYTES).rstrip("b")) <= MOST_BYTES
    # encoding, decoding and measuring are one step, so rows with clips don't wait for steps with little input
    assert wav_round_trip(spark, DATA)._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1


def test_decoded_clips_come_back_in_pieces(spark, monkeypatch):
    import numpy as np
    import pyarrow as pa

    from clipwright.functions import audio

    sent = []
    df = spark.createDataFrame([(encode_wav(np.ones(8), 8000),)], "a binary")
    real = audio.F.arrow_udf
    monkeypatch.setattr(audio.F, "arrow_udf", lambda f, schema: sent.append(f) or real(f, schema))
    assert audio.any_audio(df, "a").first()["samples"] == [1.0] * 8
    clips = [None, b"junk", *(encode_wav(np.full(100_000, i / 32), 8000) for i in range(30))]
    pieces = list(sent[0](iter([pa.array(clips, pa.binary())])))
    assert sum(map(len, pieces)) == 32 and len(pieces) > 2 and max(4 * len(p.field("x").values) for p in pieces) <= audio.PIECE
    got = [x for p in pieces for x in p.to_pylist()]
    assert got[0] == got[1] == {"x": None, "r": None} and all(x["r"] == 8000 and len(x["x"]) == 100_000 and x["x"][-1] == i / 32 for i, x in enumerate(got[2:]))
