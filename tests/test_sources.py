"""Readers, the manifest on disk, curation end to end and incremental ingestion."""

import io
import json
import tarfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltline import config
from siltline.functions import audio
from siltline.operators import analytics
from siltline.plans.curation import Curation, flat, nested
from siltline.sources import readers
from siltline.sources.manifest_files import compact, read_json, read_table, write_json, write_table
from siltline.sources.tars import read_tars
from siltline.streaming.ingest import ingest_stream

RATE = 16_000


def clip(hz, seconds, level=0.3):
    quiet = 1e-4 * np.ones(RATE // 2)
    tone = level * np.sin(2 * np.pi * hz * np.arange(int(seconds * RATE)) / RATE)
    return audio.encode_wav(np.concatenate([quiet, tone, quiet]), RATE)


def put(path, members):
    with tarfile.open(path, "w") as tar:
        for name, data in members:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))


@pytest.fixture
def shards(tmp_path):
    folder = tmp_path / "data"
    folder.mkdir()
    put(folder / "set_001.tar", [("x/a.wav", clip(300, 3)), ("b.wav", clip(400, 2)), ("notes.txt", b"no"), ("dup.wav", clip(500, 2))])
    put(folder / "set_002.tar", [("y/dup.wav", clip(500, 2)), ("c.wav", clip(600, 0.3)), ("d.wav", b"broken")])
    return str(folder)


def test_tar_shards(spark, shards):
    rows = read_tars(spark, shards).collect()
    assert sorted((r["shard"], r["name"]) for r in rows) == [(1, "a.wav"), (1, "b.wav"), (1, "dup.wav"), (2, "c.wav"), (2, "d.wav"), (2, "dup.wav")]
    assert [r["shard"] for r in read_tars(spark, shards, shards="2", limit_per_shard="1").collect()] == [2]
    assert read_tars(spark, f"{shards}/set_001.tar").count() == 3
    units = readers.work_units(spark.createDataFrame([(f"{shards}/set_001.tar",), (f"{shards}/set_002.tar",)], "path string"), "s", "tar", [1, 7])
    assert [tuple(r) for r in units.collect()] == [("s", 1)]
    assert readers.layout(["a.parquet", "b.tar"]) == "tar" and readers.layout(["A.WAV"]) == "files"
    with pytest.raises(RuntimeError):
        readers.layout(["x.txt"])


def test_ingest_once_with_sidecar_and_budget(spark, shards, tmp_path):
    (tmp_path / "t.tsv").write_text('file_name\tsentence\nx/a.mp3\t "quoted\nb.wav\tfirst\nb.wav\tlast \n\tnobody\n')
    side = readers.transcripts(spark, str(tmp_path / "t.tsv"))
    known = spark.createDataFrame([("s__c", "s", 2)], "uid string, source string, shard int")
    got = {r["uid"]: r for r in readers.ingested(read_tars(spark, shards), "s", known, side).collect()}
    assert sorted(got) == ["s__a", "s__b", "s__d", "s__dup"]
    assert got["s__a"]["text"] == '"quoted' and got["s__b"]["text"] == "last" and got["s__dup"]["text"] == "" and got["s__dup"]["shard"] == 1
    assert {r["uid"] for r in readers.ingested(read_tars(spark, shards), "s", known, None, 1).collect()} == {"s__a"}


def test_other_layouts(spark, tmp_path):
    one = spark.createDataFrame([(("p/q.wav", bytearray(b"1")), "hi"), ((None, bytearray(b"2")), None), (("z.wav", None), "gone")], "audio struct<path: string, bytes: binary>, transcript string")
    one.coalesce(1).write.parquet(str(tmp_path / "audio"))
    got = sorted((r["name"], r["text"]) for r in readers.audio_parquet(spark, str(tmp_path / "audio")).collect())
    assert got[0] == ("p/q.wav", "hi") and got[1][0].endswith("_1.wav") and got[1][1] == "" and len(got) == 2
    (tmp_path / "files" / "sub").mkdir(parents=True)
    (tmp_path / "files" / "sub" / "k.wav").write_bytes(clip(300, 1))
    (tmp_path / "files" / "x.txt").write_text("no")
    assert [r["name"] for r in readers.loose_files(spark, str(tmp_path / "files")).collect()] == ["k.wav"]
    (found,) = readers.scanned_files(spark, str(tmp_path / "files")).collect()
    assert (found["uid"], found["source"], found["duration"]) == ("k", "sub", 2.0)
    (tmp_path / "nisqa.csv").write_text("deg,mos_pred,dis_pred\na/x.wav,3.5,bad\n")
    assert [tuple(r) for r in readers.opinion_file(spark, str(tmp_path / "nisqa.csv")).collect()] == [("x", 3.5, None)]
    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "metadata.csv").write_text('uid,source,file,duration,text,dnsmos_ovrl\n,,a.flac,x,"two\nlines",\nu,s,b.flac,1.5,t,3.1\nv,s,,1,t,3\n')
    rows = {r["uid"]: r for r in readers.metadata_files(spark, str(tmp_path / "src" / "metadata.csv")).collect()}
    assert sorted(rows) == ["a", "u"] and rows["a"]["source"] == "src" and rows["a"]["duration"] == 0 and rows["a"]["dnsmos_ovrl"] is None and rows["u"]["dnsmos_ovrl"] == 3.1


def test_json_lines(spark, tmp_path):
    lines = [
        '{"uid": "a", "text": "old"}', "", '{"uid": "a", "text": "new", "shard": 3, "extra": 1, "metrics": {"vad_snr_db": NaN, "dnsmos_ovrl": Infinity}}',
        "[1]", '{"text": "no uid"}', '{"uid": "b", "reasons": ["x"], "duration": 2', '{"uid": "c", "status": "keep"}',
    ]
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "shard_003.jsonl").write_text("\n".join(lines))
    got = {r["uid"]: r for r in read_json(spark, str(tmp_path / "m")).collect()}
    assert sorted(got) == ["a", "c"] and got["a"]["text"] == "new" and got["a"]["shard"] == 3 and got["c"]["status"] == "keep"
    assert np.isnan(got["a"]["metrics"]["vad_snr_db"]) and got["a"]["metrics"]["dnsmos_ovrl"] == np.inf
    assert got["c"]["shard"] == -1 and got["c"]["reasons"] == [] and got["c"]["stage"] == "fetch"


def test_settings():
    s = config.load("quality:\n  min_ovrl: 2.9\nstages: [prefilter, quality]", training={"seed": 5})
    assert s.quality.min_ovrl == 2.9 and s.quality.min_sig == 3.0 and s.stages == ("prefilter", "quality") and s.training.seed == 5
    assert config.load(config.dump(s)) == s
    with pytest.raises(KeyError):
        config.load("quality:\n  min_overall: 1")


def curation(spark, folder, shards, **more):
    members = readers.ingested(read_tars(spark, shards), "s", spark.createDataFrame([], "uid string"))
    return members, Curation(spark, folder, members.select("uid", "content"), **more)


def test_curation_resumes(spark, shards, tmp_path):
    results = []
    for k, stop in enumerate((False, True)):
        folder = str(tmp_path / f"manifest{k}")
        members, run = curation(spark, folder, shards)
        write_table(nested(members.drop("content")), folder)
        if stop:
            run.stage("prefilter", shard=1)
            _, run = curation(spark, folder, shards)
            run.stage("prefilter")
            run.stage("separate")
            _, run = curation(spark, folder, shards)
        run.run()
        assert run.stage("vad").count() == 0  # nothing is left
        results.append(sorted((r["uid"], r["status"], r["stage"], r["reasons"]) for r in run.manifest().collect()))
    assert results[0] == results[1]
    by_uid = {r[0]: r[1:] for r in results[0]}
    assert by_uid["s__d"] == ("rejected", "prefilter", ["unreadable"])
    assert by_uid["s__c"][0] == "rejected"
    assert by_uid["s__a"] == ("low_quality", "materialize", ["band_limited"])
    # trimmed to the tone of 3 s and what the span finder and the pad leave around it
    a = run.manifest().where("uid = 's__a'").first()
    assert 3.0 <= a["duration"] <= 3.6 and a["metrics"]["trim_start"] > 0.2 and a["metrics"]["speech_segments"][0][0] < 0.2 and a["sample_rate"] == 22_050
    placed = {r["uid"]: r for r in spark.read.parquet(f"{folder}-out/clips").collect()}
    assert sorted(placed) == ["s__a", "s__b", "s__dup"] and placed["s__a"]["bucket"] == "low_quality"
    assert audio.header(placed["s__a"]["content"])[:2] == (a["duration"], 22_050) and a["path"].endswith("-out/low_quality/s/s__a.wav")
    lines = spark.read.option("header", True).csv(f"{folder}-out/metadata/by_source").collect()
    assert sorted((r["bucket"], r["source_key"], r["file"]) for r in lines) == [("low_quality", "s", f"{u}.wav") for u in sorted(placed)]
    assert {r["file"] for r in spark.read.option("header", True).csv(f"{folder}-out/metadata/combined").collect()} == {f"s/{u}.wav" for u in placed}
    assert run.stage("materialize").count() == 0 and run.plan().count() == 0

    eased = config.load("quality:\n  min_bandwidth_hz: 100.0")
    _, run = curation(spark, folder, shards, settings=eased)
    before = [tuple(r) for r in run.rescore(dry_run=True).collect()]
    assert before == [("low_quality", "keep", 3)] and run.manifest().where("status = 'keep'").count() == 0
    run.rescore()
    assert [tuple(r) for r in run.rescore().collect()] == [("keep", "keep", 3)]
    assert run.manifest().where("status = 'keep' and size(reasons) = 0 and stage = 'materialize'").count() == 3
    assert run.rescore(dry_run=True, source="other").count() == 0
    moved = run.stage("materialize")
    assert [tuple(r) for r in run.counts(moved).orderBy("shard").collect()] == [("s", 1, "materialize", 3, 3, 3, 0, 0)]
    assert {r["bucket"] for r in spark.read.parquet(f"{folder}-out/clips").collect()} == {"clean"}
    parts, summary = run.prepare(str(tmp_path / "set"))
    one = summary.first()
    assert (one["train_files"], one["val_files"], one["by_source"], one["dropped"]) == (3, 0, {"s": 3}, None) or one["dropped"] == {}
    assert spark.read.option("header", True).csv(str(tmp_path / "set" / "index")).count() == 3 and spark.read.json(str(tmp_path / "set" / "summary")).count() == 1
    run.cleanup()
    assert run._worked() is None
    assert run.training_set().count() == 3 and {r["part"] for r in run.training_set().collect()} == {"train"}
    assert {r["metric"] for r in run.calibrate()["percentiles"].collect()} >= {"bandwidth_hz", "clipping_ratio"}
    pruned = run.manifest().where("shard = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(shard" in pruned
    with pytest.raises(ValueError):
        run.stage("train")


def test_table_keeps_other_partitions(spark, tmp_path):
    folder = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", "s", 1, "pending"), ("b", "s", 2, "pending")], "uid string, source string, shard int, status string")
    write_table(nested(rows), folder)
    write_table(read_table(spark, folder).where("shard = 1").withColumn("status", F.lit("keep")), folder)
    assert sorted((r["uid"], r["status"]) for r in read_table(spark, folder).collect()) == [("a", "keep"), ("b", "pending")]
    compact(spark, folder)
    assert read_table(spark, folder).count() == 2
    write_json(read_table(spark, folder), str(tmp_path / "j"))
    lines = [json.loads(x) for p in (tmp_path / "j").rglob("*.json") for x in p.read_text().splitlines()]
    assert sorted(x["uid"] for x in lines) == ["a", "b"]
    assert analytics.summary(read_table(spark, folder)).count() > 0


def test_streams_go_on_where_they_stopped(spark, tmp_path):
    folder, target, state = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "state")
    kind = "uid string, n int"
    put_in = lambda rows: spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(str(folder))
    take = lambda: ingest_stream(spark.readStream.schema(kind).parquet(str(folder)), target, state, "uid", "n").awaitTermination()
    put_in([("a", 1), ("a", 2), ("b", 3)])
    take()
    take()
    put_in([("b", 4), ("c", 5)])
    take()
    assert sorted((r["uid"], r["n"]) for r in spark.read.parquet(target).collect()) == [("a", 1), ("b", 3), ("c", 5)]


def test_plug_ins(spark, tmp_path):
    """A decoder of another format, a span finder that fails on one clip, a model, and a stage of one's own."""
    import sys

    from siltline.operators.scorers import folder_scorer, model_scorer

    tone, other = clip(3000, 2), clip(900, 3)
    clips = spark.createDataFrame([("s__x", bytearray(tone[::-1])), ("s__y", bytearray(other[::-1])), ("s__z", bytearray(b"no"))], "uid string, content binary")
    rows = clips.select("uid", F.lit("s").alias("source"), F.lit(-1).alias("shard"), F.lit("pending").alias("status"), F.lit("fetch").alias("stage"), F.array().cast("array<string>").alias("reasons"))

    def backwards(data, mono=True):
        return audio.decode_wav(bytes(data)[::-1], mono)

    def spans(x, rate):
        if len(x) / rate > 3.5:
            raise RuntimeError("a model fails")
        return audio.energy_spans(x, rate)

    def flag(run, df):
        return df.withColumns({"stage": F.lit("separate"), "text": F.lit("seen")})

    score = model_scorer(lambda: lambda x: {"squim_pesq": float(len(x))}, ["squim_pesq", "squim_stoi"], decode=audio.decoder(backwards))
    run = Curation(spark, str(tmp_path / "m"), clips, config.load("prefilter:\n  use_vad: false"), spans_of=spans, decode=backwards, scorers=(score,), stages={"separate": flag})
    write_table(nested(rows), str(tmp_path / "m"))
    assert {(r["stage"], r["n"]) for r in run.plan().collect()} == {(s, 3) for s in run.settings.stages}
    run.run()
    got = {r["uid"]: r for r in run.manifest().collect()}
    assert got["s__z"]["reasons"] == ["unreadable"] and got["s__y"]["reasons"] == ["unreadable"] and got["s__x"]["text"] == "seen"
    assert got["s__x"]["metrics"]["squim_pesq"] > 30_000 and np.isnan(got["s__x"]["metrics"]["squim_stoi"])
    # the same failure in the speech stage is named after it
    write_table(nested(rows.withColumn("stage", F.lit("separate"))), str(tmp_path / "m"))
    assert {r["uid"]: r["reasons"] for r in run.stage("vad").collect()} == {"s__x": [], "s__y": ["vad_failed"], "s__z": ["vad_failed"]}
    short = spark.createDataFrame([("a", bytearray(clip(300, 0.1)[: 44 + 2000]))], "uid string, content binary")
    assert np.isnan(model_scorer(lambda: lambda x: {"s": 1.0}, ["s"])(short).first()["s"])

    program = "import sys, pathlib; o = pathlib.Path(sys.argv[2]); f = sorted(pathlib.Path(sys.argv[1]).iterdir()); (o / 'r.csv').write_text('deg,mos_pred\\n' + ''.join(f'{p},{p.stat().st_size}\\n' for p in f))"
    wavs = spark.createDataFrame([("p", bytearray(tone)), ("q", bytearray(other))], "uid string, content binary").coalesce(1)
    found = folder_scorer(lambda a, b: [sys.executable, "-c", program, a, b], {"mos_pred": "nisqa_mos"})(wavs).collect()
    assert {r["uid"]: r["nisqa_mos"] for r in found} == {"p": len(tone), "q": len(other)}
    assert folder_scorer(lambda a, b: [sys.executable, "-c", "raise SystemExit(3)"], {"mos_pred": "nisqa_mos"})(wavs).count() == 0


def test_sources_of_settings():
    s = config.load("sources:\n  - a/b@v2#c d\n  - repo_id: x/y\n    enabled: false\n    shards: [1, 2]\n  - {repo_id: u/v, limit: 5}")
    assert [x.slug for x in s.sources] == ["c_d", "y", "v"] and s.sources[0].revision == "v2" and s.sources[1].shards == (1, 2)
    assert [x.slug for x in config.active_sources(s.sources)] == ["c_d", "v"] and [x.limit for x in config.active_sources(s.sources, ["u/v"])] == [5]
    assert config.load(config.dump(s)) == s
    for bad in (lambda: config.active_sources(s.sources, ["y"]), lambda: config.source_of({"repo": "x"})):
        with pytest.raises(KeyError):
            bad()


def test_limits_and_candidates(spark, shards, tmp_path):
    none = spark.createDataFrame([], "uid string, source string, shard int")
    assert readers.ingested(read_tars(spark, shards), "s", none, None, 0, 3).count() == 3
    one = spark.createDataFrame([("s__a", "s", 1)], "uid string, source string, shard int")
    assert readers.ingested(read_tars(spark, shards), "s", one, None, 2, 3).count() == 2
    assert readers.candidates(spark, str(tmp_path / "none")).count() == 0
    for name in ("clean/s", "low/t"):
        (tmp_path / name).mkdir(parents=True)
        (tmp_path / name / "k.wav").write_bytes(clip(300, 1))
    (tmp_path / "clean/s/metadata.csv").write_text("uid,source,file,duration,text\ns__k,s,k.wav,2.0,hi\ns__l,s,gone.wav,2.0,hi\n")
    assert [r["uid"] for r in readers.candidates(spark, str(tmp_path / "clean")).collect()] == ["s__k"]
    both = readers.candidates(spark, str(tmp_path / "clean"), str(tmp_path / "low")).collect()
    assert sorted((r["uid"], r["source"], r["duration"]) for r in both) == [("k", "t", 2.0), ("s__k", "s", 2.0)]


def test_a_unit_is_packed_as_it_streams(spark):
    from siltline.operators.batches import greedy_batches

    r = np.random.default_rng(4)
    rows = [(f"u{k:05}", k % 3 and 1 or 2, float(x)) for k, x in enumerate(r.choice([0.0, -1.0, 50.0, 100.0, 250.0, 400.0, float("nan")], 30_000))]
    got = {x["uid"]: (x["position"], x["batch"]) for x in greedy_batches(spark.createDataFrame(rows, "uid string, shard int, duration double"), ["shard"], "uid", 300.0).collect()}
    for shard in (1, 2):
        total, batch, place = 0.0, 0, 0
        for uid, s, d in rows:
            if s == shard:
                d = d if d > 0 else 3.0
                if place and total + d > 300.0:
                    batch, total = batch + 1, 0.0
                total += d
                assert got[uid] == (place, batch)
                place += 1
