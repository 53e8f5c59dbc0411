"""Sources in YAML to records and clips; tar indexes; units that fail alone."""

import gzip
import io
import tarfile

import pytest
from pyspark.sql import functions as F

from siltline import config
from siltline.plans.fetching import fetch, fetch_plan, fetched_clips
from siltline.sources.manifest_files import read_table, write_table
from siltline.sources.tars import read_tars, tar_index, tar_payloads, write_tars


def tar_of(members, mode="w"):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode=mode) as tar:
        for name, data in members:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
        tar.addfile(_folder())
    return out.getvalue()


def _folder():
    info = tarfile.TarInfo("folder.wav")
    info.type = tarfile.DIRTYPE
    return info


@pytest.fixture
def root(spark, tmp_path):
    """Three sources: tar shards with a sidecar, audio in Parquet, loose files."""
    one = tmp_path / "own" / "tars"
    one.mkdir(parents=True)
    (one / "part_001.tar").write_bytes(tar_of([(f"x/c{k}.wav", b"one%d" % k) for k in range(8)] + [("read.txt", b"no"), ("y/c0.WAV", b"again")]))
    (one / "part_002.tar.gz").write_bytes(gzip.compress(tar_of([("c3.wav", b"other"), ("d.mp3", b"two"), ("e.flac", b"three")])))
    (one / "part_007.tar").write_bytes(tar_of([("z.wav", b"zz")]))
    (one / "text.tsv").write_text("file_name\tsentence\nx/c1.mp3\tsaid\nd.mp3\tspoken\n")
    rows = [(("p/q.wav", bytearray(b"1")), "hi"), (("r.wav", bytearray(b"22")), ""), (("r.wav", bytearray(b"333")), "twice"), (("z.txt", bytearray(b"4")), "no"), (("e.wav", None), "gone")]
    spark.createDataFrame(rows, "audio struct<path: string, bytes: binary>, text string").coalesce(1).write.parquet(str(tmp_path / "own" / "rows"))
    (tmp_path / "own" / "loose" / "deep").mkdir(parents=True)
    (tmp_path / "own" / "loose" / "deep" / "k.wav").write_bytes(b"kk")
    (tmp_path / "own" / "loose" / "l.ogg").write_bytes(b"l")
    return tmp_path


YAML = """
sources:
  - {repo_id: own/tars, shards: [1, 2, 9], metadata_file: text.tsv, name: t a}
  - own/rows
  - {path: "%s/own/loose", limit: 5}
  - {repo_id: own/none, enabled: false}
"""


def test_fetch_takes_each_clip_once(spark, root):
    s = config.load(YAML % root)
    plan = {(r["source"], r["shard"]): (r["layout"], r["files"], r["present"]) for r in fetch_plan(spark, s, str(root)).collect()}
    assert plan == {
        ("t_a", 1): ("tar", 1, True), ("t_a", 2): ("tar", 1, True), ("t_a", 9): ("tar", 0, False), ("rows", -1): ("parquet", 1, True), ("loose", -1): ("files", 2, True),
    }
    folder = str(root / "manifest")
    counts = {(r["source"], r["shard"]): (r["seen"], r["added"]) for r in fetch(spark, s, folder, str(root)).collect()}
    assert counts == {("t_a", 1): (9, 8), ("t_a", 2): (3, 2), ("rows", -1): (3, 2), ("loose", -1): (2, 2)}
    rows = {r["uid"]: r for r in read_table(spark, folder).collect()}
    clips = {r["uid"]: bytes(r["content"]) for r in fetched_clips(spark, folder).collect()}
    assert sorted(rows) == sorted(clips) == sorted([*(f"t_a__c{k}" for k in range(8)), "t_a__d", "t_a__e", "rows__q", "rows__r", "loose__k", "loose__l"])
    assert (rows["t_a__c1"]["text"], rows["t_a__d"]["text"], rows["t_a__c2"]["text"], rows["rows__q"]["text"]) == ("said", "spoken", "", "hi")
    assert clips["t_a__c5"] == b"one5" and clips["t_a__e"] == b"three" and clips["loose__l"] == b"l" and clips["rows__r"] == (b"22" if rows["rows__r"]["text"] == "" else b"333")
    assert {(r["stage"], r["status"]) for r in rows.values()} == {("fetch", "pending")} and rows["t_a__c3"]["shard"] in (1, 2)
    # again: nothing; a new shard: its clips alone
    assert {r["added"] for r in fetch(spark, s, folder, str(root)).collect()} == {0}
    more = config.load("sources: [{repo_id: own/tars, name: t a}]")
    assert {(r["shard"], r["added"]) for r in fetch(spark, more, folder, str(root)).collect()} == {(1, 0), (2, 0), (7, 1)}
    assert read_table(spark, folder).count() == fetched_clips(spark, folder).count() == 15


def test_limits_go_on_after_what_is_known(spark, root):
    folder = str(root / "manifest")
    s = config.load("sources: [{repo_id: own/tars, shards: [1], limit_per_shard: 3}]")
    assert [r["added"] for r in fetch(spark, s, folder, str(root)).collect()] == [3]
    assert [r["added"] for r in fetch(spark, s, folder, str(root)).collect()] == [0]
    s = config.load("sources: [{repo_id: own/tars, shards: [1], limit_per_shard: 5}]")
    assert [r["added"] for r in fetch(spark, s, folder, str(root)).collect()] == [2]
    s = config.load("sources: [{repo_id: own/tars, limit: 7}]")
    assert sum(r["added"] for r in fetch(spark, s, folder, str(root)).collect()) == 2 and fetched_clips(spark, folder).count() == 7
    with pytest.raises(KeyError):
        fetch(spark, s, folder, str(root), only=["other"])


def test_a_fetch_that_broke_off_is_taken_again(spark, root, monkeypatch):
    """Clips are written before records: a failure between leaves no clip twice."""
    from siltline.plans import fetching

    folder, s = str(root / "manifest"), config.load("sources: [own/rows, own/tars]")
    first = config.load("sources: [own/rows]")
    fetch(spark, first, folder, str(root))

    def broken(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(fetching, "write_table", broken)
    with pytest.raises(RuntimeError):
        fetch(spark, s, folder, str(root))
    monkeypatch.setattr(fetching, "write_table", write_table)
    fetch(spark, s, folder, str(root))
    assert fetched_clips(spark, folder).count() == fetched_clips(spark, folder).select("uid").distinct().count() == read_table(spark, folder).count() == 13


def test_large_tars_are_read_by_many_tasks(spark, tmp_path):
    members = spark.range(300).select((F.col("id") % 2).cast("int").alias("shard"), F.format_string("m%03d.wav", "id").alias("name"), F.repeat(F.col("id").cast("string"), 200).cast("binary").alias("content"))
    told = {r["shard"]: (r["members"], r["bytes"]) for r in write_tars(members, str(tmp_path / "t")).collect()}
    want = {r["name"]: bytes(r["content"]) for r in members.collect()}
    assert told == {k: (150, sum(len(c) for n, c in want.items() if int(n[1:4]) % 2 == k)) for k in (0, 1)}
    paths = spark.createDataFrame([(str(tmp_path / "t" / f"shard_{k:03d}.tar"),) for k in (0, 1)], "path string")
    index = tar_index(paths)
    assert "content" not in index.columns and index.count() == 300
    read = tar_payloads(index.where("shard = 1").withColumn("kept", F.lit("x")), split=8 << 10)
    assert read.rdd.getNumPartitions() > 5
    assert {r["name"]: bytes(r["content"]) for r in read.collect()} == {n: c for n, c in want.items() if int(n[1:4]) % 2}
    assert {r["kept"] for r in read.select("kept").collect()} == {"x"}
    assert {(r["shard"], r["name"]) for r in read_tars(spark, str(tmp_path / "t")).select("shard", "name").collect()} == {(int(n[1:4]) % 2, n) for n in want}
    assert tar_payloads(index.where("false")).collect() == []


def test_units_fail_alone(spark, tmp_path):
    """One unit's stage raises: the others finish, the failure is a row, and a rerun takes that unit alone from where it stopped."""
    from siltline.plans.curation import Curation, nested

    ran, broken = [], {"on": True}
    rows = [(f"{s}__{k}", s, n, "pending", "fetch") for s in ("a", "b") for n in (1, 2) for k in (10 * n, 10 * n + 1)] + [("c__x", "c", -1, "rejected", "fetch")]
    df = spark.createDataFrame(rows, "uid string, source string, shard int, status string, stage string").withColumn("reasons", F.array().cast("array<string>"))
    folder = str(tmp_path / "m")
    write_table(nested(df), folder)

    def stage(name, status=None):
        def run(self, records):
            first = records.select("source", "shard").first()
            if first is not None:
                ran.append((name, *first))
                if name == "vad" and broken["on"] and tuple(first) == ("a", 2):
                    raise RuntimeError("a model fails\nand more")
            return records.withColumns({"stage": F.lit(name)} | ({"status": F.lit(status)} if status else {}))

        return run

    settings = config.load("stages: [prefilter, vad, quality]")
    run = Curation(spark, folder, df.select("uid", F.lit(b"").alias("content")), settings, stages={"prefilter": stage("prefilter"), "vad": stage("vad"), "quality": stage("quality", "keep")})
    assert run.units() == [("a", 1), ("a", 2), ("b", 1), ("b", 2)] and run.units(["b"], [2]) == [("b", 2)]
    got = {(r["source"], r["shard"]): r for r in run.run_units(at_once=3).collect()}
    assert {k: (r["state"], r["stage"], r["kept"]) for k, r in got.items()} == {("a", 1): ("done", "quality", 2), ("a", 2): ("failed", "vad", 0), ("b", 1): ("done", "quality", 2), ("b", 2): ("done", "quality", 2)}
    assert got["a", 2]["error"] == "RuntimeError: a model fails" and got["b", 1]["error"] is None
    assert {(r["uid"], r["stage"]) for r in run.manifest().where("source = 'a' and shard = 2").collect()} == {("a__20", "prefilter"), ("a__21", "prefilter")}
    ran.clear()
    broken["on"] = False
    (again,) = run.run_units().collect()
    assert (again["source"], again["shard"], again["state"], again["kept"]) == ("a", 2, "done", 2)
    assert ran == [("vad", "a", 2), ("quality", "a", 2)]
    assert run.run_units().collect() == [] and spark.read.parquet(f"{folder}-runs").count() == 5


def test_units_are_placed_and_failures_counted(spark, root, tmp_path):
    """YAML in, clips placed by unit: fetched, gated, encoded; a clip that can't be encoded is counted and the rest go on."""
    import numpy as np

    from siltline.functions import audio
    from siltline.plans.curation import Curation

    tone = audio.encode_wav(0.3 * np.sin(np.arange(48_000) / 3), 16_000)
    (tmp_path / "w" / "tones").mkdir(parents=True)
    for k in (1, 2):
        (tmp_path / "w" / "tones" / f"s_{k}.tar").write_bytes(tar_of([(f"t{k}.wav", tone), (f"u{k}.wav", tone)]))
    s = config.load("sources: [tones]\nstages: [materialize]")
    folder = str(tmp_path / "made")
    fetch(spark, s, folder, str(tmp_path / "w"))
    clips = fetched_clips(spark, folder).withColumn("content", F.when(F.col("uid") == "tones__u2", F.lit(b"bad")).otherwise(F.col("content")))
    run = Curation(spark, folder, clips, s)
    got = {r["shard"]: (r["state"], r["seen"], r["failed"]) for r in run.run_units(at_once=2).collect()}
    assert got == {1: ("done", 2, 0), 2: ("done", 2, 1)}
    assert {r["uid"] for r in spark.read.parquet(f"{folder}-out/clips").collect()} == {"tones__t1", "tones__u1", "tones__t2"}
    assert spark.read.option("header", True).csv(f"{folder}-out/metadata/by_source").count() == 3


def test_shards_as_a_stream(spark, tmp_path):
    """Each run reads the shards that have come since the one before, and a run without any reads none."""
    from siltline.sources.tars import stream_tars
    from siltline.streaming.ingest import ingest_stream

    (tmp_path / "in").mkdir()
    target, state = str(tmp_path / "table"), str(tmp_path / "state")

    def take():
        rows = stream_tars(spark, str(tmp_path / "in")).select("name", "shard", F.octet_length("content").alias("n"))
        ingest_stream(rows, target, state, "name", "shard").awaitTermination()
        return sorted((r["shard"], r["name"], r["n"]) for r in spark.read.parquet(target).collect())

    (tmp_path / "in" / "s_1.tar").write_bytes(tar_of([("a.wav", b"1"), ("b.wav", b"22"), ("no.txt", b"x")]))
    assert take() == take() == [(1, "a.wav", 1), (1, "b.wav", 2)]
    (tmp_path / "in" / "s_0.tar").write_bytes(tar_of([("b.wav", b"again"), ("c.wav", b"333")]))
    (tmp_path / "in" / "s_1.tar").write_bytes(b"gone bad, and not read again")
    assert take() == [(0, "c.wav", 3), (1, "a.wav", 1), (1, "b.wav", 2)]


def test_a_unit_gives_up_its_working_clips(spark, tmp_path):
    """With mode move, what stages have kept of a unit goes when the unit is through; what failed keeps its own."""
    import numpy as np

    from siltline.functions import audio
    from siltline.plans.curation import Curation, nested

    clip = audio.encode_wav(0.2 * np.sin(np.arange(24_000) / 4), 16_000)
    rows = spark.createDataFrame([("a", "s", 1), ("b", "s", 2)], "uid string, source string, shard int").withColumns({"status": F.lit("pending"), "stage": F.lit("prefilter"), "reasons": F.array().cast("array<string>")})
    folder = str(tmp_path / "m")
    write_table(nested(rows), folder)

    def fails(run, records):
        if records.where("shard = 2").limit(1).count():
            raise RuntimeError("no")
        return records.withColumn("stage", F.lit("quality"))

    s = config.load("stages: [separate, quality, materialize]\nmaterialize: {mode: move}")
    run = Curation(spark, folder, rows.select("uid", F.lit(clip).alias("content")), s, stages={"quality": fails})
    assert {(r["shard"], r["state"]) for r in run.run_units().collect()} == {(1, "done"), (2, "failed")}
    assert [r["uid"] for r in run._worked().collect()] == ["b"]
    assert [r["uid"] for r in spark.read.parquet(f"{folder}-out/clips").collect()] == ["a"]
