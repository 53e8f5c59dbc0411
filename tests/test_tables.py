"""Tables whose folders hold several shards: few files, other units kept, units run one after another."""

import pytest
from pyspark.sql import functions as F

from siltline import config
from siltline.plans.curation import Curation, nested
from siltline.sources.manifest_files import compact, read_table, write_table


def units(spark, n):
    """Three records in each of n shards of two sources, dealt out so that every task has all of them."""
    k = F.col("id")
    rows = spark.range(6 * n).select(F.concat(F.lit("u"), k).alias("uid"), F.concat(F.lit("s"), k % 2).alias("source"), (k % n).cast("int").alias("shard"), F.lit("pending").alias("status"), F.lit("fetch").alias("stage"))
    return rows.withColumn("reasons", F.array().cast("array<string>")).repartition(8, "uid")


def files(tmp_path, name):
    return [p for p in (tmp_path / name).rglob("*.parquet")]


def test_a_unit_is_in_few_files_whatever_the_tasks(spark, tmp_path):
    write_table(nested(units(spark, 15)), str(tmp_path / "t"))
    assert len(files(tmp_path, "t")) <= 30 + 4
    write_table(nested(units(spark, 15)), str(tmp_path / "few"), 8)
    assert {p.parent.relative_to(tmp_path / "few").as_posix() for p in files(tmp_path, "few")} == {f"source=s{s}/shards={b}" for s in (0, 1) for b in (0, 1)}
    assert len(files(tmp_path, "few")) <= 4 + 4
    plain = [sorted(map(tuple, read_table(spark, str(tmp_path / t)).select("uid", "source", "shard").collect())) for t in ("t", "few")]
    assert plain[0] == plain[1] and len(plain[0]) == 90


def test_units_that_share_a_folder_stay(spark, tmp_path):
    folder = str(tmp_path / "t")
    odd = spark.createDataFrame([("x", None, -1), ("y", None, -2), ("z", "s0", None)], "uid string, source string, shard int")
    write_table(nested(units(spark, 6).unionByName(odd, allowMissingColumns=True)), folder, 4)
    write_table(read_table(spark, folder).where("source = 's0' and shard = 2 or uid = 'y'").withColumn("status", F.lit("keep")), folder, 4)
    got = {r["uid"]: (r["source"], r["shard"], r["status"]) for r in read_table(spark, folder).collect()}
    assert len(got) == read_table(spark, folder).count() == 39 and {got["x"], got["y"], got["z"]} == {(None, -1, None), (None, -2, "keep"), ("s0", None, None)}
    assert {(s, n) for s, n, status in got.values() if status == "keep"} == {("s0", 2), (None, -2)}
    later = read_table(spark, folder).where("shard = 3").withColumn("stage", F.lit("vad"))
    write_table(read_table(spark, folder).where("shard = 3").unionByName(later), folder, 4)
    compact(spark, folder, 4)
    assert read_table(spark, folder).count() == 39 and read_table(spark, folder).where("stage = 'vad'").count() == 6
    write_table(nested(units(spark, 2)), str(tmp_path / "one"))
    with pytest.raises(ValueError):
        write_table(nested(units(spark, 2)), str(tmp_path / "one"), 4)


def test_units_of_one_folder_run_and_are_cleaned_up(spark, tmp_path):
    """All records come through, and a unit gives up its own working clips only."""
    import numpy as np

    from siltline.functions import audio

    tone = audio.encode_wav(0.2 * np.sin(np.arange(8_000) / 4), 16_000)
    rows, folder = units(spark, 3).where("shard < 2"), str(tmp_path / "m")
    write_table(nested(rows), folder, 2)

    def fails(run, records):
        if records.where("source = 's1' and shard = 1").limit(1).count():
            raise RuntimeError("no")
        return records.withColumn("stage", F.lit("quality"))

    s = config.load("stages: [separate, quality, materialize]\nmaterialize: {mode: move}\nshards_per_folder: 2")
    run = Curation(spark, folder, rows.select("uid", F.lit(tone).alias("content")), s, stages={"quality": fails})
    got = {(r["source"], r["shard"]): (r["state"], r["seen"]) for r in run.run_units(at_once=4).collect()}
    assert got == {(a, n): ("failed" if (a, n) == ("s1", 1) else "done", 3) for a in ("s0", "s1") for n in range(2)}
    assert run.manifest().count() == 12 and run.manifest().where("stage = 'materialize'").count() == 9
    assert {(r["source"], r["shard"]) for r in run._worked().collect()} == {("s1", 1)} and run._worked().count() == 3
    made = spark.read.parquet(f"{folder}-out/clips")
    assert made.count() == made.select("uid").distinct().count() == 9 and "shards" in made.columns
    assert sum(r["files"] for r in run.place(str(tmp_path / "files")).collect()) == 9


def test_many_small_shards_share_tasks(spark, tmp_path):
    """An index of many tars is in a bounded number of tasks, and whole."""
    from siltline.sources.tars import tar_index, write_tars

    members = spark.range(120).select(F.col("id").cast("int").alias("shard"), F.format_string("m%d.wav", "id").alias("name"), F.lit(b"x").alias("content"))
    index = tar_index(write_tars(members, str(tmp_path / "t")).select("path"))
    assert index.rdd.getNumPartitions() <= 8 * spark.sparkContext.defaultParallelism < 120
    assert sorted(r["shard"] for r in index.collect()) == list(range(120))


def test_no_task_looks_for_metadata_among_clips(spark, tmp_path):
    """A folder without metadata is listed for metadata files alone before its clips are scanned."""
    from siltline.sources import readers

    (tmp_path / "c" / "s").mkdir(parents=True)
    (tmp_path / "c" / "s" / "a.wav").write_bytes(b"no clip")
    patterns, real = [], readers.listing
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(readers, "listing", lambda s, p, pattern="*": patterns.append(pattern) or real(s, p, pattern))
        assert readers.candidates(spark, str(tmp_path / "c"), str(tmp_path / "none")).count() == 0
    assert set(patterns) == {"metadata.csv"}
