"""The stages of curation over the manifest table: each takes what is pending, measures once, decides, and upserts."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from siltline.config import Settings
from siltline.functions import audio
from siltline.functions.expr import bucket
from siltline.functions.signal import span_stats, trim_bounds
from siltline.operators import analytics, gates, prepare
from siltline.operators.batches import greedy_batches
from siltline.operators.manifest import alive, last_write_wins, pending_for, upsert
from siltline.operators.measure import encode_clips, measure_clips, trim_clips
from siltline.operators.separation import Separator, separated, unchanged
from siltline.schema import KEEP, MANIFEST, METRICS, REJECTED, STAGES, stage_ordinal
from siltline.shared import checkpointed, remove
from siltline.sources.files import write_files
from siltline.sources.manifest_files import folder_number, read_table, write_table, write_units

#: Rows of (uid, content) in, rows of uid and any of the measures in the schema out.
Scorer = Callable[[DataFrame], DataFrame]
#: The run and its flat pending records in, those records with their stage, status and reasons out.
Stage = Callable[["Curation", DataFrame], DataFrame]


def flat(records: DataFrame) -> DataFrame:
    """Records with their measures as columns."""
    return records.select(*(c for c in records.columns if c != "metrics"), "metrics.*")


def nested(df: DataFrame) -> DataFrame:
    """The manifest's columns of flat records."""
    has = set(df.columns)
    value = lambda f: (F.col(f.name) if f.name in has else F.lit(None)).cast(f.dataType).alias(f.name)
    return df.select(*(value(f) for f in MANIFEST.fields if f.name != "metrics"), F.struct(*(value(f) for f in METRICS.fields)).alias("metrics"))


def vad_columns(df: DataFrame, spans: Column, duration: Column, rate: Column, g: gates.Speech) -> DataFrame:
    """Adds what speech spans say of clips, untrimmed, and where and how long a trimmed clip would be."""
    stats, some = span_stats(spans, duration), F.size(spans) > 0
    start, end, moved = trim_bounds(F.when(some, spans), duration, g.trim_pad)
    at = lambda t: F.least(F.floor(t * rate), F.round(duration * rate))
    return df.withColumns({
        "num_speech_segments": stats["num_speech_segments"], "speech_seconds": stats["speech_seconds"], "speech_ratio": stats["speech_ratio"],
        "speech_segments": F.when(some, spans), "_moved": F.when(some, moved), "trim_start": F.when(some, start), "trim_end": F.when(some, end),
        "trimmed": F.when(some, F.greatest(at(end) - at(start), F.lit(0)) / rate),
    })


def vad_decided(df: DataFrame, g: gates.Speech) -> DataFrame:
    """The gate of speech over vad_columns: clips that pass get their trimmed duration, rate and spans (_cut says which), or keep the whole."""
    out = gates.gate(df, gates.speech_checks(df, g), "vad").withColumn("_cut", (F.col("status") != REJECTED) & F.lit(g.trim) & F.col("trim_start").isNotNull())
    cut, passed = F.col("_cut"), F.col("status") != REJECTED
    return out.withColumns({
        "duration": F.when(cut, F.col("trimmed")).when(passed & F.lit(not g.trim), F.coalesce("_long", "duration")).otherwise(F.col("duration")),
        "sample_rate": F.when(cut, F.col("_rate")).otherwise(F.col("sample_rate")), "speech_segments": F.when(cut, F.col("_moved")).otherwise(F.col("speech_segments")),
        "trim_start": F.when(cut, F.col("trim_start")), "trim_end": F.when(cut, F.col("trim_end")),
    }).drop("_moved", "trimmed")


class Curation:
    """The manifest table at a folder and the clips' bytes (uid, content) that the measuring stages read."""

    def __init__(
        self, spark: SparkSession, folder: str, clips: DataFrame, settings: Settings | None = None, spans_of=audio.energy_spans, separator: Separator = unchanged,
        scorers: tuple[Scorer, ...] = (), decode=audio.decode_wav, stages: Mapping[str, Stage] | None = None,
    ):
        """decode(data, mono) reads the clips' bytes where they are not WAV; stages adds stages by name, or replaces those of a name."""
        self.spark, self.folder, self.clips, self.settings = spark, folder.rstrip("/"), clips, settings or Settings()
        self.spans_of, self.separator, self.scorers, self.decode = spans_of, separator, scorers, audio.decoder(decode)
        own = {name: getattr(type(self), f"_{name}") for name in STAGES[1:]}
        self.stages: dict[str, Stage] = own | dict(stages or {})

    def manifest(self) -> DataFrame:
        return read_table(self.spark, self.folder)

    def _worked(self) -> DataFrame | None:
        """Clips as stages have left them (separated, trimmed), by source and shard beside the manifest; None before the first."""
        try:
            return self.spark.read.parquet(f"{self.folder}-audio")
        except AnalysisException:
            return None

    def _keep_audio(self, new: DataFrame, units: DataFrame) -> None:
        """Puts clips (uid, content, source, shard) in place of those of their uid, in the units' partitions."""
        done = self._worked()
        if done is not None:
            new = upsert(done.join(F.broadcast(units), ["source", "shard"], "left_semi").select(new.columns), new, "uid")  # a row for each unit
        write_units(checkpointed(new), f"{self.folder}-audio", self.settings.shards_per_folder)

    def audio(self) -> DataFrame:
        """(uid, content) of each clip: as the stages have left it, else as it came."""
        done, raw = self._worked(), self.clips.select("uid", "content")
        return raw if done is None else raw.join(done.select("uid"), "uid", "left_anti").unionByName(done.select("uid", "content"))

    def cleanup(self) -> None:
        """Removes the clips that stages have kept for one another; what is materialized stays."""
        remove(self.spark, f"{self.folder}-audio")

    def _update(self, changed: DataFrame) -> DataFrame:
        """Writes the partitions that changed rows are in; returns those rows. Nothing is written if there are none."""
        changed = checkpointed(nested(changed))
        units = changed.select("source", "shard").distinct()
        touched = self.manifest().join(F.broadcast(units), ["source", "shard"], "left_semi")  # a row for each unit
        write_table(upsert(touched.select(changed.columns), changed, "uid"), self.folder, self.settings.shards_per_folder)
        return changed

    def _pending(self, stage: str, source: str | None, shard: int | None, force: bool) -> DataFrame:
        rows = alive(self.manifest()) if force else pending_for(self.manifest(), stage, source, shard)
        if force:
            rows = rows.where(F.col("source") == source) if source is not None else rows
            rows = rows.where(F.col("shard") == shard) if shard is not None else rows
        return flat(rows)

    def plan(self) -> DataFrame:
        """source, shard, stage, n: how many records of each unit each stage of the settings still has ahead; shards in order, none last."""
        order = F.posexplode(F.array(*(F.lit(s) for s in self.settings.stages)))
        rows = alive(self.manifest()).select("source", "shard", "stage").withColumnRenamed("stage", "_at").select("*", order.alias("_k", "stage"))
        ahead = rows.where(stage_ordinal(F.col("_at")) < stage_ordinal(F.col("stage")))
        out = ahead.groupBy("source", "shard", "_k", "stage").agg(F.count("*").alias("n"))
        return out.orderBy("source", F.nullif("shard", F.lit(-1)).asc_nulls_last(), "_k").drop("_k")

    def stage(self, name: str, source: str | None = None, shard: int | None = None, force: bool = False) -> DataFrame:
        """Runs one stage over what is pending for it (force: over all live records); returns the changed records."""
        if name not in self.settings.stages or name not in self.stages:
            raise ValueError(f"no such stage: {name}")
        changed = self._through(name, source, shard, force)
        if name == "materialize":
            self.write_metadata(source)
        return changed

    def _through(self, name: str, source: str | None = None, shard: int | None = None, force: bool = False) -> DataFrame:
        rows = self._placed(source, shard) if name == "materialize" else self._pending(name, source, shard, force)
        return self._update(self.stages[name](self, rows))

    def counts(self, changed: DataFrame) -> DataFrame:
        """What came of the records that a stage returned: seen, alive, keep, low_quality, rejected by unit."""
        return analytics.stage_counts(changed)

    def run(self, source: str | None = None, shard: int | None = None) -> DataFrame:
        """All stages in order, as far as each unit has not been through them; returns the summary."""
        for name in self.settings.stages:
            self.stage(name, source, shard)
        return self.stats()

    def cleanup_unit(self, source: str, shard: int) -> None:
        """Removes the clips that stages have kept of one unit."""
        per = self.settings.shards_per_folder
        if per <= 1:
            return remove(self.spark, f"{self.folder}-audio/source={source}/shard={shard}")
        done = self._worked()
        if done is None:
            return None
        own = done.where((F.col("source") == source) & (F.col("shards") == folder_number(F.lit(shard), per)))
        rest = checkpointed(own.where(F.col("shard") != shard))  # of the units that share the folder
        remove(self.spark, f"{self.folder}-audio/source={source}/shards={shard // per}")
        if not rest.isEmpty():
            write_units(rest.drop("shards"), f"{self.folder}-audio", per)
        return None

    def units(self, sources: Iterable[str] = (), shards: Iterable[int] = ()) -> list[tuple[str, int]]:
        """(source, shard) of the units that have something ahead, in the order of plan()."""
        ahead = self.plan()
        for column, wanted in (("source", tuple(sources)), ("shard", tuple(shards))):
            ahead = ahead.where(F.col(column).isin(*wanted)) if wanted else ahead
        return list(dict.fromkeys((r["source"], r["shard"]) for r in ahead.select("source", "shard").collect()))  # a few rows for each unit

    def run_units(self, sources: Iterable[str] = (), shards: Iterable[int] = (), at_once: int = 4) -> DataFrame:
        """All stages of each unit that has something ahead, each unit by itself: one that fails leaves the others alone.

        Up to at_once units run side by side, each in a scheduler pool of its own (fair, where the session is set so), and
        write their own partitions; where folders hold several shards, one unit runs after another, as each may replace
        files that others read. Returns source, shard, state ('done' or 'failed'), stage (the last that began), error,
        seen, rejected, kept, failed (records that should be placed and could not) and seconds; the same rows are added to
        <folder>-runs. What a stage has finished stays, so a run after a failure goes on with that stage of that
        unit, and takes no other unit up again. Metadata files are written once, when all units are through. With
        materialize.mode 'move' a unit that is through gives up the clips that its stages have kept.
        """
        said = f"{self.folder}-runs"

        def unit(own: tuple[str, int]) -> Row:
            source, shard = own
            began, name, error = time.time(), "", None
            self.spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"{source}-{shard}")
            try:
                for name in self.settings.stages:
                    self._through(name, source, shard)
                if self.settings.materialize.mode == "move":
                    self.cleanup_unit(source, shard)
            except Exception as e:  # noqa: BLE001  one bad unit is a row, not the end of the run
                error = f"{type(e).__name__}: {str(e).strip().splitlines()[0] if str(e).strip() else ''}"[:500]
            finally:
                self.spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
            return Row(source=source, shard=shard, state="done" if error is None else "failed", stage=name, error=error, seconds=time.time() - began)

        todo = self.units(sources, shards)
        with ThreadPoolExecutor(max(1, at_once) if self.settings.shards_per_folder <= 1 else 1) as pool:
            rows = list(pool.map(inheritable_thread_target(self.spark)(unit), todo))
        found = self.spark.createDataFrame(rows, "source string, shard int, state string, stage string, error string, seconds double")
        to_place = F.col("status").isin(*self.settings.materialize.buckets()) & (F.col("stage") != "materialize") if "materialize" in self.settings.stages else F.lit(False)
        counts = self.manifest().groupBy("source", "shard").agg(
            F.count("*").alias("seen"), F.count(F.when(F.col("status") == REJECTED, 1)).alias("rejected"), F.count(F.when(F.col("status") == KEEP, 1)).alias("kept"),
            F.count(F.when(to_place, 1)).alias("_left"),
        )
        failed = F.when(F.col("state") == "done", F.col("_left")).otherwise(F.lit(0)).alias("failed")
        out = F.broadcast(found).join(counts, ["source", "shard"])  # a row for each unit that ran
        out = checkpointed(out.select("source", "shard", "state", "stage", "error", "seen", "rejected", "kept", failed, "seconds"))
        if rows:
            if "materialize" in self.settings.stages:
                self.write_metadata()
            out.withColumn("at", F.current_timestamp()).write.mode("append").parquet(said)
        return out

    def _measured(self, rows: DataFrame, failed: str) -> DataFrame:
        """rows with measures in _m and unusable; failed names what a clip is on which measuring fails."""
        found = measure_clips(self.audio().join(rows.select("uid"), "uid", "left_semi"), spans_of=self.spans_of, decode=self.decode)
        gone = F.coalesce(F.when(F.col("_m.unusable").isin("failed", "unreadable"), failed).otherwise(F.col("_m.unusable")), F.when(F.col("_m.uid").isNull(), failed))
        return rows.join(found.select("uid", F.struct("*").alias("_m")), "uid", "left").withColumn("unusable", gone)

    def _prefilter(self, rows: DataFrame) -> DataFrame:
        early = gates.prefilter_checks(rows.select("uid", "duration"), self.settings.prefilter)
        known = rows.withColumn("_skip", (F.col("duration") > 0) & F.coalesce(gates.first_hit(early).isNotNull(), F.lit(False)))
        measured = self._measured(known.where("not _skip"), "unreadable")
        stats = span_stats(F.col("_m.spans"), F.col("_m.duration"))
        measured = measured.withColumns({
            "duration": F.coalesce("_m.duration", "duration"), "sample_rate": F.coalesce("_m.sample_rate", "sample_rate"), "raw_rms_dbfs": F.col("_m.rms_dbfs"),
            "raw_active_ratio": F.col("_m.active_ratio"), "raw_speech_seconds": stats["speech_seconds"], "raw_speech_ratio": stats["speech_ratio"],
        }).drop("_m")
        both = measured.unionByName(known.where("_skip"), allowMissingColumns=True).drop("_skip")
        return gates.gate(both, gates.prefilter_checks(both, self.settings.prefilter), "prefilter")

    def _separate(self, rows: DataFrame) -> DataFrame:
        s = self.settings.separate
        placed = greedy_batches(rows, ["source", "shard"], "uid", s.target_seconds).join(self.clips, "uid")
        found = separated(placed, self.separator, ["source", "shard", "batch"], s.sample_rate, s.guard_seconds, s.peak, self.decode, s.singly)
        found = checkpointed(found)
        self._keep_audio(found.where("content is not null").join(rows.select("uid", "source", "shard"), "uid").select("uid", "content", "source", "shard"), rows.select("source", "shard").distinct())
        named = rows.join(found.select("uid", F.coalesce("reason", F.lit("")).alias("_reason")), "uid", "left")
        reason = F.coalesce("_reason", F.lit("separation_failed"))
        return gates.gate(named, [(r, reason == r) for r in ("unreadable", "separation_failed")], "separate")

    def _vad(self, rows: DataFrame) -> DataFrame:
        g = self.settings.vad
        out = vad_columns(self._measured(rows, "vad_failed"), F.col("_m.spans"), F.col("_m.duration"), F.col("_m.sample_rate"), g)
        out = out.withColumns({"vocal_rms_dbfs": F.col("_m.rms_dbfs"), "vad_snr_db": F.coalesce("_m.snr_db", "vad_snr_db"), "_rate": F.col("_m.sample_rate"), "_long": F.col("_m.duration")}).drop("_m")
        gated = checkpointed(vad_decided(out, g))
        if g.trim:
            cut = gated.where("_cut").select("uid", "source", "shard", "trim_start", "trim_end").join(self.audio(), "uid")
            self._keep_audio(trim_clips(cut, self.decode), gated.select("source", "shard").distinct())
        return gated.drop("_cut", "_rate", "_long")

    def _placed(self, source: str | None, shard: int | None) -> DataFrame:
        """Records of every status that has a bucket."""
        rows = self.manifest().where(F.col("status").isin(*self.settings.materialize.buckets()))
        rows = rows if source is None else rows.where(F.col("source") == source)
        return flat(rows if shard is None else rows.where(F.col("shard") == shard))

    def _materialize(self, rows: DataFrame) -> DataFrame:
        """Clips at the final rate as one table, <folder>-out/clips (bucket, uid, content, by source and shard); write_metadata() puts files beside it.

        Records that are there in their bucket already are left alone; one without audio, or whose audio can't be read, stays
        as it is and counts as failed in the outcome of its unit.
        """
        m, out = self.settings.materialize, f"{self.folder}-out"
        if not m.enabled:
            return rows.limit(0)
        where = F.concat_ws("/", F.lit(out), bucket(F.col("status"), m.buckets()), F.coalesce(F.nullif("source", F.lit("")), F.lit("unknown")), F.concat("uid", F.lit(f".{m.format}")))
        todo = rows.withColumn("_path", where).where((F.col("stage") != "materialize") | (F.col("path") != F.col("_path")))
        made = checkpointed(encode_clips(self.audio().join(todo.select("uid"), "uid", "left_semi"), m.sample_rate, self.decode, m.format, m.mono))
        done = todo.join(made.drop("content").withColumnsRenamed({"duration": "_d", "sample_rate": "_r"}), "uid")
        done = checkpointed(done.withColumns({"path": F.col("_path"), "duration": F.col("_d"), "sample_rate": F.col("_r"), "stage": F.lit("materialize")}).drop("_path", "_d", "_r"))
        new = made.select("uid", "content").join(done.select("uid", "source", "shard", bucket(F.col("status"), m.buckets()).alias("bucket"), "path"), "uid")
        try:
            units = done.select("source", "shard").distinct()
            old = self.spark.read.parquet(f"{out}/clips").join(F.broadcast(units), ["source", "shard"], "left_semi")  # a row for each unit
            new = upsert(old.select(new.columns), new, "uid")
        except AnalysisException:
            pass  # the first time
        write_units(checkpointed(new), f"{out}/clips", self.settings.shards_per_folder)
        return done

    def write_metadata(self, source: str | None = None) -> None:
        """Writes the metadata files of what is materialized: of all sources, or those of one source and the combined ones."""
        m, rows = self.settings.materialize, flat(self.manifest())
        if m.enabled:
            prepare.write_metadata(rows, f"{self.folder}-out/metadata", m.format, buckets={s: b for s, b in m.buckets().items() if s != REJECTED}, source=source)

    def place(self, folder: str, source: str | None = None) -> DataFrame:
        """Writes materialized clips (of one source) as files <folder>/<bucket>/<source>/<uid>.<format>; returns bucket, source, files and bytes.

        Clips whose record has left their bucket since are not written.
        """
        m = self.settings.materialize
        rows = flat(self.manifest()).where("stage = 'materialize'")
        rows = rows if source is None else rows.where(F.col("source") == source)
        wanted = rows.select("uid", "source", "shard", bucket(F.col("status"), m.buckets()).alias("bucket"))
        made = self.spark.read.parquet(f"{self.folder}-out/clips").select("uid", "source", "shard", "bucket", "content")
        clips = made.join(wanted, ["uid", "source", "shard", "bucket"], "left_semi")
        path = F.concat_ws("/", "bucket", F.coalesce(F.nullif("source", F.lit("")), F.lit("unknown")), F.concat("uid", F.lit(f".{m.format}")))
        done = write_files(clips.select(path.alias("path"), "content"), folder)
        parts = F.split("path", "/")
        return done.groupBy(parts[0].alias("bucket"), parts[1].alias("source")).agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))

    def _quality(self, rows: DataFrame) -> DataFrame:
        out = self._measured(rows, "quality_failed").withColumns({c: F.col(f"_m.{c}") for c in ("rms_dbfs", "peak_dbfs", "clipping_ratio", "dc_offset", "bandwidth_hz", "lufs")}).drop("_m")
        for scorer in self.scorers:
            scores = scorer(self.audio())
            new = [c for c in scores.columns if c != "uid"]
            out = out.join(scores.select("uid", *(F.col(c).alias(f"_{c}") for c in new)), "uid", "left")
            out = out.withColumns({c: F.coalesce(f"_{c}", c) for c in new}).drop(*(f"_{c}" for c in new))
        bad = out.where("unusable is not null")
        good = gates.decide_quality(out.where("unusable is null"), self.settings.quality)
        return good.unionByName(gates.gate(bad, [(r, F.col("unusable") == r) for r in ("empty_audio", "corrupt_audio", "quality_failed")], "quality"))

    def rescore(self, dry_run: bool = False, source: str | None = None) -> DataFrame:
        """Decides scored records (of one source) anew; returns the transitions counted. Records whose status or reasons change are written, unless dry_run; stages stay."""
        rows = flat(self.manifest())
        counted = checkpointed(analytics.transitions(rows, self.settings.quality, source))
        if not dry_run:
            old = F.struct(F.col("status").alias("s"), F.array_sort("reasons").alias("r"), F.col("quality_failures").alias("q"))
            anew = analytics.relabelled(rows.withColumn("_old", old), self.settings.quality, source)
            now = F.struct(F.col("status").alias("s"), F.array_sort("reasons").alias("r"), F.col("quality_failures").alias("q"))
            self._update(anew.where(~F.col("_old").eqNullSafe(now)).drop("before", "_old"))
        return counted

    def calibrate(self, keep: float = 0.7) -> dict[str, DataFrame]:
        """Percentiles of the scores, suggested thresholds and the joint keep rate under the present ones."""
        rows, q = flat(self.manifest()), self.settings.quality
        four = {"dnsmos_ovrl": ("min", q.min_ovrl), "dnsmos_sig": ("min", q.min_sig), "dnsmos_bak": ("min", q.min_bak), "bandwidth_hz": ("min", q.min_bandwidth_hz)}
        return {
            "percentiles": analytics.percentiles(rows, list(analytics.SIDES)), "thresholds": analytics.suggested_thresholds(rows, analytics.SIDES, keep),
            "joint": analytics.joint_keep_rate(rows, four),
        }

    def stats(self) -> DataFrame:
        """The summary of the manifest, with one row for each uid, the furthest stage's, whatever has been appended since it was compacted."""
        rows = self.manifest().select("uid", "source", "stage", "status", "duration")
        return analytics.summary(last_write_wins(rows.withColumn("_at", stage_ordinal(F.col("stage"))), "uid", "_at"))

    def training_set(self) -> DataFrame:
        """Kept records that pass the training filters, in a repeatable order, with part 'val' or 'train'."""
        return self.prepare()[0]

    def prepare(self, folder: str | None = None) -> tuple[DataFrame, DataFrame]:
        """The training set and its summary; with a folder its index and summary are written there. No candidate at all is an error."""
        t = self.settings.training
        asked = gates.drop_reason(flat(self.manifest()).where("status = 'keep'"), self.settings.candidates)
        parts = checkpointed(prepare.split(asked.where("drop_reason is null"), t.seed, t.val_fraction, t.max_files))
        if parts.isEmpty():
            raise RuntimeError("no clip passes the training filters")
        summary = prepare.dataset_summary(parts, asked)
        if folder:
            prepare.write_index(parts, f"{folder.rstrip('/')}/index")
            summary.write.mode("overwrite").json(f"{folder.rstrip('/')}/summary")
        return parts, summary
