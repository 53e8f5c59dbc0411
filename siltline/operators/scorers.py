"""Scorers as plug-ins: a model over each clip, or a program over a folder of clips."""

from __future__ import annotations

import csv
import pathlib
import re
import subprocess
import tempfile
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltline.functions import audio, scores

#: Samples at the scorer's rate in, a score for each of its columns out.
Model = Callable[[np.ndarray], dict[str, float]]
# Fixed value: seconds below which a clip is too short to be scored.
SHORT = 0.5


def model_scorer(load: Callable[[], Model], columns: Sequence[str], rate: int = 16_000, least: float = SHORT, decode=audio.decode_wav) -> Callable[[DataFrame], DataFrame]:
    """A scorer (uid, content to uid and columns) that loads a model once in each task.

    Clips of under least seconds have NaN for every column; so has one that can't be read or scored.
    """
    schema = "uid string, " + ", ".join(f"{c} double" for c in columns)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None
        for batch in batches:
            out: dict[str, list[float]] = {c: [] for c in columns}
            for data in batch.column(1).to_pylist():
                found: dict[str, float] = {}
                try:
                    x, own = decode(data)
                    x = audio.resampled(x, own, rate)
                    if len(x) >= least * rate:
                        model = model or load()
                        found = model(x)
                except Exception:  # noqa: BLE001  what can't be scored is not measured
                    found = {}
                for c in columns:
                    out[c].append(float(found.get(c, np.nan)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(v, pa.float64()) for v in out.values())], ["uid", *out])

    return lambda clips: clips.select("uid", "content").mapInArrow(rows, schema)


#: Windows as rows (float32) in, raw sig, bak and ovrl of each as rows out.
WindowModel = Callable[[np.ndarray], np.ndarray]


def window_scorer(load: Callable[[], WindowModel], rate: int = scores.RATE, window: float = scores.WINDOW, hop: int = scores.HOP, at_once: int = 32, least: float = SHORT, personalised: bool = False, decode=audio.decode_wav) -> Callable[[DataFrame], DataFrame]:
    """A scorer (uid, content to uid, dnsmos_sig, dnsmos_bak, dnsmos_ovrl and n_windows) by a model of overlapping windows.

    The windows of a batch's clips, one clip after another, are given to the model at_once at a time, however many a
    clip has: a short clip does not leave the model half empty, and a long one is never held as windows. The
    mean raw outputs of a clip's windows go through the polynomials as column expressions; scores that are
    not plausible are null. Clips of under least seconds, that can't be read, hold samples that are no numbers, or
    on which the model fails, have null scores and no windows; the others of their batch go on.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None
        for batch in batches:
            sums, counts = np.zeros((len(batch), 3)), np.zeros(len(batch), np.int64)
            bad, held, owners = np.zeros(len(batch), bool), [], []

            def run(held=held, owners=owners, sums=sums, counts=counts, bad=bad) -> None:
                nonlocal model
                model = model or load()
                groups = [(np.stack(held), np.array(owners))]
                held.clear()
                owners.clear()
                while groups:
                    x, own = groups.pop()
                    try:
                        found = np.asarray(model(x), np.float64).reshape(len(x), 3)
                    except Exception:  # noqa: BLE001  find the clip that the model fails on
                        some = np.unique(own)
                        if len(some) == 1:
                            bad[some] = True
                        else:
                            groups += [(x[own == k], own[own == k]) for k in some.tolist()]
                        continue
                    np.add.at(sums, own, found)
                    np.add.at(counts, own, 1)

            for k, data in enumerate(batch.column(1).to_pylist()):
                try:
                    x, own = decode(data)
                    x = audio.resampled(x, own, rate)
                except Exception:  # noqa: BLE001  what can't be read is not scored
                    continue
                for w in scores.windows(x, rate, window, hop) if len(x) >= least * rate else ():
                    held.append(w)
                    owners.append(k)
                    if len(held) == at_once:
                        run()
            if held:
                run()
            counts[bad] = 0
            with np.errstate(invalid="ignore"):
                means = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], np.nan)
            columns = [batch.column(0), *(pa.array(means[:, k], from_pandas=True) for k in range(3)), pa.array(counts)]
            yield pa.RecordBatch.from_arrays(columns, ["uid", "sig", "bak", "ovrl", "n_windows"])

    def score(clips: DataFrame) -> DataFrame:
        kind = clips.schema["uid"].dataType.simpleString()
        raw = clips.select("uid", "content").mapInArrow(rows, f"uid {kind}, sig double, bak double, ovrl double, n_windows long")
        found = scores.opinion_scores({c: F.col(c) for c in ("sig", "bak", "ovrl")}, personalised)
        return raw.select("uid", *(v.alias(c) for c, v in found.items()), "n_windows")

    return score


def folder_scorer(command: Callable[[str, str], list[str]], columns: dict[str, str], floor: float = 300.0, each: float = 2.0, at_once: int = 256) -> Callable[[DataFrame], DataFrame]:
    """A scorer by a program that scores the WAV files of a folder into CSV files of another.

    command(folder in, folder out) is run for up to at_once clips of a task, in a folder of that
    task; it is ended after floor seconds, or each seconds for each clip. columns maps the CSV's
    columns to scores; 'deg' or 'filename' names the file. A program that fails or takes too long
    gives no rows for its clips, and the others go on.
    """
    schema = "uid string, " + ", ".join(f"{c} double" for c in columns.values())

    def score(uids: list[str], contents: list[bytes]) -> dict[str, list]:
        out: dict[str, list] = {"uid": [], **{c: [] for c in columns.values()}}
        with tempfile.TemporaryDirectory() as top:
            given, made = pathlib.Path(top, "in"), pathlib.Path(top, "out")
            given.mkdir()
            made.mkdir()
            for k, data in enumerate(contents):
                (given / f"{k}.wav").write_bytes(data)
            try:
                subprocess.run(command(str(given), str(made)), check=True, capture_output=True, timeout=max(floor, each * len(uids)))
            except (OSError, subprocess.SubprocessError):
                return out
            files = sorted(made.glob("*.csv"))
            with files[0].open(newline="") if files else open("/dev/null") as f:
                for row in csv.DictReader(f):
                    name = pathlib.Path(row.get("deg") or row.get("filename") or "").stem
                    if re.fullmatch("[0-9]+", name) and int(name) < len(uids):
                        out["uid"].append(uids[int(name)])
                        for c, to in columns.items():
                            try:
                                out[to].append(float(row[c]))
                            except (KeyError, TypeError, ValueError):
                                out[to].append(None)
        return out

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([("uid", pa.string()), *((c, pa.float64()) for c in columns.values())])
        for batch in batches:
            for k in range(0, len(batch), at_once):
                part = batch.slice(k, at_once)
                yield pa.RecordBatch.from_pydict(score(part.column(0).to_pylist(), part.column(1).to_pylist()), kinds)

    return lambda clips: clips.select("uid", "content").mapInArrow(rows, schema)
