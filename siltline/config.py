"""Settings: plain dataclasses, overlaid by YAML that may hold known keys only, then by arguments."""

from __future__ import annotations

import dataclasses
import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any

from siltline.functions.expr import parse_source
from siltline.operators.gates import Candidates, Prefilter, Quality, Speech
from siltline.schema import KEEP, LOW_QUALITY, PENDING, REJECTED


# Defaults of the stages.
@dataclass(frozen=True)
class Packing:
    target_seconds: float = 300.0
    guard_seconds: float = 0.5
    peak: float = 0.7
    sample_rate: int = 44_100
    singly: bool = False


@dataclass(frozen=True)
class Training:
    seed: int = 1234
    val_fraction: float = 0.01
    max_files: int = 0


@dataclass(frozen=True)
class Materialize:
    enabled: bool = True
    clean: str = "clean"
    low_quality: str = "low_quality"
    rejected: str = "rejected"
    keep_rejected: bool = False
    sample_rate: int = 22_050
    format: str = "wav"
    mono: bool = True
    mode: str = "copy"

    def buckets(self) -> dict[str, str]:
        """The bucket of each status that is placed; what is pending has come through all stages that ran."""
        placed = {KEEP: self.clean, PENDING: self.clean, LOW_QUALITY: self.low_quality}
        return placed | ({REJECTED: self.rejected} if self.keep_rejected else {})


# Names and defaults of a source's settings, but for path.
@dataclass(frozen=True)
class Source:
    """A dataset to ingest: where it is (a path, or its repo_id under a root), how it is laid out and how much of it is wanted (0: all)."""

    path: str = ""
    repo_id: str = ""
    name: str = ""
    revision: str = "main"
    enabled: bool = True
    layout: str = ""
    shards: tuple[int, ...] = ()
    metadata_file: str = ""
    metadata_delimiter: str = "\t"
    metadata_key: str = "file_name"
    metadata_text: str = "sentence"
    limit: int = 0
    limit_per_shard: int = 0

    @property
    def slug(self) -> str:
        return re.sub(r"[^\w.\-]", "_", self.name or (self.repo_id or self.path).rstrip("/").rsplit("/", 1)[-1])

    def folder(self, root: str = "") -> str:
        return self.path or "/".join(filter(None, (root.rstrip("/"), self.repo_id)))


def source_of(entry: str | Mapping[str, Any]) -> Source:
    """A source from 'owner/name[@revision][#slug]' or from its settings; an unknown key raises KeyError."""
    if isinstance(entry, str):
        spec = parse_source(entry)
        return Source(repo_id=spec["repo"], revision=spec["revision"], name=spec["slug"])
    return overlaid(Source(), entry)


def active_sources(sources: Iterable[Source], only: Iterable[str] = ()) -> list[Source]:
    """Enabled sources, of those that only names by slug or repository; KeyError if it names none."""
    active, wanted = [s for s in sources if s.enabled], set(only)
    chosen = [s for s in active if not wanted or s.slug in wanted or s.repo_id in wanted]
    if wanted and not chosen:
        raise KeyError(f"no source is named {sorted(wanted)}")
    return chosen


@dataclass(frozen=True)
class Settings:
    prefilter: Prefilter = field(default_factory=Prefilter)
    separate: Packing = field(default_factory=Packing)
    vad: Speech = field(default_factory=Speech)
    quality: Quality = field(default_factory=Quality)
    candidates: Candidates = field(default_factory=Candidates)
    training: Training = field(default_factory=Training)
    materialize: Materialize = field(default_factory=Materialize)
    sources: tuple[Source, ...] = ()
    stages: tuple[str, ...] = ("prefilter", "separate", "vad", "quality", "materialize")
    shards_per_folder: int = 1  # of tables by source and shard: more where shards hold few records


def overlaid(settings: Any, values: Mapping[str, Any]) -> Any:
    """settings with values in place of what they name, sections within sections; an unknown key raises KeyError."""
    known = {f.name for f in dataclasses.fields(settings)}
    changed = {}
    for key, value in values.items():
        if key not in known:
            raise KeyError(f"unknown setting {key!r} of {type(settings).__name__}")
        now = getattr(settings, key)
        if key == "sources":
            changed[key] = tuple(v if isinstance(v, Source) else source_of(v) for v in value or ())
            continue
        changed[key] = overlaid(now, value or {}) if dataclasses.is_dataclass(now) else tuple(value) if isinstance(now, tuple) else value
    return dataclasses.replace(settings, **changed)


def load(text: str, **arguments: Any) -> Settings:
    """Defaults, then the YAML text, then arguments such as quality={'min_ovrl': 3.0}."""
    import yaml

    return overlaid(overlaid(Settings(), yaml.safe_load(text) or {}), arguments)


def dump(settings: Settings) -> str:
    """The settings as YAML that load() reads."""
    import yaml

    plain = lambda v: {k: plain(x) for k, x in v.items()} if isinstance(v, dict) else [plain(x) for x in v] if isinstance(v, tuple) else v
    return yaml.safe_dump(plain(dataclasses.asdict(settings)), sort_keys=False, allow_unicode=True)
