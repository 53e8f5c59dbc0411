"""Predicates that treat what wasn't measured as passing, gate chains, and naming rules."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def number(value: Column) -> Column:
    """A finite double, else null: text that is no number, NaN and infinities count as not measured."""
    v = value.try_cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) < float("inf")), v)


def below(value: Column, least: float) -> Column:
    """Whether a finite value is under least; false where it wasn't measured."""
    return F.coalesce(number(value) < least, F.lit(False))


def above(value: Column, most: float) -> Column:
    """Whether a value is over most: infinity is, NaN and null are not."""
    v = value.try_cast("double")
    return F.coalesce(~F.isnan(v) & (v > most), F.lit(False))


def first_hit(checks: Sequence[tuple[str, Column]]) -> Column:
    """The name of the first check that holds, else null."""
    out = None
    for name, check in checks:
        out = F.when(check, name) if out is None else out.when(check, name)
    return out if out is not None else F.lit(None).cast("string")


def all_hits(checks: Sequence[tuple[str, Column]]) -> Column:
    """The names of all checks that hold, in order."""
    if not checks:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*(F.when(check, name) for name, check in checks)))


def fixed4(value: Column) -> Column:
    """Four decimals; empty for null and non-finite values."""
    v = number(value)
    return F.when(v.isNotNull(), F.format_string("%.4f", v)).otherwise("")


def stem(path: Column) -> Column:
    """The last part of a path without its last extension; a leading dot starts no extension."""
    name = F.regexp_extract(path, r"([^/]*)/*$", 1)
    return F.regexp_replace(name, r"^(.+)\.[^.]*$", "$1")


def slug(name: Column, repo: Column) -> Column:
    """A name (else the last part of the repository) with all but letters, digits, '-', '_' and '.' as '_'."""
    text = F.coalesce(F.nullif(name, F.lit("")), F.element_at(F.split(repo, "/"), -1))
    return F.regexp_replace(text, r"[^\p{L}\p{N}_.\-]", "_")


def uid(source: Column, path: Column) -> Column:
    return F.concat(source, F.lit("__"), stem(path))


def unit_key(shard: Column) -> Column:
    """The name of a work unit: its shard by three digits, or 'single'."""
    return F.when(shard.isNull() | (shard < 0), F.lit("single")).otherwise(F.format_string("shard_%03d", shard))


def shard_number(path: Column) -> Column:
    """All digits of the stem as one number, else null."""
    return F.regexp_replace(stem(path), "[^0-9]", "").try_cast("int")


def text_or(inline: Column, sidecar: Column) -> Column:
    return F.coalesce(F.nullif(inline, F.lit("")), sidecar, F.lit(""))


def hours(seconds: Column) -> Column:
    return F.round(F.sum(seconds) / 3600, 2)


def shard_list(spec: Column) -> Column:
    """'1-4,7,9' as its sorted distinct numbers; blanks and bad parts are left out."""
    parts = F.filter(F.transform(F.split(F.coalesce(spec, F.lit("")), ","), lambda p: F.trim(p)), lambda p: p.rlike(r"^\d+\s*(-\s*\d+)?$"))

    def span(p: Column) -> Column:
        ends = F.split(p, r"\s*-\s*")
        lo, hi = ends[0].cast("int"), F.element_at(ends, -1).cast("int")
        return F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))

    return F.array_sort(F.array_distinct(F.flatten(F.transform(parts, span))))


def parse_shards(spec: str) -> list[int]:
    """As shard_list, for a setting; raises ValueError for a bad part."""
    out: set[int] = set()
    for part in filter(None, (p.strip() for p in spec.split(","))):
        lo, _, hi = part.partition("-")
        out.update(range(int(lo), int(hi or lo) + 1))
    return sorted(out)


def parse_source(spec: str) -> dict[str, str]:
    """'owner/name[@revision][#slug]' as its parts."""
    m = re.fullmatch(r"([^@#]+)(?:@([^#]+))?(?:#(.+))?", spec)
    if not m:
        raise ValueError(f"no source: {spec}")
    repo, revision, name = m.groups()
    return {"repo": repo, "revision": revision or "main", "slug": re.sub(r"[^\w.\-]", "_", name or repo.rsplit("/", 1)[-1])}


def vocal_stem(names: Column) -> Column:
    """Of an array of file names the first whose stem doesn't say 'instrument', else the first; null for none."""
    vocal = F.filter(names, lambda n: ~F.lower(stem(n)).contains("instrument"))
    return F.coalesce(F.get(vocal, F.lit(0)), F.get(names, F.lit(0)))


def bucket(status: Column, buckets: Mapping[str, str]) -> Column:
    """The folder of a status, null for a status that has none."""
    if not buckets:
        return F.lit(None).cast("string")
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in buckets.items() for x in kv]), status)
