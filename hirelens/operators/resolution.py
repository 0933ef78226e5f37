"""Values from ranked sources, with a log of conflicts.

A field group (salary: minimum, maximum, currency, period) takes all its
fields from one source: the first in rank order that has any of its telling
fields. Sources further down that disagree with it are kept as conflict rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class FieldGroup:
    """``fields``: name -> SQL type. ``sources``: (name, field -> value) in
    rank order; a field that a source doesn't give is null. ``telling``: the
    fields that make a source count (all, if none are named)."""

    name: str
    fields: dict[str, str]
    sources: Sequence[tuple[str, dict[str, Column]]]
    telling: Sequence[str] = ()


def _blank_as_null(value: Column, kind: str) -> Column:
    if kind == "string":
        value = F.trim(value.cast(kind))
        return F.when(value != "", value)
    value = value.cast(kind)
    return F.when(F.size(value) > 0, value) if kind.startswith("array") else value


def _candidates(group: FieldGroup) -> Column:
    """The sources that have something, in rank order."""
    told = []
    for rank, (source, values) in enumerate(group.sources, 1):
        fields = [_blank_as_null(values.get(f, F.lit(None)), kind).alias(f) for f, kind in group.fields.items()]
        told.append(F.struct(F.lit(rank).alias("rank"), F.lit(source).alias("source"), F.struct(*fields).alias("v")))
    telling = group.telling or list(group.fields)
    return F.filter(F.array(*told), lambda c: F.coalesce(*[c["v"][f].cast("string") for f in telling]).isNotNull())


def _text(value: Column, group: FieldGroup) -> Column:
    """The value as it stands in the log."""
    if len(group.fields) > 1:
        return F.to_json(value)
    (field, kind), = group.fields.items()
    return F.array_join(value[field], ", ") if kind.startswith("array") else value[field].cast("string")


def _differs(a: Column, b: Column, group: FieldGroup) -> Column:
    """Some field that both have differs (text: but for case)."""
    found = F.lit(False)
    for field, kind in group.fields.items():
        x, y = a[field], b[field]
        if kind == "string":
            x, y = F.lower(x), F.lower(y)
        elif kind.startswith("array"):
            x, y = F.array_sort(F.transform(x, F.lower)), F.array_sort(F.transform(y, F.lower))
        found = found | F.coalesce(x != y, F.lit(False))
    return found


def _disagreeing(found: Column, used: Column, group: FieldGroup) -> Column:
    others = F.filter(found, lambda c: (c["rank"] > used["rank"]) & _differs(c["v"], used["v"], group))
    return F.transform(others, lambda c: F.struct(
        F.lit(group.name).alias("field_group"), c["rank"].alias("rank"), c["source"].alias("source"),
        _text(c["v"], group).alias("value"), used["source"].alias("used_source"),
        _text(used["v"], group).alias("used_value")))


def resolve(df: DataFrame, groups: Sequence[FieldGroup], out: str = "resolved", log: str = "conflicts") -> DataFrame:
    """``df`` with a struct ``out`` (per group its fields and ``source``, null
    where no source has any) and an array ``log`` of ``(field_group, rank,
    source, value, used_source, used_value)``, one entry for every source that
    disagrees with the one used.

    The candidates go through a generator, so each source is read once a row."""
    packed = F.struct(*[_candidates(g).alias(g.name) for g in groups])
    rows = df.select("*", F.explode_outer(F.array(packed)).alias("_candidates"))
    values, logs = [], []
    for group in groups:
        found = F.col("_candidates")[group.name]
        used = F.get(found, 0)
        values.append(F.struct(*[used["v"][f].alias(f) for f in group.fields], used["source"].alias("source"))
                      .alias(group.name))
        logs.append(_disagreeing(found, used, group))
    return rows.select(*df.columns, F.struct(*values).alias(out), F.concat(*logs).alias(log))


def has_conflict(group: str, log: str = "conflicts") -> Column:
    return F.exists(log, lambda c: c["field_group"] == group)


def conflict_log(df: DataFrame, *keys: str, log: str = "conflicts") -> DataFrame:
    """One row per disagreeing source."""
    return df.select(*keys, F.inline(log))
