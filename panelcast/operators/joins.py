"""Month-keyed merge chains that build the wide master panel.

Each feature table is joined on ``date`` plus whichever panel keys it carries.
Inputs are monthly aggregates (one row per key-month), so both sides of every
join are at monthly grain; AQE turns a join into a broadcast at run time only
when the measured side is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``
and keeps the shuffle join otherwise. Duplicate dates on a feature side multiply
rows exactly as a left merge does; nothing is de-duplicated silently.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _join_keys(feature: DataFrame, keys: list[str], date: str) -> list[str]:
    return [date] + [k for k in keys if k in feature.columns]


def _clean(feature: DataFrame, date: str) -> DataFrame:
    # A NULL month would match another NULL month in pandas; here such rows
    # are rejected up front so the join never depends on NULL semantics.
    return feature.filter(F.col(date).isNotNull())


def merge_chain(anchor: DataFrame, features: list[DataFrame], how: str,
                keys: list[str] | None = None, date: str = "date") -> DataFrame:
    keys = list(keys or [])
    out = _clean(anchor, date)
    for f in features:
        overlap = [c for c in f.columns if c in out.columns and c not in _join_keys(f, keys, date)]
        if overlap:
            raise ValueError(f"feature columns collide with the panel: {overlap}")
        out = out.join(_clean(f, date), _join_keys(f, keys, date), how)
    return out


def left_merge_chain(anchor: DataFrame, features: list[DataFrame],
                     keys: list[str] | None = None, date: str = "date") -> DataFrame:
    """Anchor rows are all kept; features arrive in the given order."""
    return merge_chain(anchor, features, "left", keys, date)


def inner_merge_chain(anchor: DataFrame, features: list[DataFrame],
                      keys: list[str] | None = None, date: str = "date") -> DataFrame:
    """Only months present in every input survive."""
    return merge_chain(anchor, features, "inner", keys, date)


def require_tables(spark: SparkSession, names: list[str]) -> None:
    """Fail with the full list of missing inputs before any join runs."""
    missing = [n for n in names if not spark.catalog.tableExists(n)]
    if missing:
        raise FileNotFoundError(f"input tables missing, build them first: {missing}")


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Concatenate, keeping duplicates (columns matched by name)."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def union_tagged(frames: dict[str, DataFrame], tag_col: str = "split") -> DataFrame:
    return union_all([df.withColumn(tag_col, F.lit(tag)) for tag, df in frames.items()])
