"""Checks that fail closed: forbidden columns at analysis time, data expectations in one aggregated job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Column names and fragments that would leak the future into features (fixed values).
FORBIDDEN = {"label", "label_status", "target_hit", "target_price", "exit_price", "gross_return", "entry_date", "entry_price", "entry_eligible"}
FRAGMENTS = ("future", "forward", "target", "exit_", "t_plus", "label")


class ExpectationError(ValueError):
    pass


def guard(df: DataFrame, forbidden: set[str] = FORBIDDEN, fragments: tuple[str, ...] = FRAGMENTS, required: list[str] | None = None) -> DataFrame:
    """df if its schema is clean; no job runs."""
    bad = [c for c in df.columns if c.lower() in forbidden or any(f in c.lower() for f in fragments)]
    missing = [c for c in required or [] if c not in df.columns]
    if bad or missing:
        raise ExpectationError(f"forbidden columns {sorted(bad)}, missing columns {sorted(missing)}")
    return df


def expect(df: DataFrame, checks: dict[str, Column], unique: list[str] | None = None) -> DataFrame:
    """df if no row violates a check (name -> condition that must hold) and keys are unique; at most two jobs."""
    counts = df.agg(*[F.count_if(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in checks.items()]).first().asDict() if checks else {}
    if unique and df.groupBy(*unique).count().where("count > 1").limit(1).collect():
        counts[f"UNIQUE({','.join(unique)})"] = 1
    if bad := {k: v for k, v in counts.items() if v}:
        raise ExpectationError(f"violations: {bad}")
    return df


def contiguous(calendar: DataFrame) -> bool:
    """Whether session_index runs from 0 without gaps and grows with the date."""
    m = calendar.agg(F.count("*").alias("n"), F.countDistinct("session_index").alias("d"), F.min("session_index").alias("a"), F.max("session_index").alias("b")).first()
    return m["n"] == 0 or (m["d"] == m["n"] and m["a"] == 0 and m["b"] == m["n"] - 1)
