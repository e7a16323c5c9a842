"""Whether two tables hold the same rows, as multisets, and what tells them apart.

Rows of both sides are hashed in one canonical form and counted by side in one aggregation: one shuffle of hashes and
counts, with a partial step before it, whatever the tables' widths and however often a row repeats.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.checks import require
from ..sources.snapshots import canonical


def column_differences(left: DataFrame, right: DataFrame) -> list[tuple[str, str]]:
    """(kind, column): ONLY_LEFT and ONLY_RIGHT columns, RETYPED ones, and those of both sides that MOVED among them."""
    a, b = dict(left.dtypes), dict(right.dtypes)
    both_a, both_b = [c for c in a if c in b], [c for c in b if c in a]
    found = [("ONLY_LEFT", c) for c in a if c not in b] + [("ONLY_RIGHT", c) for c in b if c not in a]
    found += [("RETYPED", c) for c in both_a if a[c] != b[c]]
    return sorted(found + [("MOVED", c) for c, d in zip(both_a, both_b) if c != d])


def differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose counts differ: content (JSON of the columns of both sides by name), n_left, n_right and the side that has
    more of it, ONLY_LEFT or ONLY_RIGHT where the other has none. Values compare as text; numbers that are not finite
    are null, and -0.0 is 0.0. No rows: both hold the same multiset."""
    shared = sorted(set(left.columns) & set(right.columns))

    def side(df: DataFrame, here: bool) -> DataFrame:
        rows = df.select(*[f"`{c}`" for c in shared])
        as_text = F.to_json(F.struct(*[x.cast("string").alias(c) for c, x in zip(shared, canonical(rows))]), {"ignoreNullFields": "false"}) if shared else F.lit("{}")
        return rows.select(as_text.alias("content"), F.lit(1 if here else 0).alias("l"), F.lit(0 if here else 1).alias("r"))

    both = side(left, True).unionAll(side(right, False))
    counted = both.groupBy(F.sha2("content", 256).alias("h")).agg(F.min("content").alias("content"), F.sum("l").alias("n_left"), F.sum("r").alias("n_right"))
    kind = F.when(F.col("n_right") == 0, "ONLY_LEFT").when(F.col("n_left") == 0, "ONLY_RIGHT").when(F.col("n_left") > F.col("n_right"), "MORE_LEFT").otherwise("MORE_RIGHT")
    return counted.where("n_left <> n_right").select("content", "n_left", "n_right", kind.alias("difference"))


def assert_same(left: DataFrame, right: DataFrame, what: str) -> DataFrame:
    """left, one row less nothing: a table of one row (n_different = 0) that fails when run if rows differ; a difference of
    columns fails at once."""
    if found := column_differences(left, right):
        raise ValueError(f"{what}: columns differ: {found}")
    counted = differences(left, right).agg(F.count("*").alias("n_different"))
    return require(counted, F.col("n_different") == 0, F.concat(F.lit(f"{what}: rows that differ: "), F.col("n_different").cast("string")))
