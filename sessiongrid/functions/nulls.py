"""Missing values: NULL is the only one, and divisions and casts never throw."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def security():
    """Rows of a security in order of session."""
    return Window.partitionBy("security_id").orderBy("session_index")


def number(x: Column) -> Column:
    """x as a finite double, else null; text that is no number is null."""
    x = x.try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def positive(x: Column) -> Column:
    """x if it is positive and finite, else null."""
    x = x.try_cast("double")
    return F.when((x > 0) & (x < float("inf")) & ~F.isnan(x), x)


def ratio(a: Column, b: Column) -> Column:
    """a / b where b is above zero, else null."""
    return F.when(b > 0, a / b)


def finite(x: Column) -> Column:
    """x unless it is infinite or not a number."""
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def is_true(x: Column) -> Column:
    """Two-valued: a comparison with null is false."""
    return F.coalesce(x, F.lit(False))


def close_symmetric(a: Column, b: Column, rel: float, absolute: float) -> Column:
    """|a - b| <= max(rel max(|a|, |b|), absolute)."""
    return F.abs(a - b) <= F.greatest(rel * F.greatest(F.abs(a), F.abs(b)), F.lit(absolute))


def filled(x: Column, key: str = "security_id", order: str = "session_index") -> Column:
    """x, else the last value before, else the first behind; for constants of an entity."""
    w = Window.partitionBy(key).orderBy(order)
    back = F.last(x, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return F.coalesce(back, F.first(x, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing)))


def in_parts(x: Column) -> Column:
    """x, by way of a higher-order function over it alone.

    Spark compiles a projection that holds one as many small methods; else as one, which the JVM does not compile but
    interprets for each row if it is larger than 8,000 bytes. For one cheap column of a wide projection: what the
    function reads is itself interpreted.
    """
    return F.transform(F.array(x), lambda y: y)[0]
