"""How queries are registered: rows with dates as text, beside SQL that must give the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Registry:
    def __init__(self):
        self.queries: dict[str, Callable] = {}
        self.sql: dict[str, str] = {}

    def query(self, text: str | None = None, name: str | None = None, dates: tuple[str, ...] = ("prediction_date",)):
        """Register a function of (spark, sf_dir).

        dates: columns that both sides return as text: dates, and booleans that may be null.
        """

        def keep(f):
            def run(spark, sf_dir) -> DataFrame:
                df = f(spark, sf_dir)
                return df.withColumns({c: F.col(c).cast("string") for c, t in df.dtypes if t == "date" or c in dates})

            key = name or f.__name__
            self.queries[key] = run
            if text:
                text_dates = ", ".join(f"CAST({d} AS VARCHAR) AS {d}" for d in dates)
                self.sql[key] = f"SELECT * REPLACE ({text_dates}) FROM (\n{text}\n)" if dates else text
            return f

        return keep
