"""Rows of Spark and DuckDB as sorted text."""


def rows_of(df) -> list[tuple]:
    """Sorted rows as text, columns by name."""
    return sorted(tuple("" if v is None else repr(v + 0.0) if isinstance(v, float) else str(v) for v in r) for r in df.select(*sorted(df.columns)).collect())


def rows_of_sql(duck, sql: str) -> list[tuple]:
    names = [d[0] for d in duck.execute(sql).description]
    order = sorted(range(len(names)), key=lambda k: names[k])
    rows = duck.execute(sql).fetchall()
    return sorted(tuple("" if r[k] is None else repr(r[k] + 0.0) if isinstance(r[k], float) else str(r[k]) for k in order) for r in rows), sorted(names)
