"""Ranges of dates: chunks, coverage, gaps and status roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: What failures of a symbol say (fixed value).
SYMBOL_MESSAGE = "(?i)(not found|delisted|redirect|symbol)"


def range_chunks(requests: DataFrame, months: int) -> DataFrame:
    """Each inclusive range (start, end) cut into chunks of n months; the next chunk begins the day after the last."""
    starts = F.sequence(F.col("start"), F.col("end"), F.make_ym_interval(F.lit(0), F.lit(months)))
    rows = requests.select("*", F.posexplode(starts).alias("chunk", "chunk_start"))
    following = F.add_months(F.col("start"), (F.col("chunk") + 1) * months)
    return rows.withColumn("chunk_end", F.least(F.date_sub(following, 1), F.col("end")))


def merged(ranges: DataFrame, key: str) -> DataFrame:
    """Covered ranges (start, end) of each key as disjoint ones; ranges that touch are joined."""
    order = Window.partitionBy(key).orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = ranges.withColumn("new", F.coalesce((F.col("start") > F.date_add(reach, 1)).cast("int"), F.lit(1)))
    rows = rows.withColumn("island", F.sum("new").over(order))
    return rows.groupBy(key, "island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("island")


def gaps(requests: DataFrame, covered: DataFrame, key: str) -> DataFrame:
    """What of each request (start, end) no covered range meets: before each covered range, and behind the last.

    Ranges outside the bounds of all requests cover no day of one and are dropped before they are shuffled. Requests meet
    the merged ranges in one join by key, whose order serves the sweep over a request's ranges.
    """
    bounds = requests.agg(F.min("start").alias("__low"), F.max("end").alias("__high"))
    near = covered.select(key, "start", "end").join(F.broadcast(bounds), (F.col("end") >= F.col("__low")) & (F.col("start") <= F.col("__high")), "left_semi")  # one row
    have = merged(near, key).select(F.col(key).alias("__key"), F.col("start").alias("c_start"), F.col("end").alias("c_end"))
    met = (F.col(key) == F.col("__key")) & (F.col("c_start") <= F.col("end")) & (F.col("c_end") >= F.col("start"))
    order = Window.partitionBy(key, "start", "end").orderBy("c_start")
    rows = requests.select(key, "start", "end").join(have, met, "left").withColumns({"cursor": F.coalesce(F.date_add(F.lag("c_end").over(order), 1), F.col("start")), "next": F.lead("c_start").over(order)})
    before = F.struct(F.col("cursor").alias("gap_start"), F.date_sub("c_start", 1).alias("gap_end"))
    behind = F.struct(F.coalesce(F.date_add("c_end", 1), F.col("start")).alias("gap_start"), F.col("end").alias("gap_end"))
    found = F.array_compact(F.array(F.when(F.col("c_start").isNotNull(), before), F.when(F.col("next").isNull(), behind)))
    return rows.select(key, F.inline(found)).where("gap_start <= gap_end")


#: What a stored range says that was fetched and held nothing (fixed value).
NO_DATA = "NO_DATA_IN_RANGE"


def unblocked(entries: DataFrame, key: str) -> DataFrame:
    """The readable ranges of the store that may be used.

    entries: key, start, end (inclusive), is_current (the store's current version), readable, result. A range of the
    current version that cannot be read blocks every range that it overlaps, of an older version too, for what they
    say may be out of date; an older one that cannot be read is passed over. One sweep over the points where
    blocking ranges begin and others end: a range is blocked if one that began by its end reaches its start.
    """
    blocking = ~F.col("readable") & F.col("is_current")
    marked = entries.where("readable or is_current").withColumn("__at", F.when(blocking, F.col("start")).otherwise(F.col("end")))
    so_far = Window.partitionBy(key).orderBy("__at").rangeBetween(Window.unboundedPreceding, 0)
    reach = F.max(F.when(blocking, F.col("end"))).over(so_far)
    swept = marked.withColumn("__reach", reach)
    return swept.where("readable and (__reach is null or __reach < start)").drop("__at", "__reach")


def versioned_coverage(requests: DataFrame, entries: DataFrame, key: str) -> DataFrame:
    """Per request (key, start, end) the stored ranges that serve it and the gaps that are left, in order.

    Columns: key, start, end, kind (HIT, EMPTY_HIT for a range that held nothing, GAP), from_date, to_date, is_current. The
    cursor passes over the ranges by (start, end, current before older): a range serves if it reaches the cursor, and
    what lies between the cursor and its start is a gap; the last gap is found before a mark behind the request.
    """
    usable = unblocked(entries, key).select(key, F.col("start").alias("s"), F.col("end").alias("e"), (~F.col("is_current")).cast("int").alias("older"), "result")
    asked = requests.select(key, "start", "end").distinct()
    met = asked.join(usable, key).where("s <= end and e >= start")
    behind = asked.select("*", F.date_add("end", 1).alias("s"), F.date_add("end", 1).alias("e"), F.lit(2).alias("older"), F.lit(None).cast("string").alias("result"))
    order = Window.partitionBy(key, "start", "end").orderBy("s", "e", "older", "result").rowsBetween(Window.unboundedPreceding, -1)
    clipped = met.unionByName(behind).withColumns({"low": F.greatest("start", "s"), "high": F.when(F.col("older") < 2, F.least("end", "e"))})
    swept = clipped.withColumn("cursor", F.coalesce(F.date_add(F.max("high").over(order), 1), F.col("start")))
    hit = F.struct(F.when(F.col("result") == NO_DATA, "EMPTY_HIT").otherwise("HIT").alias("kind"), F.col("low").alias("from_date"), F.col("high").alias("to_date"), (F.col("older") == 0).alias("is_current"))
    gap = F.struct(F.lit("GAP").alias("kind"), F.col("cursor").alias("from_date"), F.date_sub("low", 1).alias("to_date"), F.lit(None).cast("boolean").alias("is_current"))
    found = F.array_compact(F.array(F.when(F.col("low") > F.col("cursor"), gap), F.when((F.col("high") >= F.col("cursor")) & (F.col("cursor") <= F.col("end")), hit)))
    return swept.select(key, "start", "end", F.inline(found))


def collection_status(results: DataFrame) -> DataFrame:
    """Per security: worst status of its sources, rows, ranges and notes.

    results: security_id, source, status (COMPLETE, PARTIAL, FAILED, NO_HISTORY), n_rows, first_date, last_date.
    """
    all_of = lambda s: F.bool_and(F.col("status") == s)
    any_of = lambda s: F.bool_or(F.col("status") == s)
    status = F.when(all_of("COMPLETE"), "COMPLETE").when(all_of("NO_HISTORY"), "NO_HISTORY").when(any_of("FAILED"), "FAILED").otherwise("PARTIAL")
    return results.groupBy("security_id").agg(
        status.alias("status"), F.sum("n_rows").alias("n_rows"), F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"),
        F.max_by("source", F.struct("n_rows", "source")).alias("main_source"), F.concat_ws("|", F.array_sort(F.collect_set("source"))).alias("sources"),
    )


def collection_summary(status: DataFrame) -> DataFrame:
    """Rates over what was attempted (at least 1)."""
    n = F.greatest(F.count_if(F.col("status").isNotNull()), F.lit(1))
    kinds = ["COMPLETE", "PARTIAL", "FAILED", "NO_HISTORY"]
    return status.agg(F.count_if(F.col("status").isNotNull()).alias("attempted"), *[F.count_if(F.col("status") == k).alias(k.lower()) for k in kinds], (F.count_if(F.col("status") == "COMPLETE") / n).alias("complete_rate"))


def review_issues(observed: DataFrame, calendar: DataFrame, collected: DataFrame, first: str = "A", second: str = "B") -> DataFrame:
    """What asks for a look at a ticker mapping: one row for each security and issue, with the sessions of its gaps.

    observed: security_id, date, source (two sources); calendar: session_date; collected: security_id and failure_reason of
    each attempt. A series that begins late, ends early or has a gap of any length is an issue; a gap is looked for in the
    second source, or in both where that has nothing. One row of a security and session at most is shuffled.
    """
    sessions = calendar.select(F.col("session_date").alias("date")).distinct()
    ranked = sessions.withColumn("k", F.row_number().over(Window.orderBy("date")))  # a calendar is small
    ends = sessions.agg(F.min("date").alias("cal_first"), F.max("date").alias("cal_last"))
    days = observed.groupBy("security_id", "date").agg(F.bool_or(F.col("source") == first).alias("a"), F.bool_or(F.col("source") == second).alias("b"))
    per = days.groupBy("security_id").agg(F.min("date").alias("first_observed"), F.max("date").alias("last_observed"), F.count_if("a").alias("n_a"), F.count_if("b").alias("n_b"), F.count_if(F.col("a") & F.col("b")).alias("n_both"))
    base = days.join(per.select("security_id", "n_b"), "security_id").where("b or n_b = 0").join(ranked, "date")
    before = F.lag("k").over(Window.partitionBy("security_id").orderBy("k"))
    gap = base.select("security_id", (F.col("k") - before - 1).alias("missing")).groupBy("security_id").agg(F.coalesce(F.sum("missing"), F.lit(0)).alias("gap_sessions"), F.coalesce(F.max("missing"), F.lit(0)).alias("longest_gap"))
    messages = collected.groupBy("security_id").agg(F.bool_or(F.coalesce("failure_reason", F.lit("")).rlike(SYMBOL_MESSAGE)).alias("symbol"))
    rows = messages.join(per, "security_id", "full").join(gap, "security_id", "left").crossJoin(F.broadcast(ends))  # one row
    rows = rows.fillna(0, subset=["n_a", "n_b", "n_both", "gap_sessions", "longest_gap"])
    late, early, inner = F.col("first_observed") > F.col("cal_first"), F.col("last_observed") < F.col("cal_last"), F.col("gap_sessions") > 0
    issues = F.array_compact(F.array(
        F.when(F.col("first_observed").isNull(), "NO_HISTORY_BOTH_PROVIDERS"),
        F.when(late, "LATE_SERIES_START"),
        F.when(early, "EARLY_SERIES_END"),
        F.when(inner, "INTERNAL_SESSION_GAP"),
        F.when((F.col("n_a") != F.col("n_both")) | (F.col("n_b") != F.col("n_both")), "PROVIDER_DATE_COVERAGE_MISMATCH"),
        F.when(F.col("symbol"), "PROVIDER_SYMBOL_OR_REDIRECT"),
        F.when(late | early | inner, "POSSIBLE_OLD_OR_NEW_TICKER_SIGNAL"),
    ))
    own = F.col("issue_type") == "INTERNAL_SESSION_GAP"
    out = rows.select("security_id", F.explode(issues).alias("issue_type"), "first_observed", "last_observed", "gap_sessions", "longest_gap")
    return out.withColumns({"gap_sessions": F.when(own, F.col("gap_sessions")).otherwise(0), "longest_gap": F.when(own, F.col("longest_gap")).otherwise(0)})
