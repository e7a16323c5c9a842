"""Provider rows, accents, tariffs, periods and ranks on hand-made cases."""

import datetime as dt
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from sessiongrid.functions.text import fold_accents
from sessiongrid.operators import identity, metrics, providers, ticks

DAY = dt.date(2024, 1, 2)


def test_the_last_row_of_a_day_stays_and_missing_columns_are_null(spark):
    base = {c: 1.0 for c in providers.EQUITY_REQUIRED} | {"HGDG_TARIH": DAY}
    rows = [base | {"ticker": " aaa.is ", "n": n, "HG_MAX": float(n), "extra": "x"} for n in (2, 3, 1)]
    raw = spark.createDataFrame(rows, f"ticker string, n int, extra string, {', '.join(f'{c} double' for c in providers.EQUITY_REQUIRED if c != 'HGDG_TARIH')}, HGDG_TARIH date")
    got = providers.equity_history(raw, ["n"]).collect()
    assert len(got) == 1 and got[0].asDict().keys() == set(providers.EQUITY_COLUMNS)
    assert (got[0]["ticker"], got[0]["is_raw_high"], got[0]["is_market_cap_try"]) == ("AAA", 3.0, None)
    with pytest.raises(ValueError, match="HG_MAX"):
        providers.equity_history(raw.drop("HG_MAX"), ["n"])
    assert providers.equity_history(raw.limit(0), ["n"]).count() == 0


def test_quotes_and_auxiliary(spark):
    raw = spark.createDataFrame([("a", DAY, 2.0, -3.0, 4, "5", 2.0), ("a", dt.date(2024, 1, 3), None, None, None, "x", 4.0)], "ticker string, date date, Close double, Fee double, Count int, Note string, `Stock Splits` double")
    first, second = providers.quotes(raw).orderBy("date").collect()
    assert (first["yf_other_action_value"], second["yf_other_action_value"]) == (7.0, 0.0)
    assert (first["yf_provider_open"], first["yf_dividends"], first["split_factor"], first["yf_nominal_close"], second["split_factor"]) == (None, 0.0, 4.0, 8.0, 1.0)
    found = providers.auxiliary(raw.withColumn("n", F.lit(1)), ["n"]).orderBy("date").collect()
    assert [r["yf_other_action_value"] for r in found] == [12.0, 0.0] and not any("lose" in c for c in found[0].asDict())
    with pytest.raises(ValueError, match="date"):
        providers.auxiliary(raw.drop("date"), ["ticker"])


def test_raw_rows_keep_their_values(spark):
    raw = spark.createDataFrame([(dt.datetime(2024, 1, 2, 23), 1.5, None)], "Date timestamp, Open double, `Adj Close` double")
    got = providers.prepare_raw(raw, " aaa ")
    assert got.columns == ["ticker", "date", "Open", "Adj Close"] and tuple(got.first()) == ("AAA", DAY, 1.5, None)
    with pytest.raises(ValueError, match="ticker"):
        providers.prepare_raw(raw, "  ")


def test_accents_fold_as_the_decomposition_says(spark):
    texts = ["İŞÇĞıüöåãõšžřŽé", "é ä", "ﬁnance ĳ ǆ", "ＡＢ１", "Ελλάς", "Привет ё", "日本"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(fold_accents(F.col("t"))).collect()]
    want = ["".join(c for c in unicodedata.normalize("NFKD", t.replace("ı", "i")) if not unicodedata.combining(c)) for t in texts]
    assert got == want


def test_tariff_metadata(spark):
    good = ("R", "EQ", dt.date(2020, 1, 1), None, "0.01", None, "office", "a" * 64)

    def issues(*rows):
        names = "rule_set_id string, instrument_type string, effective_from date, effective_to date, lo string, hi string, official_source_name string, source_checksum string"
        df = spark.createDataFrame(list(rows), names)
        return sorted(r["issue"] for r in ticks.tariff_violations(df.withColumns({"price_min": F.col("lo").cast(ticks.PRICE), "price_max": F.col("hi").cast(ticks.PRICE)})).collect())

    assert issues(good) == []
    low, high = (*good[:5], "20", *good[6:]), (*good[:4], "20", None, *good[6:])
    assert issues(low, (*high[:7], "A" * 64)) == []
    assert issues(low, (*high[:6], "other", "a" * 64)) == ["INCONSISTENT_METADATA"]
    assert issues(low, (*high[:6], None, "a" * 64)) == ["INCONSISTENT_METADATA", "METADATA_MISSING"]
    assert issues((*good[:7], "g" * 64)) == ["CHECKSUM_NOT_SHA256"]
    assert issues(low, ("R", "EQ", dt.date(2020, 1, 2), *high[3:])) == ["INCONSISTENT_DATES"]


def test_period_violations(spark):
    day = lambda k: DAY + dt.timedelta(k)
    rows = [("A", "x", day(0), day(5)), ("A", "y", day(6), day(9)), ("A", "z", day(9), day(12)), ("B", "x", day(-1), day(3)), ("B", "y", day(8), day(7))]
    got = {(r["security_id"], r["provider_ticker"], r["issue"]) for r in identity.period_violations(spark.createDataFrame(rows, "security_id string, provider_ticker string, period_start date, period_end date"), "2024-01-02", "2024-01-31").collect()}
    assert got == {("A", "z", "OVERLAP"), ("B", "x", "OUTSIDE_RANGE"), ("B", "y", "START_AFTER_END")}


@pytest.mark.parametrize("kind", ["small", "ties", "spread", "one", "none"])
def test_ranks_by_ranges(spark, kind):
    rng = random.Random(kind)
    draw = {"small": lambda: rng.random() / 1000, "ties": lambda: rng.choice([0.1, 0.1, 0.1, 0.2, 0.9]), "spread": rng.random, "one": lambda: 0.5, "none": None}[kind]
    rows = [(f"S{rng.randrange(9)}", DAY + dt.timedelta(k), draw(), rng.choice([0, 1, 1, None])) for k in range(700)] if draw else []
    scores = spark.createDataFrame(rows, "security_id string, prediction_date date, probability double, label int").repartition(3)
    used = sorted((p, s, d, y) for s, d, p, y in rows if y is not None)
    n, got = len(used), {r["bin"]: r for r in metrics.calibration(scores, 7).collect()}
    at = 0
    for k in range(7 if used else 0):  # the first n % 7 bins hold one row more
        part = used[at : at + n // 7 + (k < n % 7)]
        at += len(part)
        assert got[k + 1]["n_rows"] == len(part) and got[k + 1]["mean_prediction"] == pytest.approx(sum(x[0] for x in part) / len(part)) and got[k + 1]["observed_rate"] == pytest.approx(sum(x[3] for x in part) / len(part))
    auc = metrics.roc_auc(scores).first()["roc_auc"]
    pos, neg = [x[0] for x in used if x[3]], [x[0] for x in used if not x[3]]
    assert auc == (pytest.approx(sum((p > q) + (p == q) / 2 for p in pos for q in neg) / (len(pos) * len(neg))) if pos and neg else None)


def test_small_scores_spread_over_ranges(spark):
    scores = spark.range(20_000).select((F.col("id") / 1e9).alias("probability"), F.lit(1).alias("label"))
    ranged = scores.crossJoin(metrics._bounds(scores, "probability")).groupBy(metrics._range_of(F.col("probability")).alias("r")).count()
    assert ranged.count() > 900 and ranged.agg(F.max("count")).first()[0] < 100
