"""Snapshots, reference files, pages and guards."""

import pytest
from pyspark.sql import functions as F

from sessiongrid.plans.guards import ExpectationError, contiguous, expect, guard
from sessiongrid.plans.modeling import fingerprint
from sessiongrid.sources import files, html, snapshots


def frame(spark):
    return spark.createDataFrame([("A", 1, 2.0), ("B", 2, None), ("B", 2, -0.0)], "ticker string, n int, x double")


def test_snapshot_is_saved_once_and_verified(spark, tmp_path):
    store = snapshots.SnapshotStore(spark, f"file://{tmp_path}/store")
    a = store.save(frame(spark), "prices")
    assert store.save(frame(spark).repartition(3).select("x", "n", "ticker").select("ticker", "n", "x"), "prices") == a
    b = store.save(frame(spark).where("n = 1"), "prices")
    assert b != a and store.find("prices") == b and store.verify(a) == [] and store.verify("none") == ["NOT_IN_MANIFEST"]
    assert store.read(a).count() == 3 and store.read(a).schema == frame(spark).schema
    assert [r["n"] for r in store.read(a, order_by=["n"]).collect()] == [1, 2, 2]
    frame(spark).limit(1).write.mode("overwrite").parquet(f"file://{tmp_path}/store/data/{a}")
    with pytest.raises(ValueError, match="CONTENT_HASH"):
        store.read(a)
    assert store.read(a, verified=False).count() == 1
    with pytest.raises(ValueError, match="no snapshot"):
        store.read("none")


def test_revision_counts_cells_columns_and_dates(spark):
    old = spark.createDataFrame([("A", "2024-01-01", 1, 1.0), ("B", "2024-01-02", 1, 1.0), ("C", "2024-01-03", 1, 1.0)], "k string, date string, n int, x double")
    new = spark.createDataFrame([("A", "2024-01-01", 2, 3.0, "q"), ("B", "2024-01-02", 1, 1.0, "q"), ("D", "2024-01-05", 1, 1.0, "q")], "k string, date string, n int, x double, q string")
    assert tuple(snapshots.revision(old, new, ["k", "date"], "date").first()) == (1, 3, "n|q|x", "2024-01-05", "2024-01-03")
    assert tuple(snapshots.revision(old, old, ["k", "date"], "date").first()) == (0, 0, "", "", "")



def test_content_hash_ignores_order_but_not_content(spark):
    h = lambda df: snapshots.content_hash(df).first()["content_hash"]
    assert h(frame(spark)) == h(frame(spark).orderBy(F.desc("n"))) != h(frame(spark).withColumn("n", F.col("n") + 1))
    assert h(frame(spark)) == h(frame(spark).withColumn("x", F.when(F.col("x") == 0, 0.0).otherwise(F.col("x"))))


def test_diff_by_key(spark):
    old = spark.createDataFrame([("A", 1, 1.0), ("B", 1, 1.0), ("B", 1, 2.0)], "k string, n int, x double")
    new = spark.createDataFrame([("A", 1, 3.0), ("B", 1, 1.0), ("C", 1, 1.0)], "k string, n int, x double")
    assert sorted((r["k"], r["copy"], r["change"], r["columns"]) for r in snapshots.diff(old, new, ["k"]).collect()) == [("A", 1, "CHANGED", "x"), ("B", 2, "REMOVED", None), ("C", 1, "ADDED", None)]


def test_reference_files(spark, tmp_path):
    (tmp_path / "t.csv").write_text("rule_set_id,instrument_type,effective_from,effective_to,price_min_inclusive,price_max_exclusive,tick_size\nA,EQUITY,2020-03-13,,0.01,20,0.01\nA,EQUITY,bad,,20,,0.02\n")
    got = files.read_tariff(spark, f"file://{tmp_path}/t.csv").collect()
    assert float(got[0]["tick_size"]) == 0.01 and got[0]["effective_to"] is None and got[1]["effective_from"] is None and got[1]["price_max"] is None
    (tmp_path / "m.csv").write_text("security_id,ticker,valid_from,valid_to,is_current_ticker,mapping_status\nS1,abc.is,2020-01-01,,true,OK\n")
    row = files.read_mapping(spark, f"file://{tmp_path}/m.csv").first()
    assert row["ticker"] == "ABC" and row["is_current_ticker"] is True
    files.write_json(str(tmp_path / "r" / "a.json"), {"b": 1})
    assert (tmp_path / "r" / "a.json").read_text() == '{\n  "b": 1\n}\n'
    files.write_csv(frame(spark), f"file://{tmp_path}/out", ["ticker", "n"])
    assert spark.read.csv(f"file://{tmp_path}/out", header=True).count() == 3


def test_records_in_scripts(spark):
    page = '<script>self.__next_f.push([1,"15:{\\"content\\":[{\\"companies\\":[{\\"mkkMemberOid\\":\\"o1\\",\\"kapMemberTitle\\":\\"T\\",\\"stockCode\\":\\"AAA AAB\\",\\"cityName\\":\\"X\\",\\"kapMemberType\\":\\"IGS\\"}]}]}"])</script>'
    pages = spark.createDataFrame([(1, page), (2, "<p>nothing</p>"), (3, None)], "page_id long, html string")
    schema = "struct<content:array<struct<companies:array<struct<mkkMemberOid:string,kapMemberTitle:string,stockCode:string,cityName:string,kapMemberType:string>>>>>"
    rows = html.companies(html.script_payloads(pages, schema))
    assert sorted(r["ticker"] for r in rows.collect()) == ["AAA", "AAB"]
    assert html.mentions(spark.createDataFrame([(1, "<b>ŞİRKET</b> <script>x</script>")], "page_id long, html string"), ["sirket"]).first()["mentions"]


def test_guards_fail_closed(spark):
    with pytest.raises(ExpectationError):
        guard(frame(spark).withColumn("future_return", F.lit(1)))
    assert guard(frame(spark), required=["ticker"]) is not None
    with pytest.raises(ExpectationError):
        expect(frame(spark), {"x": F.col("x").isNotNull()})
    with pytest.raises(ExpectationError):
        expect(frame(spark), {}, unique=["ticker"])
    assert contiguous(spark.range(3).withColumnRenamed("id", "session_index")) and not contiguous(spark.range(1, 3).withColumnRenamed("id", "session_index"))
    assert fingerprint(a=1, b="x") == fingerprint(b="x", a=1) != fingerprint(a=2, b="x")
