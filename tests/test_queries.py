"""Every query with SQL against DuckDB on the smallest tables; the others give rows."""

import datetime as dt

import pytest
from comparing import rows_of, rows_of_sql

from pyspark.sql import functions as F

from sessiongrid import queries as panel_queries
from sessiongrid.operators import folds
from sessiongrid.plans import modeling

SQL, QUERIES = panel_queries.all_sql(), panel_queries.all_queries()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    want, names = rows_of_sql(duck, SQL[name])
    assert sorted(df.columns) == names
    assert rows_of(df) == want


def test_model_scores_out_of_sample(spark, sf_dir):
    out = QUERIES["walk_forward_model"](spark, sf_dir).toPandas()
    assert len(out) and out.probability.between(0, 1).all()
    assert not out.duplicated(["security_id", "prediction_date"]).any()
    assert (out.predicted_class == (out.probability >= 0.5)).all() and set(out.label_status) > {"LABELED"}


def test_labels_behind_the_cutoff_are_blank_and_classes_are_asked_for(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(k) for k in range(40)]
    calendar = spark.createDataFrame([(d, k) for k, d in enumerate(days)], "session_date date, session_index long")
    rows = [(f"S{s}", days[k], True, (k + s) % 2, "LABELED", days[k + 1] if k < 39 else None, float((k + s) % 2), "no number" if s else None) for k in range(40) for s in range(3)]
    panel = spark.createDataFrame(rows, "security_id string, prediction_date date, prediction_eligible boolean, label int, label_status string, label_available_date date, a double, b string")
    config = folds.FoldConfig(validation=6, test=5, minimum_fit=10, horizon=1, history=2)
    learner = modeling.Learner(features=("a", "b"))
    out = modeling.walk_forward(panel, calendar, config, "2024-01-30", learner).toPandas()
    late = out.prediction_date >= days[29]
    assert late.any() and out.label[late].isna().all() and (out.label_status[late] == "NA").all()
    assert (out.label[~late] == out.predicted_class[~late]).all() and out.label[~late].notna().all()
    with pytest.raises(ValueError, match="both classes"):
        modeling.walk_forward(panel.withColumn("label", F.lit(1)), calendar, config, "2024-01-30", learner)
    with pytest.raises(ValueError, match="missing"):
        modeling.model_matrix(panel)


def test_folds_of_one_class_get_base_rates(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(k) for k in range(40)]
    calendar = spark.createDataFrame([(d, k) for k, d in enumerate(days)], "session_date date, session_index long")
    schema = "security_id string, prediction_date date, prediction_eligible boolean, label int, label_status string, label_available_date date, a double"
    config = folds.FoldConfig(validation=6, test=5, minimum_fit=10, horizon=1, history=2)

    def scores(label, status):
        rows = [(f"S{s}", days[k], True, label(k, s), status, days[k + 1] if k < 39 else None, float((k + s) % 2)) for k in range(40) for s in range(3)]
        return modeling.walk_forward(spark.createDataFrame(rows, schema), calendar, config, "2024-03-01", modeling.Learner(features=("a",)), base_rate=True).toPandas()

    ones, none, mixed = scores(lambda k, s: 1, "LABELED"), scores(lambda k, s: None, "NA"), scores(lambda k, s: (k + s) % 2 if k < 27 else 1, "LABELED")
    assert (ones.probability == 1).all() and (ones.predicted_class == 1).all() and not ones.trained.any()
    assert none.probability.isna().all() and none.predicted_class.isna().all() and len(none) == len(ones) == len(mixed)
    assert not none.duplicated(["prediction_date", "daily_rank"]).any()
    # the first folds hold both classes; from session 27 on the validation rows are of one class, the fit rows of both
    assert set(mixed.fold_id[mixed.trained]) and set(mixed.fold_id[~mixed.trained])
    assert mixed.probability[~mixed.trained].between(0.5, 0.99).all() and mixed.probability.notna().all()


def test_entry_module_lists_each_query(spark):
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns[:3] == ["security_id", "prediction_date", "session_index"]
