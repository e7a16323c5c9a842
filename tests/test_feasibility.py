"""The feasibility scan against windows that are written out session by session."""

import datetime as dt
import random
from statistics import median

import pytest

from sessiongrid.operators import feasibility
from sessiongrid.operators.folds import FoldConfig

CONFIG = FoldConfig(validation=6, test=4, minimum_fit=8, horizon=2, history=3)
SCHEMA = "security_id string, prediction_date date, prediction_eligible boolean, label int, label_status string, label_available_date date"


def days_of(n: int) -> list[dt.date]:
    return [dt.date(2021, 12, 1) + dt.timedelta(k + k // 5 * 2) for k in range(n)]


def slow(panel: list[tuple], sessions: list[dt.date], c: FoldConfig) -> dict[str, dict]:
    out = {}
    held = {d: [r for r in panel if r[1] == d and r[2]] for d in sessions}
    good = {d: [r for r in rows if r[4] == "LABELED" and r[3] in (0, 1) and r[5]] for d, rows in held.items()}
    for t, day in enumerate(sessions):
        row = dict.fromkeys(feasibility.COLUMNS, 0) | {x: "" for x in feasibility.COLUMNS if x.endswith("_date")}
        row |= {"candidate_first_test_date": str(day), "feasible": False, "warmup_session_count": c.history - 1, "fit_daily_row_count_median": 0.0, "validation_daily_row_count_median": 0.0, "test_daily_row_count_median": 0.0}
        out[str(day)] = row
        v, begin = t - c.validation, c.history - 1
        if v < 0 or v - c.horizon - begin < c.minimum_fit or t + c.test > len(sessions):
            row["failure_reason"] = feasibility.NO_VALIDATION if v < 0 else feasibility.NO_FIT if v - c.horizon - begin < c.minimum_fit else feasibility.NO_TEST_BLOCK
            continue
        for name, lo, hi, before in (("fit", begin, v, sessions[v]), ("validation", v, t, day)):
            used = [d for d in sessions[lo:hi] if good[d] and max(r[5] for r in good[d]) < before]
            n = [len(good[d]) for d in used]
            early = [len(good[d]) for d in used if d.year in (2020, 2021)]
            rows = [r for d in used for r in good[d]]
            row |= {
                f"{name}_start_date": str(sessions[lo]), f"{name}_end_date": str(sessions[hi - 1]), f"{name}_calendar_session_count": hi - lo, f"{name}_contract_labeled_session_count": hi - lo - c.horizon,
                f"{name}_purged_session_count": c.horizon, f"{name}_available_label_session_count": len(used), f"{name}_row_count": sum(n), f"{name}_positive_count": sum(r[3] == 1 for r in rows),
                f"{name}_negative_count": sum(r[3] == 0 for r in rows), f"{name}_daily_row_count_min": min(n, default=0), f"{name}_daily_row_count_median": float(median(n)) if n else 0.0,
                f"{name}_daily_row_count_max": max(n, default=0), f"{name}_2020_2021_session_count": len(early), f"{name}_2020_2021_row_count": sum(early),
            }
        test = [held[d] for d in sessions[t : t + c.test]]
        rows, n = sum(test, []), [len(x) for x in test]
        row |= {
            "test_start_date": str(day), "test_end_date": str(sessions[t + c.test - 1]), "test_calendar_session_count": c.test, "test_row_count": len(rows), "test_labeled_row_count": sum(r[4] == "LABELED" for r in rows),
            "test_positive_count": sum(r[3] == 1 for r in rows), "test_negative_count": sum(r[3] == 0 for r in rows), "test_na_label_count": sum(r[4] != "LABELED" for r in rows),
            "test_daily_row_count_min": min(n), "test_daily_row_count_median": float(median(n)), "test_daily_row_count_max": max(n), "total_complete_fold_count": (len(sessions) - t) // c.test,
        }
        codes = [
            (row["fit_available_label_session_count"] < c.minimum_fit, "FIT_LABELED_SESSIONS_BELOW_252"), (row["validation_available_label_session_count"] != c.validation - c.horizon, "VALIDATION_AVAILABLE_LABEL_SESSIONS_NOT_57"),
            (0 in (row["fit_positive_count"], row["fit_negative_count"]), "FIT_MISSING_BINARY_CLASS"), (0 in (row["validation_positive_count"], row["validation_negative_count"]), "VALIDATION_MISSING_BINARY_CLASS"),
            (not row["fit_row_count"], "FIT_EMPTY"), (not row["validation_row_count"], "VALIDATION_EMPTY"), (not row["test_row_count"], "TEST_EMPTY"),
        ]
        row["failure_reason"] = "|".join(x for bad, x in codes if bad)
        row["feasible"] = not row["failure_reason"]
    return out


def panel_of(kind: str, sessions: list[dt.date]) -> list[tuple]:
    rng, rows = random.Random(kind), []
    for k, d in enumerate(sessions):
        for s in range(0 if kind == "gaps" and k % 9 == 4 else 2 + k % 4):
            known = sessions[k + 2] if k + 2 < len(sessions) else None
            if kind == "late" and rng.random() < 0.1:  # known long after, or on a day between sessions
                known = d + dt.timedelta(rng.randrange(1, 30))
            label = 1 if kind == "one class" else rng.choice([0, 1])
            status = "NA" if kind != "one class" and rng.random() < 0.1 else "LABELED"
            eligible = rng.choice([True, True, False, None]) if kind == "gaps" else True
            rows.append((f"S{s}", d, eligible, label if status == "LABELED" else None, status if rng.random() < 0.97 else None, known))
    return rows if kind != "empty" else []


@pytest.mark.parametrize("kind", ["plain", "late", "gaps", "one class", "empty"])
def test_all_windows(spark, kind):
    sessions = days_of(45)
    panel = panel_of(kind, sessions)
    calendar = spark.createDataFrame([(d, k) for k, d in enumerate(sessions)], "session_date date, session_index long")
    got = feasibility.scan(spark.createDataFrame(panel, SCHEMA), calendar, str(sessions[41]), CONFIG)
    assert got.columns == feasibility.COLUMNS and len(got.columns) == 44
    rows = {r["candidate_first_test_date"]: r.asDict() for r in got.collect()}
    want = slow(panel, sessions[:42], CONFIG)
    assert rows.keys() == want.keys()
    for day in want:
        assert rows[day] == want[day], day
    best = [r for r in want.values() if r["feasible"]]
    assert bool(best) == (kind in ("plain", "gaps", "late")) or kind in ("gaps", "late")
    found = feasibility.recommendation(got, (1, 3, 60)).first()
    dates = [r["candidate_first_test_date"] for r in best]
    others = list(dict.fromkeys(dates[min(p, len(dates) - 1)] for p in (1, 3, 60))) if len(dates) > 1 else []
    assert tuple(found) == (dates[0] if dates else None, "|".join(others), dates[0] if dates else None, best[0]["total_complete_fold_count"] if best else 0)


def test_a_gap_in_the_calendar_fails_closed(spark):
    sessions = days_of(45)
    calendar = spark.createDataFrame([(d, k) for k, d in enumerate(sessions) if k != 30], "session_date date, session_index long")
    got = feasibility.scan(spark.createDataFrame(panel_of("plain", sessions), SCHEMA), calendar, str(sessions[-1]), CONFIG).collect()
    codes = {r["candidate_first_test_date"]: r["failure_reason"] for r in got}
    assert "VALIDATION_CALENDAR_NOT_60" in codes[str(sessions[33])] and "TEST_CALENDAR_NOT_20" in codes[str(sessions[28])]


def test_no_session_meets_all_others(spark):
    sessions = days_of(60)
    calendar = spark.createDataFrame([(d, k) for k, d in enumerate(sessions)], "session_date date, session_index long")
    plan = feasibility.scan(spark.createDataFrame(panel_of("plain", sessions), SCHEMA), calendar, str(sessions[-1]), CONFIG)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
