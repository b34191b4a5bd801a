"""Report queries over small hand-made marts."""

import datetime as dt

import pytest

from cinderframe import config as C
from cinderframe.operators import reports

AS_OF = dt.date(2024, 3, 31)


@pytest.fixture(scope="module")
def mart(spark):
    rows = []
    for plant, base in (("A", 600.0), ("B", 700.0)):
        for k in range(120):
            d = AS_OF - dt.timedelta(days=k)
            s1 = base + k
            rows.append((d, plant, s1, s1, s1, 54.99, 40.0, s1 + 94.99, 2, k % 2, s1 > 650))
    schema = ("reading_date date, plant_id string, scope1_kg_per_t double, scope1_7d_avg double, "
              "scope1_30d_avg double, scope2_kg_per_t double, scope3_kg_per_t double, "
              "total_co2_kg_per_t double, reading_count long, anomaly_count long, "
              "exceeds_2030_target boolean")
    return spark.createDataFrame(rows, schema)


def test_latest_per_plant(mart):
    got = {r["plant_id"]: (r["reading_date"], r["scope1_kg_per_t"])
           for r in reports.latest_per_plant(mart).collect()}
    assert got == {"A": (AS_OF, 600.0), "B": (AS_OF, 700.0)}


def test_window_lower_bound_inclusive(mart):
    out = reports.trend(mart, AS_OF, reports.window_days("30 days")).collect()
    assert len(out) == 2 * 31
    assert min(r["reading_date"] for r in out) == AS_OF - dt.timedelta(days=30)
    assert [r["reading_date"] for r in out] == sorted(r["reading_date"] for r in out)


def test_date_extent(mart):
    ext = {r["plant_id"]: (r["first_day"], r["last_day"])
           for r in reports.date_extent(reports.trend(mart, AS_OF, 30)).collect()}
    assert ext == {"A": (AS_OF - dt.timedelta(days=30), AS_OF), "B": (AS_OF - dt.timedelta(days=30), AS_OF)}


def test_kpi(mart):
    k = {r["plant_id"]: r for r in reports.kpi(mart).collect()}
    assert k["A"]["progress_pct_to_2030"] == pytest.approx((800 - 600) / 150 * 100)
    assert (k["A"]["gauge_band"], k["A"]["status_2030"]) == ("green", "on_track")
    assert (k["B"]["gauge_band"], k["B"]["status_2030"]) == ("red", "off_track")
    assert k["B"]["gap_vs_2030_target"] == 50.0
    assert k["A"]["anomalies"] == 0


def test_scope_share(mart):
    rows = [r for r in reports.scope_share(mart).collect() if r["plant_id"] == "A"]
    assert [r["scope"] for r in sorted(rows, key=lambda r: r["scope"])] == ["Scope 1", "Scope 2", "Scope 3"]
    assert sum(r["share_pct"] for r in rows) == pytest.approx(100.0, abs=0.02)


def test_benchmark_latest_labels(spark):
    rows = [(AS_OF, "A", 500.0, 620.0, 680.0, 650.0, -120.0, -180.0, "top_10pct"),
            (AS_OF, "B", 700.0, 620.0, 680.0, 650.0, 80.0, 20.0, "weird_code"),
            (AS_OF - dt.timedelta(days=200), "C", 700.0, 620.0, 680.0, 650.0, 80.0, 20.0, "top_10pct")]
    bg = spark.createDataFrame(rows, "reading_date date, plant_id string, scg_intensity double, "
                                     "global_avg double, asean_avg double, scg_2030_target double, "
                                     "gap_vs_global double, gap_vs_asean double, industry_position string")
    out = reports.benchmark_latest(bg, AS_OF, 90).collect()
    assert {r["plant_id"] for r in out} == {"A", "B"}  # C has nothing inside the window
    a = {r["category"]: r["value"] for r in out if r["plant_id"] == "A"}
    assert a == dict(zip(C.BENCHMARK_CATEGORIES, (500.0, 680.0, 620.0, 650.0)))
    labels = {r["plant_id"]: r["position_label"] for r in out}
    assert labels["A"] == C.POSITION_LABELS["top_10pct"] and labels["B"] == "weird_code"


def test_pipeline_log_local_time_top_k(spark):
    base = dt.datetime(2024, 1, 1, 0, 0)
    rows = [(base + dt.timedelta(hours=i), "d", "s", i, "success", None) for i in range(30)]
    log = spark.createDataFrame(rows, "run_at timestamp_ntz, dag_id string, source string, "
                                      "rows_loaded int, status string, message string")
    out = reports.pipeline_log_recent(log).collect()
    assert len(out) == 20
    assert out[0]["rows_loaded"] == 29
    assert out[0]["run_at"] == base + dt.timedelta(hours=29 + 7)
