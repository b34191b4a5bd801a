"""Runs driven by changes: what they touch, and that they give what a full rebuild gives."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from cinderframe.operators import changes, sinks
from cinderframe.plans import pipeline
from cinderframe.sources import readers
from cinderframe.streaming import air_quality_stream
from conftest import readings

RUN_TS = dt.datetime(2024, 3, 1)
CO2 = "CO2_emission_intensity"
DAILY = "reading_date date, plant_id string, reading_count long, scope1_intensity_avg double"
TABLES = ["int_daily_plant_readings", "int_scope1_emissions", "int_scope2_emissions", "int_scope3_emissions",
          "mart_co2_intensity", "mart_net_zero_progress", "mart_benchmark_gap", "int_window_state"]


def _month(day):
    return f"{day:%Y-%m}"


def _months(first, last):
    out = [first]
    while out[-1] < last:
        out.append(changes._next_month(out[-1]))
    return out if first <= last else []


def _days(rnd):
    """Reading days of one plant: dense, sparse or with a long break."""
    step = rnd.choice([1, 1, 2, 9, 40])
    day, out = dt.date(2023, 1, 1) + dt.timedelta(days=rnd.randrange(60)), []
    while day < dt.date(2023, 12, 20):
        out.append(day)
        day += dt.timedelta(days=rnd.randint(1, 2 * step) + (100 if rnd.random() < 0.02 else 0))
    return out


def test_spans_of_months():
    assert changes.spans([]) == []
    assert changes.spans(["2023-12", "2024-01", "2024-03", "2024-01"]) == [("2023-12", "2024-01"), ("2024-03", "2024-03")]
    assert changes.spans(["2023-01", "2024-01"], "2024-02") == [("2023-01", "2023-01"), ("2024-01", changes.OPEN_END)]
    assert changes.spans([], "2024-02") == [("2024-02", changes.OPEN_END)]


def test_window_state_against_brute_force(spark):
    rnd = random.Random(5)
    plants = {f"P{i}": _days(rnd) for i in range(30)}
    rows = spark.createDataFrame([(d, p, 1, float(d.toordinal())) for p, days in plants.items() for d in days], DAILY)
    last = "2023-12"
    got = {}
    for r in changes.window_state(rows.drop("reading_count"), None, dt.date(2023, 12, 1)).collect():
        assert r["scope1_intensity_avg"] == float(r["reading_date"].toordinal())
        got.setdefault((r["plant_id"], r["reading_month"]), []).append(r["reading_date"])
    want = {(p, m): [d for d in days if _month(d) <= m][-changes.WINDOW_DAYS:]
            for p, days in plants.items() for m in _months(_month(days[0]), last)}
    assert {k: sorted(v) for k, v in got.items()} == want

    # a later stretch from the state before it gives the same rows
    before = [(d, p, float(d.toordinal())) for (p, m), days in want.items() if m == "2023-06" for d in days]
    later = rows.where("reading_date between '2023-07-01' and '2023-09-30'").drop("reading_count")
    state = spark.createDataFrame(before, "reading_date date, plant_id string, scope1_intensity_avg double")
    part = changes.window_state(later.unionByName(state), dt.date(2023, 7, 1), dt.date(2023, 9, 1)).collect()
    assert sorted((r["plant_id"], r["reading_month"], r["reading_date"]) for r in part) == sorted(
        (p, m, d) for (p, m), days in want.items() if "2023-07" <= m <= "2023-09" for d in days)


def test_touched_months_against_brute_force(spark):
    """Every month whose windows or state differ between the days before and after a change is found;
    a month is reached only if a changed day lies in a window of one of its days."""
    rnd = random.Random(7)
    end = dt.date(2023, 12, 1)
    before, changed, daily = {}, [], []
    for i in range(60):
        plant, days = f"P{i}", _days(rnd)
        day = rnd.choice([rnd.choice(days), dt.date(2023, rnd.randint(1, 12), rnd.randint(1, 28))])
        after = sorted(set(days) - {day} if rnd.random() < 0.4 else {*days, day})
        before[plant] = (days, after, day)
        changed.append((_month(day), plant, day, day))
        daily += [(d, plant, 1, 0.0) for d in after] + ([(day, plant, 0, None)] if day not in after else [])
    daily = spark.createDataFrame(daily, DAILY)

    def value(days, after, day, d):
        """What a day's windows see: the days before it, and whether the changed one is among them."""
        at = days.index(d)
        seen = days[max(0, at - changes.WINDOW_DAYS): at + 1]
        return seen, (day in seen) and days is after

    for plant in [f"P{i}" for i in range(0, 60, 6)]:  # each by itself: the months are those of all plants
        days, after, day = before[plant]
        one = spark.createDataFrame([c for c in changed if c[1] == plant], sinks.CHANGED_MONTHS)
        found = changes.touched_months(daily.where(F.col("reading_date") >= F.lit(day.replace(day=1))), one, end).collect()
        reached = {r["reading_month"] for r in found if r["reached"]} | {_month(day)}
        touched = {r["reading_month"] for r in found} | {_month(day)}
        differs = {_month(d) for d in after if d not in days or value(after, after, day, d) != value(days, after, day, d)}
        state = {m for m in _months("2023-01", _month(end))
                 for a, b in [[[x for x in ds if _month(x) <= m][-changes.WINDOW_DAYS:] for ds in (days, after)]]
                 if a != b or day in b}
        assert differs <= reached <= touched, plant
        assert state <= set(_months(_month(day), max(touched))), plant


def _warehouse(spark, root, rows):
    wh = pipeline.Warehouse(root)
    pipeline.ingest_sensor_batch(spark, wh, readings(spark, rows).drop("ingested_at"), RUN_TS)
    pipeline.ingest_benchmarks(spark, wh, RUN_TS)
    spark.createDataFrame([(2020, "X", 1.0, 2.0, 0.1, 0.2, RUN_TS)],
                          "year int, country string, co2_per_capita double, co2_total_mt double, "
                          "cement_co2 double, energy_co2 double, ingested_at timestamp") \
        .write.parquet(wh.path("raw_owid_emissions"))
    return wh


def _content(spark, wh):
    out = {}
    for name in TABLES:
        df = spark.read.parquet(wh.path(name)).drop("updated_at")
        out[name] = sorted(map(str, df.select(*sorted(df.columns)).collect()))
    return out


def _exported(spark, folder):
    """The rows of an export, file by file in the order of the names."""
    names = sorted(os.path.join(r, n) for r, _, ns in os.walk(folder) for n in ns if n.endswith(".parquet"))
    return [tuple(r) for n in names for r in spark.read.parquet(n).select("reading_date", "plant_id").collect()]


def test_a_run_without_since_equals_a_full_rebuild(spark, tmp_table, monkeypatch):
    day0 = dt.date(2023, 1, 1)
    rows = [(day0 + dt.timedelta(days=k), "A", CO2, 600.0 + k) for k in range(0, 240)]
    rows += [(day0 + dt.timedelta(days=k), "B", CO2, 500.0 + k) for k in range(0, 240, 12)]   # sparse
    rows += [(day0 + dt.timedelta(days=k), "C", CO2, 700.0 + k) for k in range(0, 45)]        # stopped
    wh = _warehouse(spark, tmp_table("wh"), rows)
    pipeline.transform(spark, wh, RUN_TS)
    assert os.listdir(wh.path("raw_sensor_readings_changes")) == []

    def stamps(table):
        return {f: os.stat(f).st_mtime_ns for r, _, ns in os.walk(wh.path(table)) for n in ns
                for f in [os.path.join(r, n)] if "reading_month" in f or "newest_first" in f}

    # an old day of A corrected, one of C gone (its reading isn't positive)
    fix = [(dt.date(2023, 2, 20), "A", CO2, 900.0), (dt.date(2023, 2, 10), "C", CO2, -1.0)]
    pipeline.ingest_sensor_batch(spark, wh, readings(spark, fix).drop("ingested_at"), RUN_TS)
    _, changed = sinks.pending_changes(spark, wh.path("raw_sensor_readings"))
    assert sorted((r["plant_id"], r["first"]) for r in changed.collect()) == [
        ("A", dt.date(2023, 2, 20)), ("C", dt.date(2023, 2, 10))]
    before, exports = stamps("mart_co2_intensity"), stamps("exports/mart_co2_intensity")

    # a run that fails in an export leaves the changes to the next one
    real = sinks.export_months
    monkeypatch.setattr(sinks, "export_months", lambda df, path, spans: _raise() if "gap" in path else real(df, path, spans))
    assert len(pipeline.transform(spark, wh, RUN_TS).export_failures) == 1
    monkeypatch.undo()
    assert len(os.listdir(wh.path("raw_sensor_readings_changes"))) == 1
    res = pipeline.transform(spark, wh, RUN_TS)
    assert os.listdir(wh.path("raw_sensor_readings_changes")) == []
    assert res.export_failures == []
    after = stamps("mart_co2_intensity")
    same = {f for f in before if after.get(f) == before[f]}
    assert {f.split("reading_month=")[1][:7] for f in before if f not in same} == {"2023-02", "2023-03"}
    untouched = {f for f, t in stamps("exports/mart_co2_intensity").items() if exports.get(f) == t}
    assert {f.split("newest_first=")[1][:6] for f in exports if f not in untouched} == {"797697", "797696"}  # 999999 less 202302, 202303
    incremental = _content(spark, wh)
    order = {n: _exported(spark, wh.path(f"exports/{n}")) for n in ("mart_co2_intensity", "mart_benchmark_gap")}

    assert sum(pipeline.transform(spark, wh, RUN_TS).rows[n] for n in TABLES[4:7]) == 0  # nothing changed
    pipeline.transform(spark, wh, RUN_TS, full=True)
    full = _content(spark, wh)
    assert all(incremental[n] == full[n] for n in TABLES), [n for n in TABLES if incremental[n] != full[n]]
    assert full["int_window_state"]
    for name, got in order.items():
        assert got == _exported(spark, wh.path(f"exports/{name}")) == sorted(got, key=lambda r: (-r[0].toordinal(), r[1]))
        assert len(got) == len(full[name])

    # other settings rebuild all
    import dataclasses
    cfg = dataclasses.replace(pipeline.DEFAULT, target_2030=500.0)
    assert pipeline.transform(spark, wh, RUN_TS, cfg).rows["mart_co2_intensity"] == len(full["mart_co2_intensity"])


def _raise():
    raise OSError("no space")


def test_windows_begin_with_one_month_of_state(spark, tmp_table):
    """The plan of an incremental Scope 1 reads the state of the month before, and no earlier plant-days."""
    days = [dt.date(2023, 1, 1) + dt.timedelta(days=k) for k in range(150)]
    daily = spark.createDataFrame([(d, "A", 1, float(k)) for k, d in enumerate(days)], DAILY)
    path = tmp_table("state")
    state = changes.window_state(daily.drop("reading_count"), None, dt.date(2023, 5, 1))
    sinks.write_months(state, path, None)
    before = pipeline._state_before(spark, path, "2023-04")
    scanned = [f for f in before.inputFiles() if "reading_month=2023-03" in f]
    assert len(scanned) == len(before.inputFiles()) == 1
    assert [r["reading_date"] for r in before.orderBy("reading_date").collect()] == days[60:90]
    assert pipeline._state_before(spark, path, "2023-01").count() == 0


@pytest.mark.parametrize("repeat", ["batch", "stream"])
def test_the_same_air_quality_batch_is_appended_once(spark, tmp_table, repeat):
    records = ['{"date":"2024-01-07","parameter":"co","value":3}', '{"date":"2024-01-07","parameter":"co","value":3}',
               '{"date":"2024-01-08","parameter":"no2","location":null}']
    batch = spark.createDataFrame([(r,) for r in records], "body string")
    wh = pipeline.Warehouse(tmp_table("wh"))
    assert pipeline.ingest_air_quality(spark, wh, batch, RUN_TS) == 3
    table = wh.path("raw_openaq_readings")
    if repeat == "batch":
        again = batch.orderBy(F.desc("body")).repartition(3)
        assert pipeline.ingest_air_quality(spark, wh, again, RUN_TS + dt.timedelta(hours=1)) == 3
    else:
        landing = tmp_table("landing")
        os.makedirs(landing)
        with open(f"{landing}/a.json", "w") as f:
            f.write("\n".join(records) + "\n")
        air_quality_stream.run_available(spark, landing, table, tmp_table("ckpt"))
    assert readers.read_openaq_readings(spark, table).count() == 3
    assert len(os.listdir(table)) == 1 and os.listdir(f"{table}_staging") == []
    other = spark.createDataFrame([(r,) for r in records[:1] + records[2:]], "body string")  # one copy fewer
    assert pipeline.ingest_air_quality(spark, wh, other, RUN_TS) == 2
    assert readers.read_openaq_readings(spark, table).count() == 5


def test_digests_tell_rows_apart(spark):
    def digest(rows):
        return sinks.rows_digest(spark.createDataFrame(rows, "a string, b string"))

    rows = [("x", None), ("y", "z"), ("y", "z")]
    assert digest(rows) == digest(rows[::-1])
    others = [[(None, "x"), *rows[1:]], rows[:2], [*rows, *rows], [("x", ""), *rows[1:]], []]
    assert len({digest(r) for r in [rows, *others]}) == 6
