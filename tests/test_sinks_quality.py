"""Load rules (idempotent day replacement, NOT NULL, append) and data-quality checks."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from cinderframe.operators import quality, sinks
from cinderframe.sources import readers
from conftest import readings

TS = dt.datetime(2024, 1, 3, 12, 0)


def _table(spark, path):
    return readers.read_sensor_readings(spark, path)


def test_replace_plant_days_is_idempotent_and_local(spark, tmp_table):
    path = tmp_table("raw")
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    base = readings(spark, [(d, p, "O2_flue_gas", 1.0) for d in (d1, d2) for p in ("A", "B")])
    assert sinks.replace_plant_days(base, path, TS) == 4
    batch = readings(spark, [(d2, "A", "O2_flue_gas", 9.0), (d2, "A", "dust_emission", 9.0)])
    for _ in range(2):  # loading the same batch twice changes nothing the second time
        assert sinks.replace_plant_days(batch, path, TS) == 2
        got = sorted((r["reading_date"], r["plant_id"], r["sensor"], r["value"])
                     for r in _table(spark, path).collect())
        assert got == [(d1, "A", "O2_flue_gas", 1.0), (d1, "B", "O2_flue_gas", 1.0),
                       (d2, "A", "O2_flue_gas", 9.0), (d2, "A", "dust_emission", 9.0),
                       (d2, "B", "O2_flue_gas", 1.0)]


def test_sensor_defaults(spark, tmp_table):
    path = tmp_table("raw")
    df = spark.createDataFrame([(dt.date(2024, 1, 1), "A", "O2_flue_gas", 2.0, "pct")],
                               "reading_date date, plant_id string, sensor string, value double, unit_label string")
    sinks.replace_plant_days(df, path, TS)
    r = _table(spark, path).first()
    assert r["is_anomaly"] is False and r["ingested_at"] == TS


def test_not_null_is_enforced(spark, tmp_table):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), None, "O2_flue_gas", 2.0, "pct")],
                               "reading_date date, plant_id string, sensor string, value double, unit_label string")
    with pytest.raises(Exception, match="NOT NULL violated"):
        sinks.replace_plant_days(df, tmp_table("raw"), TS)


def test_append_and_log(spark, tmp_table):
    path, log = tmp_table("aq"), tmp_table("log")
    df = spark.createDataFrame([(1,), (2,)], "x int")
    assert sinks.append_load(df, path, "a") == 2
    assert sinks.append_load(df, path, "a") == 2       # the same load again
    assert sinks.append_load(df.where("x > 1"), path, "b") == 1
    files = sorted(os.listdir(path))
    assert sinks.append_load(df.where("x > 5"), path, "c") == 0
    assert sorted(os.listdir(path)) == files  # nothing written
    assert spark.read.parquet(path).count() == 3
    empty_target = tmp_table("never")
    assert sinks.append_load(df.where("x > 5"), empty_target, "a") == 0
    assert not os.path.exists(empty_target)
    sinks.log_run(spark, log, TS, "dag", "src", 2, "success")
    row = readers.read_pipeline_log(spark, log).first()
    assert (row["dag_id"], row["rows_loaded"], row["status"], row["message"]) == ("dag", 2, "success", None)


def test_refresh_reads_its_own_table_and_keeps_a_copy_on_failure(spark, tmp_table, monkeypatch):
    path = tmp_table("t")
    assert sinks.overwrite_table(spark.range(5).toDF("x"), path) == 5
    assert sinks.overwrite_table(spark.read.parquet(path).where("x > 1"), path) == 3
    assert [p for p in os.listdir(os.path.dirname(path)) if p != os.path.basename(path)] == []
    with pytest.raises(Exception):
        sinks.overwrite_table(spark.range(3).select(F.raise_error(F.lit("no")).alias("x")), path)
    assert spark.read.parquet(path).count() == 3


def test_a_failing_existence_check_changes_nothing(spark, tmp_table, monkeypatch):
    path = tmp_table("raw")
    day = dt.date(2024, 1, 1)
    sinks.replace_plant_days(readings(spark, [(day, p, "O2_flue_gas", 1.0) for p in "AB"]), path, TS)

    def broken(*_):
        raise OSError("no connection")

    monkeypatch.setattr(sinks, "_location", broken)
    with pytest.raises(OSError):
        sinks.replace_plant_days(readings(spark, [(day, "A", "O2_flue_gas", 2.0)]), path, TS)
    assert sorted(r["value"] for r in _table(spark, path).collect()) == [1.0, 1.0]


def test_export_is_newest_first(spark, tmp_table):
    path = tmp_table("exp")
    days = [dt.date(2024, 1, d) for d in range(1, 29)]
    df = spark.createDataFrame([(d, "A", float(i)) for i, d in enumerate(days)],
                               "reading_date date, plant_id string, v double").repartition(4)
    assert sinks.export_newest_first(df, path) == 28
    files = sorted(f for f in __import__("os").listdir(path) if f.endswith(".parquet"))
    first = spark.read.parquet(f"{path}/{files[0]}").agg(F.max("reading_date")).first()[0]
    assert first == days[-1]


def test_not_null_checks_and_summary(spark):
    raw = readings(spark, [(dt.date(2024, 1, 1), "A", "O2_flue_gas", 1.0)])
    bad = raw.withColumn("plant_id", F.lit(None).cast("string"))
    res = quality.not_null_checks({"raw_sensor_readings": raw.unionByName(bad)})
    got = {r["column_name"]: (r["failures"], r["status"]) for r in res.collect()}
    assert got == {"reading_date": (0, "pass"), "plant_id": (1, "fail"),
                   "sensor": (0, "pass"), "value": (0, "pass")}
    summary = {r["status"]: r["tests"] for r in quality.check_summary(res).collect()}
    assert summary == {"pass": 3, "fail": 1}
    log = quality.check_log_record(res, TS).first()
    assert (log["rows_loaded"], log["status"], log["message"]) == (3, "warning", "3 passed, 1 failed")


def test_singular_tests(spark):
    mart = spark.createDataFrame(
        [(dt.date(2024, 1, 1), "A", v) for v in (-1.0, 150.0, 200.0, 1200.0, 1200.01)],
        "reading_date date, plant_id string, scope1_kg_per_t double")
    assert quality.negative_intensity(mart).count() == 1
    assert sorted(r[2] for r in quality.out_of_range_intensity(mart).collect()) == [-1.0, 150.0, 1200.01]
    checks = {r["test_name"]: r["failures"] for r in quality.mart_checks(mart).collect()}
    assert checks["co2_not_negative"] == 1 and checks["intensity_reasonable_range"] == 3


@pytest.mark.parametrize("age_days,status", [(1, "pass"), (2, "pass"), (2.5, "warn"), (5, "warn"),
                                             (5.1, "error")])
def test_freshness(spark, age_days, status):
    loaded = TS - dt.timedelta(days=age_days)
    df = spark.createDataFrame([(loaded,)], "ingested_at timestamp")
    assert quality.freshness(df, "s", TS).first()["status"] == status


def test_freshness_empty_source_is_error(spark):
    df = spark.createDataFrame([], "ingested_at timestamp")
    assert quality.freshness(df, "s", TS).first()["status"] == "error"


def test_replacement_leaves_other_plants_and_months_untouched(spark, tmp_table):
    path = tmp_table("raw")
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 2, 3)]
    sinks.replace_plant_days(readings(spark, [(d, p, "O2_flue_gas", 1.0) for d in days for p in "AB"]),
                             path, TS)

    def files():
        out = {}
        for root, _, names in os.walk(path):
            for n in names:
                if n.endswith(".parquet"):
                    full = os.path.join(root, n)
                    out[full] = os.stat(full).st_mtime_ns
        return out

    before = files()
    sinks.replace_plant_days(readings(spark, [(days[1], "A", "O2_flue_gas", 5.0)]), path, TS)
    after = files()
    assert os.listdir(path + "_staging") == []  # the run's staging copies are removed
    mine = "reading_month=2024-01/plant_id=A"
    untouched = [f for f in before if mine not in f]
    assert len(untouched) == 3 and all(after.get(f) == before[f] for f in untouched)
    assert not any(f in after for f in before if mine in f)
    vals = {(r["reading_date"], r["plant_id"]): r["value"] for r in _table(spark, path).collect()}
    assert vals[(days[1], "A")] == 5.0 and vals[(days[0], "A")] == 1.0 and len(vals) == 6
    # two plants load the same day one after the other
    for plant, value in (("A", 6.0), ("B", 7.0)):
        sinks.replace_plant_days(readings(spark, [(days[2], plant, "O2_flue_gas", value)]), path, TS)
    vals = {(r["reading_date"], r["plant_id"]): r["value"] for r in _table(spark, path).collect()}
    assert (vals[(days[2], "A")], vals[(days[2], "B")], len(vals)) == (6.0, 7.0, 6)


def _files(path):
    return {os.path.join(r, n) for r, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


def test_replacement_rewrites_the_files_of_its_days_alone(spark, tmp_table, monkeypatch):
    path = tmp_table("raw")
    days = [dt.date(2024, 1, d) for d in range(1, 13)]
    month = "reading_month=2024-01/plant_id=A b%[x]"
    for part in (days[:4], days[4:8], days[8:]):  # three files of one plant and month
        sinks.replace_plant_days(readings(spark, [(d, "A b%[x]", "O2_flue_gas", 1.0) for d in part]).coalesce(1), path, TS)
    assert len(_files(path)) == 3
    before = _files(path)
    fix = readings(spark, [(days[5], "A b%[x]", "O2_flue_gas", 9.0), (days[5], "A b%[x]", "dust_emission", 9.0)])
    found = []
    real = sinks.files_of_days
    monkeypatch.setattr(sinks, "files_of_days", lambda *a: found.append(real(*a)) or found[-1])
    assert sinks.replace_plant_days(fix, path, TS) == 2
    after = _files(path)
    assert len(found[0]) == 1 and len(before & after) == 2  # the first and the last four days' files
    got = {(r["reading_date"], r["sensor"]): r["value"] for r in _table(spark, path).collect()}
    assert len(got) == 13 and got[days[5], "dust_emission"] == 9.0 and got[days[5], "O2_flue_gas"] == 9.0
    assert sorted(got)[0][0] == days[0] and {v for k, v in got.items() if k[0] != days[5]} == {1.0}

    # A failure halfway through the swap: the next load of the table first carries it out.
    for step in (0, 1):
        value = 7.0 + step
        monkeypatch.setattr(sinks, *(("remove_path", _fails_on_files(sinks.remove_path)) if step else
                                     ("_swap", _raises)))
        with pytest.raises(OSError):
            sinks.replace_plant_days(fix.withColumn("value", F.lit(value)), path, TS)
        monkeypatch.undo()
        assert any(n.endswith(sinks.JOURNAL) for n in os.listdir(path + "_staging"))
        sinks.replace_plant_days(readings(spark, [(days[0], "B", "O2_flue_gas", value)]), path, TS)
        assert os.listdir(path + "_staging") == []
        rows = [(r["reading_date"], r["plant_id"], r["value"]) for r in _table(spark, path).collect()]
        assert len(rows) == 14 and sorted(v for d, _, v in rows if d == days[5]) == [value] * 2
        assert [v for _, p, v in rows if p == "B"] == [value]
    assert month.split("/")[0] in os.listdir(path)


def _raises(*_):
    raise OSError("no connection")


def _fails_on_files(remove):
    def removed(spark, path):
        if path.endswith(".parquet"):
            raise OSError("no connection")
        remove(spark, path)
    return removed


def test_the_plan_of_a_replacement_reads_the_files_of_its_days(spark, tmp_table):
    path = tmp_table("raw")
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 20), dt.date(2024, 2, 3)]
    for d in days:
        for p in "AB":
            sinks.replace_plant_days(readings(spark, [(d, p, "O2_flue_gas", 1.0)]), path, TS)
    touched = spark.createDataFrame([("2024-01", "A", days[1])], "reading_month string, plant_id string, reading_date date")
    files = sinks.files_of_days(spark, path, touched, days[1], days[1])
    assert len(files) == 1 and "reading_month=2024-01/plant_id=A" in files[0]
    held = spark.read.parquet(*files)
    assert [f.split("/")[-1] for f in held.inputFiles()] == [files[0].split("/")[-1]]
    assert [r["reading_date"] for r in held.collect()] == [days[1]]
    assert sinks.files_of_days(spark, path, touched.limit(0), days[0], days[0]) == []


def test_staging_goes_after_a_failed_load(spark, tmp_table):
    path = tmp_table("raw")
    day = dt.date(2024, 1, 1)
    sinks.replace_plant_days(readings(spark, [(day, "A", "O2_flue_gas", 1.0)]), path, TS)
    bad = spark.createDataFrame([(day, "A", None, 2.0, "pct")],
                                "reading_date date, plant_id string, sensor string, value double, unit_label string")
    with pytest.raises(Exception, match="NOT NULL violated"):
        sinks.replace_plant_days(bad, path, TS)
    assert not os.path.exists(path + "_staging") or os.listdir(path + "_staging") == []
    assert [r["value"] for r in _table(spark, path).collect()] == [1.0]


def test_a_repeated_run_leaves_one_log_record(spark, tmp_table):
    log = tmp_table("keyed_log")
    later = dt.datetime(2024, 2, 1, 6)
    for at, rows, status in ((TS, 1, "failed"), (later, 5, "success"), (TS, 7, "success")):
        sinks.log_run(spark, log, at, "dag", "src", rows, status)
    sinks.log_run(spark, log, TS, "dag", "other", 3, "success")
    got = sorted((r["run_at"], r["source"], r["rows_loaded"], r["status"])
                 for r in readers.read_pipeline_log(spark, log).collect())
    assert got == sorted([(TS, "src", 7, "success"), (later, "src", 5, "success"), (TS, "other", 3, "success")])
    assert sorted(n for n in os.listdir(log)) == sorted({f"log_month={t:%Y-%m}" for t in (TS, later)})


def test_a_load_split_over_tasks_has_the_files_of_an_unsplit_one(spark, tmp_table):
    """Few shuffle partitions, far above the size AQE aims at: each part must not write into all directories."""
    path, months, plants = tmp_table("raw"), 12, 10
    day = F.expr(f"add_months(date'2024-01-01', cast(id % {months} as int))")
    plant = F.concat(F.lit("P"), (F.col("id") / months % plants).cast("int").cast("string"))
    rows = spark.range(0, 120_000, numPartitions=8).select(
        day.alias("reading_date"), plant.alias("plant_id"), F.lit("O2_flue_gas").alias("sensor"),
        F.rand(1).alias("value"), F.lit("pct").alias("unit_label"))
    conf = {"spark.sql.shuffle.partitions": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        assert sinks.replace_plant_days(rows, path, TS) == 120_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files = [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    assert months * plants <= len(files) <= 1.5 * months * plants
    stored = _table(spark, path)
    assert stored.count() == 120_000
    assert stored.groupBy("plant_id", "reading_date").count().where("count = 1000").count() == months * plants
