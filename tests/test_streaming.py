"""Structured Streaming ingestion: exactly-once file pickup, newest delivery wins."""

import datetime as dt
import os

import pytest

from cinderframe.sources import readers
from cinderframe.streaming import sensor_stream

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def _land(spark, path, delivery, rows, files=1):
    (spark.createDataFrame(rows, sensor_stream.LANDED_SENSOR_SCHEMA).repartition(files)
     .write.mode("append").parquet(f"{path}/delivery={delivery}"))


def _values(spark, table):
    return sorted((r["reading_date"], r["plant_id"], r["sensor"], r["value"], r["is_anomaly"])
                  for r in readers.read_sensor_readings(spark, table).collect())


def test_stream_replaces_plant_days(spark, tmp_table):
    landing, table, ckpt = tmp_table("landing"), tmp_table("table"), tmp_table("ckpt")
    _land(spark, landing, "1", [(D1, "A", "O2_flue_gas", 1.0, "pct"), (D1, "B", "O2_flue_gas", 1.0, "pct"),
                                (D1, "A", "dust_emission", 30.0, "mg")])
    # a later delivery of the same plant-day, in the same micro-batch
    _land(spark, landing, "2", [(D1, "A", "O2_flue_gas", 2.0, "pct")])
    sensor_stream.run_available(spark, landing, table, ckpt)
    assert _values(spark, table) == [(D1, "A", "O2_flue_gas", 2.0, False), (D1, "B", "O2_flue_gas", 1.0, False)]

    # A second run loads only the new delivery.
    _land(spark, landing, "3", [(D2, "A", "dust_emission", 30.0, "mg")])
    sensor_stream.run_available(spark, landing, table, ckpt)
    assert _values(spark, table) == [(D1, "A", "O2_flue_gas", 2.0, False), (D1, "B", "O2_flue_gas", 1.0, False),
                                     (D2, "A", "dust_emission", 30.0, True)]


def test_a_delivery_of_many_files_arrives_whole(spark, tmp_table):
    landing, table, ckpt = tmp_table("landing"), tmp_table("table"), tmp_table("ckpt")
    rows = [(D1, "A", "O2_flue_gas", float(i), "pct") for i in range(200)]
    _land(spark, landing, "1", rows[:120], files=4)
    sensor_stream.run_available(spark, landing, table, ckpt)
    assert len(_values(spark, table)) == 120
    # the rest of the same delivery lands after the first trigger, with an old time stamp
    _land(spark, landing, "1", rows[120:], files=4)
    for f in os.listdir(f"{landing}/delivery=1"):
        os.utime(f"{landing}/delivery=1/{f}", (10**9, 10**9))
    sensor_stream.run_available(spark, landing, table, ckpt)
    assert [v for _, _, _, v, _ in _values(spark, table)] == [float(i) for i in range(200)]


def test_a_late_file_of_an_older_delivery_keeps_the_correction(spark, tmp_table):
    landing, table, ckpt = tmp_table("landing"), tmp_table("table"), tmp_table("ckpt")
    _land(spark, landing, "2024-01-01 10:00", [(D1, "A", "O2_flue_gas", 1.0, "pct")])
    _land(spark, landing, "2024-01-01 11:00", [(D1, "A", "O2_flue_gas", 2.0, "pct")])
    sensor_stream.run_available(spark, landing, table, ckpt)
    _land(spark, landing, "2024-01-01 10:00", [(D1, "A", "O2_flue_gas", 3.0, "pct"),
                                               (D2, "A", "O2_flue_gas", 4.0, "pct")])
    sensor_stream.run_available(spark, landing, table, ckpt)
    assert _values(spark, table) == [(D1, "A", "O2_flue_gas", 2.0, False), (D2, "A", "O2_flue_gas", 4.0, False)]


def test_files_outside_a_delivery_folder_load(spark, tmp_table):
    landing, table, ckpt = tmp_table("landing"), tmp_table("table"), tmp_table("ckpt")
    _land(spark, landing, "1", [(D1, "A", "O2_flue_gas", 1.0, "pct")])
    loose = [(D1, "A", "O2_flue_gas", 9.0, "pct"), (D2, "B", "O2_flue_gas", 5.0, "pct")]
    (spark.createDataFrame(loose, sensor_stream.LANDED_SENSOR_SCHEMA).coalesce(1)
     .write.mode("append").parquet(landing))
    sensor_stream.run_available(spark, landing, table, ckpt)
    want = [(D1, "A", "O2_flue_gas", 1.0, False), (D2, "B", "O2_flue_gas", 5.0, False)]
    assert _values(spark, table) == want
    (spark.createDataFrame(loose[:1], sensor_stream.LANDED_SENSOR_SCHEMA).coalesce(1)
     .write.parquet(f"{landing}/box"))
    sensor_stream.run_available(spark, landing, table, ckpt)
    assert _values(spark, table) == want


def test_incremental_transform_equals_full(spark, tmp_table):
    from pyspark.sql import functions as F

    from cinderframe.plans import pipeline
    from conftest import readings

    wh = pipeline.Warehouse(tmp_table("wh"))
    run_ts = dt.datetime(2024, 3, 1)
    days = [D1 + dt.timedelta(days=k) for k in range(75)]
    rows = [(d, p, s, v + k) for k, d in enumerate(days) for p in ("A", "B")
            for s, v in (("CO2_emission_intensity", 650.0), ("specific_heat_consumption", 700.0),
                         ("O2_flue_gas", 2.0))]
    pipeline.ingest_sensor_batch(spark, wh, readings(spark, rows).drop("ingested_at"), run_ts)
    pipeline.ingest_benchmarks(spark, wh, run_ts)
    spark.createDataFrame([(2020, "X", 1.0, 2.0, 0.1, 0.2, run_ts)],
                          "year int, country string, co2_per_capita double, co2_total_mt double, "
                          "cement_co2 double, energy_co2 double, ingested_at timestamp") \
        .write.parquet(wh.path("raw_owid_emissions"))
    pipeline.transform(spark, wh, run_ts)

    # A correction of the last 3 days of plant A, then an incremental run.
    fix = [(d, "A", "CO2_emission_intensity", 900.0) for d in days[-3:]]
    pipeline.ingest_sensor_batch(spark, wh, readings(spark, fix).drop("ingested_at"), run_ts)
    later = dt.datetime(2024, 3, 9)
    january = wh.path("mart_co2_intensity/reading_month=2024-01")
    before = {f: os.stat(f"{january}/{f}").st_mtime_ns for f in os.listdir(january)}
    res = pipeline.transform(spark, wh, later, since=days[-3])
    assert {f: os.stat(f"{january}/{f}").st_mtime_ns for f in os.listdir(january)} == before
    assert res.rows["mart_co2_intensity"] == 30  # the plant-days of March
    incremental = readers.read_plant_days(spark, wh.path("mart_co2_intensity")).drop("updated_at").collect()
    from cinderframe.operators import quality
    scanned = quality.freshness(readers.read_sensor_readings(spark, wh.path("raw_sensor_readings")),
                                "raw_sensor_readings", later).first()
    stored = spark.read.parquet(wh.path("source_freshness")).first()
    assert (stored["max_loaded_at"], stored["status"]) == (scanned["max_loaded_at"], scanned["status"])
    assert stored["status"] == "error"  # newest load 8 days before the run

    # Tests cover the whole table in an incremental run too: a reading of an earlier day that
    # lost its sensor (written past the loader) is still reported.
    spark.createDataFrame([(days[1], None, 1.0)], "reading_date date, sensor string, value double").write.parquet(
        wh.path("raw_sensor_readings/reading_month=2024-01/plant_id=A"), mode="append")
    pipeline.transform(spark, wh, later, since=days[-3])
    tests = {r["test_name"]: r["status"] for r in spark.read.parquet(wh.path("data_test_results")).collect()}
    assert tests["not_null_raw_sensor_readings_sensor"] == "fail"

    pipeline.transform(spark, wh, run_ts, full=True)  # full rebuild for reference
    full = readers.read_plant_days(spark, wh.path("mart_co2_intensity")).drop("updated_at").collect()
    assert sorted(map(tuple, incremental)) == sorted(map(tuple, full))
    last = [r for r in full if r["plant_id"] == "A" and r["reading_date"] == days[-1]][0]
    assert last["scope1_kg_per_t"] == 900.0 and last["reading_count"] == 1
    assert readers.read_plant_days(spark, wh.path("mart_co2_intensity")).where(F.col("plant_id") == "B").count() == 75


def test_months_that_lose_all_rows_are_dropped(spark, tmp_table):
    from cinderframe.operators import sinks
    path = tmp_table("t")

    def rows(*days):
        return spark.createDataFrame([(d, "A", 1) for d in days], "reading_date date, plant_id string, v int")

    assert sinks.write_plant_days(rows(D1, dt.date(2024, 2, 1), dt.date(2024, 3, 1)), path) == 3
    assert sinks.write_plant_days(rows(dt.date(2024, 2, 5)), path, dt.date(2024, 2, 1)) == 1
    got = sorted(r["reading_date"] for r in readers.read_plant_days(spark, path).collect())
    assert got == [D1, dt.date(2024, 2, 5)]


def test_air_quality_stream_appends_exactly_once(spark, tmp_table):
    import json
    import os

    from cinderframe.streaming import air_quality_stream
    landing, table, ckpt = tmp_table("aq_landing"), tmp_table("aq_table"), tmp_table("aq_ckpt")
    os.makedirs(landing)

    def land(name, recs):
        with open(os.path.join(landing, name), "w") as f:
            f.write("\n".join(json.dumps(r) for r in recs) + "\n")

    land("a.json", [{"date": "2024-01-05", "parameter": "no2", "value": 1.5},
                    {"date": "bad", "parameter": "no2", "value": 2.0}])
    air_quality_stream.run_available(spark, landing, table, ckpt)
    assert readers.read_openaq_readings(spark, table).count() == 1
    air_quality_stream.run_available(spark, landing, table, ckpt)   # nothing new: no append
    assert readers.read_openaq_readings(spark, table).count() == 1
    land("b.json", [{"date": {"utc": "2024-01-06T00:00:00Z"}, "parameter": "so2"}])
    air_quality_stream.run_available(spark, landing, table, ckpt)
    rows = sorted((r["measurement_date"], r["parameter"], r["value"])
                  for r in readers.read_openaq_readings(spark, table).collect())
    assert rows == [(dt.date(2024, 1, 5), "no2", 1.5), (dt.date(2024, 1, 6), "so2", 0.0)]
    # batch and stream append to one table
    from cinderframe.operators import ingest, sinks
    batch = ingest.parse_air_quality(
        spark.createDataFrame([('{"date":"2024-01-07","parameter":"co","value":3}',)], "body string"),
        dt.datetime(2024, 1, 8))
    assert sinks.append_load(batch, table, "batch-1") == 1
    assert readers.read_openaq_readings(spark, table).count() == 3
    land("c.json", [{"date": "2024-01-08", "parameter": "no2", "value": 4}])
    air_quality_stream.run_available(spark, landing, table, ckpt)
    assert readers.read_openaq_readings(spark, table).count() == 4
    assert all(r["ingested_at"] is not None for r in readers.read_openaq_readings(spark, table).collect())


@pytest.mark.parametrize("column", ["reading_date", "plant_id", "sensor", "value"])
def test_a_null_key_fails_stream_and_batch_alike(spark, tmp_table, column):
    from cinderframe.operators import sinks
    good = (D1, "A", "O2_flue_gas", 1.0, "pct")
    names = sensor_stream.LANDED_SENSOR_SCHEMA.names
    bad = tuple(None if n == column else v for n, v in zip(names, (D1, "B", "O2_flue_gas", 2.0, "pct")))
    landing, table, ckpt = tmp_table("landing"), tmp_table("table"), tmp_table("ckpt")
    _land(spark, landing, "1", [good])
    sensor_stream.run_available(spark, landing, table, ckpt)
    # The newest delivery of a day holds the NULL, and so does an older one of the same batch.
    _land(spark, landing, "2", [(D2, "A", "O2_flue_gas", 5.0, "pct"), bad, bad])
    _land(spark, landing, "3", [(D2, "A", "O2_flue_gas", 6.0, "pct")])
    with pytest.raises(Exception, match=rf"NOT NULL violated: raw_sensor_readings\.{column} \(2 rows\)"):
        sensor_stream.run_available(spark, landing, table, ckpt)
    assert _values(spark, table) == [(D1, "A", "O2_flue_gas", 1.0, False)]
    batch = spark.createDataFrame([good, bad], sensor_stream.LANDED_SENSOR_SCHEMA)
    with pytest.raises(Exception, match=rf"NOT NULL violated: raw_sensor_readings\.{column}"):
        sinks.replace_plant_days(batch, table, dt.datetime(2024, 1, 1))
    assert _values(spark, table) == [(D1, "A", "O2_flue_gas", 1.0, False)]


def _files_read(df):
    return sorted(f.rsplit("/", 2)[-2] for f in df.inputFiles())


def test_a_micro_batch_reads_the_files_of_its_plant_days(spark, tmp_table, monkeypatch):
    landing, table, ckpt = tmp_table("landing"), tmp_table("table"), tmp_table("ckpt")
    read = []
    real = sensor_stream.landed_files

    def noted(spark, files):
        read.append(sorted(f.rsplit("/", 2)[-2] for f in files))
        return real(spark, files)

    monkeypatch.setattr(sensor_stream, "landed_files", noted)
    monkeypatch.setattr(sensor_stream, "landed", _only_streams(sensor_stream.landed))
    for k in range(4):  # a delivery a day, and one of another plant
        _land(spark, landing, f"2024-01-0{k + 1}", [(D1 + dt.timedelta(days=k), "A", "O2_flue_gas", float(k), "pct")])
    _land(spark, landing, "2024-01-01b", [(D1, "B", "O2_flue_gas", 7.0, "pct")])
    sensor_stream.run_available(spark, landing, table, ckpt)
    read.clear()
    _land(spark, landing, "2024-01-09", [(D2, "A", "O2_flue_gas", 9.0, "pct")])
    sensor_stream.run_available(spark, landing, table, ckpt)
    assert read == [["delivery=2024-01-09"]]  # not the delivery it replaces, nor other days
    read.clear()
    _land(spark, landing, "2024-01-02", [(D2, "A", "O2_flue_gas", 8.0, "pct"), (D1, "B", "O2_flue_gas", 8.0, "pct")])
    sensor_stream.run_available(spark, landing, table, ckpt)
    assert read == [["delivery=2024-01-02", "delivery=2024-01-09"]]
    assert [v for *_, v, _ in _values(spark, table)] == [0.0, 8.0, 9.0, 2.0, 3.0]
    # What the plan of such a batch scans are these files.
    index = sensor_stream.DeliveryIndex(spark, f"{table}_deliveries")
    days = spark.createDataFrame([(D2, "A")], "reading_date date, plant_id string")
    picked = index.newest(days, D2, D2)
    assert [r["delivery"] for r in picked.collect()] == ["2024-01-09"]
    assert _files_read(real(spark, [r["file"] for r in picked.collect()])) == ["delivery=2024-01-09"]


def _only_streams(landed):
    def checked(reader, path):
        assert "Stream" in type(reader).__name__, "a micro-batch listed all landed files"
        return landed(reader, path)
    return checked


def test_the_index_is_rewritten_without_older_deliveries(spark, tmp_table, monkeypatch):
    monkeypatch.setattr(sensor_stream, "INDEXED_BATCHES", 2)
    landing, table, ckpt = tmp_table("landing"), tmp_table("table"), tmp_table("ckpt")
    index = sensor_stream.DeliveryIndex(spark, f"{table}_deliveries")
    for k in range(5):
        _land(spark, landing, f"{k}", [(D1, "A", "O2_flue_gas", float(k), "pct"), (D2, "B", "O2_flue_gas", 1.0, "pct")])
        sensor_stream.run_available(spark, landing, table, ckpt)
        assert len(index.batches()) <= 3
    assert {r["delivery"] for r in index._rows().collect()} <= {"2", "3", "4"}
    _land(spark, landing, "3", [(D1, "A", "O2_flue_gas", 30.0, "pct")])  # late, older than the newest
    sensor_stream.run_available(spark, landing, table, ckpt)
    assert [v for *_, v, _ in _values(spark, table)] == [4.0, 1.0]
    # A replayed micro-batch records the same rows again.
    last = index.batches()[-1]
    before = sorted(map(tuple, index._rows().collect()))
    index.add(index._rows([last]), last)
    assert sorted(map(tuple, index._rows().collect())) == before


def test_a_table_from_before_the_index_takes_all_landed_files_once(spark, tmp_table):
    from cinderframe.operators import sinks
    landing, table, ckpt = tmp_table("landing"), tmp_table("table"), tmp_table("ckpt")
    _land(spark, landing, "1", [(D1, "A", "O2_flue_gas", 1.0, "pct")])
    _land(spark, landing, "2", [(D1, "A", "O2_flue_gas", 2.0, "pct")])
    sensor_stream.run_available(spark, landing, table, ckpt)
    sinks.remove_path(spark, f"{table}_deliveries")
    _land(spark, landing, "1", [(D1, "A", "O2_flue_gas", 3.0, "pct")])
    sensor_stream.run_available(spark, landing, table, ckpt)
    assert [v for *_, v, _ in _values(spark, table)] == [2.0]
