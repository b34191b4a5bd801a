"""Ingestion rules: anomaly flags, country CSV, benchmarks, air-quality JSON."""

import datetime as dt
import json

from pyspark.sql import functions as F

from cinderframe import config as C
from cinderframe.operators import ingest, staging
from cinderframe.sources import readers

AS_OF = dt.date(2024, 1, 10)


def test_flag_anomalies_strict_limits(spark):
    d = dt.date(2024, 1, 2)
    rows = [(d, "P", "CO2_emission_intensity", v, "u") for v in (599.9, 600.0, 800.0, 800.1)]
    rows.append((d, "P", "mystery", 1.0, "u"))
    df = spark.createDataFrame(rows, "reading_date date, plant_id string, sensor string, value double, unit_label string")
    got = {(r["sensor"], r["value"]): r["is_anomaly"] for r in ingest.flag_anomalies(df).collect()}
    assert got[("CO2_emission_intensity", 599.9)] is True
    assert got[("CO2_emission_intensity", 600.0)] is False
    assert got[("CO2_emission_intensity", 800.0)] is False
    assert got[("CO2_emission_intensity", 800.1)] is True
    assert got[("mystery", 1.0)] is None


def test_country_csv_cleaning(spark, tmp_table):
    path = tmp_table("csv")
    with_open = ["country,year,co2,co2_per_capita,extra",
                 "Thailand,2022,0.28,3.9,x",
                 "World,2009,37.1,4.7,x",         # before the cut-off year
                 ",2022,1.0,1.0,x",                # no country
                 "China,2021,not-a-number,8.1,x",  # malformed -> NULL
                 "Laos,,1.0,1.0,x"]                # no year
    import os
    os.makedirs(path)
    with open(f"{path}/part.csv", "w") as f:
        f.write("\n".join(with_open) + "\n")
    out = ingest.clean_owid(readers.read_country_csv(spark, path)).orderBy("country").collect()
    assert [(r["country"], r["year"]) for r in out] == [("China", 2021), ("Thailand", 2022)]
    china, thai = out
    assert china["co2_total_mt"] is None
    assert thai["co2_total_mt"] == 0.28 and thai["co2_per_capita"] == 3.9
    assert thai["cement_co2"] is None and thai["energy_co2"] is None  # absent columns


def test_stg_owid_share_and_defaults(spark):
    rows = [(2020, "A", 1.0, 10.0, 2.5, None), (2020, "B", 1.0, 0.0, 1.0, 1.0),
            (2021, "C", None, 4.0, None, 1.0), (2021, None, 1.0, 4.0, 1.0, 1.0)]
    raw = spark.createDataFrame(rows, "year int, country string, co2_per_capita double, "
                                      "co2_total_mt double, cement_co2 double, energy_co2 double")
    raw = raw.withColumn("ingested_at", F.lit(None).cast("timestamp"))
    out = {r["country"]: r for r in staging.stg_owid_emissions(raw).collect()}
    assert set(out) == {"A", "C"}
    assert out["A"]["cement_co2_share_pct"] == 25.0 and out["A"]["energy_co2_mt"] == 0.0
    assert out["C"]["cement_co2_mt"] == 0.0 and out["C"]["cement_co2_share_pct"] is None
    assert out["C"]["co2_per_capita"] == 0.0
    ordered = [(r["country"], r["year"]) for r in staging.order_countries(staging.stg_owid_emissions(raw)).collect()]
    assert ordered == [("A", 2020), ("C", 2021)]


def test_benchmark_pivot(spark):
    iea = staging.stg_iea_benchmarks(ingest.benchmark_rows(spark, run_ts=dt.datetime(2024, 1, 1)))
    rows = {(r["year"], r["region"]): r for r in iea.collect()}
    assert len(rows) == 7
    assert rows[(2022, "Global")]["co2_intensity_kg_per_t"] == 620.0
    assert rows[(2022, "Global")]["heat_consumption_mj_per_t"] == 3300.0
    assert rows[(2022, "Thailand")]["heat_consumption_mj_per_t"] is None
    assert rows[(2030, C.OWN_TARGET_REGION)]["co2_intensity_kg_per_t"] == 650.0
    ordered = [r["region"] for r in staging.order_benchmarks(iea.unionByName(
        iea.limit(1).withColumn("region", F.lit(None).cast("string")))).collect()]
    assert ordered[-1] is None and ordered[0] == "ASEAN"


def _records(spark, recs):
    return spark.createDataFrame([(json.dumps(r) if not isinstance(r, str) else r,) for r in recs], "body string")


def test_air_quality_shapes(spark):
    recs = [
        {"date": {"utc": "2024-01-05T00:00:00Z"}, "location": "L", "country": "TH", "parameter": "no2", "value": 12.5, "unit": "ppm"},
        {"date": "2024-1-6", "parameter": "pm25", "value": 3},
        {"date": "not-a-date", "parameter": "so2", "value": 1},
        {"date": {"local": "2024-01-05"}, "parameter": "so2", "value": 1},
        {"date": "2024-01-07", "parameter": "so2", "value": None, "location": None},
        {"date": "2024-01-08", "parameter": "so2", "value": "abc"},
        {"date": "2024-01-09", "value": ""},
    ]
    out = ingest.parse_air_quality(_records(spark, recs)).orderBy("measurement_date").collect()
    assert [r["measurement_date"] for r in out] == [dt.date(2024, 1, 5), dt.date(2024, 1, 6),
                                                    dt.date(2024, 1, 7), dt.date(2024, 1, 9)]
    first, second, third, fourth = out
    assert (first["location"], first["unit"], first["value"]) == ("L", "ppm", 12.5)
    assert (second["location"], second["country"], second["unit"]) == (
        C.OPENAQ_DEFAULT_LOCATION, C.OPENAQ_DEFAULT_COUNTRY, C.OPENAQ_DEFAULT_UNIT)
    assert third["value"] == 0.0 and third["location"] == C.OPENAQ_DEFAULT_LOCATION
    assert fourth["parameter"] == "" and fourth["value"] == 0.0


def test_air_quality_documents_reader(spark, tmp_table):
    import os
    path = tmp_table("docs")
    os.makedirs(path)
    for i in range(3):
        doc = {"meta": {"page": i}, "results": [
            {"date": {"utc": f"2024-01-0{i + 1}T00:00:00Z"}, "parameter": "no2", "value": i},
            {"date": f"2024-01-0{i + 1}", "parameter": "pm25", "value": i + 0.5},
        ]}
        with open(f"{path}/resp_{i}.json", "w") as f:
            json.dump(doc, f)
    parsed = ingest.parse_air_quality(readers.read_air_quality_documents(spark, path))
    assert parsed.count() == 6
    assert parsed.where(F.col("parameter") == "pm25").agg(F.sum("value")).first()[0] == 4.5


def test_documents_of_any_line_format(spark, tmp_table):
    import os

    import pytest
    path = tmp_table("some docs")
    os.makedirs(path)
    record = {"date": "2024-01-01", "parameter": "no2", "value": 1.5}
    doc = {"meta": {"page": 1}, "results": [record, {**record, "date": {"utc": "2024-01-02T00:00:00Z"}}]}
    for name, text in (("a 1.json", json.dumps(doc, indent=2)), ("b.json", json.dumps(doc) + "\n" + json.dumps(doc)),
                       ("c.json", json.dumps(doc, indent=1) + "\n" + json.dumps(doc, indent=1)),
                       ("d.json", json.dumps({"results": []}) + "\n\n")):
        with open(f"{path}/{name}", "w") as f:
            f.write(text)
    assert ingest.parse_air_quality(readers.read_air_quality_documents(spark, path)).count() == 10
    with open(f"{path}/e.json", "w") as f:
        f.write(json.dumps(doc) + "\n" + json.dumps(doc)[:-9])
    with pytest.raises(Exception, match="doesn't parse"):
        readers.read_air_quality_documents(spark, path).collect()


def test_country_csv_headers_and_line_breaks(spark, tmp_table):
    import os

    import pytest
    path = tmp_table("some csv")
    os.makedirs(path)
    for name, text in (("a.csv", "\ufeffCountry, Year ,CO2\nChina,2021,1\n\n"),
                       ("b 1.csv", 'year,note,country\r\n2022,"two\r\nlines, ""x""",Laos\r\n2023,,"Viet\nNam"\r\n')):
        with open(f"{path}/{name}", "w", newline="") as f:
            f.write(text)
    got = sorted((r.country, r.year, r.co2) for r in readers.read_country_csv(spark, path).collect())
    assert got == [("China", "2021", "1"), ("Laos", "2022", None), ("Viet\nNam", "2023", None)]
    with open(f"{path}/c.csv", "w") as f:
        f.write("nation,year\nChad,2021\n")
    with pytest.raises(Exception, match="no header line"):
        readers.read_country_csv(spark, path).collect()


def test_recent_air_quality(spark):
    rows = [(AS_OF - dt.timedelta(days=k), "L", "TH", p, float(k), "u")
            for k in range(12) for p in ("no2", "pm25", "co")]
    df = spark.createDataFrame(rows, "measurement_date date, location string, country string, "
                                     "parameter string, value double, unit string")
    out = ingest.recent_air_quality(df, AS_OF).collect()
    assert len(out) == 16  # days 0..7 inclusive, two matching parameters
    assert {r["parameter"] for r in out} == {"no2", "pm25"}


def _plan(df):
    return df._jdf.queryExecution().toString()


def test_odd_files_are_joined_not_listed(spark, tmp_table):
    """Files with torn lines are found by a join and read as streams of lines, in order."""
    import os

    import pytest
    path = tmp_table("countries")
    os.makedirs(path)
    for i in range(60):
        with open(f"{path}/torn {i}.csv", "w", newline="") as f:
            f.write('\ufeffYear, country ,co2\n')
            f.writelines(f'20{k:02d},"A\n{i}, ""{k}""",{k}\n' for k in range(40))
    with open(f"{path}/even.csv", "w") as f:
        f.write("country,co2,year\nB,1,2001\n")
    rows = readers.read_country_csv(spark, path)
    plan = _plan(rows)
    assert "torn%20" not in plan and "torn 1" not in plan and "In(file" not in plan
    got = sorted((r["country"], r["year"], r["co2"]) for r in rows.collect())
    assert got == sorted([("B", "2001", "1")] + [
        (f'A\n{i}, "{k}"', f"20{k:02d}", str(k)) for i in range(60) for k in range(40)])

    path = tmp_table("documents")
    os.makedirs(path)
    for i in range(40):
        doc = {"results": [{"date": "2024-01-01", "parameter": 'a "]} [{ b\\', "value": 100 * i + k} for k in range(5)]}
        with open(f"{path}/odd {i}.json", "w") as f:
            f.write(json.dumps(doc, indent=1) + "\n\n" + json.dumps([doc, doc], indent=2) + json.dumps(doc))
    rows = readers.read_air_quality_documents(spark, path)
    plan = _plan(rows)
    assert "odd%20" not in plan and "odd 1" not in plan
    values = sorted(json.loads(r["body"])["value"] for r in rows.collect())
    assert values == sorted(100 * i + k for i in range(40) for k in range(5) for _ in range(4))
    for bad in ('{"results": [\n{"value": 1}\n', '{"results": []}\noops', '{"results":\n 5}', ']\n{"results": []}'):
        with open(f"{path}/bad.json", "w") as f:
            f.write(bad)
        with pytest.raises(Exception, match="bad.json holds a document"):
            readers.read_air_quality_documents(spark, path).collect()
