"""Readers for the raw tables and for landed source files.

Tables are Parquet with an explicit schema, so scans never infer types and filters and
column selections reach the files (``PushedFilters`` / ``ReadSchema``).  The sensor table
has a directory per month and plant with files sorted by day, so plant and month predicates
prune directories and date predicates skip row groups.
"""

from __future__ import annotations

import csv
import datetime as dt
import itertools
import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import schemas
from ..operators import sinks


def read_sensor_readings(spark: SparkSession, path: str, since: dt.date | None = None) -> DataFrame:
    """Readings, all or from day ``since`` on (months before it aren't listed or read)."""
    stored = spark.read.schema(schemas.STORED_SENSOR_READINGS).parquet(path)
    if since is not None:
        stored = stored.where((F.col("reading_month") >= since.strftime("%Y-%m"))
                              & (F.col("reading_date") >= F.lit(since)))
    return stored.select(*schemas.RAW_SENSOR_READINGS.names)


def read_stored_sensor(spark: SparkSession, path: str) -> DataFrame:
    """Readings with the month of their directory."""
    return spark.read.schema(schemas.STORED_SENSOR_READINGS).parquet(path)


def months_of(spark: SparkSession, path: str) -> list[str]:
    """The months that a table of plant-days has directories of."""
    return sorted(n.partition("=")[2] for n in sinks.list_names(spark, path) if n.startswith("reading_month="))


def read_months(spark: SparkSession, path: str, spans: list[tuple[str, str]] | None,
                schema: StructType | None = None) -> DataFrame:
    """A stored table of plant-days, all or the months of some stretches (first, last), with
    ``reading_month``.  Only the directories of these months are listed, and with a schema no footer is
    read to infer one."""
    reader = spark.read.option("basePath", path)
    if schema is not None:
        reader = reader.schema(StructType([*schema.fields, StructField("reading_month", StringType())]))
    if spans is None:
        return reader.parquet(path)
    wanted = [m for m in months_of(spark, path) if any(a <= m <= b for a, b in spans)]
    if not wanted:
        return reader.parquet(path).where(F.lit(False))
    return reader.parquet(*[f"{path}/reading_month={m}" for m in wanted])


def read_plant_days(spark: SparkSession, path: str) -> DataFrame:
    """A stored table of plant-days (daily aggregates, scopes, marts), by months on disk."""
    return spark.read.parquet(path).drop("reading_month")


def read_owid_emissions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.RAW_OWID_EMISSIONS).parquet(path)


def read_iea_benchmarks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.RAW_IEA_BENCHMARKS).parquet(path)


def read_openaq_readings(spark: SparkSession, path: str) -> DataFrame:
    """Air-quality rows of all loads (a directory ``load_id=`` each)."""
    return spark.read.schema(schemas.RAW_OPENAQ_READINGS).option("recursiveFileLookup", True).parquet(path)


def read_pipeline_log(spark: SparkSession, path: str) -> DataFrame:
    """The audit log's records (a directory for each run, in one for each month)."""
    return spark.read.schema(schemas.PIPELINE_LOG).option("recursiveFileLookup", True).parquet(path)


COUNTRY_COLUMNS = ["country", "year", "co2", "co2_per_capita", "cement_co2", "energy_co2"]
_CSV_FIELD = r'(?:^|,)("(?:[^"]|"")*"|[^,]*)'


_MARK = "\ufeff"  # byte-order mark
RECORDS = 1024     # of a batch that leaves an ordered reader


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, at, value): the lines of all files; (start, at) is a line's place in its file.

    A split of a file is read in order by one task, so numbers that grow within a task put its lines in order."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"), "value")


def _read_in_order(lines: DataFrame, odd: DataFrame, reader: Callable, schema: str) -> DataFrame:
    """What ``reader`` makes of the lines of the files in ``odd(file)``, each file's in order.

    A file goes through one task as a stream of lines: its records, never the file, are held."""
    return (lines.join(odd, "file", "left_semi").repartition("file").sortWithinPartitions("file", "start", "at")
            .select("file", "value").mapInArrow(reader, schema))


def _by_file(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Iterator[str]]]:
    """(file, its lines) of rows that are in order."""
    pairs = (pair for batch in batches for pair in zip(*(c.to_pylist() for c in batch.columns)))
    for file, rows in itertools.groupby(pairs, key=lambda pair: pair[0]):
        yield file, (value.removeprefix(_MARK) for _, value in rows)


def _csv_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for file, lines in _by_file(batches):
        records = (r for r in csv.reader(f"{line}\n" for line in lines) if any(x.strip() for x in r))
        while some := list(itertools.islice(records, RECORDS)):
            yield pa.RecordBatch.from_arrays([pa.array([file] * len(some), pa.string()),
                                              pa.array(some, pa.list_(pa.string()))], names=["file", "fields"])


_JSON_TOKEN = re.compile(r'"(?:\\.|[^"\\])*"|[\[\]{}]')


def _texts(lines: Iterator[str]) -> Iterator[str]:
    """Lines joined until their brackets are closed: one or more whole documents each."""
    open_, depth = [], 0
    for line in lines:
        open_.append(line)
        for token in _JSON_TOKEN.findall(line):
            depth += (token in "[{") - (token in "]}")
        if depth <= 0:
            yield "\n".join(open_)
            open_, depth = [], 0
    yield "\n".join(open_)


def _json_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of all documents, whatever their line breaks."""
    decoder = json.JSONDecoder()
    for file, lines in _by_file(batches):
        for text in map(str.strip, _texts(lines)):
            at, bodies = 0, []
            while at < len(text):
                try:
                    found, at = decoder.raw_decode(text, at)
                except json.JSONDecodeError as e:
                    raise ValueError(f"{file} holds a document that doesn't parse: {e}") from e
                for document in found if isinstance(found, list) else [found]:
                    if not isinstance(document, dict) or not isinstance(document.get("results") or [], list):
                        raise ValueError(f"{file} holds a document without a list of results")
                    bodies += [json.dumps(r, ensure_ascii=False) for r in document.get("results") or []]
                while at < len(text) and text[at].isspace():
                    at += 1
            if bodies:
                yield pa.RecordBatch.from_arrays([pa.array(bodies, pa.string())], names=["body"])


def read_country_csv(spark: SparkSession, path: str) -> DataFrame:
    """Landed country-emissions CSV files, columns matched by name.

    Every file has its own header line (the one that names ``country`` and ``year``, in any case,
    with spaces around or a byte-order mark); its order holds for that file alone.  A file with
    rows but no header line fails the load.  Fields may be quoted; the lines of files with line breaks
    in quoted fields are read in order by one task a file (such a break becomes one line feed), those of
    the others anywhere.  Which files these are is a join, not a list in the plan.  Every column is text, an empty
    field NULL; typing is done by ``try_cast`` in the cleaning step, so a malformed number
    becomes NULL instead of failing the load.  Columns that a file lacks are NULL, others are
    ignored."""
    quoted = F.lit(_CSV_FIELD)
    read = _lines(spark, path)
    text = read.select("file", F.regexp_replace("value", f"^{_MARK}", "").alias("value"))
    torn = text.where(F.regexp_count("value", F.lit('"')) % 2 == 1).select("file").distinct()
    any_torn = not torn.isEmpty()
    if any_torn:
        text = text.join(torn, "file", "left_anti")
    lines = text.where(F.trim("value") != "").select(
        "file", F.transform(F.regexp_extract_all(F.regexp_replace("value", "\r$", ""), quoted, F.lit(1)),
                    lambda x: F.when(x.startswith('"'), F.replace(
                        F.substr(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"')))
                    .otherwise(x)).alias("fields"))
    if any_torn:
        lines = lines.unionByName(_read_in_order(read, torn, _csv_records, "file string, fields array<string>"))
    lines = lines.withColumn("names", F.transform("fields", lambda x: F.lower(F.trim(
        F.regexp_replace(x, _MARK, "")))))
    is_header = F.array_contains("names", "country") & F.array_contains("names", "year")
    headers = lines.where(is_header).groupBy("file").agg(F.first("names").alias("names"))
    rows = lines.where(~is_header).drop("names").join(headers, "file", "left").withColumn(
        "names", F.coalesce("names", F.raise_error(F.concat(
            F.lit("no header line with country and year: "), "file")).cast("array<string>")))

    def named(name: str) -> F.Column:
        at = F.array_position("names", name).cast("int")
        return F.nullif(F.when(at > 0, F.get("fields", at - 1)), F.lit("")).alias(name)

    return rows.select(*[named(c) for c in COUNTRY_COLUMNS])


def read_air_quality_documents(spark: SparkSession, path: str) -> DataFrame:
    """Landed API responses, JSON documents ``{"results": [record, ...]}``.

    Files of a document per line are split over tasks; files with a line that isn't a document
    are read in order, as documents formatted over several lines, by one task a file that holds a
    document at a time.  One that doesn't parse then fails the load.  A document is exploded into one ``body`` string per record.  Records keep their raw JSON so that fields with two shapes (``date`` as object or
    string) are resolved by path, not by schema inference."""
    parsed = F.from_json("value", "struct<results: array<string>, _corrupt: string>",
                         {"columnNameOfCorruptRecord": "_corrupt"})
    read = _lines(spark, path)
    lines = read.select("file", "value").where(F.trim("value") != "").withColumn("parsed", parsed)
    odd = lines.where(F.col("parsed").isNull() | F.col("parsed._corrupt").isNotNull()
                      | F.col("parsed.results").isNull()).select("file").distinct()
    records = F.explode("parsed.results").alias("body")
    if odd.isEmpty():
        return lines.select(records)
    return lines.join(odd, "file", "left_anti").select(records).unionByName(
        _read_in_order(read, odd, _json_records, "body string"))


def read_air_quality_records(spark: SparkSession, path: str) -> DataFrame:
    """Landed records as JSON lines (one record per line), splittable for large drops."""
    return spark.read.text(path).select(F.col("value").alias("body"))
