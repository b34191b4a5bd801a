"""Load rules and table writes (Parquet; Spark's commit protocol makes each write atomic
per job, so a lost executor only re-runs its tasks)."""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import re
import uuid
from functools import lru_cache, reduce
from operator import or_
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.timeutil import ts_lit

JOURNAL = "-swap.json"  # ends the names of journals of decided file swaps

# Directories of the sensor table: one per plant and month.
SENSOR_PARTITIONS = ["reading_month", "plant_id"]

TASK_ROWS = 4_000_000  # plant-days that one task writes

# Shuffle partitions, at least, that a load's plant-months are spread over.
PLANT_MONTH_PARTS = 1024

# Beside the sensor table: a folder of changed plant-months for each load that no run has taken in yet.
CHANGED_MONTHS = "reading_month string, plant_id string, first date, last date"
WHOLE = "whole-"  # begins the name of the mark that stands for all plant-months


def require_not_null(df: DataFrame, columns: list[str], table: str) -> DataFrame:
    """Enforce NOT NULL like the relational store: the write fails on a violating row.

    The check runs inside the write's own tasks (``raise_error``), so it costs no extra scan.
    """
    checked = []
    for c in df.columns:
        if c in columns:
            msg = F.lit(f"NOT NULL violated: {table}.{c}")
            checked.append(F.when(F.col(c).isNull(), F.raise_error(msg).cast(df.schema[c].dataType))
                           .otherwise(F.col(c)).alias(c))
        else:
            checked.append(F.col(c))
    return df.select(*checked)


def with_sensor_defaults(batch: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Column defaults of the raw sensor table: load time and ``is_anomaly = FALSE``."""
    out = batch
    if "ingested_at" not in out.columns:
        out = out.withColumn("ingested_at", F.lit(None).cast("timestamp"))
    if "is_anomaly" not in out.columns:
        out = out.withColumn("is_anomaly", F.lit(None).cast("boolean"))
    return out.select(
        "reading_date", "plant_id", "sensor", "value", "unit_label",
        F.coalesce(F.col("is_anomaly"), F.lit(False)).alias("is_anomaly"),
        F.coalesce(F.col("ingested_at").cast("timestamp"), ts_lit(run_ts))
        .alias("ingested_at"),
    )


@lru_cache(maxsize=4)
def _path_class(sc):
    return sc._jvm.org.apache.hadoop.fs.Path  # looked up once: each name is a call to the JVM


def _location(spark: SparkSession, path: str):
    """(file system, path) of a table location."""
    sc = spark.sparkContext
    hpath = _path_class(sc)(path)
    return hpath.getFileSystem(sc._jsc.hadoopConfiguration()), hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table location exists (a file-system metadata call, no data read).

    Only "not found" is False.  Any other trouble raises: a load that took a failing check for
    an empty table would overwrite it."""
    fs, hpath = _location(spark, path)
    return bool(fs.exists(hpath))


def plain_name(uri: str) -> str:
    """The path that ``_metadata.file_path`` or a file listing names: escapes of the URI undone."""
    return unquote(uri)


def plain_path(uri: str) -> str:
    """The same for a reader: characters that it would take for a pattern escaped."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", plain_name(uri))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it doesn't exist."""
    fs, hpath = _location(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(hpath)] if fs.exists(hpath) else []


def create_empty(spark: SparkSession, path: str) -> None:
    """An empty file as a mark, in one step of the file system."""
    fs, hpath = _location(spark, path)
    fs.create(hpath, True).close()


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a run's own staging folder once its data has been swapped in."""
    fs, hpath = _location(spark, path)
    fs.delete(hpath, True)


def _rename(spark: SparkSession, old: str, new: str) -> None:
    fs, source = _location(spark, old)
    if not fs.rename(source, _location(spark, new)[1]):
        raise RuntimeError(f"could not rename {old} to {new}")


def reading_month(day: str | Column = "reading_date") -> Column:
    return F.date_format(day, "yyyy-MM")


def _write_plant_months(df: DataFrame, path: str, obs: Observation | None = None, *more: Column) -> None:
    """Write rows into ``reading_month=/plant_id=`` directories, replacing only those present.

    Rows are rebalanced by directory (few files each; AQE splits a hot one over several
    tasks) and sorted by day and sensor inside, so date predicates skip row groups.  Each part of a split
    shuffle partition writes a file into every directory the partition holds, so directories are spread over many
    partitions, of which AQE puts small ones together: a large load has the files of a small one, not as many
    more as it has parts.  A row
    count (``n``) and ``more`` aggregates, if asked for, are observed in the final (write) stage: Spark
    applies each result partition's metrics once even when a lost executor forces earlier stages to re-run.
    """
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), PLANT_MONTH_PARTS)
    out = (df.withColumn("reading_month", reading_month())
           .hint("rebalance", parts, *SENSOR_PARTITIONS)
           .sortWithinPartitions(*SENSOR_PARTITIONS, "reading_date", "sensor"))
    if obs is not None:
        out = out.observe(obs, F.count(F.lit(1)).alias("n"), *more)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*SENSOR_PARTITIONS).parquet(path))


def _stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.STORED_SENSOR_READINGS).parquet(path)


def files_of_days(spark: SparkSession, path: str, days: DataFrame, first: dt.date, last: dt.date) -> list[str]:
    """The table's files that hold rows of ``days`` (reading_month, plant_id, reading_date), which lie
    between two dates.

    The join prunes to the days' directories, the dates to row groups (files are sorted by day); of the
    rest one column is read.  The list is what the load rewrites."""
    held = (_stored(spark, path).where(F.col("reading_date").between(F.lit(first), F.lit(last)))
            .select(*SENSOR_PARTITIONS, "reading_date", F.col("_metadata.file_path").alias("file"))
            .join(days, [*SENSOR_PARTITIONS, "reading_date"], "left_semi"))
    return [r[0] for r in held.select("file").distinct().collect()]


def _names_below(spark: SparkSession, path: str) -> list[str]:
    """Data files below a folder of plant-months, relative to it."""
    fs, hpath = _location(spark, path)
    found = spark.read.option("recursiveFileLookup", True).parquet(path).inputFiles()  # Spark's own listing
    base = unquote(fs.makeQualified(hpath).toUri().getPath()).rstrip("/") + "/"
    return [plain_name(f).partition(base)[2] for f in found]


def _commit_swap(spark: SparkSession, path: str, staging: str, old: list[str], changes: str) -> str:
    """Decide that the staged files take the place of the ``old`` ones: a journal that appears in one
    step of the file system.  Until then the table is as it was, from then on the swap will happen."""
    journal = f"{path}_staging/{uuid.uuid4().hex[:12]}{JOURNAL}"
    text = json.dumps({"staging": staging, "files": _names_below(spark, staging), "old": old, "changes": changes})
    fs, draft = _location(spark, f"{journal}.draft")
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    _rename(spark, f"{journal}.draft", journal)
    return journal


def _swap(spark: SparkSession, path: str, journal: str) -> None:
    """Carry out a journal, from wherever an earlier attempt got to."""
    fs, hpath = _location(spark, journal)
    data = fs.open(hpath)
    todo = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(data, "UTF-8"))
    data.close()
    at = _path_class(spark.sparkContext)
    for folder in sorted({name.rpartition("/")[0] for name in todo["files"]}):
        fs.mkdirs(at(f"{path}/{folder}"))
    for name in todo["files"]:
        new = at(f"{path}/{name}")
        if not fs.rename(at(f"{todo['staging']}/{name}"), new) and not fs.exists(new):
            raise RuntimeError(f"could not move {name} into {path}")
    for file in todo["old"]:
        remove_path(spark, plain_name(file))
    remove_path(spark, todo["staging"])
    # Last, so that a run which takes the changes in finds the rows; moved at most once.
    if todo.get("changes") and path_exists(spark, todo["changes"]):
        fs.mkdirs(at(changes_path(path)))
        _rename(spark, todo["changes"], f"{changes_path(path)}/{todo['changes'].rpartition('/')[2]}")
    remove_path(spark, journal)


def changes_path(path: str) -> str:
    return f"{path}_changes"


def pending_changes(spark: SparkSession, path: str) -> tuple[list[str], DataFrame | None]:
    """What loads changed in a sensor table and no run has taken in: the names of the records, and
    their (reading_month, plant_id, first, last); None if it is the whole table."""
    finish_swaps(spark, path)
    names = sorted(list_names(spark, changes_path(path)))
    if any(n.startswith(WHOLE) for n in names):
        return names, None
    schema = spark.read.schema(CHANGED_MONTHS)
    return names, (schema.parquet(*[f"{changes_path(path)}/{n}" for n in names]) if names
                   else spark.createDataFrame([], CHANGED_MONTHS))


def take_in_changes(spark: SparkSession, path: str, names: list[str]) -> None:
    """Drop records that a run has taken in.  One that fails before leaves them to the next."""
    for name in names:
        remove_path(spark, f"{changes_path(path)}/{name}")


def finish_swaps(spark: SparkSession, path: str) -> None:
    """Carry out what loads decided and a failure kept them from doing."""
    for name in list_names(spark, f"{path}_staging"):
        if name.endswith(JOURNAL):
            _swap(spark, path, f"{path}_staging/{name}")


def replace_plant_days(batch: DataFrame, path: str, run_ts: dt.datetime) -> int:
    """Idempotent load: the batch replaces every (reading_date, plant_id) it contains.

    The table has a directory per plant and month, with files sorted by day.  The batch is staged
    (in its place, if there is no table yet); the files that hold rows of its plant-days are found and
    read, what they hold besides is written with the batch into new files, and these take the place
    of the old ones.  Other files are neither read (but for the days in their footers) nor written, so
    a day costs the files it lies in, not its month.  Staging lives next to the table, on the same
    shared storage.  Returns the number of batch rows, counted while staging.

    New files are moved, not written again, once a journal has been put beside the table in one step:
    a failure before it leaves the table as it was, one after it is made good by the next load of the
    table (or by running this one again), which first carries out the journals it finds.  Its plant-months
    are left beside the table for the next run (``pending_changes``).  While files are
    being moved, for a few file-system calls, a reader may see old and new rows of these files together."""
    spark = batch.sparkSession
    rows = require_not_null(with_sensor_defaults(batch, run_ts),
                            schemas.NOT_NULL_COLUMNS["raw_sensor_readings"], "raw_sensor_readings")
    obs = Observation("loaded")
    if not path_exists(spark, path):
        create_empty(spark, f"{changes_path(path)}/{WHOLE}{uuid.uuid4().hex[:12]}")
        _write_plant_months(rows, path, obs)
        return int(obs.get.get("n", 0))
    finish_swaps(spark, path)
    run = f"{path}_staging/{uuid.uuid4().hex[:12]}"
    staging, months, changes = f"{run}-batch", f"{run}-files", f"{run}-changes"
    decided = None
    try:
        _write_plant_months(rows, staging, obs, F.min("reading_date").alias("first"),
                            F.max("reading_date").alias("last"))
        loaded = obs.get
        if not loaded.get("n"):
            return 0
        new = _stored(spark, staging)
        # The predicate on the month makes the key side selective for partition pruning.
        days = (new.where(F.col("reading_month") > "").select(*SENSOR_PARTITIONS, "reading_date").distinct())
        files = files_of_days(spark, path, days, loaded["first"], loaded["last"])
        if files:
            held = (spark.read.schema(schemas.STORED_SENSOR_READINGS).option("basePath", path)
                    .parquet(*map(plain_path, files)))
            new = held.join(days, [*SENSOR_PARTITIONS, "reading_date"], "left_anti").unionByName(new)
            _write_plant_months(new, months)
        (days.groupBy(*SENSOR_PARTITIONS).agg(F.min("reading_date").alias("first"), F.max("reading_date").alias("last"))
         .write.parquet(changes))
        decided = _commit_swap(spark, path, months if files else staging, files, changes)
        _swap(spark, path, decided)
        return int(loaded["n"])
    finally:
        # What a journal names goes with it.
        for folder in [staging, months, changes] if decided is None else [staging] if files else []:
            remove_path(spark, folder)


def overwrite_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> int:
    """Full refresh (truncate + insert) of a table; returns rows written.

    The new rows are written beside the table and swapped in by renaming, so there is a complete
    copy at every moment: a failure leaves the old rows at ``path`` or under the name in the
    error."""
    spark = df.sparkSession
    run = uuid.uuid4().hex[:12]
    obs = Observation("written")
    fresh, old = f"{path}__new-{run}", f"{path}__old-{run}"
    df.observe(obs, F.count(F.lit(1)).alias("n")).write.partitionBy(*partition_by).parquet(fresh)
    if path_exists(spark, path):
        _rename(spark, path, old)
        try:
            _rename(spark, fresh, path)
        except Exception as e:
            raise RuntimeError(f"refresh of {path} failed; its rows are in {old}") from e
        remove_path(spark, old)
    else:
        _rename(spark, fresh, path)
    return int(obs.get.get("n", 0))


def write_plant_days(df: DataFrame, path: str, since: dt.date | None = None) -> int:
    """Write a table of plant-days into ``reading_month=`` directories; returns rows written.

    Without ``since`` it is a full refresh.  With it, ``df`` has the plant-days from the first day
    of that month on, and only those months are replaced."""
    rows = df.withColumn("reading_month", reading_month())
    return write_months(rows, path, None if since is None else [(since.strftime("%Y-%m"), "9999-12")])


def write_months(rows: DataFrame, path: str, spans: list[tuple[str, str]] | None,
                 expected: int | None = None) -> int:
    """Write rows with a ``reading_month`` into a directory a month; returns rows written.

    ``spans`` are the stretches of months (first, last) that ``rows`` cover and replace: a month that
    they no longer have is dropped, others aren't touched.  None is a full refresh.  Repeating
    the call repairs a failed one.

    Rows are rebalanced by month, which puts many small months into one task that writes their files one
    after the other.  Where the caller knows about how many rows are ``expected``, months are spread over all
    tasks instead, each cut so that a month with all the rows still is ``TASK_ROWS`` a task."""
    spark = rows.sparkSession
    if expected is None:
        rows = rows.hint("rebalance", "reading_month")
    else:
        parts = 1 + expected // TASK_ROWS
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), parts)
        cut = F.pmod(F.xxhash64("plant_id"), F.lit(parts))
        rows = rows.repartition(tasks, "reading_month", *([cut] if parts > 1 else []))
    rows = rows.sortWithinPartitions("reading_month", "reading_date", "plant_id")
    if spans is None or not path_exists(spark, path):
        return overwrite_table(rows, path, ("reading_month",))
    obs = Observation("written")
    (rows.observe(obs, F.count(F.lit(1)).alias("n"), F.collect_set("reading_month").alias("months"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("reading_month").parquet(path))
    written = obs.get
    _drop_months(spark, path, "reading_month", lambda m: any(a <= m <= b for a, b in spans), written["months"])
    return int(written["n"])


def _drop_months(spark: SparkSession, path: str, column: str, covered, kept: list[str]) -> None:
    """Remove the covered directories of a table that a write left without rows."""
    for found in list_names(spark, path):
        name, _, value = found.partition("=")
        if name == column and covered(value) and value not in kept:
            remove_path(spark, f"{path}/{found}")


def _digest_parts(columns: list[str]) -> dict[str, Column]:
    """Aggregates that don't depend on the order of rows: their number, and sums and xors of two hashes.

    Hashes skip NULLs, so each column enters with a flag; the second hash has another order."""
    def row_hash(names: list[str]) -> Column:
        return F.xxhash64(*[x for c in names for x in (F.col(c).isNull(), F.col(c))])

    one, two = row_hash(columns), row_hash(columns[::-1])
    return {"n": F.count(F.lit(1)), "xor_1": F.bit_xor(one), "xor_2": F.bit_xor(two),
            "sum_1": F.sum(one.cast("decimal(20,0)")), "sum_2": F.sum(two.cast("decimal(20,0)"))}


def _digest(found: dict) -> str:
    values = [found.get(k) for k in ("n", "xor_1", "xor_2", "sum_1", "sum_2")]
    return hashlib.sha256(" ".join(str(v) for v in values).encode()).hexdigest()[:32]


def rows_digest(df: DataFrame) -> str:
    """A digest of a frame's rows, whatever their order; repeated rows count."""
    parts = _digest_parts(df.columns)
    return _digest(df.agg(*[c.alias(k) for k, c in parts.items()]).first().asDict())


def append_load(df: DataFrame, path: str, load_id: str | None = None) -> int:
    """Append a batch as a directory ``load_id=`` of its own; an empty batch writes nothing.

    Without an id the load is named by its rows (but for their load time, ``ingested_at``): a batch that
    is loaded again, by a retried run or a replayed micro-batch, leaves one copy whoever loads it.  Its rows
    are written beside the table, digested in the same pass and moved in as one; a load that is
    there already stays.  With an id the directory is overwritten as a whole."""
    spark = df.sparkSession
    if load_id is not None:
        if df.isEmpty():
            return 0
        obs = Observation("appended")
        (df.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("overwrite")
         .option("partitionOverwriteMode", "static").parquet(f"{path}/load_id={load_id}"))
        return int(obs.get.get("n", 0))
    obs = Observation("appended")
    staging = f"{path}_staging/{uuid.uuid4().hex[:12]}"
    parts = _digest_parts([c for c in df.columns if c != "ingested_at"])
    try:
        df.observe(obs, *[c.alias(k) for k, c in parts.items()]).write.parquet(staging)
        n = int(obs.get.get("n", 0))
        final = f"{path}/load_id=rows-{_digest(obs.get)}"
        if n and not path_exists(spark, final):
            fs, hpath = _location(spark, path)
            fs.mkdirs(hpath)
            _rename(spark, staging, final)
        return n
    finally:
        remove_path(spark, staging)


def log_record(spark: SparkSession, path: str, record: DataFrame, run_at: dt.datetime, dag_id: str,
               source: str) -> None:
    """Write a run's record to the audit log, in a directory of its own in that of its month.

    A run is known by ``run_at``, ``dag_id`` and ``source``: a repeated run replaces its record.  Other
    runs' records aren't touched, so runs may log at the same time."""
    run_id = hashlib.sha256("\n".join([run_at.isoformat(), dag_id, source]).encode()).hexdigest()[:32]
    (require_not_null(record, schemas.NOT_NULL_COLUMNS["pipeline_log"], "pipeline_log")
     .write.mode("overwrite").option("partitionOverwriteMode", "static")
     .parquet(f"{path}/log_month={run_at:%Y-%m}/run_id={run_id}"))


def log_run(spark: SparkSession, path: str, run_at: dt.datetime, dag_id: str, source: str,
            rows_loaded: int, status: str, message: str | None = None) -> None:
    """Record a run in the audit log (written after the data it describes, so a
    missing record means the load did not finish)."""
    row = [(run_at, dag_id, source, int(rows_loaded or 0), status, message)]  # DEFAULT 0
    log_record(spark, path, spark.createDataFrame(row, schemas.PIPELINE_LOG), run_at, dag_id, source)


def export_newest_first(df: DataFrame, path: str) -> int:
    """Export a mart to Parquet ordered by ``reading_date`` descending.

    A distributed range-partitioned sort: file ``part-00000`` holds the newest days; no
    rows pass through the driver.
    """
    obs = Observation("exported")
    # Observed above the sort: the range-partition sampling pass must not be counted.
    (df.orderBy(F.desc("reading_date"), F.asc("plant_id"))
     .observe(obs, F.count(F.lit(1)).alias("n"))
     .write.mode("overwrite").parquet(path))
    return int(obs.get.get("n", 0))


# Name of an export's directories: months counted down, so that names in order are newest first.
COUNTDOWN = "newest_first"


def _countdown(month: str) -> str:
    return f"{999999 - int(month.replace('-', '')):06d}"


def exported_by_month(spark: SparkSession, path: str) -> bool:
    return any(n.startswith(f"{COUNTDOWN}=") for n in list_names(spark, path))


def export_months(df: DataFrame, path: str, spans: list[tuple[str, str]] | None) -> int:
    """Export the plant-days of the months in ``spans`` (None: all), newest first, with a directory a month.

    Directory names count down and the files of a month are range-partitioned by day, so the files in
    the order of their names are the whole export in order.  Only the given months are written; those
    that ``df`` no longer has are dropped.  An export without such directories is replaced as a whole.
    Returns the rows written."""
    spark = df.sparkSession
    month = reading_month()
    if not exported_by_month(spark, path):
        spans = None
    if spans is not None:
        df = df.where(reduce(or_, [month.between(a, b) for a, b in spans], F.lit(False)))
    down = F.lpad((F.lit(999999) - F.date_format("reading_date", "yyyyMM").cast("int")).cast("string"), 6, "0")
    obs = Observation("exported")
    order = [F.asc(COUNTDOWN), F.desc("reading_date"), F.asc("plant_id")]
    df = df.withColumn(COUNTDOWN, down)
    if spans is None:  # as many tasks as the session has, small as they are: each writes its months' files in turn
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    else:
        df = df.orderBy(*order)
    (df.observe(obs, F.count(F.lit(1)).alias("n"), F.collect_set(COUNTDOWN).alias("months"))
     .write.mode("overwrite").option("partitionOverwriteMode", "static" if spans is None else "dynamic")
     .partitionBy(COUNTDOWN).parquet(path))
    written = obs.get
    if spans is not None:
        _drop_months(spark, path, COUNTDOWN, lambda v: any(_countdown(b) <= v <= _countdown(a) for a, b in spans),
                     written["months"])
    return int(written.get("n", 0))
