"""Helpers shared by the training-data operators: written steps, components, word shingles."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

SHINGLE_WORDS = 5


ROWS_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def written(df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, reread.

    Cuts the lineage: a lost executor repeats only the step that reads the table, and a
    step used twice is computed once.  ``batch_rows`` bounds the Arrow batches of this step
    alone, for rows that hold whole texts."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    before = spark.conf.get(ROWS_SETTING)
    if batch_rows:
        spark.conf.set(ROWS_SETTING, str(batch_rows))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(ROWS_SETTING, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete written tables that every later step has done with: what is still to be computed
    reads tables written since."""
    for table in tables:
        sc = table.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(table.written_to)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def text_batches(batches: Iterator[pa.RecordBatch], column: str = "text",
                 limit: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``limit`` bytes of text, or one row: memory in a
    task follows the longest text, not the number of rows that Arrow puts in a batch."""
    for batch in batches:
        text = batch.column(batch.schema.get_field_index(column))
        size = np.asarray(pc.fill_null(pc.binary_length(text), 0))
        start, total = 0, 0
        for i, n in enumerate(size.tolist()):
            if total and total + n > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if start < batch.num_rows:
            yield batch.slice(start)


def _give_back() -> None:
    """Unused memory of this process goes back to the system: Arrow's and, with glibc, numpy's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def frugal(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for mapInArrow, with the same rows; memory that its batches no longer need is given back.

    A Python worker serves many tasks, and the allocators keep what the largest of them needed:
    without this an executor's idle workers hold the sum of all steps' peaks."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for out in run(batches):
                yield out
                del out
                pa.default_memory_pool().release_unused()
        finally:
            _give_back()
    return task


def byte_texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The UTF-8 bytes of a string column; null reads as empty."""
    col = batch.column(batch.schema.get_field_index(column))
    return [t or b"" for t in col.cast(pa.binary()).to_pylist()]


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 characters
    for themselves, the other bytes for the code points from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    letters = {chr(b): b for b in plain}
    for n, b in enumerate(sorted(set(range(256)) - set(plain))):
        letters[chr(256 + n)] = b
    return letters


# --- word shingles -----------------------------------------------------------------------

class WordHashes(dict):
    """64-bit hash of a word; keeps at most ``limit`` words, and none of more than ``longest`` bytes."""

    def __init__(self, limit: int = 400_000, longest: int = 64):
        super().__init__()
        self.limit, self.longest = limit, longest

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= self.longest:
            self[word] = h
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def shingle_hashes(words: np.ndarray, n: int = SHINGLE_WORDS) -> np.ndarray:
    """One hash per run of ``n`` words, in order; the whole sequence if it has fewer words."""
    size = min(n, len(words))
    if not size:
        return words
    h = words[: len(words) - size + 1].copy()
    for j in range(1, size):
        h = h * np.uint64(0x9E3779B97F4A7C15) + words[j: len(words) - size + 1 + j]
    return mixed(h + np.uint64(size))


# --- connected components ------------------------------------------------------------------

def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges(src, dst)``; component = smallest node.

    Randomised contraction: in each round every node moves to the neighbour (or itself) that
    comes first in a fresh pseudo-random order, and edges inside a merged node vanish.  The
    number of nodes falls by a constant factor a round in expectation, also on long chains
    and stars.  Rounds are written tables; only an emptiness test reaches the driver."""
    edge = written(
        edges.where("src <> dst")
        .select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
        .distinct(), "edges")
    labels, step = None, 0
    while labels is None or not edge.isEmpty():
        def ranked(col: str, k: int = step):
            return F.struct(F.xxhash64(col, F.lit(k)).alias("rank"), F.col(col).alias("id"))
        both = edge.unionByName(edge.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        pick = written(
            both.groupBy("src").agg(F.min(ranked("dst")).alias("best"))
            .select(F.col("src").alias("was"), F.least("best", ranked("src"))["id"].alias("now")),
            "pick")
        if labels is None:
            now = pick.select(F.col("was").alias("node"), F.col("now").alias("label"))
        else:
            now = (labels.join(pick, F.col("label") == F.col("was"), "left")
                   .select("node", F.coalesce("now", "label").alias("label")))
        now = written(now, "labels")
        left = written(
            edge.join(pick, F.col("src") == F.col("was")).select(F.col("now").alias("a"), "dst")
            .join(pick, F.col("dst") == F.col("was")).select("a", F.col("now").alias("b"))
            .where("a <> b")
            .select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst")).distinct(),
            "edges")
        forget(edge, pick, *([labels] if labels is not None else []))
        edge, labels, step = left, now, step + 1
    forget(edge)
    smallest = labels.groupBy("label").agg(F.min("node").alias("component"))
    return labels.join(smallest, "label").select("node", "component")
