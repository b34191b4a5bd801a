"""Benchmark decontamination: SimHash of item-sized windows, Hamming blocks, exact check.

A benchmark item of n words is compared with every window of n words of every document (with
the whole document, if it is shorter).  Words are compared without case and punctuation, as
multisets of five-word shingles weighted by how often they occur.

* A window can only be similar to an item if nearly all of its shingles occur in items of that
  length.  A bitmap of fixed size (``BITMAP_BITS``) over the items' shingles tells which may; a
  collision in it costs time, never a match.
* The 64-bit SimHash of each such window is cut into ``BLOCKS`` blocks.  Two fingerprints at
  most ``RADIUS`` bits apart differ by at most ``RADIUS // BLOCKS`` bits in some block, so items
  are posted under all values that near to their own: the join meets every pair in the radius.
* Windows with equal words are compared once; candidates are confirmed by the exact weighted
  Jaccard similarity of their shingles.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SHINGLE_WORDS, WordHashes, byte_texts, frugal, mixed, shingle_hashes, text_batches, written

BITMAP_BITS = 23    # log2 of the bitmap's bits: 1 MB
RADIUS = 23         # bits; a pair at similarity 0.8 is farther apart with a chance of about 1e-6
BLOCKS, BLOCK_BITS = 8, 8
TEXT_ROWS = 512

_NOT_WORD = re.compile(r"[\W_]+")


class PlainWords(WordHashes):
    """Hash of a word without case and punctuation; 0 if nothing is left."""

    def __missing__(self, word: bytes) -> int:
        plain = _NOT_WORD.sub("", word.decode().lower())
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(plain) if plain else 0
        return h

    def text(self, text: bytes) -> np.ndarray:
        h = self.of(text.lower().split())
        return h[h != 0]


def simhash(shingles: np.ndarray) -> int:
    """Sign of the sum of the shingles' random directions, one bit per dimension."""
    bits = np.unpackbits(mixed(shingles ^ np.uint64(0xA5A5)).view(np.uint8).reshape(-1, 8), axis=1)
    ones = 2 * bits.sum(axis=0, dtype=np.int64) > len(shingles)
    return int(np.packbits(ones).view(np.int64)[0])


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard of two multisets: sum of least counts over sum of greatest counts."""
    keys, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    x = np.bincount(where[: len(a)], minlength=len(keys))
    y = np.bincount(where[len(a):], minlength=len(keys))
    return float(np.minimum(x, y).sum() / np.maximum(x, y).sum())


def _slot(shingles: np.ndarray, length: int) -> np.ndarray:
    """Bit of a shingle in the bitmap; 0 as length: of any item."""
    return (mixed(shingles + np.uint64(length)) >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = PlainWords()
    for batch in batches:
        rows = []
        for item, text in zip(batch.column(0).to_pylist(), byte_texts(batch)):
            w = words.text(text)
            if len(w):
                s = shingle_hashes(w)
                slots = np.concatenate([_slot(s, 0), _slot(s, len(w))])
                rows.append((item, len(w), simhash(s), s.view(np.int64), slots))
        columns = list(zip(*rows)) or [()] * 5
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                         names=["item_id", "n_words", "simhash", "shingles", "slots"])


def _bitmap(items: DataFrame) -> bytes:
    """The bitmap of all items' shingles: 2**BITMAP_BITS bits, however many items there are."""
    slot = F.explode("slots").alias("slot")
    parts = (items.select(slot).select((F.col("slot") + 1).alias("slot"))
             .groupBy(F.bitmap_bucket_number("slot").alias("part"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")).collect())
    bits = bytearray((1 << BITMAP_BITS) // 8)
    for part, chunk in parts:
        bits[(part - 1) * 4096: part * 4096] = chunk
    return bytes(bits)


def _least_common(size: int, other: int, percent: int) -> int:
    """Shingles that multisets of these sizes share at a similarity of ``percent``, at least."""
    return math.ceil(percent * (size + other) / (100 + percent) - 1e-9)


def _windows(bitmap, lengths: list[int], percent: int):
    def of_text(w: np.ndarray, table: np.ndarray):
        """(first word, item length, shingles) of the windows that may match an item."""
        usual = shingle_hashes(w)
        seen = np.flatnonzero(table[_slot(usual, 0)]) if len(w) >= SHINGLE_WORDS else None
        for n in lengths:
            size = min(n, len(w))
            if size < SHINGLE_WORDS:
                s = shingle_hashes(w, size)
                hit = table[_slot(s, n)]
            elif len(seen) * 2 < max(size - SHINGLE_WORDS + 1, 1):
                continue
            else:
                s, hit = usual, np.zeros(len(usual), bool)
                hit[seen] = table[_slot(usual[seen], n)]
            count = max(size - SHINGLE_WORDS + 1, 1)
            least = _least_common(count, max(n - SHINGLE_WORDS + 1, 1), percent)
            total = np.r_[0, np.cumsum(hit)]
            for p in np.flatnonzero(total[count:] - total[:-count] >= least).tolist():
                yield p, n, s[p: p + count]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = PlainWords()
        table = np.unpackbits(np.frombuffer(bitmap.value, np.uint8), bitorder="little").view(bool)
        for batch in text_batches(batches):
            rows = []
            for doc, mark, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                       byte_texts(batch)):
                w = words.text(text)
                if len(w):
                    rows += [(doc, mark, p, n, xxhash.xxh3_128_digest(s.tobytes()), simhash(s),
                              s.view(np.int64)) for p, n, s in of_text(w, table)]
            columns = list(zip(*rows)) or [()] * 7
            kinds = [pa.int64()] * 4 + [pa.binary(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["doc_id", "mark", "start", "n_words", "words", "simhash", "shingles"])
    return run


def _block(k: int):
    return F.shiftrightunsigned("simhash", k * BLOCK_BITS).bitwiseAND((1 << BLOCK_BITS) - 1)


def _blocks(df: DataFrame, near: int) -> DataFrame:
    """A row per block and value at most ``near`` bits from the fingerprint's."""
    masks = [sum(1 << b for b in bits) for k in range(near + 1)
             for bits in itertools.combinations(range(BLOCK_BITS), k)]
    df = df.withColumn("b", F.explode(F.array(*[
        F.struct(F.lit(k).alias("block"), _block(k).alias("value")) for k in range(BLOCKS)])))
    if near:
        df = df.withColumn("mask", F.explode(F.array(*[F.lit(m).cast("long") for m in masks])))
        return df.select("*", "b.block", F.col("b.value").bitwiseXOR(F.col("mask")).alias("value"))
    return df.select("*", "b.block", "b.value")


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [similarity(np.array(a, np.int64), np.array(b, np.int64)) for a, b in
                     zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())]
            out = pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found, pa.float64())],
                                             names=["words", "n_words", "item_id", "similarity"])
            yield out.filter(pa.array([100 * x >= percent for x in found], pa.bool_()))
    return run


def _mark(docs: DataFrame):
    return F.xxhash64(docs["text"].cast("string"))


def _matches(docs: DataFrame, items: DataFrame, percent: int) -> DataFrame:
    items = written(
        items.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
        .mapInArrow(frugal(_items), "item_id long, n_words long, simhash long, shingles array<long>, "
                    "slots array<long>"), "items", batch_rows=TEXT_ROWS)
    lengths = sorted(r[0] for r in items.select("n_words").distinct().collect())
    bitmap = docs.sparkSession.sparkContext.broadcast(_bitmap(items))
    windows = written(
        docs.select(F.col("doc_id").cast("long"), _mark(docs).alias("mark"),
                    F.col("text").cast("string"))
        .mapInArrow(frugal(_windows(bitmap, lengths, percent)),
                    "doc_id long, mark long, start long, n_words long, words binary, "
                    "simhash long, shingles array<long>"), "windows", batch_rows=TEXT_ROWS)
    different = written(windows.groupBy("words", "n_words").agg(
        F.first("simhash").alias("simhash"), F.first("shingles").alias("shingles")), "different")
    posted = _blocks(items.select("item_id", "n_words", "simhash"), RADIUS // BLOCKS)
    pairs = (_blocks(different.select("words", "n_words", "simhash"), 0)
             .join(posted.withColumnRenamed("simhash", "other"), ["n_words", "block", "value"])
             .where(F.bit_count(F.col("simhash").bitwiseXOR(F.col("other"))) <= RADIUS)
             .select("words", "n_words", "item_id").distinct())
    checked = written(
        pairs.join(different.select("words", "n_words", "shingles"), ["words", "n_words"])
        .join(items.select("item_id", "n_words", F.col("shingles").alias("item")),
              ["item_id", "n_words"])
        .select("words", "n_words", "item_id", "shingles", "item").distinct()
        .mapInArrow(frugal(_verify(percent)), "words binary, n_words long, item_id long, similarity double"),
        "checked", batch_rows=TEXT_ROWS)
    return windows.select("doc_id", "mark", "start", "n_words", "words").join(
        checked, ["words", "n_words"])


def contaminated(docs: DataFrame, items: DataFrame, percent: int = 80) -> DataFrame:
    """One row per document and item it holds: doc_id, item_id, similarity, start_word, n_words.

    Of several windows, the most similar and then the first is named.  Null, empty or
    punctuation-only texts and items match nothing; other columns are ignored; repeated rows
    of a doc_id count as one document, rows without doc_id likewise."""
    best = F.max(F.struct("similarity", (-F.col("start")).alias("before"), "n_words")).alias("best")
    return (_matches(docs, items, percent).groupBy("doc_id", "item_id").agg(best)
            .select("doc_id", "item_id", "best.similarity",
                    (-F.col("best.before")).alias("start_word"), "best.n_words"))


def decontaminate(docs: DataFrame, items: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns."""
    found = written(_matches(docs, items, percent).select(
        F.col("doc_id").alias("_llm_doc"), F.col("mark").alias("_llm_mark")).distinct(), "found")
    return docs.join(found, docs["doc_id"].cast("long").eqNullSafe(found["_llm_doc"])
                     & (_mark(docs) == found["_llm_mark"]), "left_anti")
