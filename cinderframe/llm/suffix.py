"""Repeated byte strings by merging shard Burrows-Wheeler transforms.

A byte goes if a ``LENGTH``-byte string that covers it starts anywhere else too.  All windows
of ``LENGTH`` bytes have to be compared; the steps below bring equal windows together first.

1. *Runs.*  The windows of a text that share their least ``GRAM``-byte hash (the anchor) form a
   run.  Equal windows have the same anchor at the same place, so only runs with a common
   anchor can hold equal windows.  Runs whose bytes are equal are repeated as a whole; they are
   counted, not compared; equal runs that follow each other in a text are one row.  Runs with a
   common anchor but different bytes are contested.
2. *Cores.*  A contested run is cut into groups of ``STEP`` neighbouring windows.  All windows
   of a group contain its core (``LENGTH - STEP + 1`` bytes); the digest of the core is the key
   that partitions them.  What is left to compare are up to ``STEP - 1`` bytes at either side,
   with the core as one symbol between them.
3. *Merging.*  A partition holds the strings left + core + right of its cores in shards.  Each
   shard has its own Burrows-Wheeler transform (symbols and the mapping to the row of the
   preceding suffix).  They are merged by refining their interleave: one step sorts the merged
   order, stably, by the transforms' symbols and follows the mappings, which turns the order by
   h symbols into the order by h + 1.  Places where a step first tells neighbours apart have
   common prefixes of h symbols; blocks that survive ``STEP`` steps are the repeated intervals.
   Suffixes are never sorted again; those alone in their block are dropped early.

Cores with more than ``GROUP_ROWS`` different strings are not merged in one task: their windows
are counted one by one with a partial aggregation, which gives the same result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_texts, forget, frugal, mixed, text_batches, written

LENGTH = 400
GRAM = 64
STEP = 16
SHARD_STRINGS = 2048   # strings in one shard
MERGE_STRINGS = 16384  # strings that one merge holds, about
GROUP_ROWS = 8192      # different strings of one core that are merged in a task
SLICE_ROWS = 50_000    # rows of one Arrow batch that a text step gives back
SEGMENT = 1 << 16      # bytes of a text that are hashed at once
TEXT_ROWS = 256

_PLACE_BITS = 24  # positions within a segment


# --- 1. runs -----------------------------------------------------------------------------------

class Anchors:
    """Runs of windows by their least gram hash."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM):
        self.length, self.gram = length, min(gram, length)
        self.width = length - self.gram + 1
        base = 0x9E3779B97F4A7C15
        self.base, self.back = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
        self.codes = mixed(np.arange(1, 257, dtype=np.uint64))
        self.powers = self.inverse = np.ones(1, np.uint64)

    def _power(self, n: int) -> None:
        if len(self.powers) < n:
            size = 1 << int(n).bit_length()
            for name, b in (("powers", self.base), ("inverse", self.back)):
                p = np.full(size, b, np.uint64)
                p[0] = 1
                setattr(self, name, np.cumprod(p))

    def runs(self, text: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(first window, last window, anchor place, anchor hash) over the whole text."""
        for begin in range(0, max(len(text) - self.length + 1, 0), SEGMENT):
            part = text[begin: begin + SEGMENT + self.length - 1]
            yield from ((begin + f, begin + t, begin + p, h) for f, t, p, h in self._runs(part))

    def _runs(self, text: np.ndarray):
        n, k, w = len(text), self.gram, self.width
        self._power(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.codes[text] * self.powers[:n], out=sums[1:])
        grams = mixed((sums[k:] - sums[:-k]) * self.inverse[: n - k + 1])
        place = np.arange(len(grams), dtype=np.uint64)
        low = np.uint64((1 << _PLACE_BITS) - 1)
        keys = (grams & ~low) | place  # ties go to the first place
        pad = -len(keys) % w
        blocks = np.concatenate([keys, np.full(pad, np.iinfo(np.uint64).max)]).reshape(-1, w)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        windows = n - self.length + 1
        least = np.minimum(behind[:windows], ahead[w - 1: w - 1 + windows])
        anchor = (least & low).astype(np.int64)
        first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        last = np.r_[first[1:] - 1, windows - 1]
        at = anchor[first]
        return zip(first.tolist(), last.tolist(), at.tolist(), grams[at].view(np.int64).tolist())


_RUN = "doc_id long, mark long, anchor long, run binary, first long, last long, at long, until long, times long"


def _batch(rows: list[tuple], names: list[str], binary: set[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.binary() if n in binary else pa.int64()) for c, n in zip(columns, names)], names=names)


def _find_runs(length: int):
    """A row per run; a run whose bytes come again in the very next run (a text of one letter, or
    of a short period) takes that one in: ``times`` counts them, ``until`` is the last one's last window.
    Rows leave in slices, so memory doesn't follow their number."""
    names = [f.split()[0] for f in _RUN.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, rows = Anchors(length), []
        for batch in text_batches(batches, limit=4 << 20):
            for doc, mark, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                       byte_texts(batch)):
                if len(text) < length:
                    continue
                view, open_ = memoryview(text), None
                for first, last, at, h in anchors.runs(np.frombuffer(text, np.uint8)):
                    digest = xxhash.xxh3_128_digest(view[first: last + length], at - first)
                    if open_ and open_[2] == h and open_[3] == digest:
                        open_[7], open_[8] = last, open_[8] + 1
                        continue
                    if open_:
                        rows.append(open_)
                    if len(rows) >= SLICE_ROWS:
                        yield _batch(rows, names, {"run"})
                        rows = []
                    open_ = [doc, mark, h, digest, first, last, at, last, 1]
                rows.append(open_)
        yield _batch(rows, names, {"run"})
    return run


# --- 2. cores ----------------------------------------------------------------------------------

def _cut_cores(length: int, step: int):
    lead = length - min(GRAM, length)  # from the first window that can hold the anchor to it

    names = ["doc_id", "mark", "begin", "core", "left", "right"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in text_batches(batches, limit=4 << 20):
            for doc, mark, text, runs in zip(batch.column(0).to_pylist(),
                                             batch.column(1).to_pylist(), byte_texts(batch),
                                             batch.column(3).to_pylist()):
                for r in runs or []:
                    first, last, at = r["first"], r["last"], r["at"]
                    zero = at - lead
                    for c in range((first - zero) // step, (last - zero) // step + 1):
                        begin = zero + c * step
                        end = begin + step - 1
                        a, b = max(first, begin), min(last, end)
                        core = xxhash.xxh3_128_digest(text[end: begin + length], c)
                        rows.append((doc, mark, begin, core, text[a:end],
                                     text[begin + length: b + length]))
                    if len(rows) >= SLICE_ROWS:
                        yield _batch(rows, names, {"core", "left", "right"})
                        rows = []
        yield _batch(rows, names, {"core", "left", "right"})
    return run


# --- 3. merging --------------------------------------------------------------------------------

def shard_transform(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Burrows-Wheeler transform of strings given as rows of symbols (0: filler at both ends).

    Returns, in suffix order, the preceding symbol and the row of the preceding suffix (-1 at
    a string's start), and for every place of the input the row of its suffix."""
    count, size = symbols.shape
    flat = symbols.ravel().astype(np.int64)
    rank, reach = flat, 1
    ends = np.arange(count * size) % size
    while reach < size:
        ahead = np.zeros_like(rank)
        ahead[:-reach] = np.where(ends[:-reach] + reach < size, rank[reach:] + 1, 0)
        order = np.lexsort((ahead, rank))
        new = np.r_[0, np.cumsum((rank[order][1:] != rank[order][:-1])
                                 | (ahead[order][1:] != ahead[order][:-1]))]
        rank = np.empty_like(rank)
        rank[order] = new
        reach *= 2
    order = np.argsort(rank, kind="stable")
    row = np.empty(len(order), np.int64)
    row[order] = np.arange(len(order))
    inner = order % size > 0
    before = np.where(inner, flat[order - 1], -1)
    previous = np.where(inner, row[order - 1], -1)
    return before, previous, row.reshape(count, size)


def merge_repeats(groups: np.ndarray, left: list[bytes], right: list[bytes], step: int) -> np.ndarray:
    """strings x step: whether window t of a string is equal to one of another string.

    String i is left[i] + core(groups[i]) + right[i]; its window t has ``step`` symbols and
    starts at place t, of which the core is place ``step - 1``."""
    count, size = len(left), 2 * step
    symbols = np.zeros((count, size), np.int64)
    symbols[:, step - 1] = 257 + groups
    lefts = np.fromiter(map(len, left), np.int64, count)
    rights = np.fromiter(map(len, right), np.int64, count)
    places = np.arange(size)
    symbols[(places < step - 1) & (places >= step - 1 - lefts[:, None])] = \
        np.frombuffer(b"".join(left), np.uint8).astype(np.int64) + 1
    symbols[(places >= step) & (places < step + rights[:, None])] = \
        np.frombuffer(b"".join(right), np.uint8).astype(np.int64) + 1

    before, previous, rows, owner = [], [], [], []
    offset = 0
    for s in range(0, count, SHARD_STRINGS):
        b, p, r = shard_transform(symbols[s: s + SHARD_STRINGS])
        before.append(b)
        previous.append(np.where(p < 0, -1, p + offset))
        rows.append(r + offset)
        owner.append(np.empty(len(b), np.int64))
        owner[-1][r.ravel()] = s + np.repeat(np.arange(len(r)), size)
        offset += len(b)
    before, previous = np.concatenate(before), np.concatenate(previous)
    rows, owner = np.concatenate(rows), np.concatenate(owner)

    # Windows that exist start at place t with step - 1 - lefts <= t <= rights; their
    # refinement begins `step` places later.  Rows of a shard keep their shard's order.
    valid = (np.arange(step) >= step - 1 - lefts[:, None]) & (np.arange(step) <= rights[:, None])
    order = np.sort(rows[:, step:][valid])
    block = np.zeros(len(order), np.int64)
    for _ in range(step):
        sort = np.argsort(before[order], kind="stable")
        symbol, block = before[order][sort], block[sort]
        order = previous[order[sort]]
        new = np.r_[True, (symbol[1:] != symbol[:-1]) | (block[1:] != block[:-1])][:len(order)]
        block = np.cumsum(new) - 1
        several = np.bincount(block, minlength=1)[block] > 1 if len(block) else new
        order, block = order[several], block[several]
    found = np.zeros((count, step), bool)
    place = np.empty(len(owner), np.int64)
    place[rows.ravel()] = np.tile(places, count)
    found[owner[order], place[order]] = True
    return found


def _ranges(found: np.ndarray) -> list[list[dict]]:
    """For each string, the ranges [a, b) of its windows that are found."""
    out = []
    for row in found:
        edge = np.flatnonzero(np.diff(np.r_[False, row, False].astype(np.int8)))
        out.append([{"a": int(a), "b": int(b)} for a, b in edge.reshape(-1, 2)])
    return out


def _merge(step: int):
    def flush(rows: list[tuple]) -> pa.RecordBatch:
        core, left, right = zip(*rows)
        _, groups = np.unique(np.array(core, object), return_inverse=True)
        ranges = _ranges(merge_repeats(groups, left, right, step))
        kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
        return pa.RecordBatch.from_arrays(
            [pa.array(core, pa.binary()), pa.array(left, pa.binary()),
             pa.array(right, pa.binary()), pa.array(ranges, kind)],
            names=["core", "left", "right", "windows"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if len(rows) >= MERGE_STRINGS and row[0] != rows[-1][0]:
                    yield flush(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield flush(rows)
    return run


# --- the operator ------------------------------------------------------------------------------

def _marked(docs: DataFrame) -> DataFrame:
    """Rows under (doc_id, hash of the text): repeated doc_ids keep their texts apart."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
                       ).withColumn("mark", F.xxhash64("text"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, step: int = STEP):
    """(spans, texts) of ``docs(doc_id, text)``.

    spans(doc_id, mark, lo, hi): byte ranges that repeated strings cover, overlapping;
    texts(doc_id, mark, text): the texts that have any shared anchor."""
    marked = _marked(docs)
    runs = written(
        marked.where(F.octet_length("text") >= length).select("doc_id", "mark", "text")
        .mapInArrow(frugal(_find_runs(length)), _RUN), "runs", batch_rows=TEXT_ROWS)
    kinds = runs.groupBy("anchor", "run").agg(F.sum("times").alias("copies"))
    kinds = written(
        kinds.join(kinds.groupBy("anchor").agg(F.count("*").alias("variants")), "anchor")
        .where("copies > 1 or variants > 1"), "kinds")
    shared = written(runs.join(kinds, ["anchor", "run"]), "shared")
    forget(runs, kinds)
    same_key = [F.col("doc_id").eqNullSafe(F.col("d")), F.col("mark") == F.col("m")]

    whole = shared.where("copies > 1").select("doc_id", "mark", F.col("first").alias("lo"),
                                              (F.col("until") + length).alias("hi"))
    # Of equal runs, one takes part in the comparison.
    contested = (shared.where("variants > 1").groupBy("anchor", "run")
                 .agg(F.min(F.struct("doc_id", "mark", "first", "last", "at")).alias("r"))
                 .groupBy(F.col("r.doc_id").alias("d"), F.col("r.mark").alias("m"))
                 .agg(F.collect_list(F.struct("r.first", "r.last", "r.at")).alias("runs")))
    involved = (shared.groupBy("doc_id", "mark").agg(F.lit(1).alias("one"))
                .select(F.col("doc_id").alias("d"), F.col("mark").alias("m"))
                .join(contested.select(F.col("d").alias("cd"), F.col("m").alias("cm"), "runs"),
                      [F.col("d").eqNullSafe(F.col("cd")), F.col("m") == F.col("cm")], "left")
                .select("d", "m", "runs"))
    texts = written(marked.join(involved, same_key).drop("d", "m")
                    .select("doc_id", "mark", "text", "runs"), "texts")
    chunks = written(
        texts.where("runs is not null").mapInArrow(
            frugal(_cut_cores(length, step)),
            "doc_id long, mark long, begin long, core binary, left binary, right binary"),
        "cores", batch_rows=TEXT_ROWS)

    # Equal strings of one core are counted; different ones are merged.
    strings = chunks.groupBy("core", "left", "right").agg(F.count("*").alias("copies"))
    strings = written(
        strings.join(strings.groupBy("core").agg(F.count("*").alias("variants")), "core")
        .where("copies > 1 or variants > 1"), "strings")
    window = F.explode(F.sequence(step - 1 - F.octet_length("left"),
                                  F.octet_length("right"))).alias("t")
    all_windows = strings.where("copies > 1").select(
        "core", "left", "right",
        F.array(F.struct((step - 1 - F.octet_length("left")).cast("long").alias("a"),
                         (F.octet_length("right") + 1).cast("long").alias("b"))).alias("windows"))
    merged = (strings.where(F.col("variants").between(2, GROUP_ROWS))
              .repartition("core").sortWithinPartitions("core").select("core", "left", "right")
              .mapInArrow(frugal(_merge(step)), "core binary, left binary, right binary, "
                          "windows array<struct<a: long, b: long>>").where("size(windows) > 0"))
    single = (strings.where(F.col("variants") > GROUP_ROWS).select("core", "left", "right", window)
              .withColumn("window", F.struct(
                  "core", "t",
                  F.expr(f"substring(left, octet_length(left) - ({step - 1} - t) + 1)").alias("l"),
                  F.expr("substring(right, 1, t)").alias("r"))))
    often = single.groupBy("window").agg(F.count("*").alias("n")).where("n > 1").select("window")
    counted = single.join(often, "window").select(
        "core", "left", "right",
        F.array(F.struct(F.col("t").cast("long").alias("a"),
                         (F.col("t") + 1).cast("long").alias("b"))).alias("windows"))
    windows = all_windows.unionByName(merged).unionByName(counted)
    parts = chunks.join(windows, ["core", "left", "right"]).select(
        "doc_id", "mark", "begin", F.explode("windows").alias("w"))
    part_spans = parts.select("doc_id", "mark", (F.col("begin") + F.col("w.a")).alias("lo"),
                              (F.col("begin") + F.col("w.b") - 1 + length).alias("hi"))
    spans = written(whole.unionByName(part_spans), "spans")
    forget(shared, chunks, strings)
    return spans, texts


def _merged_spans(spans: list[dict], size: int) -> list[tuple[int, int]]:
    """Disjoint, sorted ranges; ranges that touch are one."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted((s["lo"], s["hi"]) for s in spans or []):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def _kept(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *(e for s in spans for e in s), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_batches(batches):
        rows = []
        for text, spans in zip(byte_texts(batch), batch.column(3).to_pylist()):
            found = _merged_spans(spans, len(text))
            rows.append((sum(b - a for a, b in found), len(found),
                         hashlib.sha256(_kept(text, found)).hexdigest()))
        removed, count, digest = list(zip(*rows)) or [()] * 3
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(removed, pa.int64()),
             pa.array(count, pa.int64()), pa.array(digest, pa.string())],
            names=["doc_id", "mark", "n_removed", "n_spans", "kept_sha256"])


def _by_text(spans: DataFrame) -> DataFrame:
    return (spans.groupBy(F.col("doc_id").alias("_llm_doc"), F.col("mark").alias("_llm_mark"))
            .agg(F.collect_list(F.struct("lo", "hi")).alias("_llm_spans")))


def repeat_report(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Texts are judged as UTF-8 bytes (null: empty), each as given; repeated rows are copies of
    each other.  Texts under ``length`` bytes lose nothing.  Other columns are ignored."""
    spans, texts = repeated_spans(docs, length)
    key = [F.col("doc_id").eqNullSafe(F.col("_llm_doc")), F.col("mark") == F.col("_llm_mark")]
    cut = written(
        texts.dropDuplicates(["doc_id", "mark"]).join(_by_text(spans), key)
        .select("doc_id", "mark", "text", "_llm_spans")
        .mapInArrow(frugal(_digest), "doc_id long, mark long, n_removed long, n_spans long, "
                    "kept_sha256 string"), "cut", batch_rows=TEXT_ROWS)
    forget(spans, texts)
    plain = _marked(docs).select("doc_id", "mark", F.octet_length("text").cast("long").alias("n_bytes"),
                                 F.sha2("text", 256).alias("sha256"))
    cut = cut.withColumnsRenamed({"doc_id": "_llm_doc", "mark": "_llm_mark"})
    return plain.join(cut, key, "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"),
        F.coalesce("kept_sha256", "sha256").alias("kept_sha256"))


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with the repeated bytes taken out of ``text``; every column and row stays.

    A character of which a byte was removed goes as a whole; ``n_chars``, if there, is set to
    the new length.  Null texts stay null."""
    spans, texts = repeated_spans(docs, length)
    forget(texts)
    names = docs.columns
    key = [F.col("doc_id").cast("long").eqNullSafe(F.col("_llm_doc")),
           F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))) == F.col("_llm_mark")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(names.index("text")).to_pylist()
            for i, spans_ in enumerate(batch.column(len(names)).to_pylist()):
                if spans_ and texts[i] is not None:
                    raw = texts[i].encode()
                    texts[i] = _kept(raw, _merged_spans(spans_, len(raw))).decode("utf-8", "ignore")
            columns = list(batch.columns[:len(names)])
            columns[names.index("text")] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    out = docs.join(_by_text(spans), key, "left").select(*names, "_llm_spans")
    out = written(out.mapInArrow(frugal(cut), schema), "cut", batch_rows=TEXT_ROWS)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*names)
