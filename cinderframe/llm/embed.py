"""Embedding near-duplicates with spherical-cap filters from structured random product codes.

A filter is a direction; a vector passes it if their cosine is at least ``alpha``.  Directions
form a product code: the (randomly rotated) space is cut into ``BLOCKS`` blocks with
``CODEWORDS`` random unit vectors each, and a direction takes one from every block.  So a code has
CODEWORDS ** BLOCKS directions, but a vector's filters are found by list decoding: sums over the
first blocks that can still reach ``alpha`` are completed by the codewords of the last.  There are
``CODES`` codes with rotations of their own.

Near vectors share filters; those that share one are compared, and the cosine in double
precision decides.  Pairs are never rows: a vector's home is the most common of its filters, a cell is
a part of the vectors of one home, and two cells that meet in some filter are compared by one matrix
product.  As every vector is in one cell, every pair is judged once, in its pair of cells, which gives the
number of links of each vector and a spanning forest.  So a group of near copies costs a row for each
vector and cell that it meets.  ``alpha`` is set from the dimension so that a vector passes ``FILTERS``
directions of a code on average; a vector that reaches it nowhere, or barely, passes its best
direction and those within ``MARGIN`` of it.  The tests measure recall against brute force.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, written

CODES = 8
BLOCKS = 3
CODEWORDS = 128
FILTERS = 2        # directions of a code that a vector passes, on average
MARGIN = 0.015     # of the sum of inner products
SEED = 20240229
VECTOR_ROWS = 2048
CELL_ROWS = 512    # vectors of a cell, about


@lru_cache(maxsize=64)
def _code(dim: int, number: int) -> tuple[np.ndarray, list[np.ndarray], float]:
    """(rotation, codewords of each block, alpha * sqrt(blocks)) for vectors of ``dim``."""
    rng = np.random.default_rng([SEED, dim, number])
    rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    blocks = []
    for part in np.array_split(np.arange(dim), min(BLOCKS, dim)):
        c = rng.standard_normal((CODEWORDS, len(part)))
        blocks.append(c / np.linalg.norm(c, axis=1, keepdims=True))
    probe = rng.standard_normal((256, dim))
    probe /= np.linalg.norm(probe, axis=1, keepdims=True)
    low, high = 0.0, 2.0  # the sum that FILTERS directions reach, on average over random vectors
    for _ in range(12):
        mid = (low + high) / 2
        passed = len(_passed(probe, blocks, mid, 0.0)[0]) / len(probe)
        low, high = (mid, high) if passed > FILTERS else (low, mid)
    return rotation, blocks, high


def _passed(x: np.ndarray, blocks: list[np.ndarray], least: float, margin: float = MARGIN):
    """(row of x, number of direction) for every direction whose sum reaches ``least``, or comes
    within ``margin`` of the row's best."""
    cuts = np.cumsum([0, *(b.shape[1] for b in blocks)])
    products = [x[:, a:b] @ c.T for a, b, c in zip(cuts, cuts[1:], blocks)]
    best = sum(p.max(1) for p in products)
    enough = np.minimum(least, best - margin) if margin else np.full(len(x), least)
    head, last = np.zeros((len(x), 1)), products[-1]
    for p in products[:-1]:
        head = (head[:, :, None] + p[:, None, :]).reshape(len(x), -1)
    row, first = np.nonzero(head >= (enough - last.max(1))[:, None])
    pick, second = np.nonzero(head[row, first][:, None] + last[row] >= enough[row][:, None])
    return row[pick], first[pick] * last.shape[1] + second


def _decode(x: np.ndarray, dim: int, number: int) -> tuple[np.ndarray, np.ndarray]:
    """(row of x, filter) of all rows under one code."""
    rotation, blocks, least = _code(dim, number)
    return _passed(x @ rotation, blocks, least)


def _valid(values: list | None) -> np.ndarray | None:
    """The vector in double precision; None if it links with nothing."""
    if not values or any(v is None for v in values):
        return None
    v = np.array(values, np.float64)
    if not np.isfinite(v).all():
        return None
    scale = np.abs(v).max()
    return v / scale if scale > 0 else None


def _unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes of unit doubles; null for those that link with nothing."""
    for batch in batches:
        out = []
        for values in batch.column(1).to_pylist():
            v = _valid(values)
            out.append(None if v is None else (v / math.sqrt(float(v @ v))).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())],
                                         names=["vec_id", "unit"])


def _filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(list, node): the filters of each vector, numbered over all codes and dimensions."""
    for batch in batches:
        nodes, units = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        by_dim: dict[int, list[int]] = {}
        for i, u in enumerate(units):
            by_dim.setdefault(len(u) // 8, []).append(i)
        for dim, rows in by_dim.items():
            for s in range(0, len(rows), 64):  # sums of 64 vectors stay in a core's cache
                some = np.array(rows[s: s + 64])
                x = np.stack([np.frombuffer(units[i]) for i in some])
                for number in range(CODES):
                    row, found = _decode(x, dim, number)
                    first = (dim * CODES + number) * CODEWORDS ** BLOCKS
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found.astype(np.int64) + first),
                         pa.array([nodes[i] for i in some[row]], pa.int64())], names=["list", "node"])


def _links(x: np.ndarray, left: np.ndarray, same: bool, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, row) of the linked pairs of two cells, or of the pairs within one."""
    one, two = (np.arange(len(x)),) * 2 if same else (np.flatnonzero(left), np.flatnonzero(~left))
    near = x[one] @ x[two].T >= least
    if same:
        near = np.triu(near, 1)
    i, j = np.nonzero(near)
    return one[i], two[j]


def _smallest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest row that each of ``n`` rows reaches by the links (i, j)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        for end in (i, j):
            np.minimum.at(new, end, low)
            np.minimum.at(new, label[end], low)  # the whole group that a row stood for moves along
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _judge(least: float):
    """(node, linked, other) from rows in order of their pair of cells: in each pair of cells, how many
    vectors a node links with there, and a node that it reaches there."""
    def of_groups(batch: pa.RecordBatch, starts: np.ndarray) -> pa.RecordBatch:
        left, same, node, size = (np.asarray(batch.column(c)) for c in ("is_left", "same", "node", "size"))
        units = batch.column("unit").to_pylist()
        out: list[list[np.ndarray]] = [[], [], []]
        for s, e in zip(starts, [*starts[1:], batch.num_rows]):
            if e - s < 2:
                continue
            x = np.frombuffer(b"".join(units[s:e])).reshape(e - s, -1)
            i, j = _links(x, left[s:e], bool(same[s]), least)
            if not len(i):
                continue
            ids, sizes, linked = node[s:e], size[s:e], np.zeros(e - s, np.int64)
            np.add.at(linked, i, sizes[j])
            np.add.at(linked, j, sizes[i])
            met = np.flatnonzero(linked)
            for part, column in zip((ids[met], linked[met], ids[_smallest(e - s, i, j)[met]]), out):
                column.append(part)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(c) if c else np.zeros(0, np.int64)) for c in out],
            names=["node", "linked", "other"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None  # rows of the last pair of cells, which may go on
        for batch in batches:
            if rest is not None and rest.num_rows:
                batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
            if not batch.num_rows:
                continue
            key = np.stack([np.asarray(batch.column(c)) for c in PAIR])
            starts = np.flatnonzero(np.r_[True, (key[:, 1:] != key[:, :-1]).any(0)])
            yield of_groups(batch.slice(0, starts[-1]), starts[:-1])
            rest = batch.slice(starts[-1])
        if rest is not None and rest.num_rows:
            yield of_groups(rest, np.zeros(1, np.int64))
    return run


PAIR = ["home_a", "part_a", "home_b", "part_b"]


def _cells(posts: DataFrame) -> DataFrame:
    """(list, node, cell) of the posts in lists of two or more: ``cell`` is a part of the vectors of one home."""
    lists = posts.groupBy("list").agg(F.count("*").alias("n")).where("n > 1")
    shared = written(posts.join(lists, "list"), "shared")
    home = written(shared.groupBy("node").agg(F.max(F.struct("n", "list"))["list"].alias("home")), "home")
    sizes = home.groupBy("home").agg(F.ceil(F.count("*") / CELL_ROWS).alias("parts"))
    cell = F.struct("home", F.pmod(F.xxhash64("node"), "parts").alias("part"))
    cells = home.join(sizes, "home").select("node", cell.alias("cell"))
    return written(shared.join(cells, "node").select("list", "node", "cell"), "cells")


def _meetings(cells: DataFrame) -> DataFrame:
    """(PAIR, node, is_left, same): each vector once for every cell that it shares a filter with."""
    present = cells.select("list", F.col("cell").alias("other")).distinct()
    met = cells.join(present, "list").select("node", "cell", "other").distinct()
    a, b = F.least("cell", "other"), F.greatest("cell", "other")
    return met.select(a["home"].alias("home_a"), a["part"].alias("part_a"), b["home"].alias("home_b"),
                      b["part"].alias("part_b"), "node", (F.col("cell") < F.col("other")).alias("is_left"),
                      (F.col("cell") == F.col("other")).alias("same"))


def near_vectors(vectors: DataFrame, least: float = 0.95) -> DataFrame:
    """Per row of ``vectors(vec_id, embedding)``: vec_id, n_links, component_id, kept.

    Rows link at a cosine of at least ``least``.  Null, zero, empty and non-finite vectors, or
    those with a null component, link with nothing; vectors of different dimension don't link.
    Rows of the same direction are compared once, as a class: n_links counts the other rows of
    its class and all rows of linked classes.  Rows without vec_id have a null component and
    are kept.  Other columns are ignored."""
    unit = written(vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                                  F.col("embedding").cast("array<double>"))
                   .mapInArrow(_unit, "vec_id long, unit binary"), "unit", batch_rows=VECTOR_ROWS)
    known = unit.where("unit is not null and vec_id is not null")
    classes = written(known.groupBy("unit").agg(F.min("vec_id").alias("node"),
                                                F.count("*").alias("size")), "classes")
    posts = written(classes.select("node", "unit").mapInArrow(
        _filters, "list long, node long"), "posts", batch_rows=VECTOR_ROWS)
    rows = (_meetings(_cells(posts)).join(classes, "node").repartition(*PAIR).sortWithinPartitions(*PAIR)
            .select(*PAIR, "is_left", "same", "node", "size", "unit"))
    found = written(rows.mapInArrow(_judge(least), "node long, linked long, other long"), "links",
                    batch_rows=VECTOR_ROWS)
    component = connected_components(found.select(F.col("node").alias("src"), F.col("other").alias("dst")))
    degree = found.groupBy("node").agg(F.sum("linked").alias("linked"))
    labelled = (classes.join(degree, "node", "left").join(component, "node", "left")
                .select("unit", (F.col("size") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
                        F.coalesce("component", "node").alias("component_id")))
    labelled = written(labelled, "labelled")
    rows = unit.join(labelled, "unit", "left").select(
        "vec_id", F.when(F.col("vec_id").isNotNull(), F.col("n_links")).alias("n_links"),
        F.when(F.col("vec_id").isNotNull(), F.col("component_id")).alias("component_id"))
    return rows.select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "vec_id") == F.col("vec_id"),
                   F.lit(True)).alias("kept"))
