"""MinHash near-duplicates by an inverted join on signature coordinates.

Each text becomes its set of five-word shingles and a signature of ``COORDINATES`` minima.
Texts with the same set form one class; only class representatives go on.

* Every (coordinate, value) of a signature is a posting.  Postings shared by nobody are
  dropped at once, and with them every representative that keeps fewer postings than
  ``least_matches``: no other text can agree with it often enough.
* Counting collisions with skips: two signatures that agree in T coordinates must meet in
  the rarest ``s - T + 1`` of the s postings that each has left.  Only this prefix is joined;
  the other postings are skipped and counted for the pairs that met.
* A parity sketch bounds the sets' difference from below: every shingle flips one bit, so two
  sketches differ in at most as many bits as the sets differ in shingles.  Pairs whose sketches
  differ too much for the threshold aren't formed by the joins at all.
* Pairs with T matches are confirmed on the full shingle sets.

Within one posting list, members first meet only the smallest one (a hub), which settles
groups of near copies with as many pairs as members.  A second join then takes the members
of one list that are still in different components, so no link between components is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (WordHashes, byte_texts, connected_components, forget, frugal, mixed, shingle_hashes,
                     text_batches, written)

COORDINATES = 64
SKETCH_WORDS = 8  # 64-bit words of a parity sketch
TEXT_ROWS = 512  # rows with whole texts or sets in one Arrow batch
MISS = 1e-6  # accepted chance that a pair exactly at the threshold has too few matches


def least_matches(percent: int, coordinates: int = COORDINATES, miss: float = MISS) -> int:
    """Matches that a pair at the threshold reaches with a chance of at least 1 - ``miss``."""
    p, below = percent / 100, 0.0
    for t in range(coordinates + 1):
        below += math.comb(coordinates, t) * p**t * (1 - p) ** (coordinates - t)
        if below > miss:
            return max(t, 1)
    return coordinates


def shingle_set(text: bytes, words: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes: A-Z lowered, words split at ASCII white space."""
    return np.unique(shingle_hashes(words.of(text.lower().split())))


def _signature(shingles: np.ndarray) -> np.ndarray:
    """The minimum of the shingles under each of ``COORDINATES`` orders."""
    seeds = mixed(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64))
    xor, odd = seeds[:COORDINATES, None], seeds[COORDINATES:, None] | np.uint64(1)
    out = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 2048):
        h = (shingles[None, i: i + 2048] ^ xor) * odd
        np.minimum(out, (h ^ (h >> np.uint64(31))).min(axis=1), out=out)
    return mixed(out + seeds[:COORDINATES])


def _sketch(shingles: np.ndarray) -> np.ndarray:
    """Parity of the shingles that hash to each of the sketch's bits."""
    bits = (mixed(shingles + np.uint64(1)) >> np.uint64(32)) % np.uint64(64 * SKETCH_WORDS)
    odd = np.bincount(bits.astype(np.int64), minlength=64 * SKETCH_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = WordHashes()
    for batch in text_batches(batches):
        sizes, prints, signs, sketches = [], [], [], []
        for text in byte_texts(batch):
            s = shingle_set(text, words)
            sizes.append(len(s))
            prints.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
            signs.append(_signature(s).view(np.int64) if len(s) else None)
            sketches.append(_sketch(s) if len(s) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()),
             pa.array(signs, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int64()))],
            names=["doc_id", "n_shingles", "class", "signature", "sketch"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = WordHashes()
    for batch in text_batches(batches):
        sets = [shingle_set(t, words).tobytes() for t in byte_texts(batch)]
        same = [xxhash.xxh3_128_digest(s) == c for s, c in zip(sets, batch.column(2).to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())],
                                         names=["node", "shingles"]).filter(pa.array(same))


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)],
                                             names=["src", "dst"]).filter(pa.array(keep))
    return run


def _links(pairs: DataFrame, signs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (src < dst) that match often enough and whose full sets are similar enough."""
    least = least_matches(percent)
    pairs = pairs.distinct()
    for end in ("src", "dst"):
        pairs = pairs.join(signs.select(F.col("node").alias(end),
                                        F.col("signature").alias(f"signature_{end}")), end)
    pairs = pairs.where(
        F.size(F.array_intersect("signature_src", "signature_dst")) >= least).select("src", "dst")
    for end in ("src", "dst"):
        pairs = pairs.join(sets.select(F.col("node").alias(end),
                                       F.col("shingles").alias(f"shingles_{end}")), end)
    return pairs.select("src", "dst", "shingles_src", "shingles_dst").mapInArrow(
        frugal(_confirm(percent)), "src long, dst long")


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: doc_id, n_shingles, component_id, kept.

    Rows link when ``100 * |A & B| >= percent * |A | B|`` over their shingle sets.  Texts with
    fewer than five words form one shingle; null, empty or blank texts have none and link
    with nothing.  Rows with the same set are linked, also when repeated (each row goes by its
    own text); a row without a doc_id is kept and has the component of the rows with its set, null
    if none of them has an id.  Other columns are ignored."""
    percent = int(percent)
    least = least_matches(percent)
    signed = written(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
        .mapInArrow(frugal(_sign), "doc_id long, n_shingles long, class binary, signature array<long>, "
                    "sketch array<long>"),
        "signed", batch_rows=TEXT_ROWS)
    known = signed.where("class is not null and doc_id is not null")
    classes = written(known.groupBy("class").agg(
        F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"),
        F.first("signature").alias("signature"), F.first("sketch").alias("sketch")), "classes")
    rows = written(signed.select("doc_id", "n_shingles", "class"), "rows")
    forget(signed)

    # One shuffle by value serves the count and, with it, the pruning of lonely postings.
    posts = (classes.select("node", "n", F.explode("signature").alias("value"))
             .repartition("value"))
    shared = (posts.join(posts.groupBy("value").agg(F.count("*").alias("df")), "value")
              .where("df > 1"))
    prefix = written(
        shared.groupBy("node", "n")
        .agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("posts"))  # <= COORDINATES
        .where(F.size("posts") >= least)
        .select("node", "n", F.explode(F.slice("posts", F.lit(1), F.size("posts") - (least - 1)))
                .alias("post"))
        .select("node", "n", "post.value"), "prefix")
    signs = written(classes.join(prefix.select("node").distinct(), "node", "left_semi")
                    .select("node", "class", "signature", "sketch"), "signs")
    sets = written(
        docs.select(F.col("doc_id").cast("long").alias("node"), F.col("text").cast("string"))
        .join(signs.select("node", "class"), "node")
        .mapInArrow(frugal(_sets), "node long, shingles binary").dropDuplicates(), "sets", batch_rows=TEXT_ROWS)

    # Sets of n and m shingles that are similar enough differ in at most this share of n + m.
    apart = sum((F.bit_count(F.col("sketch")[i].bitwiseXOR(F.col("other")[i]))
                 for i in range(SKETCH_WORDS)), F.lit(0))
    alike = ((F.least("n", "m") * 100 >= F.greatest("n", "m") * percent)
             & (apart * (100 + percent) <= (F.col("n") + F.col("m")) * (100 - percent)))
    posted = prefix
    prefix = posted.join(signs.select("node", "sketch"), "node")
    hubs = prefix.groupBy("value").agg(F.min(F.struct("node", "n", "sketch")).alias("hub"))
    by_hub = (prefix.join(hubs.select("value", F.col("hub.node").alias("src"),
                                      F.col("hub.n").alias("m"), F.col("hub.sketch").alias("other")),
                          "value")
              .where((F.col("src") != F.col("node")) & alike)
              .select("src", F.col("node").alias("dst")))
    first = written(_links(by_hub, signs, sets, percent), "links", batch_rows=TEXT_ROWS)
    found = written(connected_components(first), "components")

    # Lists that still hold several components: their members meet across components.
    part = prefix.join(found, "node", "left").withColumn("component",
                                                         F.coalesce("component", "node"))
    split = (part.groupBy("value").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
             .where("lo < hi").select("value"))
    open_ = written(part.join(split, "value"), "open")
    across = (open_.select("value", F.col("node").alias("src"), "n", F.col("component").alias("c"),
                           "sketch")
              .join(open_.select("value", F.col("node").alias("dst"), F.col("n").alias("m"),
                                 F.col("component").alias("d"),
                                 F.col("sketch").alias("other")), "value")
              .where("src < dst and c <> d").where(alike).select("src", "dst"))
    second = written(_links(across, signs, sets, percent), "links", batch_rows=TEXT_ROWS)
    linked = connected_components(first.unionByName(second))
    component = written(
        classes.select("class", "node").join(linked, "node", "left")
        .select("class", F.coalesce("component", "node").alias("component_id")), "component")
    forget(classes, signs, sets, posted, first, found, open_, second)
    return (rows.join(component, "class", "left")
            .withColumn("component_id", F.coalesce("component_id", "doc_id"))
            .select("doc_id", "n_shingles", "component_id",
                    F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")))
