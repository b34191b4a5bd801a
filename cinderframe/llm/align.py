r"""Alignment of two tokenizers' tokens over the same bytes, in Arrow columns.

Tokenizer A (byte-level BPE) reads space + text, tokenizer B (a sentence-piece model) the text, to which it
adds the space itself.  Where both give back exactly the bytes of space + text, every token covers a range of
them.  Offsets where a token of A and one of B both end cut the text into *groups*; a *link* is a pair of an A
and a B token whose ranges overlap.

The documents of a chunk (``CHUNK_BYTES`` of text, or one document) are columns: token lists are flattened,
their parent indices are the documents, segmented cumulative sums of the tokens' byte lengths give each
token's end, and one full outer Acero join on the (document, end) key merges both tokenizers' ends.  In the
order of that key each row is one link: a side that doesn't end there is the token that ends next.  Rows in
which both end close a group.

``Table.group_by`` counts the documents of a chunk that hold each id pair; Spark sums these partial counts,
and each chunk gets back the sums of its own pairs.  What is shuffled is the distinct pairs of chunks, not
the links; a pair that every document holds is one row per chunk, and in the join that returns the sums
adaptive execution splits such a key.  Memory in a task follows the chunk or the longest text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_letters, byte_texts, text_batches, written

CHUNK_BYTES = 4 << 20
TEXT_ROWS = 2048

_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
_SCHEMA = ("chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, "
           "steps array<int>, a_id int, b_id int, docs long")
_ARROW = pa.schema([("chunk", pa.int64()), ("doc_id", pa.int64())] + [(c, pa.int64()) for c in _COUNTS]
                   + [("groups", pa.string()), ("steps", pa.list_(pa.int32())), ("a_id", pa.int32()),
                      ("b_id", pa.int32()), ("docs", pa.int64())])


# --- the two tokenizers --------------------------------------------------------------------

# Characters whose class (letter, number, space) every Unicode version agrees on: with these the
# rank encoder's split of a text is the tokenizer's own.
_COMMON = re.compile("[^\x00-ɏ‐-‧‰-⁞₠-₿]")
_LONG = re.compile(r"\S{2000}|\s{2000}|[^\w\s]{2000}")


class ByteLevel:
    """A byte-level BPE tokenizer file of the ``tokenizers`` library.

    If the file's merges make ids in order (so an id is its rank), most texts are encoded by a
    rank encoder built from the same file, which is several times faster; texts with rarer
    characters or very long words go to the library itself.  The ids are the same."""

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        letters = byte_letters()
        vocabulary = self.tokenizer.get_vocab()
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.pieces = [b""] * (max(vocabulary.values()) + 1)
        for piece, i in vocabulary.items():
            self.pieces[i] = piece.encode() if piece in special else bytes(letters[c] for c in piece)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.ranks = self._rank_encoder(model, vocabulary, special, letters)

    @staticmethod
    def _rank_encoder(model: dict, vocabulary: dict, special: set, letters: dict):
        made = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if made != list(range(256, 256 + len(made))) or len(vocabulary) != 256 + len(made) + len(special):
            return None
        import public_tokenizers
        import tiktoken
        ranks = {bytes(letters[c] for c in piece): i for piece, i in vocabulary.items() if piece not in special}
        return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        out: list = [None] * len(texts)
        rest = []
        for i, text in enumerate(texts):
            if self.ranks is None or _COMMON.search(text) or _LONG.search(text):
                rest.append(i)
            else:
                out[i] = self.ranks.encode_ordinary(text)
        codes = self.tokenizer.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False)
        for i, code in zip(rest, codes):
            out[i] = code.ids
        return out


class Pieces:
    """A sentence-piece model; U+2581 is a space, ``<0xHH>`` a byte."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(self.model.id_to_piece(list(range(self.model.get_piece_size()))))]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Side:
    """One tokenizer with its tables: the bytes of an id, their number, the id's decimal string."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.bytes = pa.array(tokenizer.pieces, pa.binary())
        self.length = pc.binary_length(self.bytes).cast(pa.int64())
        self.name = pa.array([str(i) for i in range(len(tokenizer.pieces))])

    def lists(self, texts: list[str]) -> pa.ListArray:
        return pa.array(self.tokenizer.encode(texts), pa.list_(pa.int32()))

    def joined(self, lists: pa.ListArray) -> pa.Array:
        """The bytes that a document's tokens stand for."""
        return pc.binary_join(pa.ListArray.from_arrays(lists.offsets, self.bytes.take(lists.flatten())), b"")


@lru_cache(maxsize=2)
def _sides(a_path: str, b_path: str) -> tuple[Side, Side]:
    return Side(ByteLevel(a_path)), Side(Pieces(b_path))


# --- a chunk of documents ------------------------------------------------------------------

def _ends(lists: pa.ListArray, length: pa.Array, column: str) -> pa.Table:
    """(key, column): document and end offset of every token as one number, and the token's place."""
    flat, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    ends = np.asarray(pc.cumulative_sum(length.take(flat)))
    offsets = np.asarray(lists.offsets)
    before = np.append(np.int64(0), ends)[offsets[:-1]]  # bytes before the document
    doc = np.asarray(parent).astype(np.int64)
    return pa.table({"key": doc << 40 | (ends - before[doc]), column: pa.array(np.arange(len(flat)))})


class Aligned:
    """The links and groups of a chunk's documents, all of which have tokens."""

    def __init__(self, a: Side, b: Side, a_lists: pa.ListArray, b_lists: pa.ListArray):
        merged = _ends(a_lists, a.length, "a").join(
            _ends(b_lists, b.length, "b"), "key", join_type="full outer", use_threads=False)
        merged = merged.combine_chunks().sort_by("key")
        at_a, at_b = (merged[c].combine_chunks() for c in ("a", "b"))
        closes = np.asarray(pc.and_(at_a.is_valid(), at_b.is_valid()))
        self.doc = np.asarray(merged["key"]) >> 40
        a_ids, b_ids = a_lists.flatten(), b_lists.flatten()
        self.a = a_ids.take(pc.fill_null_backward(at_a))
        self.b = b_ids.take(pc.fill_null_backward(at_b))
        n = len(a_lists)
        self.links = np.bincount(self.doc, minlength=n)
        self.group_counts = np.bincount(self.doc[closes], minlength=n)
        some = pa.array(closes)

        def named(side: Side, ids: pa.Array, at: pa.Array) -> pa.Array:
            ends = np.append(0, np.asarray(at.filter(some)) + 1)
            return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), side.name.take(ids)), ",")

        groups = pc.binary_join_element_wise(named(a, a_ids, at_a), named(b, b_ids, at_b), "|")
        cuts = np.append(0, np.cumsum(self.group_counts))
        self.groups = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), groups), ";")

    def pairs(self) -> tuple[pa.Table, pa.ListArray]:
        """The chunk's id pairs with the number of documents that hold each, in order of the pair;
        and per document the places of its links' pairs there, ascending, as differences."""
        code = np.asarray(self.a).astype(np.int64) << 32 | np.asarray(self.b)
        held = pa.table({"doc": self.doc, "pair": code}).group_by(["doc", "pair"], use_threads=False).aggregate(
            [([], "count_all")])
        counts = held.group_by("pair", use_threads=False).aggregate([([], "count_all")]).sort_by("pair")
        pair = counts["pair"].combine_chunks()
        place = np.asarray(pc.index_in(held["pair"], value_set=pair)).astype(np.int64)
        doc, times = np.asarray(held["doc"]), np.asarray(held["count_all"])
        order = np.argsort(doc << 32 | place)
        doc, place = np.repeat(doc[order], times[order]), np.repeat(place[order], times[order])
        steps = np.diff(place, prepend=0)
        first = np.flatnonzero(np.diff(doc, prepend=-1))
        steps[first] = place[first]
        cuts = np.append(0, np.cumsum(self.links))
        key = np.asarray(pair)
        table = pa.table({"a_id": pa.array(key >> 32, pa.int32()), "b_id": pa.array(key & 0xFFFFFFFF, pa.int32()),
                          "docs": counts["count_all"]})
        return table, pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(steps, pa.int32()))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about ``CHUNK_BYTES`` of text."""
    waiting, total = [], 0
    for batch in text_batches(batches, limit=CHUNK_BYTES):
        size = pc.sum(pc.binary_length(batch.column(1))).as_py() or 0
        if waiting and total + size > CHUNK_BYTES:
            yield pa.concat_batches(waiting)
            waiting, total = [], 0
        waiting.append(batch)
        total += size
    if waiting:
        yield pa.concat_batches(waiting)


def _with_nulls(columns: dict, rows: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pc.cast(columns[f.name], f.type) if f.name in columns else pa.nulls(rows, f.type) for f in _ARROW], schema=_ARROW)


def _align(batch: pa.RecordBatch, chunk: int, a: Side, b: Side) -> Iterator[pa.RecordBatch]:
    docs, raw = batch.column(0), byte_texts(batch)
    n = len(raw)
    some = np.array([bool(t) for t in raw])
    texts = [t.decode() for t in raw if t]
    a_lists, b_lists = a.lists([" " + t for t in texts]), b.lists(texts)
    spaced = pa.array([b" " + t for t in raw if t], pa.binary())
    whole = pc.and_(pc.equal(a.joined(a_lists), spaced), pc.equal(b.joined(b_lists), spaced))
    a_lists, b_lists = (pa.array(x.filter(whole)) for x in (a_lists, b_lists))
    some[some] = np.asarray(whole)
    numbers = {c: np.zeros(n, np.int64) for c in _COUNTS}
    groups, steps = pa.nulls(n, pa.string()), pa.nulls(n, pa.list_(pa.int32()))
    pairs = None
    if len(a_lists):
        done = Aligned(a, b, a_lists, b_lists)
        pairs, links = done.pairs()
        for c, v in (("n_a", a_lists.value_lengths()), ("n_b", b_lists.value_lengths()),
                     ("n_groups", done.group_counts), ("n_links", done.links)):
            numbers[c][some] = np.asarray(v)
        place = pa.array(np.cumsum(some) - 1, mask=~some)
        groups, steps = done.groups.take(place), links.take(place)
    yield _with_nulls({"chunk": pa.array(np.full(n, chunk)), "doc_id": docs, "groups": groups, "steps": steps,
                       **{c: pa.array(v) for c, v in numbers.items()}}, n)
    for part in pairs.to_batches(max_chunksize=1 << 16) if pairs else ():
        columns = dict(zip(part.schema.names, part.columns))
        yield _with_nulls({"chunk": pa.array(np.full(part.num_rows, chunk)), **columns}, part.num_rows)


def alignments(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Rows of documents and of id pairs, by chunk.

    A row per row of ``docs(doc_id, text)``: chunk, doc_id, n_a, n_b (tokens), n_groups, n_links, groups (ids
    as ``a1,a2|b1;a3|b2,b3``), steps (the links' pairs, by place among the chunk's pairs in order).  A row per
    chunk and id pair, with docs set: chunk, a_id, b_id, docs (documents of the chunk that hold the pair linked).

    A text that is null or empty, or whose tokens of either tokenizer don't join to space + text, has
    no tokens: counts of 0, groups and steps null.  A null doc_id stays; repeated rows are documents of
    their own; other columns are ignored; an empty table gives no rows."""
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _sides(a_path, b_path)
        first = TaskContext.get().partitionId() << 32
        for k, batch in enumerate(_chunks(batches)):
            yield from _align(batch, first + k, a, b)

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(align, _SCHEMA))


# --- counts over the corpus ------------------------------------------------------------------

def pair_counts(aligned: DataFrame) -> DataFrame:
    """(a_id, b_id, docs): in how many documents of the corpus an id of A and one of B are linked."""
    return (aligned.where("docs is not null").groupBy("a_id", "b_id").agg(F.sum("docs").alias("docs")))


def link_counts(aligned: DataFrame) -> DataFrame:
    """The document rows of a written :func:`alignments` table, its other columns included, with n_best (links
    whose pair is the most frequent one of its A id, ties included) and count_sum (sum of the links' counts)."""
    counts = written(pair_counts(aligned), "pair-counts")
    # One row for each id of A at most: bounded by the vocabulary.
    most = counts.groupBy("a_id").agg(F.max("docs").alias("most"))
    judged = counts.join(F.broadcast(most), "a_id").select(
        "a_id", "b_id", F.col("docs").alias("total"), (F.col("docs") == F.col("most")).alias("best"))
    own = (aligned.where("docs is not null").select(F.col("chunk").alias("of_chunk"), "a_id", "b_id")
           .join(judged, ["a_id", "b_id"]))
    rows = aligned.where("docs is null").drop("a_id", "b_id", "docs")
    kept = [c for c in rows.columns if c not in ("chunk", "steps")]

    def counted(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by([("a_id", "ascending"), ("b_id", "ascending")])
        total = np.asarray(right["total"].combine_chunks())
        best = np.asarray(right["best"].combine_chunks().cast(pa.int64()))
        lists = left["steps"].combine_chunks()
        counts = np.asarray(pc.fill_null(pc.list_value_length(lists), 0)).astype(np.int64)
        steps = np.asarray(lists.flatten()).astype(np.int64)
        begin = np.cumsum(counts) - counts
        run = np.append(0, np.cumsum(steps))
        place = run[1:] - np.repeat(run[begin], counts)  # cumulative sum within a document

        def sums(of: np.ndarray) -> pa.Array:
            added = np.append(0, np.cumsum(of[place]))
            return pa.array(added[begin + counts] - added[begin], pa.int64())

        return left.select(kept).append_column("n_best", sums(best)).append_column("count_sum", sums(total))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name in kept)
    return rows.groupBy("chunk").cogroup(own.groupBy("of_chunk")).applyInArrow(
        counted, schema + ", n_best long, count_sum long")
