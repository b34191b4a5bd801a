"""Token packing with a bounded number of open windows per partition.

Each partition streams its documents.  Whole windows are cut off a document at once; what is
left goes, uncut, into the open window that it fits best (least room left after it).  If none
has room, the fullest window takes as much as it holds, is emitted full, and the rest opens a
new one.  A partition therefore holds at most ``OPEN_WINDOWS`` windows, and at its end the
windows that are still open are its leftovers.

Leftovers of ``MERGED_PARTITIONS`` partitions at a time are merged the same way in a second
step.  What remains there is cut at powers of two, which need no padding.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_letters, byte_texts, frugal, text_batches, written

WINDOW = 4096
OPEN_WINDOWS = 8
MERGED_PARTITIONS = 256
CACHED_BYTES = 96 << 20  # of each generation of words whose ids a Python worker remembers
ENTRY_BYTES = 180  # of a word's objects, besides its letters and ids
TEXT_ROWS = 512

_PIECE = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")
_FIELDS = [f.split()[0] for f in _PIECE.split(", ")]


class WordIds:
    """Little-endian 32-bit ids of the tokens of a word without white space.

    The tokenizer drops white space and never joins across it, so the ids of a text are those
    of its words in order.  A word of letters and closing punctuation is two pre-tokens, whose
    ids are joined.  Latin letters, nearly all words of most texts, go through a rank encoder
    built from the same file, many words at a time; it splits nothing, as every word is one piece
    that a mark ends, and the mark makes the letter before it the one that closes a word.

    The cache has two generations of ``CACHED_BYTES`` each: a full one becomes the older one, whose
    words move to the younger when a text holds them again, so words in use are never learnt
    twice and long words count by their length."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.kept = 0
        self._rank_encoder(path)

    def _rank_encoder(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocabulary = model["vocab"]
        letters = byte_letters()
        suffix = model.get("end_of_word_suffix") or ""
        self.ranks = None
        if suffix != "</w>" or model.get("continuing_subword_prefix"):
            return

        def raw(piece: str) -> bytes:
            word = piece.removesuffix(suffix)
            return bytes(letters[c] for c in word) + (_MARK if piece != word else b"")

        # The mark's own bytes join first, then it joins a letter, then the file's merges in order.
        ranks = {bytes([b]): b for b in range(256)} | {_MARK[:2]: 256, _MARK: 257}
        names = {raw(c): i for c, i in vocabulary.items() if len(c) == 1 or c[1:] == suffix}
        for i, piece in enumerate(sorted(p for p in names if len(p) > 1)):
            ranks[piece] = 258 + i
        for i, merge in enumerate(model["merges"]):
            piece = "".join(merge.split(" ") if isinstance(merge, str) else merge)
            if raw(piece) in ranks:
                continue  # of a piece that holds bytes of the mark: no Latin word has them
            ranks[raw(piece)] = 1024 + i
            names[raw(piece)] = vocabulary[piece]
        self.of_rank = np.zeros(1024 + len(model["merges"]), np.uint32)
        self.closes = np.zeros(len(self.of_rank), bool)
        for piece, i in names.items():
            if piece in ranks:
                self.of_rank[ranks[piece]] = i
                self.closes[ranks[piece]] = piece.endswith(_MARK)
        import tiktoken
        mark = _MARK.decode()
        self.ranks = tiktoken.Encoding("words", pat_str=f"[^{mark}]+{mark}", mergeable_ranks=ranks, special_tokens={})

    def _encode(self, words: list[bytes]) -> list[bytes]:
        codes = self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
        return [np.asarray(c.ids, "<u4").tobytes() for c in codes]

    def _encode_latin(self, words: list[bytes]) -> list[bytes]:
        out = []
        for i in range(0, len(words), 4096):
            text = _MARK.join(words[i: i + 4096]) + _MARK
            ranks = np.asarray(self.ranks.encode_ordinary(text.decode()), np.int64)
            ends = (4 * (np.flatnonzero(self.closes[ranks]) + 1)).tolist()
            ids = self.of_rank[ranks].astype("<u4").tobytes()
            out += [ids[a:b] for a, b in zip([0, *ends], ends)]
        return out

    def learn(self, words: set[bytes]) -> None:
        """Put the ids of the words into the younger generation."""
        if self.kept > CACHED_BYTES:
            self.young, self.old, self.kept = {}, self.young, 0
        young, old = self.young, self.old
        split, letters, rests, others = [], [], [], []
        for w in words:
            known = old.get(w)
            if known is not None:
                young[w] = known
                continue
            core = w.rstrip(_CLOSING)
            plain = core if core.isalpha() else _latin(core)
            if plain and self.ranks and b"<|" not in w:
                split.append(w)
                letters.append(plain.lower())
                rests.append(w[len(core):])
            else:
                others.append(w)
        distinct = list(set(letters))
        of_letters = dict(zip(distinct, self._encode_latin(distinct)))
        few = [r for r in set(rests) if r]
        of_rests = {b"": b"", **dict(zip(few, self._encode(few)))}
        young.update(zip(split, [of_letters[a] + of_rests[b] for a, b in zip(letters, rests)]))
        young.update(zip(others, self._encode(others)))
        self.kept += ENTRY_BYTES * len(words) + sum(map(len, words)) + sum(map(len, map(young.__getitem__, words)))

    @staticmethod
    def words(text: bytes) -> list[bytes]:
        """The words of a text; lowered, as the tokenizer does, unless special tokens may be in it."""
        return (text if b"<|" in text else text.lower()).split()

    def of(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text; every text is split once."""
        split = list(map(self.words, texts))
        found = [list(map(self.young.get, words)) for words in split]
        new: set[bytes] = set()
        for words, ids in zip(split, found):
            if None in ids:
                new.update([w for w, i in zip(words, ids) if i is None])
        if new:
            self.learn(new)
            young = self.young
            found = [ids if None not in ids else [young[w] if i is None else i for w, i in zip(words, ids)]
                     for words, ids in zip(split, found)]
        return list(map(b"".join, found))

    def ids(self, text: bytes) -> bytes:
        return self.of([text])[0]


# ASCII characters that no letter pattern takes; an apostrophe may begin a piece of its own.
_CLOSING = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_MARK = "\ue000".encode()


def _latin(word: bytes) -> bytes | None:
    """The word in lower case if it is Latin letters only (nothing there is composed otherwise)."""
    text = word.decode()
    if not text.isalpha() or max(text) > "\u024f" or "\u0130" in text:
        return None
    return text.lower().encode()


@lru_cache(maxsize=1)
def _word_ids(path: str) -> WordIds:
    """One cache for all tasks of a Python worker."""
    return WordIds(path)


class Packer:
    """Best-fit packing of pieces (doc_id, start, ids, doc_tokens) into windows."""

    def __init__(self, partition: int, size: int = WINDOW, open_windows: int = OPEN_WINDOWS):
        self.next_id = partition << 40  # up to 2**40 sequences a partition
        self.size, self.limit = size, open_windows
        self.open: list[list] = []  # [tokens, pieces]
        self.rows: list[tuple] = []

    def emit(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            self.rows.append((doc, start, n, zlib.crc32(ids), total, self.next_id, offset))
            offset += n
        self.next_id += 1

    def add(self, doc, start: int, ids: bytes, total: int) -> None:
        at, left = 0, len(ids) // 4
        while left >= self.size:
            self.emit([(doc, start + at, ids[4 * at: 4 * (at + self.size)], total)])
            at, left = at + self.size, left - self.size
        if not left:
            return
        best = max((w for w in self.open if w[0] + left <= self.size),
                   key=lambda w: w[0], default=None)
        if best is None and len(self.open) >= self.limit:
            fullest = max(self.open, key=lambda w: w[0])
            room = self.size - fullest[0]
            fullest[1].append((doc, start + at, ids[4 * at: 4 * (at + room)], total))
            self.emit(fullest[1])
            self.open.remove(fullest)
            at, left = at + room, left - room
        if best is None:
            self.open.append(best := [0, []])
        best[0] += left
        best[1].append((doc, start + at, ids[4 * at:], total))
        if best[0] == self.size:
            self.emit(best[1])
            self.open.remove(best)

    def merge_open(self) -> list[tuple]:
        """Fill windows from the open ones, fullest first; the pieces that are left over."""
        self.open.sort(key=lambda w: -w[0])
        pieces = [p for w in self.open for p in w[1]]
        self.open = []
        while sum(len(p[2]) for p in pieces) >= 4 * self.size:
            self.emit(self.take(pieces, self.size))
        return pieces

    @staticmethod
    def take(pieces: list[tuple], tokens: int) -> list[tuple]:
        """Remove the first ``tokens`` tokens of ``pieces``, cutting the last piece."""
        out = []
        while tokens:
            doc, start, ids, total = pieces.pop(0)
            n = min(tokens, len(ids) // 4)
            out.append((doc, start, ids[:4 * n], total))
            if n < len(ids) // 4:
                pieces.insert(0, (doc, start + n, ids[4 * n:], total))
            tokens -= n
        return out

    def finish(self) -> None:
        pieces = self.merge_open()
        left = sum(len(p[2]) for p in pieces) // 4
        while left:
            n = 1 << (left.bit_length() - 1)
            self.emit(self.take(pieces, n))
            left -= n

    def drain(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [()] * len(_FIELDS)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                          names=_FIELDS)


def _with_leftover(rows: pa.RecordBatch, left: list[tuple], partition: int) -> pa.RecordBatch:
    """The rows with two more columns; each leftover piece is a row that carries its ids."""
    extra = [(d, s, len(i) // 4, 0, t, 0, 0, i, partition) for d, s, i, t in left]
    columns = list(zip(*extra)) or [()] * 9
    types = [pa.int64()] * 7 + [pa.binary(), pa.int64()]
    more = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                      names=[*_FIELDS, "ids", "partition"])
    nulls = [pa.nulls(rows.num_rows, pa.binary()), pa.nulls(rows.num_rows, pa.int64())]
    full = pa.RecordBatch.from_arrays([*rows.columns, *nulls], names=more.schema.names)
    return pa.concat_batches([full, more])


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 2, size: int = WINDOW) -> DataFrame:
    """One row per piece of ``docs(doc_id, text)``: doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset.

    A document is its token ids and ``end_id`` (null or empty text: ``end_id`` alone); every id
    is in exactly one piece.  Repeated rows are packed once each.  A null doc_id stays null
    in its pieces.  Other columns are ignored; an empty table gives no rows.  ``sequence_id`` is unique, not gapless.  Sequences are full
    but for the last of each merge, whose lengths are powers of two: nothing is padded."""
    end = np.asarray([end_id], "<u4").tobytes()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, partition = _word_ids(tokenizer), TaskContext.get().partitionId()
        packer = Packer(partition, size)
        for batch in text_batches(batches, limit=4 << 20):
            for doc, ids in zip(batch.column(0).to_pylist(), words.of(byte_texts(batch))):
                ids += end
                packer.add(doc, 0, ids, len(ids) // 4)
            yield _with_leftover(packer.drain(), [], partition)
        left = packer.merge_open()
        yield _with_leftover(packer.drain(), left, partition)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, group = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["merged"] != group:
                    if packer:
                        packer.finish()
                        yield packer.drain()
                    group = row["merged"]
                    packer = Packer((1 << 22) + group, size)  # above any partition's ids
                packer.add(row["doc_id"], row["start"], row["ids"], row["doc_tokens"])
        if packer:
            packer.finish()
            yield packer.drain()

    placed = written(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
                     .mapInArrow(frugal(place), _PIECE + ", ids binary, partition long"),
                     "placed", batch_rows=TEXT_ROWS)
    left = (placed.where("ids is not null")
            .withColumn("merged", F.floor(F.col("partition") / MERGED_PARTITIONS))
            .repartition("merged").sortWithinPartitions("merged", "partition", "doc_id", "start")
            .mapInArrow(frugal(merge), _PIECE))
    return placed.where("ids is null").select(*_FIELDS).unionByName(written(left, "merged", batch_rows=TEXT_ROWS))
