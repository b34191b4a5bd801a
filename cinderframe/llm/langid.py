"""Language identification of words and documents with a linear-chain CRF.

A text is a sequence of words (runs of letters; a run of more than ``LONGEST`` bytes, as in scripts
without spaces, enters as consecutive pieces that are a word each).  Each word gets a score per language from
its affixes (2-4 bytes at either end), its byte trigrams and a lexicon (the word itself); one
learned matrix scores the transition between the languages of neighbouring words.
Forward-backward gives the probability of every language for every word, so a text that
switches languages is labelled word by word; the mean over its words is the document's score.

The model is trained on a bounded sample of labelled rows (``TRAIN_WORDS`` words for each
language, of rows that a hash names).  Half of its sequences are spliced from two
languages, from which the transitions learn how languages switch.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import frugal, text_batches, written

TRAIN_WORDS = 12_000     # labelled words for each language, at most
TRAIN_ROWS = 300         # rows for each language that they come from, about
ROW_WORDS = 240          # words of one row, from a place that its hash names
SEQUENCE = 32            # words in a sequence
BUCKETS = 1 << 16        # rows of the feature weights
LONGEST = 32             # bytes of a word; longer runs are cut into pieces
OVERLAP = 2              # bytes that neighbouring pieces share: every trigram is in one of them
CUT = b"\0"              # marks the ends of a piece where its run goes on
EPOCHS, RATE, DECAY = 4, 0.1, 1e-4
CACHED_WORDS = 300_000
TEXT_ROWS = 512
UNDETERMINED = "und"

_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray      # BUCKETS x labels
    transitions: np.ndarray  # labels x labels


# --- features ------------------------------------------------------------------------------

def _hashed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return ((h ^ (h >> np.uint64(32))) % np.uint64(BUCKETS)).astype(np.int32)


def features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(feature rows, whether present) of each word or piece, as words x features arrays."""
    first = np.fromiter((not w.startswith(CUT) for w in words), bool, len(words))
    last = np.fromiter((not w.endswith(CUT) for w in words), bool, len(words))
    short = [w.strip(CUT) for w in words]
    n = np.fromiter(map(len, short), np.int64, len(short))
    table = np.zeros((len(short), LONGEST), np.uint64)
    flat = np.frombuffer(b"".join(short), np.uint8)
    rows = np.repeat(np.arange(len(short)), n)
    cols = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
    table[rows, cols] = flat
    prime = np.uint64(0x100000001B3)
    index, present = [], []

    def put(kind: int, h: np.ndarray, there: np.ndarray) -> None:
        index.append(_hashed(h * np.uint64(31) + np.uint64(kind)))
        present.append(there)

    lexicon = np.zeros(len(short), np.uint64)
    for j in range(LONGEST):
        lexicon = lexicon * prime + table[:, j]
    put(1, lexicon, (n > 0) & first & last)
    every = np.arange(len(short))
    for size in (2, 3, 4):
        head, tail = np.zeros(len(short), np.uint64), np.zeros(len(short), np.uint64)
        for j in range(size):
            head = head * prime + table[:, j]
            tail = tail * prime + table[every, np.maximum(n - size + j, 0)]
        put(10 + size, head, (n >= size) & first)
        put(20 + size, tail, (n >= size) & last)
    for j in range(LONGEST - 2):
        there = n >= j + 3
        if not there.any():
            break
        gram = (table[:, j] * prime + table[:, j + 1]) * prime + table[:, j + 2]
        put(30, gram, there)
    return np.stack(index, 1), np.stack(present, 1)


def _scores(model_weights: np.ndarray, words: list[bytes]) -> np.ndarray:
    out = np.zeros((len(words), model_weights.shape[1]), np.float64)
    for i in range(0, len(words), 8192):
        index, present = features(words[i: i + 8192])
        for j in range(index.shape[1]):
            out[i: i + 8192] += model_weights[index[:, j]] * present[:, j, None]
    return out


# --- forward-backward ------------------------------------------------------------------------

def marginals(scores: np.ndarray, transitions: np.ndarray, lengths: np.ndarray):
    """Probabilities of the labels of every word, and expected transitions.

    ``scores``: sequences x words x labels, padded behind ``lengths`` words."""
    count, steps, labels = scores.shape
    move = np.exp(transitions)
    emit = np.exp(scores - scores.max(2, keepdims=True))
    alpha = np.empty_like(emit)
    beta = np.ones_like(emit)
    alpha[:, 0] = emit[:, 0] / emit[:, 0].sum(1, keepdims=True)
    for t in range(1, steps):
        a = (alpha[:, t - 1] @ move) * emit[:, t]
        alpha[:, t] = a / a.sum(1, keepdims=True)
    for t in range(steps - 2, -1, -1):
        b = (beta[:, t + 1] * emit[:, t + 1]) @ move.T
        inside = (t + 1 < lengths)[:, None]
        beta[:, t] = np.where(inside, b / b.sum(1, keepdims=True), 1.0)
    p = alpha * beta
    p /= p.sum(2, keepdims=True)
    return p, alpha, beta, emit, move


def _expected_moves(alpha, beta, emit, move, lengths) -> np.ndarray:
    total = np.zeros_like(move)
    for t in range(alpha.shape[1] - 1):
        pair = alpha[:, t, :, None] * move * (beta[:, t + 1] * emit[:, t + 1])[:, None, :]
        pair /= pair.sum((1, 2), keepdims=True)
        total += pair[t + 1 < lengths].sum(0)
    return total


# --- training ----------------------------------------------------------------------------------

def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def pieces_of(words: list[str]) -> list[str | bytes]:
    """The words, with those of more than ``LONGEST`` bytes cut into even pieces."""
    out: list[str | bytes] = []
    for word in words:
        if 4 * len(word) <= LONGEST or len(run := word.encode("utf-8", "replace")) <= LONGEST:
            out.append(word)
            continue
        size = len(run) - OVERLAP
        count = -(-size // (LONGEST - OVERLAP))
        at = [i * size // count for i in range(count + 1)]
        out += [CUT * (i > 0) + run[at[i]: at[i + 1] + OVERLAP] + CUT * (i < count - 1) for i in range(count)]
    return out


def _bytes(word: str | bytes) -> bytes:
    return word if isinstance(word, bytes) else word.encode("utf-8", "replace")


def fit(samples: list[tuple[str, str]], seed: int = 7) -> Model:
    """Train on (language, text) rows: stochastic gradient of the conditional likelihood."""
    labels = sorted({lang for lang, _ in samples})
    rng = np.random.default_rng(seed)
    pieces = []  # (words, label numbers)
    for k, lang in enumerate(labels):
        words = [w for l, t in samples if l == lang for w in pieces_of(words_of(t))]
        pieces += [(words[i: i + SEQUENCE], k) for i in range(0, len(words), SEQUENCE)]
    order = rng.permutation(len(pieces))
    sequences = []
    for i, j in zip(order[::2], order[1::2]):  # every other pair of sequences is spliced
        (a, k), (b, m) = pieces[i], pieces[j]
        sequences += [(a, [k] * len(a)), (b, [m] * len(b))]
        cut = int(rng.integers(1, SEQUENCE))
        mix = a[:cut] + b[cut:]
        sequences.append((mix, [k] * len(a[:cut]) + [m] * len(b[cut:])))
        sequences.append((b[:cut] + a[cut:], [m] * len(b[:cut]) + [k] * len(a[cut:])))
    if len(pieces) == 1:
        sequences = [(pieces[0][0], [pieces[0][1]] * len(pieces[0][0]))]
    size = len(labels)
    weights, moves = np.zeros((BUCKETS, size)), np.zeros((size, size))
    spread = np.zeros(BUCKETS)
    spread_moves = 1.0
    for _ in range(EPOCHS if size > 1 else 0):
        rng.shuffle(sequences)
        for start in range(0, len(sequences), 64):
            some = [s for s in sequences[start: start + 64] if s[0]]
            if not some:
                continue
            lengths = np.array([len(w) for w, _ in some])
            steps = lengths.max()
            inside = np.arange(steps) < lengths[:, None]
            flat = [_bytes(w) for ws, _ in some for w in ws]
            index, present = features(flat)
            scores = np.zeros((len(some), steps, size))
            scores[inside] = (weights[index] * present[:, :, None]).sum(1)
            gold = np.zeros_like(scores)
            gold[inside] = np.eye(size)[np.concatenate([k for _, k in some])]
            p, alpha, beta, emit, move = marginals(scores, moves, lengths)
            error = (gold - p)[inside]
            rows = index[present]
            grad = np.repeat(error, present.sum(1), axis=0)
            step = np.zeros_like(weights)
            np.add.at(step, rows, grad)
            touched = np.unique(rows)
            spread[touched] += (step[touched] ** 2).sum(1)
            weights[touched] += (RATE * step[touched] / np.sqrt(spread[touched, None] + 1e-8)
                                 - DECAY * weights[touched])
            seen = np.einsum("nta,ntb->ab", gold[:, :-1], gold[:, 1:])
            change = seen - _expected_moves(alpha, beta, emit, move, lengths)
            spread_moves += (change ** 2).sum()
            moves += RATE * change / np.sqrt(spread_moves)
    return Model(labels, weights, moves)


def training_rows(docs: DataFrame) -> DataFrame:
    """(lang, text) of at most about ``TRAIN_ROWS`` rows for each language.

    Rows are taken by a hash of their id, at a rate that follows each language's row count, so
    every language fills its share and nothing is sorted or gathered to choose them."""
    labelled = docs.where("lang is not null and text is not null and doc_id is not null")
    rates = written(labelled.groupBy("lang").agg(F.count("*").alias("rows")), "rates")
    big = F.lit(1_000_003)
    share = F.pmod(F.xxhash64("doc_id", F.lit(11)), big) / big
    # The ids are chosen first, so that no text moves for the choice.
    chosen = written(labelled.select("doc_id", "lang").join(rates, "lang")
                     .where(share < F.lit(float(TRAIN_ROWS)) / F.col("rows"))
                     .select("doc_id", "lang").distinct(), "chosen")
    words = F.split("text", r"\s+")
    start = F.floor(F.pmod(F.xxhash64("doc_id", F.lit(13)), big) / big
                    * F.greatest(F.size(words) - ROW_WORDS, F.lit(0))).cast("int") + 1
    return (labelled.join(chosen, ["doc_id", "lang"])
            .select("lang", F.array_join(F.slice(words, start, ROW_WORDS), " ").alias("text")))


def train(docs: DataFrame) -> Model:
    """A model from the labelled rows of ``docs(lang, text)``; the sample that reaches the
    driver has about ``TRAIN_ROWS`` rows of ``ROW_WORDS`` words for each language."""
    taken: dict[str, list[str]] = {}
    for lang, text in sorted({tuple(r) for r in training_rows(docs).collect()}):
        taken.setdefault(lang, []).append(text)
    samples = []
    for lang, texts in taken.items():
        left = TRAIN_WORDS
        for text in texts:
            words = []
            for word in words_of(text):
                cost = len(pieces_of([word]))
                if cost > left:  # what is left of the sample takes the start of a long run
                    word = word.encode("utf-8", "replace")[: left * (LONGEST - OVERLAP)].decode("utf-8", "ignore")
                    cost = left
                if word:
                    words.append(word)
                left -= cost
                if not left:
                    break
            samples.append((lang, " ".join(words)))
            if not left:
                break
    return fit([s for s in samples if s[1]])


# --- prediction --------------------------------------------------------------------------------

class _Labeller:
    def __init__(self, model: Model):
        self.model = model
        self.rows: dict[str | bytes, int] = {}
        self.scores = np.zeros((1, len(model.labels)))

    def _numbers(self, words: list[str | bytes]) -> np.ndarray:
        new = list(dict.fromkeys(w for w in words if w not in self.rows))
        if len(self.rows) + len(new) > CACHED_WORDS:
            self.rows, new = {}, list(dict.fromkeys(words))
            self.scores = self.scores[:0]
        if new:
            base = len(self.rows)
            self.rows.update((w, base + i) for i, w in enumerate(new))
            more = _scores(self.model.weights, [_bytes(w) for w in new])
            self.scores = np.concatenate([self.scores[:base], more])
        return np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))

    def documents(self, texts: list[str | None]) -> list[tuple[str, float]]:
        found = [pieces_of(words_of(t)) if t else [] for t in texts]
        sizes = [len(w) for w in found]
        words = self._numbers([w for ws in found for w in ws])
        # All sequences of all texts at once; a text's last sequence is padded.
        pieces = [-(-n // SEQUENCE) for n in sizes]
        total = sum(pieces)
        if not total or not self.model.labels:
            return [(UNDETERMINED, 0.0)] * len(texts)
        lengths = np.concatenate([np.r_[np.full(p - 1, SEQUENCE), n - SEQUENCE * (p - 1)]
                                  for p, n in zip(pieces, sizes) if p]).astype(int)
        inside = np.arange(SEQUENCE) < lengths[:, None]
        owner = np.repeat(np.arange(len(texts)), pieces)
        mean = np.zeros((len(texts), len(self.model.labels)))
        ends = np.cumsum(lengths)
        for i in range(0, total, 4096):  # bounded memory, also within one long text
            part, size = inside[i: i + 4096], lengths[i: i + 4096]
            scores = np.zeros((*part.shape, len(self.model.labels)))
            scores[part] = self.scores[words[ends[i] - lengths[i]: ends[i + len(size) - 1]]]
            p = marginals(scores, self.model.transitions, size)[0] * part[:, :, None]
            np.add.at(mean, owner[i: i + 4096], p.sum(1))
        out = []
        for n, m in zip(sizes, mean):
            k = int(m.argmax())
            out.append((self.model.labels[k], min(1.0, float(m[k] / n))) if n
                       else (UNDETERMINED, 0.0))
        return out

    def words(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, probabilities of the labels) of every word; a word's pieces count alike."""
        low = text.lower()
        found = list(_WORD.finditer(low))
        cut = [pieces_of([m.group()]) for m in found]
        numbers = self._numbers([piece for pieces in cut for piece in pieces])
        p = np.empty((len(numbers), len(self.model.labels)))
        for i in range(0, len(numbers), SEQUENCE * 4096):  # bounded memory, also within one long text
            part = numbers[i: i + SEQUENCE * 4096]
            lengths = np.full(-(-len(part) // SEQUENCE), SEQUENCE)
            lengths[-1] = len(part) - SEQUENCE * (len(lengths) - 1)
            inside = np.arange(SEQUENCE) < lengths[:, None]
            scores = np.zeros((*inside.shape, len(self.model.labels)))
            scores[inside] = self.scores[part]
            p[i: i + len(part)] = marginals(scores, self.model.transitions, lengths)[0][inside]
        first = np.cumsum([0, *map(len, cut)])
        mean = np.add.reduceat(p, first[:-1], axis=0) / np.diff(first)[:, None] if found else p
        place = np.array([m.span() for m in found], np.int64).reshape(-1, 2)
        if len(low) != len(text):  # a letter whose lower case is several characters
            origin = np.repeat(np.arange(len(text)), [len(c.lower()) for c in text])
            place = np.stack([origin[place[:, 0]], origin[place[:, 1] - 1] + 1], 1)
        return place[:, 0], place[:, 1], mean


def spans(docs: DataFrame, model: Model) -> DataFrame:
    """The stretches of one language in each text of ``docs(doc_id, text)``, in order of their place.

    Rows of doc_id, span (from 0), start and end (code points, end exclusive), n_words, lang and
    score (mean probability of that language over the words): neighbouring words with the same most
    probable label, ties going to the first label by name.  Null texts, texts without a letter and a
    model without labels give no rows; repeated rows give theirs each, a null doc_id stays null and
    other columns are ignored.  Memory follows the longest text."""
    schema = "doc_id long, span long, start long, end long, n_words long, lang string, score double"
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = _Labeller(model)
        for batch in text_batches(batches, limit=4 << 20):
            for doc, text in zip(*(c.to_pylist() for c in batch.columns)):
                start, end, p = labeller.words(text) if text and model.labels else ([], [], None)
                if not len(start):
                    continue
                best = p.argmax(1)
                first = np.flatnonzero(np.r_[True, best[1:] != best[:-1]])
                last = np.r_[first[1:], len(best)]
                score = np.add.reduceat(p[np.arange(len(best)), best], first) / (last - first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc] * len(first), pa.int64()), pa.array(np.arange(len(first))), pa.array(start[first]),
                     pa.array(end[last - 1]), pa.array(last - first), pa.array([model.labels[k] for k in best[first]]),
                     pa.array(np.minimum(score, 1.0))], names=names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(frugal(run), schema)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred and score (mean probability of that language over all words).

    Null texts and texts without a letter get ``und`` and 0.  Reads ``text`` alone; every
    other column passes through, also ``lang``."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = _Labeller(model)
        for batch in text_batches(batches, limit=4 << 20):
            texts = batch.column(names.index("text")).to_pylist()
            langs, scores = zip(*labeller.documents(texts))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(langs), pa.array(scores)],
                names=[*names, "lang_pred", "score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(frugal(run), schema + ", lang_pred string, score double")


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from training: crc32 of its id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """Per row of ``docs(doc_id, text, lang)``: doc_id, held_out, lang_pred, score.

    Learns from the text and lang of documents that aren't held out; predicts from text."""
    model = train(docs.where(~held_out()))
    plain = docs.select("doc_id", F.col("text").cast("string").alias("text"),
                        held_out().alias("held_out"))
    labelled = written(predict(plain, model).drop("text"), "languages", batch_rows=TEXT_ROWS)
    return labelled.select("doc_id", "held_out", "lang_pred", "score")

