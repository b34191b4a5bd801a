r"""Periodic runs of words, found in a Re-Pair grammar of the word ids.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are equal) of at
least ``max(6, 4 q)`` words that no neighbouring word extends.

The texts of an Arrow batch get one grammar.  Rounds replace repeated pairs of neighbouring symbols, more
frequent ones first, until none repeats; the symbols left of each document are then paired up to one root.
A nonterminal stands for one string wherever it is derived, so what crosses the boundary between its two
halves is computed once, at its first place:

* a run across the boundary has two whole periods on one side of it, so an even-sized piece of words next
  to the boundary comes again ``q`` words further; only such ``q`` are looked at;
* the period is followed to both ends of the nonterminal by bisection over a rolling hash, and every run
  that results is compared word by word (a hash that lied is corrected there).

Runs are then translated to all places where their nonterminal is derived.  A run is found whole in the
smallest derivation that holds it; parts of it found further down lie inside it and are merged away, and
so are multiples of its period.

Documents never share a symbol pair, so no run crosses them.  Spark parts the documents; nothing is
shuffled.  A batch is cut at ``BATCH_BYTES`` of text or one document: memory in a task follows the longest
text (about 60 bytes a byte of it).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_texts, mixed, text_batches

LEAST_WORDS, LEAST_PERIODS = 6, 4
BATCH_BYTES = 4 << 20
SMALL_PERIODS = 96  # periods up to this are tried for all nonterminals at once

_SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def _ranges(counts: np.ndarray) -> np.ndarray:
    """0 .. c-1 for every count c, joined."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


class Grammar:
    """A grammar of several words sequences: rules ``left``, ``right`` of two symbols each.

    Symbols below ``terminals`` are word ids, symbol ``terminals + k`` is rule ``k``.  ``size`` is the length of
    a rule's string, ``first`` a place where it stands, ``blocks`` the rounds that made the rules (a rule's
    symbols come from earlier rounds), ``roots`` the symbol of every non-empty sequence."""

    def __init__(self, ids: np.ndarray, starts: np.ndarray):
        self.terminals = int(ids.max(initial=-1)) + 1
        self.left, self.right, self.size, self.first = [], [], [], []
        self.blocks, self.rules = [], 0
        ends = np.append(starts[1:], len(ids))
        full = ends > starts
        self.root_at = starts[full]
        self.seq, self.at = ids.astype(np.int64), np.arange(len(ids))
        self.width = np.ones(len(ids), np.int64)
        self.last = np.zeros(len(ids), bool)  # no pair with the next symbol
        self.last[ends[full] - 1] = True
        while (chosen := self._repeated()) is not None:
            self._replace(chosen)
        while not self.last.all():
            self._replace(self._neighbours())
        self.roots = self.seq
        for name in ("left", "right", "size", "first"):
            parts = getattr(self, name)
            setattr(self, name, np.concatenate(parts) if parts else np.zeros(0, np.int64))
        del self.seq, self.at, self.width, self.last

    def _codes(self, at: np.ndarray) -> np.ndarray:
        return self.seq[at] * (self.terminals + self.rules) + self.seq[at + 1]

    def _repeated(self) -> np.ndarray | None:
        """Places of pairs to replace in this round, none overlapping: of the pairs that occur
        again, those that come before both neighbours in order of frequency (by powers of two)
        and then at random, so that rounds are few whatever the text."""
        at = np.flatnonzero(~self.last)
        code = self._codes(at)
        spread = mixed(code.astype(np.uint64))
        bucket = (spread >> np.uint64(42)).astype(np.int64)
        again = np.bincount(bucket, minlength=1)[bucket] > 1
        at, code, spread = at[again], code[again], spread[again]
        if not len(at):
            return None
        order = np.argsort(code, kind="stable")
        ordered = code[order]
        new = np.append(True, ordered[1:] != ordered[:-1])
        counts = np.diff(np.append(np.flatnonzero(new), len(ordered)))
        often = np.empty(len(at), np.int64)
        often[order] = np.repeat(counts, counts)
        again = often > 1
        at, spread, often = at[again], spread[again], often[again]
        if not len(at):
            return None
        level = np.frexp(often.astype(np.float64))[1].astype(np.uint64)
        rank = np.zeros(len(self.seq) + 1, np.uint64)
        rank[at + 1] = level << np.uint64(58) | spread >> np.uint64(6) | np.uint64(1)
        # Runs of one rank: "a a a a" gives the same pair at each place.
        begin = np.append(0, np.flatnonzero(rank[1:] != rank[:-1]) + 1)
        of = rank[begin]
        before, after = np.append(np.uint64(0), of[:-1]), np.append(of[1:], np.uint64(0))
        best = (of > before) & (of > after)
        length = np.diff(np.append(begin, len(rank)))[best]
        pairs = (length + 1) // 2
        return np.repeat(begin[best] - 1, pairs) + 2 * _ranges(pairs)

    def _neighbours(self) -> np.ndarray:
        """Every second place of each sequence that has a next one."""
        begin = np.flatnonzero(np.append(True, self.last[:-1]))
        length = np.diff(np.append(begin, len(self.last)))
        return np.repeat(begin, length // 2) + 2 * _ranges(length // 2)

    def _replace(self, chosen: np.ndarray) -> None:
        code = self._codes(chosen)
        kinds, place, which = np.unique(code, return_index=True, return_inverse=True)
        place = chosen[place]
        self.left.append(self.seq[place])
        self.right.append(self.seq[place + 1])
        self.size.append(self.width[place] + self.width[place + 1])
        self.first.append(self.at[place])
        self.blocks.append((self.rules, self.rules + len(kinds)))
        self.seq[chosen] = self.terminals + self.rules + which
        self.width[chosen] += self.width[chosen + 1]
        self.last[chosen] = self.last[chosen + 1]
        self.rules += len(kinds)
        stays = np.ones(len(self.seq), bool)
        stays[chosen + 1] = False
        self.seq, self.at = self.seq[stays], self.at[stays]
        self.width, self.last = self.width[stays], self.last[stays]


class Words:
    """Word ids with a rolling hash that compares any two pieces in constant time."""

    def __init__(self, ids: np.ndarray):
        self.ids = ids
        n = len(ids)
        self.power = np.cumprod(np.append(np.uint64(1), np.full(n, 0x9E3779B97F4A7C15, np.uint64)))
        hashed = mixed(ids.astype(np.uint64) + np.uint64(0x51ED270B))
        self.sums = np.append(np.uint64(0), np.cumsum(hashed * self.power[:n]))

    def equal(self, x, y, n):
        """Whether the ``n`` words from ``x`` have the hash of those from ``y`` (``y >= x``)."""
        return (self.sums[x + n] - self.sums[x]) * self.power[y - x] == self.sums[y + n] - self.sums[y]

    def common(self, x: np.ndarray, y: np.ndarray, limit: np.ndarray, backward: bool) -> np.ndarray:
        """Length of the equal words from x and y on (or before them), at most ``limit``."""
        found = np.zeros(len(x), np.int64)
        step = 1 << max(int(limit.max(initial=0)).bit_length() - 1, 0)
        while step:
            n = found + step
            fits = np.flatnonzero(n <= limit)
            m = n[fits]
            back = m if backward else 0
            same = fits[self.equal(x[fits] - back, y[fits] - back, m)]
            found[same] += step
            step >>= 1
        return found


def _side(words: Words, at: np.ndarray, cap: np.ndarray, sign: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(which, period): boundaries ``at`` beside which the words come again one period further,
    to the right (sign 1) or the left (-1), for periods up to ``cap``."""
    order = np.argsort(-cap, kind="stable")
    falling = -cap[order]
    ids = words.ids
    own = ids[at[order] - (sign < 0)] if len(order) else order
    for q in range(1, min(SMALL_PERIODS, int(cap.max(initial=0))) + 1):
        some = order[: np.searchsorted(falling, -q, side="right")]
        b = at[some]
        hit = np.flatnonzero(ids[b + sign * q - (sign < 0)] == own[: len(some)])
        some, b = some[hit], b[hit]
        m = 1 << (q.bit_length() - 1)
        low = b if sign > 0 else b - q - m
        hit = words.equal(low, low + q, m)
        yield some[hit], np.full(int(hit.sum()), q)
    for i in order[: np.searchsorted(falling, -SMALL_PERIODS)].tolist():
        b, most, q = int(at[i]), int(cap[i]), SMALL_PERIODS + 1
        while q <= most:
            m = 1 << (q.bit_length() - 1)
            end = min(most, 2 * m - 1) + 1
            if sign > 0:
                hit = np.flatnonzero(ids[b + q: b + end] == ids[b]) + q
                hit = hit[words.equal(at[i: i + 1], b + hit, m)]
            else:
                hit = end - 1 - np.flatnonzero(ids[b - end: b - q] == ids[b - 1])
                hit = hit[words.equal(b - hit - m, np.full(len(hit), b - m), m)]
            if len(hit):
                yield np.full(len(hit), i), hit
            q = end


def _crossing(grammar: Grammar, words: Words) -> tuple[np.ndarray, ...]:
    """Runs across the boundary of each rule, inside its string: (rule, start, end, period), with
    places of the rule's first occurrence, sorted by rule."""
    rule = np.flatnonzero(grammar.size >= LEAST_WORDS)
    low = grammar.first[rule]
    high = low + grammar.size[rule]
    left = grammar.left[rule]
    inner = left >= grammar.terminals
    cut = low + 1
    cut[inner] = low[inner] + grammar.size[left[inner] - grammar.terminals]
    whole = (high - low) // LEAST_PERIODS
    found = []
    for sign, beside in ((1, high - cut), (-1, cut - low)):
        for which, q in _side(words, cut, np.minimum(beside // 2, whole), sign):
            found.append((which, cut[which] if sign > 0 else cut[which] - q, q))
    if not found:
        return (np.zeros(0, np.int64),) * 4
    which, x, q = map(np.concatenate, zip(*found))
    end = x + q + words.common(x, x + q, high[which] - x - q, False)
    start = x - words.common(x, x + q, x - low[which], True)
    some = np.flatnonzero(end - start >= np.maximum(LEAST_WORDS, LEAST_PERIODS * q))
    which, x, q, start, end = (a[some] for a in (which, x, q, start, end))
    # The hash can only say too much: the words have the last word.
    ids = words.ids
    order = np.lexsort((q, end, start, which))
    seen, kept = None, []
    for i in order.tolist():
        same = (which[i], start[i], end[i])
        if same == seen:
            continue  # a multiple of the period before
        s, e, p = int(start[i]), int(end[i]), int(q[i])
        odd = np.flatnonzero(ids[s: e - p] != ids[s + p: e])
        if len(odd):
            s, e = _true_ends(odd + s, int(x[i]), s, e, p)
            if e - s < max(LEAST_WORDS, LEAST_PERIODS * p):
                continue
        else:
            seen = same
        kept.append((rule[which[i]], s, e, p))
    return tuple(np.asarray(kept, np.int64).reshape(-1, 4).T)


def _true_ends(odd: np.ndarray, x: int, start: int, end: int, period: int) -> tuple[int, int]:
    """The stretch around ``x`` between places whose word differs from that a period further."""
    after = odd[odd >= x]
    before = odd[odd < x]
    return (int(before[-1]) + 1 if len(before) else start), (int(after[0]) + period if len(after) else end)


def _translated(grammar: Grammar, runs: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """(start, end, period) at every place where the runs' rules are derived."""
    of, start, end, period = runs
    live = np.zeros(grammar.terminals + grammar.rules, bool)
    live[grammar.terminals + of] = True
    for a, b in grammar.blocks:
        live[grammar.terminals + a: grammar.terminals + b] |= live[grammar.left[a:b]] | live[grammar.right[a:b]]
    begin = np.searchsorted(of, np.arange(grammar.rules + 1))
    out = []
    symbol, at = grammar.roots, grammar.root_at
    while len(symbol):
        some = live[symbol]
        rule, at = symbol[some] - grammar.terminals, at[some]
        counts = begin[rule + 1] - begin[rule]
        which = np.repeat(begin[rule], counts) + _ranges(counts)
        moved = np.repeat(at - grammar.first[rule], counts)
        out.append((start[which] + moved, end[which] + moved, period[which]))
        left = grammar.left[rule]
        width = np.ones(len(rule), np.int64)
        inner = left >= grammar.terminals
        width[inner] = grammar.size[left[inner] - grammar.terminals]
        symbol, at = np.append(left, grammar.right[rule]), np.append(at, at + width)
    return tuple(map(np.concatenate, zip(*out)))


def find_runs(ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """(start, end, period) of every run in the sequences that begin at ``starts``, by start, then period."""
    none = (np.zeros(0, np.int64),) * 3
    if not len(ids):
        return none
    grammar = Grammar(ids, starts)
    crossing = _crossing(grammar, Words(ids))
    if not len(crossing[0]):
        return none
    start, end, period = _translated(grammar, crossing)
    # Parts of a run lie inside it.
    order = np.lexsort((-end, start, period))
    start, end, period = start[order], end[order], period[order]
    reach = np.maximum.accumulate(end + period * (len(ids) + 1))
    whole = np.append(True, reach[1:] > reach[:-1])
    start, end, period = start[whole], end[whole], period[whole]
    # A multiple of a run's period has the run's own ends.
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    least = np.append(True, (start[1:] != start[:-1]) | (end[1:] != end[:-1]))
    start, end, period = start[least], end[least], period[least]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def _judge(docs: pa.Array, texts: list[bytes]) -> pa.RecordBatch:
    words: list[bytes] = []
    starts = [0]
    for text in texts:
        words += text.split()
        starts.append(len(words))
    starts = np.asarray(starts)
    ids = pa.array(words, pa.binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int32)
    start, end, period = find_runs(ids, starts[:-1])
    change = np.zeros(len(ids) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, end, -1)
    kept = (np.cumsum(change)[:-1] == 0)
    cut = np.searchsorted(start, starts)
    doc = np.repeat(np.arange(len(texts)), np.diff(cut))
    runs = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.StructArray.from_arrays(
        [pa.array(start - starts[doc]), pa.array(end - start), pa.array(period)], ["start", "length", "period"]))
    bounds = starts.tolist()
    collapsed = [b" ".join(compress(words[a:b], kept[a:b]) if i < j else words[a:b])
                 for a, b, i, j in zip(bounds, bounds[1:], cut.tolist(), cut[1:].tolist())]
    return pa.RecordBatch.from_arrays(
        [docs, pa.array(np.diff(starts)), runs, pa.array(collapsed, pa.binary()).cast(pa.string())],
        names=["doc_id", "n_words", "runs", "collapsed"])


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_batches(batches, limit=BATCH_BYTES):
        yield _judge(batch.column(0), byte_texts(batch))


def periodic_runs(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_words, runs (array of start, length, period
    in words, by start, then period), collapsed (the words, joined by one space, without those that
    a run holds after its first period).

    Words are runs of characters other than ASCII white space.  A null or empty text has no words,
    no runs and an empty collapsed text; a null doc_id stays; repeated rows are judged once each;
    runs of equal start are in order of their period; other columns are ignored; an empty table
    gives no rows."""
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(_judged, _SCHEMA))


def strongest(runs: Column) -> Column:
    """The run of the greatest length by period, compared as fractions; of equal ones the first."""
    def better(best: Column, run: Column) -> Column:
        more = best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"])
        return F.when(more, run).otherwise(best)

    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    return F.aggregate(runs, none, better)
