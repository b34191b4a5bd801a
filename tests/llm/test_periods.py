"""Periodic runs: brute force over random sequences and texts, long periodic texts, edges, the planted query."""

import random
import zlib

import numpy as np
import pytest

from cinderframe.llm import periods
from cinderframe.llm.queries import planted_runs

ROWS = "doc_id long, text string, runs string, n_words int, collapsed long, words string"


def plain_runs(w):
    """Every run of the sequence, by trying each period."""
    best = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                best.setdefault((i, j + q), q)
            i = j
    return sorted((s, e, q) for (s, e), q in best.items())


def random_words(rng):
    letters = rng.choice([1, 2, 2, 3, 5, 50])
    words = [rng.randrange(letters) for _ in range(rng.choice([0, 1, 5, 8, 30, 100, 300]))]
    for _ in range(rng.randrange(4)):
        part = words[:rng.randrange(1, 12)] if rng.random() < .5 else [
            rng.randrange(letters) for _ in range(rng.randrange(1, 20))]
        at = rng.randrange(len(words) + 1)
        words[at:at] = part * rng.randrange(1, 9)
    return words


def test_runs_equal_brute_force():
    rng = random.Random(11)
    for _ in range(400):
        docs = [random_words(rng) for _ in range(rng.randrange(1, 6))]
        starts = np.cumsum([0] + [len(d) for d in docs])
        ids = np.array([x for d in docs for x in d], np.int32)
        got = list(zip(*(a.tolist() for a in periods.find_runs(ids, starts[:-1]))))
        want = [(s + o, e + o, q) for d, o in zip(docs, starts.tolist()) for s, e, q in plain_runs(d)]
        assert got == sorted(want, key=lambda r: (r[0], r[2])), docs


def test_long_periods_and_long_texts():
    rng = random.Random(4)
    part = [rng.randrange(10 ** 6) for _ in range(5000)]
    for words, want in (
            ([7] * 200_000, [(0, 200_000, 1)]), ([1, 2] * 60_000 + [1], [(0, 120_001, 2)]),
            ([1] * 50_000 + [2] + [1] * 50_000, [(0, 50_000, 1), (50_001, 100_001, 1)]),
            ([-0 + 9] + part * 4, [(1, 20_001, 5000)]), (part * 3 + part[:-1], []),
            (part + ([1, 1, 1, 1, 1, 1, 2] * 5), [(5000 + 7 * k, 5006 + 7 * k, 1) for k in range(5)] + [(5000, 5035, 7)]),
            ([bin(i).count("1") % 2 for i in range(1 << 14)], [])):  # overlap-free, and hard on the hash
        got = periods.find_runs(np.array(words, np.int32), np.array([0]))
        assert sorted(zip(*(a.tolist() for a in got))) == sorted(want)


def test_hash_that_lies_is_corrected(monkeypatch):
    rng = random.Random(9)
    real = periods.Words.equal

    def lying(self, x, y, n):
        return real(self, x, y, n) | (np.asarray(x) % 7 == 0)

    monkeypatch.setattr(periods.Words, "equal", lying)
    for _ in range(150):
        words = random_words(rng)
        got = periods.find_runs(np.array(words, np.int32), np.array([0]))
        found = set(zip(*(a.tolist() for a in got)))
        for s, e, q in found:
            assert words[s:e - q] == words[s + q:e] and e - s >= max(6, 4 * q)


def judged(text):
    words = (text or "").split(" ")
    words = [w for w in words if w]
    runs = plain_runs(words)
    gone = {i for s, e, q in runs for i in range(s + q, e)}
    return (len(words), [(s, e - s, q) for s, e, q in sorted(runs, key=lambda r: (r[0], r[2]))],
            " ".join(w for i, w in enumerate(words) if i not in gone))


def test_documents(spark):
    rng = random.Random(6)
    texts = [" ".join(f"w{x}" for x in random_words(rng)) for _ in range(120)]
    texts += [None, "", "   ", "a a a a a a", "a a a a a", "é b é b é b é b", "ha " * 3000, "x" * 200_000,
              "a b c a b c a b c a b c", "a b c a b c a b c a b c"]
    rows = [(i, t, "r", 1, 2, "w") for i, t in enumerate(texts)] + [(None, "z z z z z z z", "r", 1, 2, "w"),
                                                                   (3, texts[3], "r", 1, 2, "w")]
    df = spark.createDataFrame(rows, ROWS).repartition(3)
    out = periods.periodic_runs(df).collect()
    assert len(out) == len(rows)
    for r in out:
        text = "z z z z z z z" if r.doc_id is None else texts[r.doc_id]
        n, runs, collapsed = judged(text)
        assert (r.n_words, [tuple(x) for x in r.runs], r.collapsed) == (n, runs, collapsed)
    assert periods.periodic_runs(df.limit(0)).count() == 0


def test_any_ascii_space_parts_words(spark):
    df = spark.createDataFrame([(1, "\ta\x0ba\x0ca\ra\na a\t", "r", 1, 2, "w"), (2, "a a a a \x85 a", "r", 1, 2, "w")], ROWS)
    got = {r.doc_id: r for r in periods.periodic_runs(df).collect()}
    assert got[1].n_words == 6 and got[1].collapsed == "a" and [tuple(x) for x in got[1].runs] == [(0, 6, 1)]
    assert got[2].n_words == 4 and got[2].runs == []


def test_strongest_run(spark):
    rows = [([(5, 9, 2), (1, 9, 2), (0, 8, 1)],), ([(3, 9, 2), (4, 18, 4), (9, 9, 2)],), ([],), ([(1, 13, 3), (2, 13, 3)],)]
    df = spark.createDataFrame(rows, "runs array<struct<start: long, length: long, period: long>>")
    got = [r[0] for r in df.select(periods.strongest(df["runs"])).collect()]
    assert [g and tuple(g) for g in got] == [(0, 8, 1), (3, 9, 2), None, (1, 13, 3)]


@pytest.mark.parametrize("text", ["a b c d e f g h i j", "one", "", None, "x  y\tz"])
def test_planted_texts(spark, text):
    ids = list(range(60)) + [None]
    got = {r.doc_id: r.text for r in planted_runs(spark.createDataFrame([(i, text) for i in ids], "doc_id long, text string")).collect()}
    words = (text or "").split()
    for i in ids:
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 or not words:
            assert got[i] == text
            continue
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        assert got[i] == " ".join(words[k] if k < a else words[a + (k - a) % p] for k in range(n))
