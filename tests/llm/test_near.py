"""Embedding, MinHash and benchmark matches against brute force; edge rows."""

import collections
import math
import random

import numpy as np
import pytest

from cinderframe.llm import decontam, embed, minhash
from cinderframe.llm.common import WordHashes, connected_components

DOCS = "doc_id long, text string, value string, class string, node long"


def words(rng, n, pool=500):
    return [f"w{rng.randrange(pool)}" for _ in range(n)]


def components(n, links):
    label = list(range(n))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        label[max(a, b)] = min(a, b)
    return [root(x) for x in range(n)]


def test_connected_components_on_chain_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 130)] + [(7, 7), (200, 201)]
    random.Random(1).shuffle(edges)
    rows = connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()
    got = {r.node: r.component for r in rows}
    assert len(rows) == len(got)
    assert all(got[i] == 0 for i in range(41)) and all(got[x] == 100 for x in range(100, 130))
    assert got[201] == 200
    empty = connected_components(spark.createDataFrame([], "src long, dst long"))
    assert empty.count() == 0


def near_texts():
    rng = random.Random(5)
    texts = []
    for n in (3, 8, 40, 160):
        base = words(rng, n)
        texts.append(" ".join(base))
        for edits in (0, 1, 1, 2, 3, 4, 6):
            copy = list(base)
            for _ in range(edits):
                copy[rng.randrange(n)] = f"x{rng.randrange(10**6)}"
            texts.append("  ".join(copy).upper() if edits == 1 else "\n".join(copy))
    texts += ["", None, " \t ", "one", "one", "ONE", "two words", " ".join(words(rng, 9000))]
    return texts


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_equal_brute_force(spark, percent):
    texts = near_texts()
    hashes = WordHashes()
    sets = [set(minhash.shingle_set((t or "").encode(), hashes).tolist()) for t in texts]
    links = [(i, j) for i in range(len(sets)) for j in range(i)
             if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    want = components(len(texts), links)
    df = spark.createDataFrame([(i, t, "v", None, 1) for i, t in enumerate(texts)], DOCS)
    got = {r.doc_id: r for r in minhash.near_duplicates(df, percent).collect()}
    assert [got[i].component_id for i in range(len(texts))] == want
    assert [got[i].n_shingles for i in range(len(texts))] == [len(s) for s in sets]
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_near_copies_of_a_large_group_lose_no_link(spark):
    """Copies that differ from the smallest one by more than the threshold, but not from others."""
    rng = random.Random(9)
    base = words(rng, 120, 10**6)
    texts = []
    for _ in range(60):
        copy = list(base)
        for _ in range(rng.choice([1, 2, 3, 4, 5])):
            copy[rng.randrange(len(copy))] = f"y{rng.randrange(10**6)}"
        texts.append(" ".join(copy))
    hashes = WordHashes()
    sets = [set(minhash.shingle_set(t.encode(), hashes).tolist()) for t in texts]
    links = [(i, j) for i in range(60) for j in range(i)
             if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(df, 85).collect()}
    assert [got[i] for i in range(60)] == components(60, links)


def test_near_duplicates_of_nothing_and_of_rows_without_id(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    rows = minhash.near_duplicates(spark.createDataFrame(
        [(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (9, "A b c d e f")],
        "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.component_id, r.kept) for r in rows) == [
        (0, 4, True), (4, 4, True), (4, 4, True), (9, 4, False)]
    by = collections.Counter((r.doc_id, r.kept) for r in rows)
    assert by == {(None, True): 1, (4, True): 2, (9, False): 1}


def test_match_threshold():
    assert minhash.least_matches(85) < 0.85 * minhash.COORDINATES
    p = sum(math.comb(64, t) * 0.85**t * 0.15**(64 - t) for t in range(minhash.least_matches(85)))
    assert p <= minhash.MISS


def vectors(rng, dim=64):
    out = []
    for _ in range(12):
        center = rng.standard_normal(dim)
        center /= np.linalg.norm(center)
        for _ in range(25):
            v = center + rng.standard_normal(dim) * rng.choice([0.01, 0.025, 0.04, 0.06])
            out.append((v * rng.uniform(0.1, 9)).tolist())
    return out


def test_near_vectors_recall_and_edges(spark):
    rows = vectors(np.random.default_rng(3))
    x = np.array(rows, np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    truth = x @ x.T >= 0.95
    np.fill_diagonal(truth, False)
    odd = [None, [], [0.0] * 64, [float("nan")] + [1.0] * 63, [None] + [1.0] * 63,
           [float("inf")] * 64, [1.0, 0.0], [2.0, 0.0]]
    data = [(i, v, 1) for i, v in enumerate(rows + odd)]
    data += [(1000, rows[0], 2), (None, rows[0], 3)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, unit int")
    found = embed.near_vectors(df).collect()
    got = {r.vec_id: r for r in found}
    assert len(found) == len(data)
    base = len(rows)
    links = sum(got[i].n_links for i in range(base)) - truth[0].sum() - 1
    assert 0.99 * truth.sum() <= links <= truth.sum()
    assert got[1000].n_links == got[0].n_links and got[1000].component_id == got[0].component_id
    assert [got[base + i].n_links for i in range(8)] == [0] * 6 + [1, 1]
    assert got[base + 7].component_id == base + 6 and not got[base + 7].kept
    assert got[None].n_links == 0 and got[None].component_id is None and got[None].kept
    assert embed.near_vectors(df.limit(0)).count() == 0


def test_links_within_blocks_and_large_groups(spark, monkeypatch):
    """Cells of a few vectors give what one cell gives; every pair counts once."""
    rng = np.random.default_rng(5)
    center = rng.standard_normal(48)
    rows = [center + rng.standard_normal(48) * s for s in rng.choice([0.1, 0.2, 0.25], 500)]
    rows += list(rng.standard_normal((80, 48)))
    x = np.array(rows)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    truth = x @ x.T >= 0.95
    np.fill_diagonal(truth, False)
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], "vec_id long, embedding array<double>")
    whole = sorted(map(tuple, embed.near_vectors(df).collect()))
    monkeypatch.setattr(embed, "CELL_ROWS", 16)
    parted = sorted(map(tuple, embed.near_vectors(df).collect()))
    want = truth.sum(1)
    label = components(len(rows), zip(*np.nonzero(truth)))
    for got in (whole, parted):
        links = np.array([r[1] for r in got])
        assert (links <= want).all() and links.sum() >= 0.99 * want.sum()
        assert sum(r[2] == c for r, c in zip(got, label)) >= 0.99 * len(rows)


def test_smallest_reached_row():
    rng = random.Random(4)
    for _ in range(200):
        n = rng.randrange(1, 40)
        links = [(rng.randrange(n), rng.randrange(n)) for _ in range(rng.randrange(60))]
        i, j = (np.array([e[k] for e in links], int) for k in (0, 1))
        assert embed._smallest(n, i, j).tolist() == components(n, links)
    chain = np.random.default_rng(1).permutation(1000)
    assert (embed._smallest(1000, chain[:-1], chain[1:]) == 0).all()


BENCH = "item_id long, text string"


def plain(text):
    import re
    return [w for w in (re.sub(r"[\W_]+", "", x) for x in (text or "").lower().split()) if w]


def brute(docs, items, percent):
    def shingles(w):
        return [tuple(w[i: i + 5]) for i in range(len(w) - 4)] or ([tuple(w)] if w else [])
    out = {}
    for i, text in items:
        iw = plain(text)
        a = collections.Counter(shingles(iw))
        for d, doc in docs:
            w = plain(doc)
            n = min(len(iw), len(w))
            best = None
            for p in range(len(w) - n + 1) if n else []:
                b = collections.Counter(shingles(w[p: p + n]))
                s = sum((a & b).values()) / sum((a | b).values())
                if 100 * s >= percent and (best is None or s > best[0]):
                    best = (s, p)
            if best:
                out[d, i] = best
    return out


def test_contaminated_equals_brute_force(spark):
    rng = random.Random(11)
    items = [(i, " ".join(words(rng, n, 10**6))) for i, n in enumerate([4, 5, 6, 15, 30, 30, 59])]
    items += [(90, None), (91, ""), (92, "...")]
    docs = []
    for k in range(60):
        w = words(rng, rng.randrange(5, 200), 10**6)
        item = items[k % 7][1].split()
        if k % 3 == 0:
            item[rng.randrange(len(item))] = "changed"
        if k % 5 == 0:
            item = item[: len(item) * 9 // 10 + 1]
        at = rng.randrange(len(w))
        docs.append((k, " ".join(w[:at] + [x.title() + "," for x in item] + w[at:])))
    docs += [(100, items[4][1]), (101, None), (102, ""), (103, items[3][1] + " "), (104, "a b"),
             (105, " ".join([items[2][1]] * 400)), (106, items[0][1])]
    want = brute(docs, items, 80)
    df = spark.createDataFrame([(*d, "x", 1) for d in docs],
                               "doc_id long, text string, words string, _llm int")
    bench = spark.createDataFrame(items, BENCH)
    got = {(r.doc_id, r.item_id): (r.similarity, r.start_word)
           for r in decontam.contaminated(df, bench, 80).collect()}
    assert got == want
    kept = decontam.decontaminate(df, bench, 80)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in docs} - {d for d, _ in want}
    assert decontam.contaminated(df.limit(0), bench).count() == 0
    assert decontam.decontaminate(df, bench.limit(0)).count() == df.count()
