"""The pipeline: each stage's decisions, columns and edges; the registered queries and their SQL."""

import random

import corpus_pipeline
from cinderframe.llm.oracle import ORACLE
from cinderframe.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


def corpus(spark):
    rng = random.Random(8)
    syllables = {"en": ["the", "ing", "er", "on"], "de": ["sch", "ung", "ein", "ver"]}
    rows = []

    def prose(lang, n):
        return " ".join("".join(rng.choice(syllables[lang]) for _ in range(rng.randrange(1, 6))) for _ in range(n))

    for i in range(60):
        lang = ["en", "de"][i % 2]
        rows.append((i, prose(lang, 120), lang))
    rows += [(100, rows[4][1], "en"), (101, rows[5][1] + " ende", "de"), (102, "123 --- 456", "en"),
             (103, None, "en"), (104, "", None), (105, rows[7][1], None), (7, rows[7][1], "de"),
             (None, prose("en", 50), "en")]
    return spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], DOCS)


def test_stages(spark, tmp_path):
    docs = corpus(spark)
    item = docs.where("doc_id = 20").first().text.split()[30:70]
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet"))
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != "pack":
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = {r.doc_id for r in docs.collect()}
    assert kept["language"] == {*range(60), 100, 101, 105, None}
    assert kept["near_duplicates"] == {*range(60), None}
    assert kept["repeats"] == kept["near_duplicates"]
    assert kept["benchmark"] == kept["near_duplicates"] - {20}
    assert kept["pack"] == kept["benchmark"]


def test_stages_of_an_empty_table(spark, tmp_path):
    docs = corpus(spark).limit(0)
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, str(tmp_path)).count() == 0


def test_near_duplicate_stage_keeps_one_of_repeated_rows(spark):
    out = corpus_pipeline.near_duplicates(spark, corpus(spark).where("doc_id in (7, 105) or doc_id is null"), SF)
    assert sorted((r.doc_id or -1) for r in out.collect()) == [-1, 7]


def test_language_stage_rejects_even_mixtures(spark):
    assert abs(corpus_pipeline.least_score(4) - 0.3) < 1e-9 and corpus_pipeline.least_score(1) == 0.0
    docs = corpus(spark).where("doc_id < 60")
    text = {r.doc_id: r.text.split() for r in docs.collect()}
    mixed = " ".join(w for a, b in zip(text[0], text[1]) for w in [a] * 2 + [b] * 2)
    extra = spark.createDataFrame([(500, mixed, None, "s", 0)], DOCS)
    kept = corpus_pipeline.language(spark, docs.unionByName(extra), SF)
    assert {r.doc_id for r in kept.collect()} == set(range(60))


def test_near_duplicate_stage_judges_each_text_of_an_id(spark):
    x, y, z = (" ".join(f"{c}{i}" for i in range(40)) for c in "xyz")
    rows = [(3, y), (5, y), (5, x), (5, x), (6, ""), (6, ""), (6, None), (7, z), (7, z + " end"), (9, x + " end"),
            (None, y)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    out = [(r.doc_id or -1, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()]
    seven = [t for i, t in out if i == 7]
    assert len(seven) == 1 and seven[0] in (z, z + " end")  # near copies under one id
    assert sorted((i, "-" if t is None else t) for i, t in out if i != 7) == [
        (-1, y), (3, y), (5, x), (6, ""), (6, ""), (6, "-")]


def test_run_over_the_test_table(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append((r.start, r.length, r.doc_tokens))
    for parts in by.values():
        assert sum(n for _, n, _ in parts) == parts[0][2]
    assert 150 < len(by) <= 200


def test_queries_are_registered_once_per_operator():
    import __spark_entry__ as entry
    assert [n for n in QUERIES if n.startswith("op")] == sorted(
        (n for n in QUERIES if n.startswith("op")), key=lambda n: int(n[2:].split("_")[0]))
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(QUERIES)
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" not in ORACLE


HELD = """
import re
import numpy as np
import pyarrow as pa
from cinderframe.llm import langid

class Docs:  # gives the step's function back
    columns, schema = ["text"], []
    def mapInArrow(self, step, schema):
        return step

def anonymous():
    with open("/proc/self/smaps_rollup") as f:
        return int(re.search(r"Anonymous:\\s+(\\d+)", f.read())[1]) // 1024

step = langid.predict(Docs(), langid.Model(["en"], np.zeros((langid.BUCKETS, 1)), np.zeros((1, 1))))

def batches(n):
    if n:
        held = [pa.array(["word " * 200] * 1000) for _ in range(n)]  # a step's peak, gone with its task
        held = [a.cast(pa.binary()).take(list(range(1000))) for a in held]
        del held
    yield pa.record_batch([pa.array(["word"])], names=["text"])

list(step(batches(0)))
before = anonymous()
list(step(batches(200)))
print(anonymous() - before)
"""


def test_a_step_gives_its_memory_back():
    """What an idle Python worker holds doesn't follow the largest task that it ever ran."""
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    run = subprocess.run([sys.executable, "-c", HELD], cwd=root, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    assert int(run.stdout) < 40  # of 400 MB
