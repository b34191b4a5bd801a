"""Quality rules: measures against a plain count, rule boundaries, edges, no Python in the plan."""

import collections
import random
import re

from cinderframe.llm import rules
from cinderframe.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ROWS = "doc_id long, text string, words string, windows int, lines string, id string, n_words int"


def counted(text):
    text = text or ""
    words = WORD.findall(text)
    windows = collections.defaultdict(list)
    for i in range(len(words) - 2):
        windows[tuple(words[i:i + 3])].append(i)
    again = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return dict(
        n_words=len(words), word_chars=sum(map(len, words)), n_symbols=sum(c in "#*$%&|<>" for c in text),
        n_stop_words=sum(w.lower() in rules.STOP_WORDS for w in words),
        n_letter_words=sum(any(c.isalpha() for c in w) for w in words), n_lines=len(lines),
        n_dup_lines=len(lines) - len(set(lines)),
        n_bullet_lines=sum(x.lstrip(" \t\r\x0b\x0c")[0] in "-*•" for x in lines),
        n_ellipsis_lines=sum(x.rstrip(" \t\r\x0b\x0c").endswith(("...", "…")) for x in lines),
        n_repeat_words=len(again))


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "w", 1, "l", "i", 7) for i, t in enumerate(texts)], ROWS)


def test_measures_equal_a_plain_count(spark):
    rng = random.Random(5)
    bits = ["a", "the", "The", "é", "x#", "$$$", "|", "-", "•", "...", "…", "12", "\n", "\n", "\t", " ", "\x0b", "\r",
            "\x85", " ", "a.", "🙂"]
    texts = [" ".join(rng.choice(bits) for _ in range(rng.randrange(60))) for _ in range(300)]
    texts += [None, "", " \n\t ", "a", "a a a a a", "a b c a b c", "x y z x y", "same\nsame \nsame", "\n\nend\n",
              "w" * 100_000, "the cat sat " * 4000, "the cat sat " * 4000]
    got = {r.id: r for r in rules.measures(frame(spark, texts)).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        want = counted(text)
        assert {k: got[i][k] for k in want} == want, repr(text)[:200]
    assert rules.measures(frame(spark, ["a"]).limit(0)).count() == 0


def test_rules_hold_at_their_thresholds(spark):
    table = (rules.Rule("many", "n_words", "n_lines", most=3000), rules.Rule("few", "n_words", "n_lines", least=2000),
             rules.Rule("free", "n_words", "n_lines"), rules.Rule("none", "n_symbols", "n_lines", least=1))
    texts = ["a # c", "a b c #", "a", "a #", ""]
    got = {r.doc_id: r for r in rules.judge(frame(spark, texts), table, least_words=2).collect()}
    assert [got[i].failed for i in range(5)] == [[], ["many"], ["few", "none"], [], []]
    assert [got[i].base_failed for i in range(5)] == [False, False, True, False, True]
    assert [got[i].kept for i in range(5)] == [True, False, False, True, False]


def test_base_and_verdict(spark):
    clean = " ".join(f"the word{i} of thing{i}" for i in range(20))
    half = " ".join(f"w{i}" for i in range(50)) + " a b c d e" * 10  # 50 of 100 words repeat
    over = " ".join(f"w{i}" for i in range(49)) + " a b c d e" * 10
    texts = [clean, half, over, "the " * 49, None, " ".join(f"the{i} |#" for i in range(40)) + " end"]
    rows = frame(spark, texts).union(frame(spark, texts[:1])).union(
        spark.createDataFrame([(None, clean, "w", 1, "l", "i", 7)], ROWS))
    got = rules.judge(rows).collect()
    assert len(got) == 8 and sum(r.kept for r in got) == 3 and sum(r.doc_id is None for r in got) == 1
    by = {r.doc_id: r for r in got}
    assert by[0].kept and not by[1].base_failed and by[2].base_failed and by[3].base_failed and by[4].base_failed
    assert by[1].n_repeat_words == 50 and not by[5].kept and "symbols" in by[5].failed


def test_plan_is_native(spark):
    plan = QUERIES["op11_quality_rules"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("EvalPython", "InArrow", "InPandas", "Exchange", "Join"))
