"""Packing, byte repeats, language, HTML: brute force, round trips, held-out accuracy, edges."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest

from cinderframe.llm import html, langid, packing, suffix
from cinderframe.llm.queries import word_tokenizer

LONG = "doc_id long, text string, ids string, mark long, spans int, _x double"


def documents(spark, texts, ids=None):
    return spark.createDataFrame(
        [(i, t, "c", 1, 2, 0.5) for i, t in zip(ids or range(len(texts)), texts)], LONG)


# --- packing ---------------------------------------------------------------------------------

def test_word_ids_equal_the_tokenizer():
    words = packing.WordIds(word_tokenizer())
    rng = random.Random(1)
    letters = list("aZ é́  \x0b\x1c\x85\t\n'sİΣς​中12,.;!?\"-") + ["<|endoftext|>", "don't", " Été,"]
    for _ in range(400):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(30)))
        want = words.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(words.ids(text.encode()), "<u4").tolist() == want


def test_latin_words_equal_the_tokenizer():
    words = packing.WordIds(word_tokenizer())
    assert words.ranks is not None
    rng = random.Random(4)
    latin = [chr(c) for c in range(0x41, 0x250) if chr(c).isalpha()]
    some = ["".join(rng.choice(latin if k % 2 else "etaoinshrdlu") for _ in range(rng.randrange(1, 14)))
            + rng.choice(["", "", ".", ",", "$$$", "--", "!?", "|", "'", "'s", "1", "<|", "_"]) for k in range(20000)]
    want = [c.ids for c in words.tokenizer.encode_batch(some, add_special_tokens=False)]
    assert [np.frombuffer(i, "<u4").tolist() for i in words.of([w.encode() for w in some])] == want


def test_words_in_use_are_learnt_once(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_BYTES", 2000)
    words = packing.WordIds(word_tokenizer())
    learnt = collections.Counter()
    real = words._encode_latin
    monkeypatch.setattr(words, "_encode_latin", lambda some: (learnt.update(some), real(some))[1])
    for i in range(200):
        text = f"often used words and new{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]} {'z' * i}"
        want = words.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(words.ids(text.encode()), "<u4").tolist() == want
    assert learnt[b"often"] == 1 and words.kept < 4000 and len(words.old) < 40


def test_pack_documents(spark):
    rng = random.Random(2)
    texts = [" ".join(f"w{rng.randrange(900)}" for _ in range(rng.choice([1, 50, 900, 3000])))
             for _ in range(60)] + ["", None, "  ", "x " * 30000, "same text", "same text"]
    ids = [*range(len(texts) - 1), len(texts) - 2]  # one id twice
    words = packing.WordIds(word_tokenizer())
    full = {i: words.ids((t or "").encode()) + b"\2\0\0\0" for i, t in zip(ids, texts)}
    rows = packing.pack_documents(documents(spark, texts, ids).repartition(5), word_tokenizer()).collect()
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        cut = full[r.doc_id][4 * r.start: 4 * (r.start + r.length)]
        assert zlib.crc32(cut) == r.ids_crc32 and r.doc_tokens == len(full[r.doc_id]) // 4
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for doc, parts in pieces.items():
        copies = ids.count(doc)
        covered = collections.Counter(p for s, n in parts for p in range(s, s + n))
        assert covered == {p: copies for p in range(len(full[doc]) // 4)}
    assert set(pieces) == set(ids)
    for parts in sequences.values():
        parts.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:])) and parts[0][0] == 0
        total = sum(parts[-1])
        assert total <= 4096 and total & (total - 1) == 0
    assert sum(sum(p[-1]) < 4096 for p in map(sorted, sequences.values())) <= 12
    assert packing.pack_documents(documents(spark, []), word_tokenizer()).count() == 0


# --- repeated bytes ----------------------------------------------------------------------------

@pytest.mark.parametrize("step", [1, 3, 16])
def test_merged_transforms_equal_counting(step, monkeypatch):
    monkeypatch.setattr(suffix, "SHARD_STRINGS", 5)
    rng = random.Random(step)
    for _ in range(15):
        rows = sorted({(rng.randrange(3), bytes(rng.choice(b"ab") for _ in range(rng.randrange(step))),
                        bytes(rng.choice(b"ab") for _ in range(rng.randrange(step)))) for _ in range(40)})
        groups, left, right = zip(*rows)
        windows = {(i, t): (g, t, a[len(a) - (step - 1 - t):], b[:t])
                   for i, (g, a, b) in enumerate(rows) for t in range(step)
                   if step - 1 - t <= len(a) and t <= len(b)}
        count = collections.Counter(windows.values())
        got = suffix.merge_repeats(np.array(groups), list(left), list(right), step)
        assert {k for k, w in windows.items() if count[w] > 1} == set(zip(*map(list, np.nonzero(got))))


def repeats(texts, length):
    raw = [(t or "").encode() for t in texts]
    count = collections.Counter(r[i: i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - length + 1):
            if count[r[i: i + length]] > 1:
                gone[i: i + length] = True
        kept = np.frombuffer(r, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((len(r), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def repeat_texts():
    rng = random.Random(4)
    def word():
        return rng.choice(["né", "a", "bcd", "über", "xyz12"]) + str(rng.randrange(60))
    def prose(n):
        return " ".join(word() for _ in range(n))
    shared, line = prose(120), prose(30)
    texts = [prose(rng.randrange(5, 300)) for _ in range(20)]
    texts += [prose(40) + shared[a:b] + prose(40) for a, b in
              [(0, 400), (0, 399), (1, 401), (0, 700), (13, 640), (200, 605), (0, 120)]]
    texts += [texts[0], texts[0], shared, "z" * 1500, "ab" * 900, "\n".join([line] * 40), "", None,
              "y" * 400, prose(20000), shared + shared]
    return texts


@pytest.mark.parametrize("rows", [8192, 1])
def test_repeat_report_equals_brute_force(spark, rows, monkeypatch):
    monkeypatch.setattr(suffix, "GROUP_ROWS", rows)  # 1: every core is counted window by window
    texts = repeat_texts()
    got = {r.doc_id: tuple(r)[1:] for r in
           suffix.repeat_report(documents(spark, texts), length=400).collect()}
    assert [got[i] for i in range(len(texts))] == repeats(texts, 400)


@pytest.mark.parametrize("text", ["a" * 300_000, "ab" * 150_000, "one line of a text, again and again\n" * 9000])
def test_periodic_texts_are_few_rows(text):
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([2]), pa.array([text])], names=["doc_id", "mark", "text"])
    rows = [r for b in suffix._find_runs(400)(iter([batch])) for r in b.to_pylist()]
    # A handful for each segment that is hashed at once.
    assert len(rows) < 6 * (1 + len(text) // suffix.SEGMENT) and rows[0]["first"] == 0
    assert rows[-1]["until"] == len(text) - 400 and all(b["first"] == a["until"] + 1 for a, b in zip(rows, rows[1:]))


def test_periodic_texts_equal_brute_force(spark):
    texts = ["a" * 5000, "ab" * 2000 + "c" + "ab" * 2000, "x" * 399 + "y", "line of text, again\n" * 300, "a" * 401, "b" * 400,
             "a" * 300 + "z" + "a" * 450]
    got = {r.doc_id: tuple(r)[1:] for r in suffix.repeat_report(documents(spark, texts), length=400).collect()}
    assert [got[i] for i in range(len(texts))] == repeats(texts, 400)


def kept_characters(texts, length):
    """What remove_repeats should leave: a character of which a byte goes, goes."""
    raw = [(t or "").encode() for t in texts]
    count = collections.Counter(r[i: i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for text, r in zip(texts, raw):
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - length + 1):
            if count[r[i: i + length]] > 1:
                gone[i: i + length] = True
        at, kept = 0, []
        for c in text or "":
            n = len(c.encode())
            if not gone[at: at + n].any():
                kept.append(c)
            at += n
        out.append(None if text is None else "".join(kept))
    return out


def test_remove_repeats_equals_brute_force(spark):
    texts = repeat_texts()
    df = documents(spark, texts)
    assert {r.doc_id: r.text for r in suffix.remove_repeats(df).collect()} == dict(enumerate(kept_characters(texts, 400)))


def test_remove_repeats_keeps_rows_and_columns(spark):
    texts = repeat_texts()
    ids = [*range(len(texts) - 2), 0, None]
    df = documents(spark, texts, ids).withColumn("n_chars", __import__("pyspark").sql.functions.lit(7))
    out = suffix.remove_repeats(df)
    assert out.columns == df.columns
    rows = out.collect()
    assert len(rows) == len(texts)
    want = repeats(texts, 400)
    plain = [r for r in rows if r.doc_id == 20][0]
    assert len(plain.text.encode()) <= want[20][0] - want[20][1] and plain.n_chars == len(plain.text)
    assert [r.text for r in rows if r.doc_id == texts.index(None)] == [None]
    assert suffix.remove_repeats(df.limit(0)).count() == 0


# --- language ----------------------------------------------------------------------------------

def tongues(rng, n):
    parts = {"aa": ["ka", "ko", "ki", "ku"], "bb": ["tze", "sch", "ung", "pfe"], "cc": ["é", "eau", "oi", "è"]}
    def word(lang):
        return "".join(rng.choice(parts[lang]) for _ in range(rng.randrange(1, 5)))
    return [(lang, " ".join(word(lang) for _ in range(rng.choice([6, 60, 300]))))
            for lang in parts for _ in range(n)]


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    scores, moves = rng.standard_normal((1, 4, 3)), rng.standard_normal((3, 3))
    p = langid.marginals(scores, moves, np.array([3]))[0][0]
    total = np.zeros((3, 3))
    for path in np.ndindex(3, 3, 3):
        w = np.exp(sum(scores[0, i, k] for i, k in enumerate(path))
                   + sum(moves[a, b] for a, b in zip(path, path[1:])))
        for i, k in enumerate(path):
            total[i, k] += w
    assert np.allclose(p[:3], total / total.sum(1, keepdims=True))


def test_identify_learns_and_labels(spark):
    rows = tongues(random.Random(6), 60)
    odd = [None, "", "123 !?", "ka" * 30000, " ".join(["tzesch"] * 9000)]
    data = [(i, t, l, "s", 0.0) for i, (l, t) in enumerate(rows)]
    data += [(1000 + i, t, None, "s", 0.0) for i, t in enumerate(odd)] + [(None, "koka ki", "aa", "s", 0.0)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, score double")
    got = {r.doc_id: r for r in langid.identify(df).collect()}
    assert len(got) == len(data)
    held = [i for i in range(len(rows)) if got[i].held_out]
    assert held == [i for i in range(len(rows)) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([got[i].lang_pred == rows[i][0] for i in held]) > 0.97
    assert [got[1000 + i].lang_pred for i in range(5)] == ["und", "und", "und", "aa", "bb"]
    assert all(0 <= r.score <= 1 for r in got.values())
    assert langid.identify(df.limit(0)).count() == 0
    none = langid.identify(df.where("doc_id >= 1000"))  # no labelled row
    assert {r.lang_pred for r in none.collect()} == {"und"}


def test_words_of_a_mixed_text_follow_their_language():
    rows = tongues(random.Random(7), 40)
    model = langid.fit(rows)
    labeller = langid._Labeller(model)
    a, b = (max((t for lang, t in rows if lang == k), key=len) for k in ("aa", "bb"))
    mixed = " ".join(a.split()[:30] + b.split()[:30])
    lang, score = labeller.documents([mixed])[0]
    assert 0.3 < score < 0.8 and model.transitions.argmax(1).tolist() == [0, 1, 2]


def test_every_piece_of_a_long_run_counts():
    labeller = langid._Labeller(langid.fit(tongues(random.Random(7), 40)))
    middle = "".join(random.Random(9).choice(["tze", "sch", "ung", "pfe"]) for _ in range(3000))
    ends = "kako" * 10
    mixed, plain, short = labeller.documents([ends + middle + ends, ends * 200, middle + " ka ko ki"])
    assert (mixed[0], plain[0], short[0]) == ("bb", "aa", "bb")
    assert mixed[1] > 0.9 and short[1] > 0.9  # a long run has more weight than short words
    for n in (1, 32, 33, 62, 63, 64, 1000):
        run = bytes(random.Random(n).choice(b"abcdefgh") for _ in range(n))
        pieces = [langid._bytes(p).strip(langid.CUT) for p in langid.pieces_of([run.decode()])]
        assert all(len(p) <= langid.LONGEST for p in pieces)
        assert sum(max(len(p) - 2, 0) for p in pieces) == max(n - 2, 0)
        assert pieces[0] + b"".join(p[2:] for p in pieces[1:]) == run


# --- pages -------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="home">
<header><h1>Site</h1></header><nav><ul><li><a href="/a">A</a></ul></nav>
<div class="cookie-notice">We use cookies, please agree to all of them now.</div>
<div id="content-9"><div class="post post-17"><h2>Title &amp; more</h2>
<p>First  paragraph with <b>bold<i>er</i></b> text,<br>and a second line&nbsp;here.
<p>Next <a href="#">linked</a> paragraph &lt;tag&gt; &#233;.</p><script>var t = "</p>";</script>
<ul><li>one<li>two</ul><div class="advert">Buy this.</div><blockquote>Quote</blockquote></div>
<div class="comments"><p>A reader wrote a very long comment about this article, much longer than it.</p></div></div>
<aside>More</aside><form><p>Search here</p></form><footer><p>&copy; me</p></footer></body></html>"""
TEXT = ("Title & more\nFirst paragraph with bolder text, and a second line here.\n"
        "Next linked paragraph <tag> é.\none\ntwo\nQuote")


def test_extract_one_page():
    assert html.extract(PAGE, []) == TEXT
    assert html.Page(PAGE).best()[0].endswith("/div/div.post.post-")
    for cut in range(0, len(PAGE), 7):  # truncated anywhere
        html.extract(PAGE[:cut], [])
    assert html.extract("", []) == "" and html.extract("<p>", []) == ""
    assert html.extract("just text & more", []) == "just text & more"
    assert html.extract("<div><p>a < b</p><p>x &am</p><p", []) == "a < b\nx &am"
    assert html.extract('<p a="1>2">q</p><!-- <p>no</p> --><p>r</p><!-- open', []) == "q\nr"
    assert html.extract("<p>" + "<b>" * 3000 + "deep", []) == "deep"


def test_names_that_only_mention_furniture_are_kept():
    body = "<p>The article has a first paragraph.</p><p>And it has a second one.</p>"
    text = "The article has a first paragraph.\nAnd it has a second one."
    for wrapper in ("class='content has-sidebar'", "id=page class=no-sidebar", "class='post with-comments'",
                    "class=form", "id=main-menu", "data-class=ad", 'title="a hidden gem"', "data-x='display:none'"):
        assert html.extract(f"<body><div {wrapper}>{body}</div></body>", []) == text, wrapper
    assert html.extract(f"<article><div class='entry-header'><h1>T</h1></div>{body}</article>", []) == "T\n" + text
    assert html.extract(f"<div><h2 class='post-header'>T</h2>{body}</div>", []) == "T\n" + text
    for name in ("related-work", "navigation", "cookie-policy"):
        assert html.extract(f"<div>{body}<h2 id='{name}'>H</h2><section id={name}><p>more</p></section></div>",
                            []) == text + "\nH\nmore"
    assert html.extract("<p>a <span class='search-term'>b</span> c</p>", []) == "a b c"
    for gone in ("class='site-nav'", "class=ad-slot-3", "id=comments", "role=complementary", "class='x sidebar'",
                 "hidden", "hidden=''", "aria-hidden=true", "style='color:red;display: none'"):
        assert html.extract(f"<div>{body}<div {gone}><p>gone</p></div></div>", []) == text, gone


BODY = "<p>The article has a first paragraph.</p><p>And it has a second one.</p>"
BODY_TEXT = "The article has a first paragraph.\nAnd it has a second one."


def test_comments_and_notices_go_whatever_their_size():
    much = "<p>A reader wrote far more than the article has.</p>" * 40
    for gone in ("class=comments", "class='user-comments'", "class='cookie-banner-text'", "id=comments", "class=ad-slot",
                 "class='comments-list text'"):
        for tag in ("div", "section"):
            page = f"<html><body><div class='post'>{BODY}</div><{tag} {gone}>{much}</{tag}></body></html>"
            assert html.extract(page, []) == BODY_TEXT, (tag, gone)
    assert html.extract(f"<section id=comments>{much}</section><div>{BODY}</div>", []) == BODY_TEXT


def test_forms_and_named_wrappers_are_judged_by_what_they_hold():
    search = "<form><p>Search this site</p></form>"
    assert html.extract(f"<body><div>{BODY}</div>{search}</body>", []) == BODY_TEXT
    assert html.extract(f"<body><form id=aspnetForm><nav><p>Menu</p></nav><div>{BODY}</div></form></body>", []) == BODY_TEXT
    assert html.extract(f"<body><form><div class=sidebar><p>side</p></div><div>{BODY}</div>"
                        f"<div class=comments><p>{'no ' * 99}</p></div></form></body>", []) == BODY_TEXT
    assert html.extract(f"<body><p>Line</p><div class=overlay><article>{BODY}</article></div></body>", []).endswith(BODY_TEXT)
    assert html.extract(f"<body><div class=sidebar><p>one</p></div><div class=comments>{BODY}</div></body>", []) == "one"


@pytest.mark.parametrize("name", "noscript svg canvas video object iframe select math audio template".split())
def test_an_unclosed_element_doesnt_take_the_page(name):
    assert html.extract(f"<body><div><{name}>{BODY}</div></body>", []) == BODY_TEXT
    assert html.extract(f"<body><div><{name}><p>gone</p></{name}>{BODY}</div></body>", []) == BODY_TEXT


def test_main_text_votes_by_host(spark):
    plain = "<html><body><div class='main1'><p>{0}</p></div><div class='extra'>{1}</div></body></html>"
    rows = [(i, f"http://a.org/{i}", plain.format("long article text " * 9, "short"), "h", None)
            for i in range(6)]
    rows += [(6, "http://A.org:80/x", plain.format("brief", "a much longer extra box " * 9), "h", None),
             (7, None, PAGE, "h", None), (8, "http://b.org", None, "h", None), (9, "", "", "h", None),
             (0, "http://a.org/0", rows[0][2], "h", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string, paths string")
    got = [(r.page_id, r.text, r.n_chars) for r in html.main_text(df).collect()]
    assert len(got) == len(rows)
    by = {i: t for i, t, _ in got}
    assert by[6] == "brief" and by[7] == TEXT and by[8] == by[9] == ""
    assert by[3] == ("long article text " * 9).strip()
    assert all(n == len(t) for _, t, n in got)
    assert html.main_text(df.limit(0)).count() == 0


def test_spans_of_spliced_texts(spark):
    """Words of texts spliced from three languages get their language, and spans name their places."""
    rng = random.Random(12)
    model = langid.fit(tongues(rng, 30))
    texts, truth = [], []
    for _ in range(30):
        words = [(w, lang) for lang, text in rng.sample(tongues(rng, 1), 3) for w in text.split()]
        texts.append(", ".join(w for w, _ in words))
        truth.append([lang for _, lang in words])
    odd = [None, "", "12 - 3", "\u0130ka k\u0130 kaka", "ka" * 5000 + " " + "tzesch" * 5000, "ka ko"]
    rows = [(i, t, "x", 0.5) for i, t in enumerate(texts + odd)] + [(None, "ka ko", "y", 0.1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    got = {}
    for r in sorted(langid.spans(df, model).collect(), key=lambda r: (r.doc_id or 0, r.span)):
        got.setdefault(r.doc_id, []).append(r)
    right = total = 0
    for i, (text, langs) in enumerate(zip(texts, truth)):
        found = got[i]
        assert [r.span for r in found] == list(range(len(found)))
        assert all(a.end < b.start and a.lang != b.lang for a, b in zip(found, found[1:]))
        labels = [r.lang for r in found for _ in text[r.start: r.end].split()]
        assert all(len(text[r.start: r.end].split()) == r.n_words and 0 < r.score <= 1 for r in found)
        assert len(labels) == len(langs)
        right += sum(map(str.__eq__, labels, langs))
        total += len(langs)
    assert right >= 0.95 * total
    n = len(texts)
    assert not {n, n + 1, n + 2} & set(got)
    assert got[n + 3][0].start == 0 and got[n + 3][-1].end == len(odd[3])
    assert [(r.start, r.end, r.lang) for r in got[n + 4]] == [(0, 10000, "aa"), (10001, 40001, "bb")]
    assert [tuple(r)[2:6] for r in got[None]] == [tuple(r)[2:6] for r in got[n + 5]] == [(0, 5, 2, "aa")]
    assert langid.spans(df.limit(0), model).count() == 0
