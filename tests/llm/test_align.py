"""Cross-tokenizer alignment: brute force over byte ranges, the fast encoder, edges."""

import collections
import random

import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cinderframe.llm import align
from cinderframe.llm.common import written
from cinderframe.llm.queries import vocabulary

A, B = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
ROWS = "doc_id long, text string, chunk string, docs int, a_id long, groups int"


@pytest.fixture(scope="module")
def sides():
    return align._sides(A, B)


def byte_of(letter):
    """The byte of a byte-level letter, from the rule in its published form."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    if ord(letter) < 256:
        return ord(letter)
    return [b for b in range(256) if b not in plain][ord(letter) - 256]


def plain_alignment(text, a, b):
    """(a ids, b ids, groups, links) of a text by comparing byte ranges; None without tokens."""
    if not text:
        return None
    a_ids = a.encode(" " + text, add_special_tokens=False).ids
    b_ids = b.encode(text)
    a_bytes = [bytes(byte_of(c) for c in a.id_to_token(i)) for i in a_ids]
    b_bytes = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
               for i in b_ids]
    whole = (" " + text).encode()
    if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
        return None

    def ranges(parts):
        out, at = [], 0
        for p in parts:
            out.append((at, at + len(p)))
            at += len(p)
        return out

    ra, rb = ranges(a_bytes), ranges(b_bytes)
    links = [(a_ids[i], b_ids[j]) for i, (s, e) in enumerate(ra) for j, (u, v) in enumerate(rb) if s < v and u < e]
    ends = sorted({e for _, e in ra} & {e for _, e in rb})
    groups, low = [], 0
    for end in ends:
        groups.append(",".join(str(i) for i, (s, e) in zip(a_ids, ra) if low <= s and e <= end) + "|"
                      + ",".join(str(i) for i, (s, e) in zip(b_ids, rb) if low <= s and e <= end))
        low = end
    return a_ids, b_ids, groups, links


def texts():
    rng = random.Random(8)
    bits = ["the ", "cat", " sat", "é", "naïve ", "日本", "🙂", "  ", "\n", "\t", "<|endoftext|>", "<s>", "</s>", "<unk>",
            "<0x41>", "don't ", "12345", "...", "x" * 9, "Straße ", "́", " ", "ﬁ", "\r\n", "ing", "ed "]
    out = ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 25))) for _ in range(150)]
    return out + [None, "", " ", "a", "▁", "a▁b", "\x00", "same same", "same same", "the cat " * 300]


def test_counts_equal_brute_force(spark, sides):
    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=B)
    rows = [(i, t, "c", 1, 2, 3) for i, t in enumerate(texts())] + [(None, "no id", "c", 1, 2, 3), (7, "again", "c", 1, 2, 3)]
    plain = [plain_alignment(t, tokenizer, model) for _, t, *_ in rows]
    held = collections.Counter(p for x in plain if x for p in set(x[3]))
    most = collections.defaultdict(int)
    for (i, _), n in held.items():
        most[i] = max(most[i], n)
    assert sum(x is None for x in plain) >= 4 and sum(x is not None for x in plain) > 140

    df = spark.createDataFrame(rows, ROWS).repartition(4)
    aligned = written(align.alignments(df, A, B), "test-aligned")
    got = collections.Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups)
                              for r in align.link_counts(aligned).collect())
    want = collections.Counter()
    for (doc, *_), x in zip(rows, plain):
        if x is None:
            want[doc, 0, 0, 0, 0, 0, 0, None] += 1
        else:
            a_ids, b_ids, groups, links = x
            want[doc, len(a_ids), len(b_ids), len(groups), len(links), sum(held[p] == most[p[0]] for p in links),
                 sum(held[p] for p in links), ";".join(groups)] += 1
    assert got == want
    assert {(r.a_id, r.b_id): r.docs for r in align.pair_counts(aligned).collect()} == held


def test_many_chunks_give_the_same(spark, monkeypatch, sides):
    rows = [(i, t, "c", 1, 2, 3) for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows, ROWS).coalesce(1)

    def result(aligned):
        # Partial rows and documents of one run belong together: written once.
        aligned = written(aligned.withColumn("n", F.lit(1)), "test-chunks")
        return aligned.select("chunk").distinct().count(), sorted(
            map(tuple, align.link_counts(aligned).collect()), key=str)

    one = result(align.alignments(df, A, B))
    many = result(align.alignments(df.repartition(40), A, B))
    assert one[0] < many[0] and one[1] == many[1]
    assert align.link_counts(written(align.alignments(df.limit(0), A, B), "none")).count() == 0


def test_chunks_keep_to_their_size():
    import pyarrow as pa
    texts = [b"x" * n for n in (3 << 20, 3 << 20, 9 << 20, 10, 10, 2 << 20)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts).cast(pa.string())], names=["doc_id", "text"])
    parts = [p.column(0).to_pylist() for p in align._chunks(iter([batch.slice(0, 4), batch.slice(4)]))]
    assert parts == [[0], [1], [2], [3, 4, 5]]


def test_fast_encoder_gives_the_tokenizers_ids(sides):
    a = sides[0].tokenizer
    assert a.ranks is not None
    rng = random.Random(2)
    common = [chr(c) for c in [*range(0x250), *range(0x2010, 0x2028), *range(0x2030, 0x205F), *range(0x20A0, 0x20C0)]]
    letters = common + list(" \n\t'sdtrevml  aeiou") * 20
    some = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 40))) for _ in range(4000)]
    some += ["日本 <|endoftext|> x", "y" * 5000, "'" * 3000, " " * 3000, "<|endoftext|>"]
    want = [c.ids for c in a.tokenizer.encode_batch(some, add_special_tokens=False)]
    assert a.encode(some) == want
