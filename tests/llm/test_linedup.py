from __future__ import annotations

import random
from itertools import product

from pyspark.sql import functions as F

from rivulet.llm import linedup
from rivulet.llm.linedup import MIN_BLOCK_WORDS, common_blocks, drop_common_blocks, line_hashes, patience
from tests.llm.conftest import DOCS


def words(n, tag):
    return " ".join(f"{tag}{i}" for i in range(n))


def test_line_hashes():
    index, own, count, links = line_hashes(b"a b\n\n  \n c d e \nf", 4)
    assert index == [0, 3, 4] and count == [2, 3, 1] and len(set(own)) == 3
    assert links[0] is not None and links[1] is not None and links[2] is None and links[1] != own[1]
    assert line_hashes(b"c d e\nf g", 3)[3][0] == line_hashes(b" c d e ", 3)[1][0]
    assert line_hashes(None) == ([], [], [], []) == line_hashes(b"")


def lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, j in product(range(len(a)), range(len(b))):
        best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_patience_is_an_alignment():
    rng = random.Random(3)
    for _ in range(500):
        a, b = ([rng.randrange(12) for _ in range(rng.randint(0, 15))] for _ in range(2))
        got = patience(a, b)
        assert all(a[i] == b[j] for i, j in got)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:]))
        same = rng.sample(range(100), 12)
        kept = sorted(rng.sample(range(12), 8))
        assert len(patience(same, [same[i] for i in kept])) == lcs(same, [same[i] for i in kept]) == 8


def test_only_long_blocks_count():
    seq = lambda spec: [(p, p, h, w) for p, (h, w) in enumerate(spec)]
    a = seq([(1, 10), (2, 10), (3, 10), (4, 3)])
    assert common_blocks(a, seq([(1, 10), (2, 10), (9, 5), (4, 3)]), 25) == []
    assert common_blocks(a, seq([(8, 1), (1, 10), (2, 10), (3, 10)]), 25) == [1, 2, 3]
    # neighbours on one side only are two blocks
    assert common_blocks(a, [(0, 0, 1, 10), (1, 1, 2, 10), (5, 5, 3, 10)], 25) == []


def build():
    """Documents, and the lines of each that an earlier document holds in a block of enough words."""
    passage = [words(20, "p"), words(20, "q"), words(20, "r")]
    boiler = "all rights reserved by the owner"
    texts = {
        1: [boiler, words(40, "a"), *passage, words(30, "b")],
        2: [boiler, words(40, "c"), *passage],
        3: [boiler, words(41, "d"), "", passage[0], "  ", passage[1], words(9, "e")],
        4: [words(40, "a"), words(30, "b")],
        5: [boiler, words(50, "f")],
        6: [words(12, "p"), words(50, "g")],
    }
    texts[7] = texts[1]
    gone = {1: [], 2: [2, 3, 4], 3: [3, 5], 4: [0, 1], 5: [], 6: [], 7: [0, 1, 2, 3, 4, 5]}
    return {k: "\n".join(v) for k, v in texts.items()}, gone


def test_blocks_go_from_the_later_document(spark):
    texts, gone = build()
    rows = [(k, t) for k, t in texts.items()] + [(2, texts[2]), (None, texts[1])]
    got = drop_common_blocks(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    for r in got:
        want = gone[r.doc_id] if r.doc_id is not None else gone[7]
        assert list(r.deleted) == want
        source = texts[r.doc_id if r.doc_id is not None else 1].split("\n")
        assert r.text == "\n".join(x for i, x in enumerate(source) if i not in want)
    assert len(got) == len(rows)
    by_id = {r.doc_id: list(r.partners) for r in got}
    assert by_id[2] == [1] and by_id[3] == [1] and by_id[7] == [1] and by_id[1] == [] and by_id[4] == [1]


def test_a_large_group_of_copies_keeps_one(spark):
    body = "\n".join(words(30, f"z{i}_") for i in range(4))
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(body).alias("text"))
    got = drop_common_blocks(spark, docs).where("text <> ''").collect()
    assert [r.doc_id for r in got] == [0]


def test_every_deleted_line_is_in_an_earlier_document(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    earlier, found = {}, 0
    for r in docs.orderBy("doc_id").collect():
        for line in {x.strip() for x in r.text.split("\n")}:
            earlier.setdefault(line, r.doc_id)
    texts = {r.doc_id: r.text.split("\n") for r in docs.collect()}
    seen = {}
    for r in drop_common_blocks(spark, docs).collect():
        seen[r.doc_id] = set(r.deleted)
        for i in r.deleted:
            assert earlier[texts[r.doc_id][i].strip()] < r.doc_id
            found += 1
    assert found
    # brute force: every line of enough words that an earlier document holds in the same run is gone
    for i, lines in texts.items():
        for n, x in enumerate(lines):
            if len(x.split()) >= MIN_BLOCK_WORDS and earlier[x.strip()] < i:
                assert n in seen[i]


def test_edge_cases(spark, docs, clashing, empty):
    out = drop_common_blocks(spark, clashing, deleted="__d", partners="__p")
    assert set(clashing.columns) < set(out.columns) and out.count() == len(DOCS)
    assert out.where("doc_id = 3").first().text is None and out.where("doc_id = 4").first().text == ""
    assert drop_common_blocks(spark, empty).count() == 0


def left_over(a, b, gone, min_words=MIN_BLOCK_WORDS):
    """Whether a block of enough words of ``a`` is left in ``b``; all runs against all runs."""
    def runs(spec):
        for i in range(len(spec)):
            for j in range(i + 1, len(spec) + 1):
                part = spec[i:j]
                if all(q[0] == p[0] + 1 for p, q in zip(part, part[1:])) and sum(x[3] for x in part) >= min_words:
                    yield tuple(x[2] for x in part)
    return bool(set(runs(a)) & set(runs([x for x in b if x[1] not in gone])))


def test_no_block_is_left_in_any_order_or_repeat():
    seq = lambda spec: [(p, p, h, w) for p, (h, w) in enumerate(spec)]
    p, q, short = [(1, 15), (2, 15)], [(3, 15), (4, 15)], [(h, 1) for h in range(20, 30)]
    assert common_blocks(seq(p + q), seq(q + p)) == [0, 1, 2, 3]
    assert common_blocks(seq(p), seq(p + [(9, 3)] + p)) == [0, 1, 3, 4]
    assert common_blocks(seq([(1, 30)]), seq([(1, 30)] * 7)) == list(range(7))
    # no line is unique on both sides
    assert common_blocks(seq([(7, 1)] + (p + [(5, 1)]) * 2), seq([(8, 1)] + (p + [(6, 1)]) * 2)) == [1, 2, 4, 5]
    # ten short lines in order outnumber the passage that crosses them
    apart = [x for h in short for x in (h, (100 + h[0], 1))]
    assert common_blocks(seq(p + apart), seq([x for h in short for x in (h, (200 + h[0], 1))] + p)) == [20, 21]
    # a short line at the end of a block belongs to it
    assert common_blocks(seq([(1, 30), (2, 1)]), seq([(5, 9), (1, 30), (2, 1), (6, 9)])) == [1, 2]
    rng = random.Random(11)
    for _ in range(2000):
        weight = [rng.choice([1, 8, 14, 26]) for _ in range(6)]
        a, b = (seq([(h, weight[h]) for h in (rng.randrange(6) for _ in range(rng.randint(0, 9)))]) for _ in range(2))
        gone = common_blocks(a, b)
        assert len(gone) == len(set(gone)) and not left_over(a, b, set(gone))
        assert all(any(x[2] == y[2] for y in a) for x in b if x[1] in set(gone))


def test_crossing_and_repeated_passages(spark):
    p, q = words(40, "p"), words(40, "q")
    rows = [(1, "\n".join([p, words(9, "a"), q])), (2, "\n".join([q, words(30, "b"), p])), (3, "\n".join([p, words(8, "c"), p, p]))]
    got = {r.doc_id: list(r.deleted) for r in
           drop_common_blocks(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: [], 2: [0, 2], 3: [0, 2, 3]}


def test_many_repeats_take_linear_time():
    many = [(i, i, i % 3, 26) for i in range(60_000)]
    assert common_blocks(many[:3], many) == list(range(60_000))


def test_lcs_is_longest():
    rng = random.Random(5)
    for _ in range(500):
        a, b = ([rng.randrange(4) for _ in range(rng.randint(0, 14))] for _ in range(2))
        got = linedup.lcs(a, b)
        assert len(got) == lcs(a, b) and all(a[i] == b[j] for i, j in got)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:]))


def test_an_alignment_in_pieces_is_one(monkeypatch):
    monkeypatch.setattr(linedup, "LCS_BITS", 40)
    rng = random.Random(6)
    for _ in range(200):
        a, b = ([rng.randrange(4) for _ in range(rng.randint(0, 30))] for _ in range(2))
        got = linedup.lcs(a, b)
        assert all(a[i] == b[j] for i, j in got) and bool(got) == bool(set(a) & set(b))
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:]))


def test_only_the_alignment_deletes(monkeypatch):
    """Without an alignment nothing goes, and one alignment takes a passage once."""
    seq = lambda spec: [(p, p, h, w) for p, (h, w) in enumerate(spec)]
    a, b = seq([(1, 30), (2, 30)]), seq([(2, 30), (9, 2), (1, 30)])
    anchors = [(x[0], y[0]) for x, y in [((0, 0), (2, 0))]]
    assert linedup.aligned_blocks(a, b, anchors) == {2}
    calls = []
    first = linedup.patience
    monkeypatch.setattr(linedup, "patience", lambda x, y: calls.append(len(y)) or first(x, y))
    assert common_blocks(a, b) == [0, 2] and len(calls) == 2
    many = seq([(1, 30)] + [(7, 3), (1, 30)] * 500)
    calls.clear()
    assert len(common_blocks(seq([(1, 30)]), many)) == 501 and sum(calls) <= 2 * 501
