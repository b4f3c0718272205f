"""Partial matching against a model written out symbol by symbol."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from rivulet.llm.ppm import END, ORDER, Lookup, coded_bytes, scores, tokens_of

TEXTS = ["the cat sat on the mat", "The  cat\nsat on a hat", None, "", "zebra zebra quartz", "the cat sat on the mat",
         "über den wolken", "x" * 300, "the the the the", "wholly new 中文 words", "cat hat mat sat", "a", "b c d e f"]


def held(i):
    return zlib.crc32(str(i).encode()) % 7 == 2


def brute(rows, order=ORDER):
    train = [t for i, t in rows if not held(i)]
    follow = [defaultdict(Counter) for _ in range(order + 1)]
    words = Counter()
    for t in train:
        own = tokens_of((t or "").encode())
        words.update([*own, END])
        data = END * order + coded_bytes(own)
        for i in range(order, len(data)):
            for k in range(order + 1):
                follow[k][data[i - k:i]][data[i]] += 1
    n, v = sum(words.values()), len(words)
    out = []
    for i, t in rows:
        own = tokens_of((t or "").encode())
        base = sum(math.log10((words[w] + 1) / (n + v + 1)) for w in [*own, END])
        data, score = END * order + coded_bytes(own), 0.0
        for p in range(order, len(data)):
            out_of = set()
            for k in range(order, -1, -1):
                left = {s: c for s, c in follow[k].get(data[p - k:p], {}).items() if s not in out_of}
                if not left:
                    continue
                whole = sum(left.values()) + len(left)
                if data[p] in left:
                    score += math.log10(left[data[p]] / whole)
                    break
                score += math.log10(len(left) / whole)
                out_of |= set(left)
            else:
                score -= math.log10(256 - len(out_of))
        out.append((i, held(i), len(own) + 1, sum(words[w] > 0 for w in [*own, END]), n, base, score))
    return out


def run(spark, rows, **kw):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"row": F.lit("x"), "id": F.lit(1)})
    flag = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return sorted(tuple(r) for r in scores(spark, docs, flag, **kw).collect())


@pytest.mark.parametrize("shares", [{}, {"word_share": 0.05, "gram_share": 0.02}, {"word_share": 2.0, "gram_share": 2.0}])
def test_scores_equal_the_written_out_model(spark, shares):
    rows = [(i, TEXTS[i % len(TEXTS)]) for i in range(60)]
    assert any(held(i) for i, _ in rows)
    for got, want in zip(run(spark, rows, **shares), sorted(brute(rows)), strict=True):
        assert got[:5] == want[:5]
        assert got[5:] == pytest.approx(want[5:], rel=1e-9, abs=1e-9)


def test_no_training_texts_and_empty_table(spark):
    only = [(i, "ab cd") for i in range(40) if held(i)][:2]
    got = run(spark, only)
    assert [r[3] for r in got] == [0, 0] and [r[4] for r in got] == [0, 0]
    assert [r[6] for r in got] == pytest.approx([-6 * math.log10(256)] * 2)
    assert run(spark, []) == []


def test_lookup_finds_all_keys_and_no_other():
    import numpy as np

    keys = np.unique(np.random.default_rng(0).integers(0, 1 << 40, 20_000))
    table = Lookup(keys[::2], keys[::2] * 0.5)
    value, found = table.get(keys)
    assert found[::2].all() and not found[1::2].any() and (value[::2] == keys[::2] * 0.5).all()
    assert not Lookup(keys[:0], keys[:0] * 0.5).get(keys)[1].any()


def test_edge_cases(spark, docs, clashing):
    from tests.llm.conftest import DOCS

    rows = [("" if i is None else i, t) for i, t, *_ in DOCS]
    want = sorted(map(str, (("None" if r[0] == "" else r[0], *r[1:5], *(f"{x:.9g}" for x in r[5:])) for r in brute(rows))))
    flag = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2
    for frame in (docs, clashing):
        got = scores(spark, frame, flag, word_share=0.001, gram_share=0.001).collect()
        assert sorted(map(str, (("None" if r[0] is None else r[0], *r[1:5], *(f"{x:.9g}" for x in r[5:])) for r in got))) == want
