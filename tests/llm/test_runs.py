"""Periodic runs against a search that tries every period at every place."""

import random
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest

from rivulet.llm.runs import find_runs, periodic_runs, planted, run_digest


def brute_runs(words, min_words=24, min_periods=3):
    """(start, end, period): every stretch equal to itself q further on, unless a smaller q has it too."""
    n, seen, out = len(words), set(), []
    for q in range(1, n // min_periods + 1):
        s = 0
        while s + q < n:
            e = s
            while e + q < n and words[e] == words[e + q]:
                e += 1
            if e + q - s >= max(min_words, min_periods * q) and (s, e + q) not in seen:
                seen.add((s, e + q))
                out.append((s, e + q, q))
            s = e + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(text, doc_id):
    words = (text or "").encode().split()
    if doc_id is not None and words and crc32(str(doc_id).encode()) % 10 == 0:
        g, n = crc32(str(doc_id).encode()) // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    gone = {i for s, e, q in runs for i in range(s + q, e)}
    best = min(runs, key=lambda r: (-(r[1] - r[0]) / r[2], r[0], r[2]), default=None)
    lines = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    one = (None,) * 4 if best is None else \
        (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2])
    return (doc_id, len(runs), *one, sha256(lines.encode()).hexdigest(), sha256(kept).hexdigest())


def random_words(rng):
    """A few letters, repeated blocks of repeated blocks, some changed: many runs that touch and overlap."""
    letters = rng.choice([1, 2, 3, 5, 30])
    words = [rng.randrange(letters) for _ in range(rng.randrange(0, 80))]
    for _ in range(rng.randrange(0, 4)):
        if words:
            a = rng.randrange(len(words))
            unit = words[a:a + rng.randrange(1, 50)]
            words[a:a] = (unit * 9)[:rng.randrange(1, 6 * len(unit) + 2)]
    for _ in range(rng.choice([0, 0, 1, 3])):
        if words:
            words[rng.randrange(len(words))] = rng.randrange(letters)
    return words[:900]


@pytest.mark.parametrize("least", [24, 3])
def test_runs_equal_brute_force(least):
    rng = random.Random(least)
    for _ in range(60):
        texts = [random_words(rng) for _ in range(6)]
        doc = np.repeat(np.arange(6), [len(t) for t in texts])
        flat = np.array([w for t in texts for w in t], np.int64)
        found = list(zip(*(x.tolist() for x in find_runs(flat, doc, least))))
        want, base = [], 0
        for t in texts:
            want += [(s + base, e + base, q) for s, e, q in brute_runs(t, least)]
            base += len(t)
        assert found == want


def test_words_of_two_letters_by_doubling():
    """Sequences in which short blocks recur everywhere but long periods decide (Thue-Morse, Fibonacci)."""
    morse = [0]
    while len(morse) < 400:
        morse += [1 - x for x in morse]
    a, b = [0], [0, 1]
    while len(b) < 800:
        a, b = b, b + a
    for unit in (morse[:37], morse[:64], b[:89], b[:55]):
        seq = unit * 5 + morse[:100] + b[:700]
        found = list(zip(*(x.tolist() for x in find_runs(np.array(seq), np.zeros(len(seq), np.int64)))))
        assert found == brute_runs(seq)


def test_one_word_a_million_times_and_long_periods():
    n = 1_000_000
    assert [x.tolist() for x in find_runs(np.zeros(n, np.int64), np.zeros(n, np.int64))] == [[0], [n], [1]]
    unit = np.random.default_rng(1).permutation(200_000)
    words = np.concatenate([unit, unit, unit, unit[:5], [-1]]) + 1
    assert [x.tolist() for x in find_runs(words, np.zeros(len(words), np.int64))] == [[0], [600_005], [200_000]]


def test_fewer_than_three_periods_are_refused():
    with pytest.raises(ValueError):
        find_runs(np.zeros(9, np.int64), np.zeros(9, np.int64), 2, 2)


def test_query_rows_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = sorted(tuple(r) for r in run_digest(periodic_runs(docs, plant=True)).collect())
    texts = sorted((r.doc_id, r.text) for r in docs.collect())
    assert got == [brute_row(t, d) for d, t in texts]
    assert sum(r[1] > 0 for r in got) >= 5
    assert any(planted(t.split(), d) != t.split() for d, t in texts if t)


def test_cases(spark, docs, clashing, empty):
    cases = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    again = [(20, "x " * 40), (21, " a b c" * 30 + " d " + "a b c " * 30), (None, "y " * 24), (20, "x " * 40)]
    df = docs.select("doc_id", "text").unionAll(spark.createDataFrame(again, "doc_id long, text string"))
    for plant in (False, True):
        got = [tuple(r) for r in run_digest(periodic_runs(df, plant=plant)).collect()]
        short = [(d, t) for d, t in cases + again if d != 6]
        want = [brute_row(t, d if plant else None)[1:] for d, t in short]
        assert sorted(map(repr, ((d, *w) for (d, _), w in zip(short, want)))) == sorted(repr(r) for r in got if r[0] != 6)
        assert len([r for r in got if r[0] == 6]) == 1
    found = {r.doc_id: r for r in periodic_runs(df).collect()}
    assert found[20].collapsed == "x" and [tuple(r) for r in found[20].runs] == [(0, 40, 1)]
    assert found[21].collapsed == "a b c d a b c" and len(found[21].runs) == 2
    assert periodic_runs(clashing).columns == ["doc_id", "runs", "collapsed"]
    assert periodic_runs(clashing).count() == docs.count()
    assert run_digest(periodic_runs(empty)).count() == 0
