from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from rivulet.llm.simhash import MAX_BITS, anchors, drop_near_duplicates, fingerprint, fingerprint_links, links_within, \
    near_duplicates
from tests.llm.conftest import DOCS, LONG


def brute_fingerprint(text, k=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxh64_intdigest(b" ".join(words[i:i + k]), 42) for i in range(max(1, len(words) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, near):
    up = {x: x for x in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a in nodes:
        for b in nodes:
            if near(a, b):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {x: find(x) for x in nodes}


@pytest.mark.parametrize("text", [t for _, t, *_ in DOCS if t != LONG] + ["A b", "x " * 9, "Ä Ö ü a B c D e"])
def test_fingerprint(text):
    assert fingerprint(None if text is None else text.encode()) == brute_fingerprint(text)


def test_fingerprint_in_blocks():
    assert fingerprint(LONG.encode(), block=1000) == fingerprint(LONG.encode())


def test_near_words_share_an_anchor():
    import numpy as np

    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 32, 2000, dtype=np.uint64)
    y = x.copy()
    for i in range(len(y)):
        for b in rng.choice(32, rng.integers(0, 3), replace=False):
            y[i] ^= np.uint64(1 << int(b))
    a, b = anchors(x, 1), anchors(y, 1)
    assert all(set(p.tolist()) & set(q.tolist()) for p, q in zip(a, b))
    assert max(bin(int(w) ^ int(v)).count("1") for w, row in zip(x, a) for v in row) <= 2


def planted(n=400, seed=5):
    rng = random.Random(seed)
    found = set()
    while len(found) < n:
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 3, 12])):
            found.add(x)
            for b in rng.sample(range(64), rng.randint(1, 5)):
                x ^= 1 << b
    return [x - (1 << 64) if x >> 63 else x for x in sorted(found)][:n]


def near(a, b):
    return bin((a ^ b) & ((1 << 64) - 1)).count("1") <= MAX_BITS


@pytest.mark.parametrize("tile", [4096, 3])
def test_links_connect_what_is_near(spark, tile):
    fps = planted()
    got = fingerprint_links(spark, spark.createDataFrame([(x,) for x in fps], "fp long"), tile=tile).collect()
    assert all(near(r.a, r.b) for r in got)
    links = {(r.a, r.b) for r in got}
    assert brute_components(fps, lambda a, b: (a, b) in links or (b, a) in links) == brute_components(fps, near)


def test_links_within_is_a_forest():
    fps = planted(200, 8)
    links = links_within(fps, MAX_BITS).tolist()
    assert all(near(*x) for x in links) and len(links) == len(fps) - len(set(brute_components(fps, near).values()))


def test_near_duplicates(spark, docs, clashing, empty):
    got = sorted(near_duplicates(spark, docs).collect(), key=str)
    prints = {(i, t): brute_fingerprint(t) for i, t, *_ in DOCS}
    comp = brute_components(sorted(set(prints.values())), near)
    least = {}
    for (i, _), f in prints.items():
        if i is not None:
            least[comp[f]] = min(least.get(comp[f], i), i)
    want = sorted(((i, f"{prints[i, t]:016x}", least.get(comp[prints[i, t]])) for i, t, *_ in DOCS), key=str)
    assert [tuple(r) for r in got] == sorted(want, key=lambda r: str(got[0].__class__(*r))) or \
        sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    again = near_duplicates(spark, clashing.select(*[c for c in clashing.columns]))
    assert sorted(map(str, map(tuple, again.collect()))) == sorted(map(str, want))
    assert near_duplicates(spark, empty).count() == 0


def test_one_of_each_group_stays(spark, docs, clashing, empty):
    left = drop_near_duplicates(spark, clashing)
    assert left.columns == clashing.columns
    ids = sorted(r.doc_id for r in left.collect() if r.doc_id is not None)
    assert ids == [1, 3, 6, 7, 8, 9]
    assert left.where("doc_id IS NULL").count() == 1
    assert drop_near_duplicates(spark, empty).count() == 0
    only_null = docs.where("doc_id IS NULL").unionAll(docs.where("doc_id IS NULL"))
    assert drop_near_duplicates(spark, only_null).count() == 2
    assert drop_near_duplicates(spark, docs.select(F.lit(None).cast("long").alias("doc_id"), "text")).count() == 7


def test_groups_are_components_not_ids(spark):
    rng = random.Random(12)
    text = lambda: [f"w{rng.randrange(10**6)}" for _ in range(400)]
    a, b = text(), text()
    copies = [" ".join([*b[:400 - i], *[f"x{j}" for j in range(i)]]) for i in range(30)]
    copies = [c for c in copies if near(brute_fingerprint(c), brute_fingerprint(copies[0]))
              and brute_fingerprint(c) != brute_fingerprint(copies[0])][:2]
    assert copies and not near(brute_fingerprint(" ".join(a)), brute_fingerprint(" ".join(b)))
    a, b = " ".join(a), " ".join(b)
    kept = lambda rows: sorted(map(tuple, drop_near_duplicates(
        spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    # one id on two different texts
    assert kept([(5, a), (5, b), *[(7 + i, c) for i, c in enumerate(copies)]]) == sorted([(5, a), (5, b)], key=str)
    # near copies without ids
    left = kept([(None, b), *[(None, c) for c in copies]])
    assert len(left) == 1 and left[0][1] in [b, *copies]
    assert kept([(None, b), (3, copies[0])]) == [(3, copies[0])]
