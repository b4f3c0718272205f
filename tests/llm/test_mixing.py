from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from rivulet.llm.mixing import MAX_EPOCHS, SEED, TREE, Tree, budgets, mix, split
from tests.llm.conftest import DOCS


def test_split_gives_shortages_to_siblings():
    F_ = Fraction
    assert split(F_(100), [("a", 1, F_(10)), ("b", 1, F_(200)), ("c", 2, F_(200))]) == {"a": 10, "b": 30, "c": 60}
    assert split(F_(100), [("a", 1, F_(10)), ("b", 0, F_(200))]) == {"a": 10, "b": 0}
    assert split(F_(0), [("a", 1, F_(10))]) == {"a": 0} and split(F_(5), []) == {}


def test_siblings_come_before_ancestors():
    tree = Tree({"x": 1, "y": 1}, {"en": 1, "de": 1}, {"x": {"s": 1, "t": 1}, "y": {"u": 1}})
    have = {("x", "en", "s"): 5, ("x", "en", "t"): 100, ("x", "de", "s"): 100, ("y", "en", "u"): 100, ("y", "de", "u"): 10}
    got = budgets(tree, have, 100, 1)
    # y's German shortage goes to y's English, x's source shortage to its sibling source
    assert got == {("x", "en", "s"): 5, ("x", "en", "t"): 20, ("x", "de", "s"): 25, ("x", "de", "t"): 0,
                   ("y", "en", "u"): 40, ("y", "de", "u"): 10}
    # only when y is exhausted does x get more than its half
    got = budgets(tree, {**have, ("y", "en", "u"): 20}, 100, 1)
    assert got["y", "en", "u"] == 20 and got["y", "de", "u"] == 10
    assert sum(v for k, v in got.items() if k[0] == "x") == 70


def brute(rows, tree, share, epochs, seed=SEED):
    """(id, leaf, tokens, epoch) by sorting every leaf in full."""
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    leaves = defaultdict(list)
    for i, text, lang, source in rows:
        d = tree.domain_of.get(source, "*")
        leaf = (d, lang if lang in tree.languages else "*", "*" if d == "*" else source)
        if leaf in tree.leaves():
            leaves[leaf].append((i, text, len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))))
    sums = {k: sum(x[2] for x in v) for k, v in leaves.items()}
    goal = budgets(tree, sums, int(Fraction(str(share)) * sum(sums.values())), epochs)
    out = []
    for leaf, docs in leaves.items():
        total = sums[leaf]
        whole = goal[leaf] // total if total else 0
        rest = goal[leaf] - whole * total
        groups = defaultdict(list)
        for d in docs:
            own = md5(d[1] or "")
            groups[md5(f"{seed}|{whole + 1}|{'null' if d[0] is None else d[0]}|{own}")].append(d)
        used, open_ = 0, rest > 0
        for key in sorted(groups):
            size = sum(d[2] for d in groups[key])
            open_ = open_ and used + size <= rest
            used += size
            for d in groups[key]:
                out += [(d[0], "/".join(leaf), d[2], e) for e in range(1, whole + open_ + 1)]
    return sorted(map(str, out))


def run(spark, docs, **kw):
    return sorted(str((r.doc_id, r.leaf, r.n_tokens, r.epoch)) for r in mix(spark, docs, **kw).collect())


@pytest.mark.parametrize("share,epochs", [(0.8, MAX_EPOCHS), (0.3, 1), (1.7, 3), (0.0, 1)])
def test_whole_table_by_brute_force(spark, share, epochs):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source")
    rows = [tuple(r) for r in docs.collect()]
    assert run(spark, docs, budget_share=share, max_epochs=epochs) == brute(rows, TREE, share, epochs)


def test_budget_is_kept(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    total = docs.select(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0]
    took = mix(spark, docs).agg(F.sum("n_tokens")).first()[0]
    assert took <= 0.8 * total


def test_edge_cases(spark, docs, clashing, empty):
    rows = [tuple(x) for x in DOCS]
    for share, epochs in ((0.8, 2), (1.0, 1), (0.001, 1)):
        assert run(spark, docs, budget_share=share, max_epochs=epochs) == brute(rows, TREE, share, epochs)
    kept = mix(spark, clashing, budget_share=1.0, max_epochs=1, leaf_out="__l", tokens_out="__t", epoch_out="__e")
    assert set(clashing.columns) < set(kept.columns) and kept.where("leaf <> 'mine'").count() == 0
    assert mix(spark, empty).count() == 0
    no_weights = Tree({"x": 1.0}, {"en": 1.0}, {"x": {"src0": 1.0}})
    assert {r.leaf for r in mix(spark, docs, no_weights, 1.0, 1).collect()} == {"x/en/src0"}
