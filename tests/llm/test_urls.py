from __future__ import annotations

import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rivulet.llm.queries import OP8_SQL
from rivulet.llm.urls import Propagation, host_of, judge, path_of, propagate

SCHEMA = "page_id long, url string, html string"


def twin(rows):
    con = duckdb.connect()
    pages = pd.DataFrame(rows, columns=["page_id", "url", "html"]).astype({"url": object, "html": object})  # noqa: F841
    con.execute("CREATE TABLE pages AS SELECT page_id::BIGINT AS page_id, url::VARCHAR AS url, html::VARCHAR AS html FROM pages")
    return sorted(con.execute(OP8_SQL).fetchall(), key=str)


def run(spark, rows):
    return sorted((tuple(r) for r in judge(spark, spark.createDataFrame(rows, SCHEMA)).collect()), key=str)


@pytest.mark.parametrize("url,host,path", [
    (None, "", ""), ("", "", ""), ("example.com/x", "", ""), ("http://A.Example.COM", "a.example.com", ""),
    ("HTTPS://x.NET?q=/en/", "x.net", ""), ("http://x.org/fr/a?b#c", "x.org", "/fr/a"), ("a://b://c/d", "b:", "//c/d"),
    ("http://É.net/#x", "É.net", "/"), ("http:///p", "", "/p"), ("http://x\n.net/a\nb", "x\n.net", "/a\nb")])
def test_parts_of_a_url(spark, url, host, path):
    r = spark.createDataFrame([(url,)], "u string").select(host_of(F.col("u")), path_of(F.col("u"))).first()
    assert tuple(r) == (host, path)


def test_rules(spark):
    urls = ["http://net/", "http://a.net/x", "http://a.net", "http://example.net/en/1", "http://b.example.net/en",
            "http://B.example.net/en/x", "http://example.com/de/1", "http://example.com/de", "http://xexample.com/de/",
            "http://w.org/fr/", "http://worg/fr/", None, "mailto:x"]
    rows = [(i, u, None) for i, u in enumerate(urls)]
    got = {r[0]: (r[3], r[4]) for r in run(spark, rows)}
    assert [got[i] for i in range(len(urls))] == [
        ("net/", "block"), ("net/", "block"), (None, "block"), ("example.net/en/", "allow"), ("net/", "block"),
        ("example.net/en/", "allow"), ("example.com/de/", "block"), (None, "allow"), (None, "allow"), ("org/fr/", "allow"),
        (None, "allow"), (None, "allow"), (None, "allow")]
    assert run(spark, rows) == twin(rows)


def test_links_spread_trust_and_distrust(spark):
    rng = random.Random(6)
    hosts = [f"h{i}.com" for i in range(12)] + ["bad.net", "worse.net", "good.org", "s.example.net"]
    seen = set()
    for _ in range(2):
        rows = []
        for i in range(80):
            host = rng.choice(hosts)
            path = rng.choice(["/", "/en/1", "/fr/2", "", "/x"])
            links = "".join(f'<a {rng.choice(["href", "HREF"])}={rng.choice(["", chr(34), chr(39)])}'
                            f'{rng.choice(["http:", "https:", ""])}//{rng.choice(hosts).upper()}/p">x</a>'
                            for _ in range(rng.choice([0, 1, 3])))
            rows.append((i, f"http://{host}{path}", rng.choice([None, links, links])))
        got = run(spark, rows)
        assert got == twin(rows)
        seen |= {r[4] for r in got if r[3] is None}
    assert seen == {"allow", "block"}


def test_scores_of_a_small_graph(spark):
    links = spark.createDataFrame([("a", "b", 1), ("b", "c", 3), ("b", "a", 1)], "src string, dst string, n long")
    seeds = spark.createDataFrame([("a", 2, 0), ("c", 0, 5)], "host string, good long, bad long")
    got = {r.host: (r.trust, r.distrust) for r in propagate(spark, links, seeds, Propagation(tolerance=1e-4)).collect()}
    a = 0.15 / (1 - 0.85 * 0.25 * 0.85)
    assert got["a"][0] == pytest.approx(a, rel=1e-3) and got["c"][0] == pytest.approx(0.85 * 0.75 * 0.85 * a, rel=1e-3)
    assert got["c"][1] == pytest.approx(0.15)
    b = (0.85 * 0.15) / (1 - 0.85 * 0.85)
    assert got["b"][1] == pytest.approx(b, rel=1e-3) and got["a"][1] == pytest.approx(0.85 * b, rel=1e-3)


def test_edge_cases(spark):
    assert judge(spark, spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, "http://a.net/", "x"), (1, "http://a.net/", "x"), (None, None, None), (2, "http://c.com/", "<a href=//c.com/>")]
    extra = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("mine") for c in ("host", "rule", "said", "src", "n")})
    got = sorted((tuple(r) for r in judge(spark, extra).collect()), key=str)
    assert got == sorted([(1, "a.net", "/", "net/", "block")] * 2 + [(None, "", "", None, "allow"),
                                                                       (2, "c.com", "/", None, "allow")], key=str)
