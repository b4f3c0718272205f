"""The queries of the corpus operators: each reads its whole table of ``sf_dir``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, tuple] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = (fn, sql)
        return fn
    return deco


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@query("op1_simhash")
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rivulet.llm.simhash import near_duplicates

    return near_duplicates(spark, read(spark, sf_dir, "documents"))


@query("op2_quality_bands")
def op2_quality_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rivulet.llm.quality import quality

    return quality(read(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op6_token_counts")
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rivulet.llm.tokens import token_counts, tokenizer_text

    return token_counts(read(spark, sf_dir, "documents").select("doc_id", "text"),
                        tokenizer_text(spark, "byte_bpe_50k.json"))


@query("op10_html_text")
def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rivulet.llm.html import extract

    return extract(read(spark, sf_dir, "pages").select("page_id", "url", "html"))


OP8_SQL = """
WITH RECURSIVE p AS (
  SELECT page_id, html,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(verdict, rhost, rpath) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
                                        ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
u AS (
  SELECT page_id, p.host, p.path, html,
         arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(verdict, length(rhost || rpath)) AS said
  FROM p LEFT JOIN rules ON (p.host = rhost OR ends_with(p.host, '.' || rhost)) AND starts_with(p.path, rpath)
  GROUP BY ALL),
seed AS (
  SELECT host, count(*) FILTER (said = 'allow') AS good, count(*) FILTER (rule = 'net/') AS bad
  FROM u WHERE host <> '' GROUP BY host),
link AS (
  SELECT src, dst, count(*) AS n
  FROM (SELECT host AS src, lower(unnest(regexp_extract_all(
          html, '(?i)\\bhref\\s*=\\s*["'']?\\s*(?:https?:)?//([^/?#"''\\s>]+)', 1))) AS dst FROM u WHERE host <> '')
  WHERE src <> dst GROUP BY ALL),
-- a state '*' keeps score 1 and feeds the seeds; each row moves a share w of a score
move AS (
  SELECT 'trust' AS kind, src AS a, dst AS b, 0.85 * n / sum(n) OVER (PARTITION BY src) AS w FROM link
  UNION ALL SELECT 'distrust', dst, src, 0.85 * n / sum(n) OVER (PARTITION BY dst) FROM link
  UNION ALL SELECT 'trust', '*', host, 0.15 * good / sum(good) OVER () FROM seed
  UNION ALL SELECT 'distrust', '*', host, 0.15 * bad / sum(bad) OVER () FROM seed
  UNION ALL SELECT unnest(['trust', 'distrust']), '*', '*', 1.0),
score AS (
  SELECT 0 AS round, kind, '*' AS host, 1.0::DOUBLE AS s FROM (SELECT unnest(['trust', 'distrust']) AS kind)
  UNION ALL
  SELECT round + 1, score.kind, b, sum(s * w) FROM score JOIN move ON move.kind = score.kind AND a = host
  WHERE round < 100 GROUP BY ALL),
last AS (
  SELECT host, coalesce(sum(s) FILTER (kind = 'trust'), 0) AS t, coalesce(sum(s) FILTER (kind = 'distrust'), 0) AS d
  FROM score WHERE round = 100 AND host <> '*' GROUP BY host),
bad AS (
  SELECT host FROM last
  WHERE d > t AND d >= 0.1 * (SELECT avg(d) FROM last JOIN seed USING (host) WHERE bad > 0))
SELECT page_id, host, path, rule,
       coalesce(said, CASE WHEN host IN (SELECT host FROM bad) THEN 'block' ELSE 'allow' END) AS verdict
FROM u
"""


@query("op8_url_graph", OP8_SQL)
def op8_url_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rivulet.llm.urls import judge

    return judge(spark, read(spark, sf_dir, "pages").select("page_id", "url", "html"))


OP4_SQL = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND list_bool_and([x IS NOT NULL AND isfinite(x) FOR x IN embedding])
    AND list_bool_or([x <> 0 FOR x IN embedding]))
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (
  SELECT q.vec_id AS query_id, v.vec_id, list_dot_product(q.e, v.e) AS score,
         row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(q.e, v.e) DESC, v.vec_id) AS rank
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id AND len(q.e) = len(v.e) WHERE q.vec_id % 20 = 0)
WHERE rank <= 20
"""


@query("op4_rotated_codes", OP4_SQL)
def op4_rotated_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from rivulet.llm.ann import nearest

    return nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


@query("op7_line_alignment")
def op7_line_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rivulet.llm.linedup import drop_common_blocks

    return drop_common_blocks(spark, read(spark, sf_dir, "documents").select("doc_id", "text"))


def _op3_sql(buckets: int = 8, batch_tokens: int = 16_384, seed: int = 29) -> str:
    """The dynamic programme with one common table for each number of buckets."""
    steps = "".join(f""",
d{k} AS (
  SELECT h.j, h.g, h.c, min(d.cost + h.g * (h.c - d.c)) AS cost,
         list_append(arg_min(d.path, (d.cost + h.g * (h.c - d.c))::HUGEINT * 1000000 + d.j), h.g) AS path
  FROM h JOIN d{k - 1} AS d ON d.j < h.j GROUP BY h.j, h.g, h.c)""" for k in range(2, buckets + 1))
    ends = " UNION ALL ".join(f"SELECT {k} AS k, cost, path FROM d{k} WHERE j = (SELECT max(j) FROM h)"
                              for k in range(1, buckets + 1))
    return f"""
WITH t AS (
  SELECT doc_id, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) + 1 AS n,
         md5('{seed}|0|' || coalesce(doc_id::VARCHAR, 'null') || '|' || md5(coalesce(text, ''))) AS key
  FROM documents),
own AS (
  SELECT doc_id, n, key, (ceil(n / pow(2, greatest(0, length(bin(n - 1)) - 11)))
                          * pow(2, greatest(0, length(bin(n - 1)) - 11)))::BIGINT AS grid FROM t),
h AS (SELECT row_number() OVER (ORDER BY grid) AS j, grid AS g, (sum(count(*)) OVER (ORDER BY grid))::BIGINT AS c
      FROM own GROUP BY grid),
d1 AS (SELECT j, g, c, g * c AS cost, [g] AS path FROM h){steps},
best AS (SELECT path FROM ({ends}) ORDER BY cost, k LIMIT 1),
b AS (SELECT unnest(path) AS edge FROM best),
placed AS (SELECT doc_id, n, key, (SELECT min(edge) FROM b WHERE edge >= grid) AS bucket FROM own),
ranked AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY key, doc_id) - 1 AS rank,
                  greatest(1, {batch_tokens} // bucket) AS size FROM placed)
SELECT doc_id, n::BIGINT AS n_tokens, bucket, (rank // size)::BIGINT AS batch, (rank % size)::BIGINT AS place FROM ranked
"""


@query("op3_length_buckets", _op3_sql())
def op3_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rivulet.llm.packing import pack

    return pack(spark, read(spark, sf_dir, "documents").select("doc_id", "text"))


def _fill_sql(name: str, source: str, group: str) -> str:
    """Split ``amount`` among the rows (w, cap, id) of a group by weight; what one cannot hold goes to the others."""
    order = f"PARTITION BY {group} ORDER BY cap / w, id"
    return f"""
{name}_o AS (
  SELECT *, coalesce(sum(cap) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
         sum(w) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS wrest,
         row_number() OVER ({order}) AS k FROM {source}),
{name}_f AS (
  SELECT *, min(CASE WHEN cap > (amount - used) / wrest * w THEN k END) OVER (PARTITION BY {group}) AS open_from FROM {name}_o),
{name} AS (
  SELECT *, CASE WHEN open_from IS NULL OR k < open_from THEN cap
                 ELSE w * max(CASE WHEN k = open_from THEN (amount - used) / wrest END) OVER (PARTITION BY {group}) END AS x
  FROM {name}_f)"""


def _op9_sql() -> str:
    from rivulet.llm.mixing import BUDGET_SHARE, MAX_EPOCHS, SEED, TREE

    rows = ", ".join(f"('{d}', {TREE.domains[d]}, '{lang}', {TREE.languages[lang]}, '{s}', {TREE.sources[d][s]})"
                     for d, lang, s in TREE.leaves())
    return f"""
WITH tree(domain, dw, lang, lw, source, sw) AS (
  SELECT a, b::DOUBLE, c, d::DOUBLE, e, f::DOUBLE FROM (VALUES {rows}) v(a, b, c, d, e, f)),
docs AS (
  SELECT doc_id, lang, source, coalesce(t.domain, '*') AS d, CASE WHEN lang IN (SELECT lang FROM tree) THEN lang ELSE '*' END AS l,
         CASE WHEN t.domain IS NULL THEN '*' ELSE source END AS s, md5(coalesce(text, '')) AS content,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS n
  FROM documents LEFT JOIN (SELECT DISTINCT domain, source AS src FROM tree WHERE source <> '*') t ON source = t.src),
leaf AS (
  SELECT tree.*, coalesce(sum(n), 0)::DOUBLE AS total, {MAX_EPOCHS} * coalesce(sum(n), 0)::DOUBLE AS room
  FROM tree LEFT JOIN docs ON domain = d AND tree.lang = l AND tree.source = s GROUP BY ALL),
a1 AS (SELECT 0 AS g, domain AS id, any_value(dw) AS w, sum(room) AS cap,
              (SELECT floor({BUDGET_SHARE} * sum(total)) FROM leaf) AS amount FROM leaf GROUP BY domain),{_fill_sql("f1", "a1", "g")},
a2 AS (SELECT domain, lang AS id, any_value(lw) AS w, sum(room) AS cap, any_value(f1.x) AS amount
       FROM leaf JOIN f1 ON f1.id = domain GROUP BY domain, lang),{_fill_sql("f2", "a2", "domain")},
a3 AS (SELECT leaf.domain, lang, source AS id, sw AS w, room AS cap, f2.x AS amount, total
       FROM leaf JOIN f2 ON f2.domain = leaf.domain AND f2.id = lang),{_fill_sql("f3", "a3", "domain, lang")},
goal AS (
  SELECT domain, lang, id AS source, total, CASE WHEN total > 0 THEN floor(floor(x + 1e-6) / total) ELSE 0 END::BIGINT AS epochs,
         floor(x + 1e-6) AS want FROM f3),
keyed AS (
  SELECT docs.*, epochs, want - epochs * total AS rest,
         md5('{SEED}|' || (epochs + 1) || '|' || coalesce(doc_id::VARCHAR, 'null') || '|' || content) AS key
  FROM docs JOIN goal ON domain = d AND goal.lang = l AND goal.source = s),
placed AS (SELECT *, sum(n) OVER (PARTITION BY d, l, s ORDER BY key) AS upto FROM keyed),
taken AS (SELECT *, epochs + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END AS times FROM placed)
SELECT doc_id, lang, source, d || '/' || l || '/' || s AS leaf, n AS n_tokens, unnest(range(1, times + 1)) AS epoch FROM taken
"""


@query("op9_mixing", _op9_sql())
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rivulet.llm.mixing import mix

    return mix(spark, read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")).drop("text")


@query("op5_partial_matching")
def op5_partial_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from rivulet.llm.ppm import scores

    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2
    return scores(spark, read(spark, sf_dir, "documents"), held)


@query("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rivulet.llm.runs import periodic_runs, run_digest

    return run_digest(periodic_runs(read(spark, sf_dir, "documents"), plant=True))


@query("op12_whitening")
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from rivulet.llm.whitening import whiten

    return whiten(spark, read(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").cast("long"))


@query("op11_ngram_join")
def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rivulet.llm.ngram_join import jaccard_components

    return jaccard_components(spark, read(spark, sf_dir, "documents"))
