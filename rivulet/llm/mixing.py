"""Mixing sources to target weights by hierarchical budgeting.

A tree domain - language - source holds target weights.  A token budget moves
down the tree: each node splits its amount among its children by weight, and
what a child cannot hold (all of its documents, ``max_epochs`` times) goes to
its siblings; only when a whole subtree is exhausted does the rest reach the
siblings of its ancestors.  A leaf then takes whole epochs of its documents,
and of the next epoch's seeded order the longest prefix that fits its budget.

Only sums per leaf and per hash cell of a leaf meet on the driver or in a
window; both are bounded by the tree and the number of cells.  Documents are
never sorted as a whole and their texts never shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rivulet.llm.common import staged

OTHER = "*"
CELL_DIGITS = 3
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Tree:
    """Target weights: ``domains`` by domain, ``languages`` by language within
    each domain, ``sources`` by source within each domain.  ``OTHER`` stands
    for every value that is not listed; without it such documents get nothing.
    """

    domains: dict[str, float]
    languages: dict[str, float]
    sources: dict[str, dict[str, float]]
    domain_of: dict[str, str] = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "domain_of", {s: d for d, own in self.sources.items() for s in own if s != OTHER})

    def leaves(self) -> list[tuple[str, str, str]]:
        return [(d, lang, s) for d in self.domains for lang in self.languages for s in self.sources.get(d, {OTHER: 1})]


#: Production parameters: two listed domains of ten sources each, and the rest.
TREE = Tree(
    domains={"crawl": 0.55, "curated": 0.40, OTHER: 0.05},
    languages={"en": 0.40, "de": 0.20, "fr": 0.20, "es": 0.15, OTHER: 0.05},
    sources={"crawl": {f"src{i}": 2.0 if i == 0 else 1.0 for i in range(10)},
             "curated": {f"src{i}": 1.0 for i in range(10, 20)}, OTHER: {OTHER: 1.0}})
BUDGET_SHARE = 0.8
MAX_EPOCHS = 2
SEED = 17


def split(amount: Fraction, children: list[tuple]) -> dict:
    """Split ``amount`` among children (name, weight, capacity) by weight; what
    one cannot hold goes to the others.  Returns the amounts by name."""
    got = {name: Fraction(0) for name, _, _ in children}
    open_ = [c for c in children if c[1] > 0 and c[2] > 0]
    while open_ and amount > 0:
        rate = amount / sum(c[1] for c in open_)
        full = [c for c in open_ if c[2] <= rate * c[1]]
        if not full:
            got.update({name: rate * weight for name, weight, _ in open_})
            break
        for name, _, capacity in full:
            got[name] = capacity
            amount -= capacity
        open_ = [c for c in open_ if c not in full]
    return got


def budgets(tree: Tree, tokens: dict[tuple[str, str, str], int], budget: int, max_epochs: int) -> dict[tuple, int]:
    """Token budget of each leaf, rounded down."""
    weight = lambda w: Fraction(str(w))
    capacity = {leaf: Fraction(tokens.get(leaf, 0) * max_epochs) for leaf in tree.leaves()}

    def can(prefix):
        total = Fraction(0)
        for leaf, c in capacity.items():
            d, lang, s = leaf
            path = (tree.domains[d], tree.languages[lang], tree.sources.get(d, {OTHER: 1})[s])
            if leaf[:len(prefix)] == prefix and all(w > 0 for w in path[len(prefix):]):
                total += c
        return total

    out = {}
    by_domain = split(Fraction(budget), [(d, weight(w), can((d,))) for d, w in tree.domains.items()])
    for d, amount in by_domain.items():
        by_lang = split(amount, [(lang, weight(w), can((d, lang))) for lang, w in tree.languages.items()])
        for lang, part in by_lang.items():
            own = tree.sources.get(d, {OTHER: 1})
            by_source = split(part, [(s, weight(w), capacity[d, lang, s]) for s, w in own.items()])
            out.update({(d, lang, s): int(x) for s, x in by_source.items()})
    return out


def leaf_of(tree: Tree, lang: Column, source: Column) -> Column:
    """The leaf of a document as one string (tab-joined); NULL and unlisted values count as ``OTHER``."""
    pairs = [F.lit(x) for item in tree.domain_of.items() for x in item]
    domain = F.coalesce(F.create_map(*pairs)[source], F.lit(OTHER)) if pairs else F.lit(OTHER)
    language = F.when(lang.isin([x for x in tree.languages if x != OTHER]), lang).otherwise(OTHER)
    own = F.when(domain == OTHER, F.lit(OTHER)).otherwise(source)
    return F.concat_ws("\t", domain, language, own)


def order_key(seed: int, epoch: Column, id_col: Column, text: Column) -> Column:
    """Seeded place of a document in an epoch, as 32 hex digits; rows that repeat id and text tie."""
    return order_key_of(seed, epoch, id_col, F.md5(F.coalesce(text, F.lit(""))))


def order_key_of(seed: int, epoch: Column, id_col: Column, content: Column) -> Column:
    """The same, from the MD5 of the text."""
    return F.md5(F.concat_ws("|", F.lit(seed), epoch, F.coalesce(id_col.cast("string"), F.lit("null")), content))


def mix(spark: SparkSession, docs: DataFrame, tree: Tree = TREE, budget_share: float = BUDGET_SHARE,
        max_epochs: int = MAX_EPOCHS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang", source_col: str = "source", leaf_out: str = "leaf", tokens_out: str = "n_tokens",
        epoch_out: str = "epoch") -> DataFrame:
    """The selected documents, one row for each epoch they are taken in, with
    their leaf, their token count (words) and the epoch (from 1).

    The budget is ``budget_share`` of all tokens.  NULL or empty texts have 0
    tokens and follow the prefix of their leaf; NULL or unlisted languages and
    sources belong to ``OTHER``; rows that repeat id and text are taken
    together; an empty table gives an empty result.
    """
    leaf, tokens, key = "__leaf", "__tokens", "__key"
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in (leaf_out, tokens_out, epoch_out)])
    counted = docs.withColumn(leaf, leaf_of(tree, F.col(lang_col), F.col(source_col))) \
        .withColumn(tokens, F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long"))
    # the texts are read twice: here, for what decides, and at the end
    content = "__content"
    placed = staged(spark, counted.select(leaf, tokens, F.col(id_col).alias("__id"),
                                          F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias(content)), "leaves")
    names = ["\t".join(x) for x in tree.leaves()]
    # at most one row for each leaf of the tree
    sums = {r[0]: r[1] for r in placed.where(F.col(leaf).isin(names)).groupBy(leaf).agg(F.sum(tokens)).collect()}
    goal = budgets(tree, {tuple(k.split("\t")): v for k, v in sums.items()},
                   int(Fraction(str(budget_share)) * sum(sums.values())), max_epochs)
    plan = []
    for name in names:
        total, want = sums.get(name, 0), goal[tuple(name.split("\t"))]
        whole = want // total if total else 0
        plan.append((name, whole, want - whole * total))
    plan = spark.createDataFrame(plan, f"{leaf} string, __whole long, __rest long")
    small = placed.join(F.broadcast(plan.where("__rest > 0")), leaf) \
        .withColumn(key, order_key_of(seed, F.col("__whole") + 1, F.col("__id"), F.col(content)))
    part = small.select(leaf, tokens, key, "__rest", F.substring(key, 1, CELL_DIGITS).alias("cell"))
    # the cell in which a leaf's prefix ends, from the sums of its cells
    cells = part.groupBy(leaf, "cell", "__rest").agg(F.sum(tokens).alias("s"))
    until = F.sum("s").over(Window.partitionBy(leaf).orderBy("cell"))
    last = cells.withColumn("until", until).where("until > __rest").groupBy(leaf) \
        .agg(F.min(F.struct("cell", (F.col("until") - F.col("s")).alias("before"))).alias("c")).select(leaf, "c.*")
    # the place in that cell
    inside = part.join(F.broadcast(last), [leaf, "cell"]).groupBy(leaf, "cell", "before", "__rest", key) \
        .agg(F.sum(tokens).alias("s"))
    reach = F.col("before") + F.sum("s").over(Window.partitionBy(leaf).orderBy(key))
    ends = {r[0]: r[1] for r in inside.withColumn("reach", reach).groupBy(leaf)
            .agg(F.coalesce(F.max(F.when(F.col("reach") <= F.col("__rest"), F.col(key))), F.first("cell"))).collect()}
    # a leaf without an end takes its whole next epoch, or nothing of it
    bounds = spark.createDataFrame([(n, ends.get(n)) for n in names], f"{leaf} string, __end string")
    keyed = counted.join(F.broadcast(plan.where("__whole > 0 OR __rest > 0")), leaf) \
        .withColumn(key, F.when(F.col("__rest") > 0, order_key(seed, F.col("__whole") + 1, F.col(id_col), F.col(text_col))))
    more = F.when(F.col("__rest") > 0, F.coalesce(F.col(key) <= F.col("__end"), F.lit(True))).otherwise(False)
    return keyed.join(F.broadcast(bounds), leaf) \
        .withColumn("__times", F.col("__whole") + more.cast("long")).where("__times > 0") \
        .withColumn("__epoch", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__times")))) \
        .select(*[F.col(f"`{c}`") for c in docs.columns], F.translate(leaf, "\t", "/").alias(leaf_out),
                F.col(tokens).alias(tokens_out), F.col("__epoch").alias(epoch_out))
