"""Language-model scores by prediction by partial matching over bytes.

The model is a trie of byte contexts of up to ``ORDER`` bytes with the counts
of the byte that follows, gathered from all training texts.  A byte is coded in
the longest context; where it was never seen there, an escape is coded (method
C: distinct successors over distinct plus total) and the next shorter context
is asked, without the symbols that the longer one would have coded.  After the
empty context the bytes left are equally likely.

Because the model is static, a byte's code length depends only on the gram of
its ``ORDER`` context bytes and itself.  Grams and words that are frequent (a
share of all occurrences that bounds their number) are looked up in broadcast
tables; all others are counted per document and joined with the whole tables,
so no count is cut off and nothing unbounded is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm.common import binary_column, slices, staged

ORDER = 4
#: An entry is broadcast if it makes up at least this share of all occurrences; so at most 1/share entries are.
WORD_SHARE = 1 / (1 << 21)
GRAM_SHARE = 1 / (1 << 22)
END = b"\n"
#: Bytes that are coded at once, when counting and when scoring, and positions looked up at once.
PIECE, SCORED_PIECE, LOOKED_UP = 1 << 22, 1 << 20, 1 << 18


def tokens_of(text: bytes | None) -> list[bytes]:
    """Words of a text, A-Z lower-cased; the end token is left out."""
    return (text or b"").lower().split()


def coded_bytes(words: list[bytes]) -> bytes:
    """The byte string that is coded: words with single spaces, closed by ``END`` (no word holds either)."""
    return b" ".join(words) + END


def grams_of(texts: list[bytes], order: int = ORDER, size_of_piece: int = PIECE):
    """(gram, owner) of every byte of the texts, in pieces of bounded size.

    A gram holds the ``order`` bytes before (``END`` before the text) and the byte.
    """
    import numpy as np

    def pieces():
        for i, text in enumerate(texts):
            for at in range(0, len(text), size_of_piece):
                yield i, (END * order if at == 0 else text[at - order:at]) + text[at:at + size_of_piece]

    def coded(parts):
        buf = np.frombuffer(b"".join(p for _, p in parts), np.uint8)
        sizes = np.array([len(p) for _, p in parts])
        code = np.zeros(len(buf) - order, np.int64)
        for j in range(order + 1):
            code <<= 8
            code |= buf[j:len(buf) - order + j]
        valid = np.ones(len(buf), bool)
        starts = np.cumsum(sizes) - sizes
        for j in range(order):
            valid[starts + j] = False
        owner = np.repeat(np.array([i for i, _ in parts], np.int32), sizes)
        valid = valid[order:]
        return code[valid], owner[order:][valid]

    held, size = [], 0
    for piece in pieces():
        held.append(piece)
        size += len(piece[1])
        if size >= size_of_piece:
            yield coded(held)
            held, size = [], 0
    if held:
        yield coded(held)


def _counts(train: DataFrame, text_col: str, order: int) -> DataFrame:
    """(word, gram, n): counts of the training words and grams, the other key NULL."""

    def run(batches):
        from collections import Counter

        import numpy as np
        import pyarrow as pa

        def rows(words, grams, n):
            return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(grams, pa.int64()), pa.array(n, pa.int64())],
                                              names=["word", "gram", "n"])

        for whole in batches:
            for batch in slices(whole, 2 * PIECE, text_col):
                count, texts = Counter(), []
                for text in binary_column(batch, text_col):
                    words = tokens_of(text)
                    count.update(words)
                    texts.append(coded_bytes(words))
                count[END] += len(texts)
                yield rows(list(count), [None] * len(count), list(count.values()))
                for code, _ in grams_of(texts, order):
                    code.sort()
                    first = np.concatenate(([0], np.flatnonzero(code[1:] != code[:-1]) + 1))
                    n = np.diff(np.concatenate((first, [len(code)])))
                    yield rows([None] * len(n), code[first], n)

    return train.select(text_col).mapInArrow(run, "word binary, gram long, n long") \
        .groupBy("word", "gram").agg(F.sum("n").alias("n"))


class Lookup:
    """A hash table from grams to scores in two arrays."""

    def __init__(self, keys, values):
        import numpy as np

        self.bits = max(8, int(4 * len(keys) + 1).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.zeros(1 << self.bits, np.float64)
        left, slot = np.arange(len(keys)), self.slot(keys)
        while len(left):
            free = self.keys[slot] == -1
            _, first = np.unique(slot[free], return_index=True)
            put = np.flatnonzero(free)[first]
            self.keys[slot[put]], self.values[slot[put]] = keys[left[put]], values[left[put]]
            rest = np.ones(len(left), bool)
            rest[put] = False
            left, slot = left[rest], (slot[rest] + 1) & ((1 << self.bits) - 1)

    def slot(self, keys):
        import numpy as np

        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys):
        """(values, found)."""
        import numpy as np

        slot = self.slot(keys)
        at = self.keys[slot]
        values, found = self.values[slot], at == keys
        open_ = np.flatnonzero(~found & (at != -1))
        slot = slot[open_]
        while len(open_):
            slot = (slot + 1) & ((1 << self.bits) - 1)
            at = self.keys[slot]
            hit = at == keys[open_]
            values[open_[hit]], found[open_[hit]] = self.values[slot[hit]], True
            more = ~hit & (at != -1)
            open_, slot = open_[more], slot[more]
        return values, found


def _context(gram: str, order: int) -> Column:
    """The last ``order`` context bytes of a gram column."""
    return F.shiftright(F.col(gram), 8).bitwiseAND(F.lit((1 << (8 * order)) - 1))


def unseen_scores(spark: SparkSession, grams: DataFrame, wanted: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, score) of grams that training never met, from the training counts (gram, n).

    A context's symbols are among those of every shorter context, so the
    symbols excluded at an order are those of the next longer context that was
    seen; their total there is kept with that context.
    """
    tables = {order: grams.select("gram", "n")}
    for k in range(order - 1, -1, -1):
        tables[k] = staged(spark, tables[k + 1].select(F.col("gram").bitwiseAND(F.lit((1 << (8 * (k + 1))) - 1)).alias("gram"), "n")
                           .groupBy("gram").agg(F.sum("n").alias("n")), f"order{k}")
    out = wanted.select("gram").withColumns({"score": F.lit(0.0), "open": F.lit(True), "t1": F.lit(0).cast("long"),
                                             "d1": F.lit(0).cast("long")})
    for k in range(order, -1, -1):
        # total and number of a context's symbols, and their total one order lower
        own = tables[k].withColumns({"c": _context("gram", k), "low": F.col("gram").bitwiseAND(F.lit((1 << (8 * k)) - 1))})
        if k:
            own = own.join(tables[k - 1].select(F.col("gram").alias("low"), F.col("n").alias("m")), "low")
        else:
            own = own.withColumn("m", F.lit(0).cast("long"))
        stats = own.groupBy("c").agg(F.sum("n").alias("t"), F.count("*").alias("d"), F.sum("m").alias("x"))
        seen = tables[k].select(F.col("gram").alias("g"), F.col("n").alias("hit"))
        if k < 2:  # at most 256 contexts and 65,536 grams
            stats, seen = F.broadcast(stats), F.broadcast(seen)
        out = out.withColumns({"c": _context("gram", k), "g": F.col("gram").bitwiseAND(F.lit((1 << (8 * (k + 1))) - 1))}) \
            .join(stats, "c", "left").join(seen, "g", "left")
        total, kinds = F.col("t") - F.col("t1"), F.col("d") - F.col("d1")
        step = F.when(F.col("hit").isNotNull(), F.log10(F.col("hit") / (total + kinds))) \
            .when(kinds > 0, F.log10(kinds / (total + kinds))).otherwise(0.0)
        out = out.select("gram", (F.col("score") + F.when(F.col("open"), step).otherwise(0.0)).alias("score"),
                         (F.col("open") & F.col("hit").isNull()).alias("open"),
                         F.coalesce("x", F.lit(0)).alias("t1"), F.coalesce("d", F.lit(0)).alias("d1"))
    rest = F.when(F.col("open"), -F.log10(256 - F.col("d1"))).otherwise(0.0)
    return out.select("gram", (F.col("score") + rest).alias("score"))


def scores(spark: SparkSession, docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
           order: int = ORDER, word_share: float = WORD_SHARE, gram_share: float = GRAM_SHARE) -> DataFrame:
    """One row per document: id, ``held_out``, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score`` (unigram, one added to each count) and
    ``score`` (the model's), both log10 probabilities of the tokens.

    The model learns from the documents that are not held out.  A NULL or
    empty text is the end token alone.  Repeated rows are learnt as often as
    they stand there and get equal results; without training texts every byte
    is equally likely; an empty table gives an empty result.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("txt"), held_out.alias("held"))
    counts = staged(spark, _counts(docs.where(~F.col("held")), "txt", order), "counts")
    words = counts.where("word IS NOT NULL").select("word", F.col("n").alias("c"))
    n, v = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    below = n + v + 1
    # a context has at most 256 successors
    whole = counts.where("gram IS NOT NULL").select("gram", "n", F.shiftright("gram", 8).alias("c"))
    stats = whole.groupBy("c").agg((F.sum("n") + F.count("*")).alias("t"))
    seen = staged(spark, whole.join(stats, "c").select("gram", "n", F.log10(F.col("n") / F.col("t")).alias("score")), "grams")
    total = seen.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    top = words.where((F.col("c") >= word_share * n) & (F.octet_length("word") <= 64)).toArrow()
    often = seen.where(F.col("n") >= gram_share * total).select("gram", "score").toArrow()
    sc = spark.sparkContext
    word_table = sc.broadcast((top.column("word").to_pylist(), top.column("c").to_numpy()))
    gram_table = sc.broadcast((often.column("gram").to_numpy(), often.column("score").to_numpy()))

    def run(batches):
        from collections import Counter

        import numpy as np
        import pyarrow as pa

        keys, c = word_table.value
        known = dict(zip(keys, np.log10((c + 1) / below).tolist()))
        table = Lookup(*gram_table.value)

        def looked_up(coded):
            for code, owner in coded:
                for at in range(0, len(code), LOOKED_UP):
                    yield code[at:at + LOOKED_UP], owner[at:at + LOOKED_UP]

        pair = lambda kind, t: pa.list_(pa.struct([(kind, t), ("n", pa.int64())]))
        for whole in batches:
            for batch in slices(whole, 2 * SCORED_PIECE, "txt"):
                texts, tokens, met, base, rare = [], [], [], [], []
                for text in binary_column(batch, "txt"):
                    words = tokens_of(text)
                    texts.append(coded_bytes(words))
                    words.append(END)
                    got = list(map(known.get, words))
                    missing = got.count(None)
                    tokens.append(len(words))
                    met.append(len(words) - missing)
                    if missing:
                        rare.append([{"w": w, "n": k} for w, k in Counter(w for w, g in zip(words, got) if g is None).items()])
                        base.append(float(sum(g for g in got if g is not None)))
                    else:
                        rare.append([])
                        base.append(float(sum(got)))
                score = np.zeros(len(texts))
                odd = [[] for _ in texts]
                for code, owner in looked_up(grams_of(texts, order, SCORED_PIECE)):
                    value, found = table.get(code)
                    score += np.bincount(owner[found], weights=value[found], minlength=len(texts))
                    miss = np.stack([owner[~found].astype(np.int64), code[~found]], axis=1)
                    if len(miss):
                        pairs, times = np.unique(miss, axis=0, return_counts=True)
                        for (i, g), k in zip(pairs.tolist(), times.tolist()):
                            odd[i].append({"g": g, "n": k})
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2), pa.array(tokens, pa.int64()), pa.array(met, pa.int64()),
                     pa.array(base, pa.float64()), pa.array(score), pa.array(rare, pair("w", pa.binary())),
                     pa.array(odd, pair("g", pa.int64()))],
                    names=["id", "held", "tokens", "met", "base", "score", "words", "grams"])

    id_type = docs.schema["id"].dataType.simpleString()
    part = staged(spark, docs.mapInArrow(run, f"id {id_type}, held boolean, tokens long, met long, base double, score double, "
                                              "words array<struct<w: binary, n: long>>, grams array<struct<g: long, n: long>>")
                  .withColumn("row", F.monotonically_increasing_id()), "scored")
    odd = part.select("row", F.explode("grams").alias("x")).select("row", F.col("x.g").alias("gram"), F.col("x.n").alias("k"))
    new = odd.select("gram").distinct().join(seen, "gram", "left_anti")
    odd_scores = seen.select("gram", "score").unionAll(unseen_scores(spark, seen, staged(spark, new, "unseen"), order))
    rare = part.select("row", F.explode("words").alias("x")).select("row", F.col("x.w").alias("word"), F.col("x.n").alias("k")) \
        .join(words, "word", "left")
    nothing = F.lit(0).cast("long")
    more = rare.select("row", (F.col("k") * F.log10((F.coalesce("c", F.lit(0)) + 1) / F.lit(float(below)))).alias("b"),
                       F.when(F.col("c").isNotNull(), F.col("k")).otherwise(nothing).alias("m"), F.lit(0.0).alias("s")) \
        .unionAll(odd.join(odd_scores, "gram").select("row", F.lit(0.0), nothing, F.col("k") * F.col("score"))) \
        .groupBy("row").agg(F.sum("b").alias("b"), F.sum("m").alias("m"), F.sum("s").alias("s"))
    return part.drop("words", "grams").join(more, "row", "left").select(
        F.col("id").alias(id_col), F.col("held").alias("held_out"), F.col("tokens").alias("n_tokens"),
        (F.col("met") + F.coalesce("m", F.lit(0))).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("b", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("s", F.lit(0.0))).alias("score"))
