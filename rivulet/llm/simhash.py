"""SimHash near-duplicates found through anchor points of a covering code.

A fingerprint is cut into two halves.  Two fingerprints within ``max_bits``
differ by at most ``max_bits // 2`` in one of the halves.  The anchors of a
half are the code words of the perfect one-error-correcting [31, 26] Hamming
code, with the 32nd bit left free: every 32-bit word is within the covering
radius 1 of one anchor.  Each fingerprint is replicated to every anchor within
the covering radius plus half of a half's threshold; the word midway between
two near halves then has an anchor that holds both fingerprints.  Fingerprints
are compared on all 64 bits at each anchor, and an anchor hands on a spanning
forest of its links, never all pairs.  Anchors with many fingerprints are cut
into tiles of bounded size, compared tile against tile, so none is capped.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.llm.common import binary_column, document_key, staged
from rivulet.llm.components import connected_components

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: Fingerprints of an anchor that one task compares with one another; a larger anchor is cut into tiles of twice that.
TILE = 4096


def _bit_table():
    import numpy as np

    return np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: bytes | None, k: int = SHINGLE_WORDS, bits=None, block: int = 1 << 16) -> int:
    """SimHash of a text: bit set if it is set in over half of the shingles' XXH64 values.

    Words are runs without ASCII white space, A-Z lower-cased; no word (or
    NULL) gives 0, fewer than ``k`` words give one shingle of all of them.
    """
    import numpy as np
    from xxhash import xxh64_digest

    words = (text or b"").lower().split()
    if not words:
        return 0
    bits = _bit_table() if bits is None else bits
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words))) + np.arange(len(words))
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(k, len(words))
    a, b = starts[:len(words) - k + 1], ends[k - 1:]
    lane = np.arange(8) * 256
    hist = np.zeros(2048, np.int64)
    for at in range(0, len(a), block):
        h = b"".join([xxh64_digest(joined[i:j], SEED) for i, j in
                      zip(a[at:at + block].tolist(), b[at:at + block].tolist())])
        hist += np.bincount((np.frombuffer(h, np.uint8).reshape(-1, 8) + lane).ravel(), minlength=2048)
    ones = (hist.reshape(8, 256) @ bits).ravel()
    return int.from_bytes(np.packbits(2 * ones > len(a)).tobytes(), "big")


def with_fingerprint(docs: DataFrame, text_col: str = "text", out: str = "fingerprint",
                     k: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` with the signed 64-bit SimHash of ``text_col`` in column ``out``."""
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.LongType())])

    def run(batches):
        import numpy as np
        import pyarrow as pa

        bits = _bit_table()
        for batch in batches:
            fps = np.array([fingerprint(t, k, bits) for t in binary_column(batch, text_col)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fps)], names=[*batch.schema.names, out])

    return docs.mapInArrow(run, schema)


def anchors(half, radius: int):
    """Anchors of each 32-bit word in ``half`` within the covering radius plus ``radius``, as rows.

    A row repeats its first anchor where it has fewer than the widest row.
    """
    import numpy as np

    half = np.asarray(half, np.uint64)
    # syndrome: exclusive or of (i + 1) over the set bits i of the 31 code positions
    tables = np.zeros((4, 256), np.uint64)
    for byte in range(4):
        for bit in range(8):
            if byte * 8 + bit < 31:
                tables[byte, (np.arange(256) >> bit) & 1 == 1] ^= np.uint64(byte * 8 + bit + 1)
    syndrome = np.zeros(len(half), np.uint64)
    for byte in range(4):
        syndrome ^= tables[byte, (half >> np.uint64(8 * byte)) & np.uint64(255)]
    flips = [0] + [sum(1 << i for i in c) for r in range(1, radius + 1) for c in combinations(range(32), r)]
    flip_syn = np.array([np.bitwise_xor.reduce([i + 1 for i in range(31) if f >> i & 1] or [0]) for f in flips], np.uint64)
    s = syndrome[:, None] ^ flip_syn[None, :]
    fix = np.where(s > 0, np.uint64(1) << np.where(s > 0, s - np.uint64(1), np.uint64(0)), np.uint64(0))
    found = np.sort((half[:, None] ^ np.array(flips, np.uint64)[None, :]) ^ fix, axis=1)
    return found


def _replicate(fps: DataFrame, max_bits: int) -> DataFrame:
    """(anchor, fp): one row for each anchor that a fingerprint is sent to; ``anchor`` carries the half's number."""
    radius = (max_bits // 2 + 1) // 2

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            fp = batch.column(0).to_numpy()
            for at in range(0, len(fp), 1 << 16):
                part = fp[at:at + (1 << 16)]
                word = part.view(np.uint64)
                for which, half in enumerate((word >> np.uint64(32), word & np.uint64(0xFFFFFFFF))):
                    a = anchors(half, radius)
                    new = np.ones(a.shape, bool)
                    new[:, 1:] = a[:, 1:] != a[:, :-1]
                    key = a[new].astype(np.int64) | (which << 32)
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.repeat(part, new.sum(axis=1)))],
                                                     names=["anchor", "fp"])

    return fps.select("fp").mapInArrow(run, "anchor long, fp long")


class Forest:
    """Union-find over integers that reports which links joined two trees."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        root = x
        while up.get(root, root) != root:
            root = up[root]
        while x != root:
            up[x], x = root, up.get(x, x)
        return root

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True


def links_within(fps, max_bits: int):
    """A spanning forest, as pairs, of the links of at most ``max_bits`` among distinct fingerprints.

    Breadth first: a fingerprint is compared only with those not reached yet,
    in blocks, so memory stays linear in the group.
    """
    import numpy as np

    fps = np.asarray(fps, np.int64).view(np.uint64)
    left = np.arange(len(fps))
    out = []
    while len(left):
        frontier, left = left[:1], left[1:]
        while len(frontier) and len(left):
            reached = []
            for at in range(0, len(frontier), 64):
                if not len(left):
                    break
                block = frontier[at:at + 64]
                near = np.bitwise_count(fps[block][:, None] ^ fps[left][None, :]) <= max_bits
                hit = near.any(axis=0)
                if hit.any():
                    out.append(np.stack([block[near[:, hit].argmax(axis=0)], left[hit]], axis=1))
                    reached.append(left[hit])
                    left = left[~hit]
            frontier = np.concatenate(reached) if reached else left[:0]
    return fps.view(np.int64)[np.concatenate(out)] if out else np.zeros((0, 2), np.int64)


def _compare(tiles: DataFrame, max_bits: int) -> DataFrame:
    """Links inside each (anchor, i, j) tile of rows sorted by tile; each task hands on one spanning forest."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        forest = Forest()

        def linked(key, fp):
            """Pairs of the groups of equal rows of ``key``; they are sorted."""
            cut = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            starts = np.concatenate(([0], cut))
            sizes = np.diff(np.concatenate((starts, [len(fp)])))
            two = starts[sizes == 2]
            x, y = fp[two], fp[two + 1]
            ok = np.bitwise_count(x.view(np.uint64) ^ y.view(np.uint64)) <= max_bits
            found = [np.stack([x[ok], y[ok]], axis=1)]
            for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
                found.append(links_within(fp[s:s + n], max_bits))
            pairs = np.concatenate(found)
            kept = [p for p in pairs.tolist() if forest.join(*p)]
            return np.array(kept, np.int64).reshape(-1, 2)

        def out(pairs):
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        rest_key, rest_fp = np.zeros((0, 3), np.int64), np.zeros(0, np.int64)
        for batch in batches:
            key = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(3)], axis=1)
            key, fp = np.concatenate([rest_key, key]), np.concatenate([rest_fp, batch.column(3).to_numpy()])
            if not len(fp):
                continue
            last = np.flatnonzero((key != key[-1]).any(axis=1))
            done = last[-1] + 1 if len(last) else 0
            rest_key, rest_fp = key[done:], fp[done:]
            if done:
                yield out(linked(key[:done], fp[:done]))
        if len(rest_fp):
            yield out(linked(rest_key, rest_fp))

    return tiles.mapInArrow(run, "a long, b long")


def fingerprint_links(spark: SparkSession, fps: DataFrame, max_bits: int = MAX_BITS, tile: int = TILE) -> DataFrame:
    """(a, b): links that connect all distinct fingerprints (column ``fp``) within ``max_bits`` bits."""
    sent = _replicate(fps, max_bits)
    full = staged(spark, sent.groupBy("anchor").count().where(F.col("count") > 2 * tile)
                  .select("anchor", F.ceil(F.col("count") / tile).cast("int").alias("parts")), "anchors")
    mine = F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    tiles = sent.join(full, "anchor", "left").withColumn("mine", mine) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("parts"), F.lit(1)) - 1))) \
        .select("anchor", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "fp")
    return _compare(tiles.repartition("anchor", "i", "j").sortWithinPartitions("anchor", "i", "j"), max_bits)


def near_duplicates(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    k: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: id, ``fingerprint`` (16 hex digits) and ``component_id``.

    Documents whose fingerprints differ in at most ``max_bits`` bits are
    linked; the component is the smallest id reachable.  NULL and empty texts
    have fingerprint zero and are linked like any other; NULL ids take part but
    are never the smallest (NULL if a component has no other).  Repeated rows
    stay, each with the same result; an empty table gives an empty result.
    """
    own = staged(spark, with_fingerprint(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("txt")),
                                         "txt", "fp", k).select("id", "fp"), "fingerprints")
    return component_of(spark, own, max_bits).select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"))


def rooted(spark: SparkSession, own: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, first, root) of each fingerprint of ``own`` (id, fp, ...): its smallest id and its component's root fingerprint."""
    distinct = staged(spark, own.groupBy("fp").agg(F.min("id").alias("first")), "distinct")
    roots = connected_components(spark, fingerprint_links(spark, distinct, max_bits))
    return distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left") \
        .select("fp", "first", F.coalesce("root", "fp").alias("root"))


def component_of(spark: SparkSession, own: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``own`` (id, fp, ...) with ``component``, the smallest id of the fingerprint's component."""
    placed = rooted(spark, own, max_bits)
    named = staged(spark, placed.join(placed.groupBy("root").agg(F.min("first").alias("component")), "root")
                   .select("fp", "component"), "components")
    return own.join(named, "fp")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         k: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with exactly one row of each near-duplicate group: the one with the
    smallest id (NULL ids last, then the text's hash; of equal rows, one).

    A group is a component of fingerprints, whatever its ids: texts that repeat
    an id but are not near stay in groups of their own.
    """
    key = document_key(id_col, text_col)
    own = staged(spark, with_fingerprint(docs.select(F.col(id_col).alias("id"), key.alias("key"), F.col(text_col).alias("txt")),
                                         "txt", "fp", k).select("id", "key", "fp"), "fingerprints")
    keep = own.join(rooted(spark, own, max_bits).select("fp", "root"), "fp") \
        .groupBy("root").agg(F.min("key").alias("__key")).select("__key")
    # one shuffle of the texts at any size; rows that repeat a key are cut to one per task before it
    place = F.row_number().over(Window.partitionBy("__key").orderBy("__key"))
    return docs.withColumn("__key", key.cast(own.schema["key"].dataType)).withColumn("__again", place).where("__again = 1") \
        .join(keep.hint("merge"), "__key", "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
