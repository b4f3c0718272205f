"""Line de-duplication by pairwise alignment.

A line's hash is rare enough to link documents once it stands for
``MIN_BLOCK_WORDS`` words: a shorter line is taken together with the lines
after it until the run has that many, so a boilerplate line alone links
nothing.  A document is paired with the earliest holder of each of its hashes,
never with all of them, so pairs grow with the lines and every block of that
many words is met in its earliest place.  Pairs are aligned by patience diff over the
runs of lines that link them (runs unique on both sides, their longest increasing
order, then the stretches between them, by a longest common subsequence where
none is unique), and aligned blocks of at least ``MIN_BLOCK_WORDS`` words are
deleted from the later document, whose other lines are aligned again until it
shares no such block with the earlier one: passages in another order and
repeated ones go too.  The earliest copy of a line always stays.
"""

from __future__ import annotations

from bisect import bisect_left
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.llm.common import binary_column, document_key, staged

#: Words of the shortest block that is deleted.
MIN_BLOCK_WORDS = 25
#: Bits of an alignment table that are kept at once.
LCS_BITS = 1 << 29


def line_hashes(text: bytes | None, min_words: int = MIN_BLOCK_WORDS):
    """(index, hash, words, link) of each line with a word: ``index`` counts all
    lines, ``link`` is the hash of the run from this line that has
    ``min_words`` words, None where the text ends before."""
    from xxhash import xxh64_intdigest

    signed = lambda x: x - (1 << 64) if x >> 63 else x
    index, own, words = [], [], []
    for i, line in enumerate((text or b"").split(b"\n")):
        n = len(line.split())
        if n:
            index.append(i)
            own.append(signed(xxh64_intdigest(line.strip())))
            words.append(n)
    links, end, held = [], 0, 0
    for i in range(len(own)):
        while end < len(own) and held < min_words:
            held += words[end]
            end += 1
        if held < min_words:
            links.append(None)
        elif end == i + 1:
            links.append(own[i])
        else:
            links.append(signed(xxh64_intdigest(b",".join(b"%d" % h for h in own[i:end]))))
        held -= words[i]
    return index, own, words, links


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned positions of two sequences, in order: elements unique on both sides in their longest
    increasing order, then the same between them; a stretch without a unique one by its longest common subsequence."""
    found, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            found.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            found.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        places: list[dict[int, int | None]] = [{}, {}]
        for seen, seq, lo, hi in ((places[0], a, a0, a1), (places[1], b, b0, b1)):
            for i in range(lo, hi):
                seen[seq[i]] = None if seq[i] in seen else i
        common = [(i, places[1][h]) for h, i in places[0].items() if i is not None and places[1].get(h) is not None]
        if not common:
            found += [(a0 + i, b0 + j) for i, j in lcs(a[a0:a1], b[b0:b1])]
            continue
        common.sort()
        # longest increasing order of the places in b
        ends, at, before = [], [], [-1] * len(common)
        for n, (_, j) in enumerate(common):
            k = bisect_left(ends, j)
            before[n] = at[k - 1] if k else -1
            ends[k:k + 1], at[k:k + 1] = [j], [n]
        chain, n = [], at[-1]
        while n >= 0:
            chain.append(common[n])
            n = before[n]
        chain.reverse()
        found += chain
        for (i, j), (i2, j2) in zip([(a0 - 1, b0 - 1), *chain], [*chain, (a1, b1)]):
            if i + 1 < i2 and j + 1 < j2:
                todo.append((i + 1, i2, j + 1, j2))
    return sorted(found)


def lcs(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned positions of a longest common subsequence; rows of bits, one per element of the shorter side.

    Sides too long for the rows to be kept at once are cut: the pieces of the longer
    side are aligned one by one with what the shorter side has left.
    """
    if len(a) > len(b):
        return [(i, j) for j, i in lcs(b, a)]
    found, at = [], 0
    piece = max(1, LCS_BITS // max(len(a), 1))
    for start in range(0, len(b), piece):
        part = b[start:start + piece]
        places: dict[int, int] = {}
        for j, h in enumerate(part):
            places[h] = places.get(h, 0) | 1 << j
        full = (1 << len(part)) - 1
        state, rows = full, []
        for h in a[at:]:
            hit = state & places.get(h, 0)
            state = ((state + hit) | (state - hit)) & full
            rows.append(state)
        i, j, pairs = len(rows), len(part), []
        while i and j:
            if rows[i - 1] >> (j - 1) & 1:
                j -= 1
            else:
                i -= 1
                if not i or rows[i - 1] >> (j - 1) & 1:
                    j -= 1
                    pairs.append((at + i, start + j))
        pairs.reverse()
        found += pairs
        at = found[-1][0] + 1 if found else 0
    return found


def runs(seq: list, min_words: int = MIN_BLOCK_WORDS) -> list[tuple[int, int]]:
    """(start, hash) of the shortest run of neighbouring lines with ``min_words`` words from each line on that has one."""
    total = [0, *accumulate(x[3] for x in seq)]
    edges = [0, *(i for i in range(1, len(seq)) if seq[i][0] != seq[i - 1][0] + 1), len(seq)]
    out = []
    for lo, hi in zip(edges, edges[1:]):
        for i in range(lo, hi):
            end = bisect_left(total, total[i] + min_words, i + 1, hi + 1)
            if end > hi:
                break
            out.append((i, hash(tuple([x[2] for x in seq[i:end]]))))
    return out


def aligned_blocks(a: list, b: list, anchors: list[tuple[int, int]], min_words: int = MIN_BLOCK_WORDS) -> set[int]:
    """Positions in ``b`` of the blocks of at least ``min_words`` words around aligned anchors (i, j), in order.

    From an anchor the alignment goes on line by line, back to the one before and
    forth to the next, while lines are equal and neighbours on both sides.
    """
    out: set[int] = set()
    last = (-1, -1)
    for (i, j), (i2, j2) in zip(anchors, [*anchors[1:], (len(a), len(b))]):
        if i <= last[0] or j <= last[1]:
            continue  # inside the block before
        near = lambda seq, n: seq[n][0] == seq[n - 1][0] + 1
        s, t = i, j
        while s - 1 > last[0] and t - 1 > last[1] and near(a, s) and near(b, t) and a[s - 1][2] == b[t - 1][2]:
            s, t = s - 1, t - 1
        e, f = i, j
        while e < len(a) and f < len(b) and a[e][2] == b[f][2] and (e == i or near(a, e) and near(b, f)) \
                and (e - i2 == f - j2 or e < i2 and f < j2):
            e, f = e + 1, f + 1
        if sum(x[3] for x in b[t:f]) >= min_words:
            out.update(range(t, f))
        last = (e - 1, f - 1)
    return out


def common_blocks(a: list, b: list, min_words: int = MIN_BLOCK_WORDS) -> list[int]:
    """Line indexes of ``b`` in blocks of at least ``min_words`` words shared with ``a``.

    ``a`` and ``b`` are lists of (place among the lines with words, index,
    hash, words); a block is consecutive on both sides.  The anchors of an
    alignment are the rare line hashes: runs of ``min_words`` words that both
    sides hold.  One alignment finds passages in one order and each once, so the
    lines it leaves are aligned with the whole of ``a`` again, until the sides
    share no such run: the last anchor of an alignment always yields its block.
    The first alignment is that of the whole documents; later ones take what is
    left of ``b`` in pieces of as many anchors as ``a`` has, so a passage repeated
    many times doesn't cost an alignment of the whole for each repeat.
    """
    of_a, out, whole = runs(a, min_words), [], True
    known = {h for _, h in of_a}
    while True:
        of_b = [(j, h) for j, h in runs(b, min_words) if h in known]
        if not of_b:
            return sorted(out)
        there = {h for _, h in of_b}
        left = [(i, h) for i, h in of_a if h in there]
        gone: set[int] = set()
        size = len(of_b) if whole else len(left)
        for n in range(0, len(of_b), size):
            part = of_b[n:n + size]
            pairs = patience([h for _, h in left], [h for _, h in part])
            gone |= aligned_blocks(a, b, [(left[x][0], part[y][0]) for x, y in pairs], min_words)
        if not gone:  # only if two different runs have one 64-bit hash
            return sorted(out)
        out += [b[j][1] for j in gone]
        b = [x for j, x in enumerate(b) if j not in gone]
        whole = False


def deletions(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              min_words: int = MIN_BLOCK_WORDS) -> DataFrame:
    """(doc, deleted, partners): documents that lose lines, the lines' indexes, and the ids they are aligned with."""
    keyed = docs.select(document_key(id_col, text_col).alias("doc"), F.col(text_col).alias("txt")).where("txt <> ''")
    key_type = keyed.schema["doc"].dataType
    line = T.StructType([T.StructField("place", T.IntegerType()), T.StructField("index", T.IntegerType()),
                         T.StructField("hash", T.LongType()), T.StructField("words", T.IntegerType()),
                         T.StructField("link", T.LongType())])

    def read(batches):
        import pyarrow as pa

        names = ["place", "index", "hash", "words", "link"]
        types = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64()]
        for batch in batches:
            columns, offsets = [[] for _ in names], [0]
            for text in binary_column(batch, "txt"):
                index, own, words, links = line_hashes(text, min_words)
                for c, values in zip(columns, (range(len(index)), index, own, words, links)):
                    c += values
                offsets.append(offsets[-1] + len(index))
            lines = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), lines)],
                                             names=["doc", "lines"])

    schema = T.StructType([T.StructField("doc", key_type), T.StructField("lines", T.ArrayType(line))])
    lines = staged(spark, keyed.mapInArrow(read, schema).select("doc", F.explode("lines").alias("l")).select("doc", "l.*"), "lines")
    links = lines.where("link IS NOT NULL").select("link", "doc").distinct()
    first = links.groupBy("link").agg(F.min("doc").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    pairs = staged(spark, links.join(first, "link").where("doc <> first").select("first", "doc").distinct(), "pairs")
    # only lines that stand twice somewhere can be aligned
    shared = lines.groupBy("hash").count().where("count > 1").select("hash")
    taking_part = pairs.select("doc").unionAll(pairs.select("first")).distinct()
    sequences = staged(spark, lines.join(taking_part, "doc", "left_semi").join(shared, "hash", "left_semi")
                       .groupBy("doc").agg(F.sort_array(F.collect_set(F.struct("place", "index", "hash", "words"))).alias("seq")),
                       "sequences")
    both = pairs.join(sequences.select(F.col("doc").alias("first"), F.col("seq").alias("a")), "first") \
        .join(sequences.select("doc", F.col("seq").alias("b")), "doc")

    def align(batches):
        import pyarrow as pa

        def rows(column):
            flat = column.flatten()
            values = list(zip(*(flat.field(i).to_pylist() for i in range(4))))
            at = column.offsets.to_pylist()
            return [values[s - at[0]:e - at[0]] for s, e in zip(at, at[1:])]

        for batch in batches:
            gone = [common_blocks(a, b, min_words) for a, b in zip(rows(batch.column(2)), rows(batch.column(3)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(gone, pa.list_(pa.int32()))],
                                             names=["doc", "first", "gone"])

    aligned = staged(spark, both.select("doc", "first", "a", "b").mapInArrow(
        align, T.StructType([T.StructField("doc", key_type), T.StructField("first", key_type),
                             T.StructField("gone", T.ArrayType(T.IntegerType()))])).where("size(gone) > 0"), "aligned")
    gone = aligned.select("doc", F.explode("gone").alias("i")).distinct() \
        .groupBy("doc").agg(F.sort_array(F.collect_list("i")).alias("deleted"))
    partners = aligned.groupBy("doc").agg(F.sort_array(F.collect_list("first.id")).alias("partners"))
    return gone.join(partners, "doc")


def drop_common_blocks(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       min_words: int = MIN_BLOCK_WORDS, deleted: str = "deleted", partners: str = "partners") -> DataFrame:
    """``docs`` with the blocks gone from ``text_col``, and two columns: the
    indexes of the deleted lines and the ids of the earlier documents that hold
    them (empty where nothing is deleted).

    "Later" is the larger id, NULL ids last, then the text's hash.  NULL and
    empty texts have no lines and stay as they are; rows that repeat id and
    text count as one document and get equal results; an empty table gives an
    empty result.
    """
    lost = deletions(spark, docs, id_col, text_col, min_words)
    empty = F.array().cast("array<int>")
    marked = docs.withColumn("__doc", document_key(id_col, text_col)) \
        .join(lost.select(F.col("doc").alias("__doc"), F.col("deleted").alias("__gone"), F.col("partners").alias("__with"))
              .hint("merge"), "__doc", "left")
    kept = [c for c in docs.columns if c not in (deleted, partners)]
    out = marked.select(*[F.col(f"`{c}`") for c in kept], F.coalesce("__gone", empty).alias(deleted),
                        F.coalesce("__with", F.array().cast(T.ArrayType(docs.schema[id_col].dataType))).alias(partners))

    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            gone = batch.column(batch.schema.get_field_index(deleted)).to_pylist()
            texts = batch.column(at)
            if any(gone):
                new = []
                for text, lines in zip(texts.to_pylist(), gone):
                    if lines:
                        lines = set(lines)
                        text = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in lines)
                    new.append(text)
                texts = pa.array(new, texts.type)
            yield pa.RecordBatch.from_arrays([texts if i == at else c for i, c in enumerate(batch.columns)],
                                             schema=batch.schema)

    return out.mapInArrow(cut, out.schema)
