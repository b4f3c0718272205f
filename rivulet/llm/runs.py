"""Periodic runs of words, found by seeds and extended along diagonals.

A run is a stretch of neighbouring words with smallest period q, at least
``max(MIN_WORDS, MIN_PERIODS * q)`` long, that no neighbouring word extends.
Inside it the text equals itself q words further on (the diagonal of lag q), so
two occurrences of one k-gram lie q apart as long as k is at most the overlap
that is guaranteed.  Lags are taken an octave at a time: for the lags from
2k - 1 to 4k - 2 the k-grams are indexed.  Of the occurrences of a k-gram that
follow one another within k words (k > 1) only the first is kept: if none in a
period were kept, the whole run would have a period of at most k.  Kept
occurrences are over k words apart, so each has at most four partners in its
octave and the pairs stay linear in the text, also in one of a repeated word.  Every pair
seeds a diagonal, extended to both sides by comparing k-grams of falling length;
a table of the furthest word covered on each lag of a document drops pairs that
lie on a diagonal already extended.

k-grams are named by pairs of k/2-grams, so two are equal exactly if their names
are: there is no hashing and the result is exact.
"""

from __future__ import annotations

from zlib import crc32

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.llm.common import binary_column, slices, word_numbers

MIN_WORDS = 24
MIN_PERIODS = 3
#: Text bytes that are searched at once; a longer text is a piece of its own.
PIECE_BYTES = 2 << 20


def planted(words: list, doc_id: int | None) -> list:
    """``words`` as the query's contract wants them: for a tenth of the ids the tail repeats with one period."""
    if doc_id is None or not words:
        return words
    h = crc32(b"%d" % doc_id)
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a:a + p]
    return words[:a] + (unit * ((n - a) // len(unit) + 1))[:n - a]


def _names(key):
    """Dense names of the values of ``key``, the order that sorts them, and where a name differs from the one before."""
    import numpy as np

    order = np.argsort(key, kind="stable")
    s = key[order]
    new = np.empty(len(s), bool)
    new[:1] = True
    new[1:] = s[1:] != s[:-1]
    rank = np.empty(len(s), np.int64)
    rank[order] = np.cumsum(new) - 1
    return rank, order, new


def _extend(levels, i, j, step: int):
    """How far the words at ``i`` and ``j`` agree, from there on (``step`` 1) or before (-1)."""
    import numpy as np

    far = np.zeros(len(i), np.int64)
    size = len(levels[0])

    def match(rank, k, live):
        a, b = (i[live] + far[live], j[live] + far[live]) if step > 0 else (i[live] - far[live] - k, j[live] - far[live] - k)
        ok = (a >= 0) & (b + k <= size)
        ok[ok] = rank[a[ok]] == rank[b[ok]]
        return live[ok]

    live = np.arange(len(i))
    while len(live):  # a match may be many times the longest indexed k-gram
        live = match(levels[-1], 1 << (len(levels) - 1), live)
        far[live] += 1 << (len(levels) - 1)
    everything = np.arange(len(i))
    for n in range(len(levels) - 2, -1, -1):
        far[match(levels[n], 1 << n, everything)] += 1 << n
    return far


def find_runs(words, doc, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS):
    """(start, end, period) arrays of all runs, by start and period.

    ``words`` holds a number for each word (equal numbers for equal words),
    ``doc`` the number of its document, not falling; no run leaves a document.
    """
    import numpy as np

    if min_periods < 3:
        raise ValueError("the octaves guarantee a seed for runs of three periods or more")
    size = len(words)
    none = np.zeros(0, np.int64)
    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if size else none
    length = np.diff(np.r_[first, size])
    levels, found = [], []
    live = np.flatnonzero(np.repeat(length >= min_words, length))  # positions whose document can still hold a run
    k = 1
    while len(live):
        # name the k-grams that start at live positions; every other one differs from all
        if k == 1:
            key = doc[live].astype(np.int64) << 32 | words[live]
        else:
            half = levels[-1]
            ok = live + k <= size
            live = live[ok]
            live = live[(half[live] >= 0) & (half[live + k // 2] >= 0)]
            if not len(live):
                break
            key = half[live] << 32 | half[live + k // 2]
        rank, order, new = _names(key)
        pos = live[order]
        # a k-gram that stands once in its document can't seed, nor can one that holds it
        single = new & np.r_[new[1:], True]
        level = np.full(size, -1, np.int64) - np.arange(size)
        level[live] = rank
        level[pos[single]] = -1 - pos[single]
        levels.append(level)
        gap = np.r_[np.int64(1 << 40), pos[1:] - pos[:-1]]
        gap[new] = 1 << 40
        kept = ((gap > k) | (k == 1)) & ~single
        at, name = pos[kept], rank[order][kept]
        if len(at):
            lo, hi = 2 * k - 1, 4 * k - 2
            near = []
            for d in range(1, 5):
                same = name[d:] == name[:-d] if d < len(at) else np.zeros(0, bool)
                lag = at[d:][same] - at[:-d][same] if len(same) else none
                ok = (lag >= lo) & (lag <= hi)
                near.append((at[:-d][same][ok], lag[ok]) if len(same) else (none, none))
            i, lag = (np.concatenate(x) for x in zip(*near))
            order = np.lexsort((i, lag))
            found += _diagonals(levels, i[order], lag[order], first, length, doc, min_words, min_periods)
        # a document goes on while it is long enough for the next octave and some k-gram stands twice
        twice = np.zeros(len(first), bool)
        twice[np.searchsorted(first, pos[~single], "right") - 1] = True
        twice &= length >= min_periods * (4 * k - 1)
        live = live[twice[np.searchsorted(first, live, "right") - 1]] if twice.any() else none
        k *= 2
    if not found:
        return none, none, none
    start, end, period = (np.concatenate(x) for x in zip(*found))
    # one stretch found at several lags: the smallest is its period
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    once = np.r_[True, (start[1:] != start[:-1]) | (end[1:] != end[:-1])]
    start, end, period = start[once], end[once], period[once]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def _diagonals(levels, i, lag, first, length, doc, min_words, min_periods):
    """The long diagonals through the pairs (i, i + lag), sorted by lag and i, as (start, end, lag) of their stretches."""
    import numpy as np

    out = []
    while len(i):
        # of each document and lag, extend the first pair that no diagonal covers yet
        head = np.r_[True, (lag[1:] != lag[:-1]) | (doc[i[1:]] != doc[i[:-1]])]
        a, q = i[head], lag[head]
        own = np.searchsorted(first, a, "right") - 1
        ahead = np.minimum(_extend(levels, a, a + q, 1), first[own] + length[own] - q - a)
        back = np.minimum(_extend(levels, a, a + q, -1), a - first[own])
        start, end = a - back, a + ahead + q
        long = end - start >= np.maximum(min_words, min_periods * q)
        if long.any():
            out.append((start[long], end[long], q[long]))
        covered = np.repeat(a + np.maximum(ahead, 1), np.diff(np.r_[np.flatnonzero(head), len(i)]))
        rest = i >= covered
        i, lag = i[rest], lag[rest]
    return out


def _search(texts: list, ids: list | None, min_words: int, min_periods: int):
    """(words, runs) of each text: its words and (start, length, period) rows relative to it."""
    import numpy as np

    split = [(t or b"").split() for t in texts]
    if ids is not None:
        split = [planted(w, d) for w, d in zip(split, ids)]
    words, _, sizes = word_numbers(split)
    doc = np.repeat(np.arange(len(split)), sizes)
    start, end, period = find_runs(words, doc, min_words, min_periods)
    base = np.r_[0, np.cumsum(sizes)]
    owner = doc[start] if len(start) else start
    edges = np.searchsorted(owner, np.arange(len(split) + 1))
    rows = np.stack([start - base[owner], end - start, period], axis=1) if len(start) else np.zeros((0, 3), np.int64)
    for n, w in enumerate(split):
        yield w, rows[edges[n]:edges[n + 1]]


def _collapsed(words: list, runs) -> list:
    """``words`` without those that a run holds after its first period."""
    if not len(runs):
        return words
    out, at = [], 0
    for lo, hi in sorted((int(s + q), int(s + n)) for s, n, q in runs):
        if lo > at:
            out += words[at:lo]
        at = max(at, hi)
    return out + words[at:]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                  min_periods: int = MIN_PERIODS, plant: bool = False) -> DataFrame:
    """Per document: ``id_col``, ``runs`` (an array of start, length and period
    by start and period, counted in words) and ``collapsed`` (the words that no
    run repeats, joined by one space).

    Words are runs of bytes without ASCII white space.  NULL and empty texts
    have no runs and an empty ``collapsed``; repeated rows stay, each with the
    same result; other columns are not read; an empty table gives an empty
    result.  ``plant`` puts the periods of ``planted`` into the texts first
    (for integer ids; a NULL id changes nothing).
    """
    run = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("txt"))

    def search(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch, PIECE_BYTES, "txt"):
                ids = part.column(0)
                rows, counts, kept = [], [0], []
                for words, runs in _search(binary_column(part, "txt"), ids.to_pylist() if plant else None,
                                           min_words, min_periods):
                    rows.append(runs)
                    counts.append(len(runs))
                    kept.append(b" ".join(_collapsed(words, runs)).decode(errors="replace"))
                flat = np.concatenate(rows)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.cumsum(counts), pa.int32()),
                    pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], names=["start", "length", "period"]))
                yield pa.RecordBatch.from_arrays([ids, lists, pa.array(kept, pa.string())], names=["id", "runs", "collapsed"])

    schema = T.StructType([source.schema["id"], T.StructField("runs", T.ArrayType(run)), T.StructField("collapsed", T.StringType())])
    return source.mapInArrow(search, schema).withColumnRenamed("id", id_col)


def run_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The query's columns: the number of runs, the run of greatest exponent
    (exact length / period; ties to the smallest start, then period) and the
    SHA-256 of all runs and of the collapsed text."""
    first = F.get(F.array_sort("runs", lambda a, b: F.coalesce(
        F.nullif(F.signum(b["length"] * a["period"] - a["length"] * b["period"]).cast("int"), F.lit(0)),
        F.nullif(F.signum(a["start"] - b["start"]).cast("int"), F.lit(0)),
        F.signum(a["period"] - b["period"]).cast("int"))), 0)
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","),
                                                                r["period"], F.lit("\n"))), "")
    best = F.when(F.size("runs") > 0, first)
    return found.withColumn("__best", best).select(
        F.col(id_col), F.size("runs").cast("long").alias("n_runs"), F.col("__best.start").alias("start"),
        F.col("__best.length").alias("length"), F.col("__best.period").alias("period"),
        F.expr("CAST(1000 * __best.length DIV __best.period AS LONG)").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
