"""Quality rules by compression bands.

A text is compressed with zstandard as a whole and in chunks of fixed size.
Repetitive text shrinks too well, random text too little.  Because the ratio of
whole texts rises with their length, its limits are given by length band; a
chunk always has the same length, so chunks have one band.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass
from math import log

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.llm.common import binary_column


@dataclass(frozen=True)
class Bands:
    """Limits of the compression ratio (bytes before / bytes after, level 3).

    ``whole``: (characters, lowest, highest) in ascending order; between two lengths
    the limits are interpolated over the logarithm of the length, outside them
    the nearest holds.  Lengths are characters, not bytes, so that a script of
    three bytes a character is held to the limits of texts that say as much.
    ``chunk``: lowest and highest ratio of a chunk of ``chunk_bytes``; a text is
    rejected when more than ``low_share`` of its chunks are below or more than
    ``high_share`` above (a table or a list of badges is part of many manuals, a
    block of encoded data is part of none).  The last
    chunk of a text that does not divide evenly is its last ``chunk_bytes``;
    shorter texts have no chunk, only the whole's limits.

    The defaults leave room on both sides of written prose, whatever its subject:
    licences, manuals, change logs and package descriptions of 300 bytes to 90 KB
    have ratios from 1.31 (shortest) to 3.33 (longest), their chunks from 1.48 to
    3.2 but for a hundredth.  Text in base 64 has 1.09 at 300 bytes and 1.33 at any
    length from 4 KB on, so the lower limits lie between; the upper ones lie
    above all of that prose.
    """

    level: int = 3
    whole: tuple = (
        (20, 0.55, 1.60), (50, 0.72, 1.75), (100, 0.85, 1.90), (300, 1.10, 2.10), (600, 1.28, 2.40), (1200, 1.44, 2.70),
        (2000, 1.58, 2.95), (2800, 1.66, 3.05), (5000, 1.70, 3.20), (10000, 1.74, 3.40), (20000, 1.78, 3.50), (40000, 1.80, 3.70),
        (262144, 1.84, 3.80), (262145, 1.86, 3.90), (1638400, 1.90, 4.00))
    chunk_bytes: int = 2048
    chunk: tuple = (1.40, 3.40)
    low_share: float = 0.1
    high_share: float = 0.25


BASE_FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a ``window``-word sequence occurring at least twice in the text."""
    import numpy as np

    n = len(words)
    if n <= window:
        return 0
    number = {w: i for i, w in enumerate(set(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, n)
    key, bound, size = ids[:n - window + 1], len(number), len(number)
    for j in range(1, window):
        if bound * size >= 1 << 62:
            key = np.unique(key, return_inverse=True)[1]
            bound = len(key)
        key, bound = key * size + ids[j:n - window + 1 + j], bound * size
    ordered = np.sort(key)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    at = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
    again = twice[at] == key
    covered = np.zeros(n, bool)
    for j in range(window):
        covered[j:n - window + 1 + j] |= again
    return int(covered.sum())


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a UTF-8 text."""
    words = text.split()
    bare = text.translate(None, b"\x20\x09\x0a\x0b\x0c\x0d")
    word_chars = len(bare.translate(None, bytes(range(0x80, 0xC0))))
    symbols = len(text) - len(text.translate(None, b"#*$%&|<>"))
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(words), word_chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words


def characters(data: bytes) -> int:
    """Code points of a UTF-8 text."""
    return len(data.translate(None, bytes(range(0x80, 0xC0))))


class Judge:
    """Compression verdicts under one set of bands."""

    def __init__(self, bands: Bands):
        import zstandard

        self.bands, self.lengths = bands, [b[0] for b in bands.whole]
        self.pack = zstandard.ZstdCompressor(level=bands.level).compress

    def limits(self, n_chars: int) -> tuple[float, float]:
        """Lowest and highest ratio of a whole text of this many characters."""
        at = bisect_right(self.lengths, n_chars)
        (n0, low0, high0), (n1, low1, high1) = self.bands.whole[max(at - 1, 0)], self.bands.whole[min(at, len(self.lengths) - 1)]
        share = log(n_chars / n0) / log(n1 / n0) if n1 > n0 and n_chars > n0 else 0.0
        return low0 + share * (low1 - low0), high0 + share * (high1 - high0)

    def ratio(self, data: bytes) -> float:
        return len(data) / len(self.pack(data))

    def chunk_ratios(self, data: bytes) -> list[float]:
        """Ratios of the fixed chunks; the last one ends with the text."""
        step = self.bands.chunk_bytes
        starts = list(range(0, len(data) - step + 1, step))
        if starts and starts[-1] + step < len(data):
            starts.append(len(data) - step)
        return [self.ratio(data[i:i + step]) for i in starts]

    def chunks_outside(self, data: bytes) -> tuple[int, int]:
        """Chunks, and how many of them are outside the chunk band."""
        ratios, (low, high) = self.chunk_ratios(data), self.bands.chunk
        return len(ratios), sum(not low <= r <= high for r in ratios)

    def accepts(self, data: bytes) -> bool:
        low, high = self.limits(characters(data))
        if not low <= self.ratio(data) <= high:
            return False
        ratios, (low, high) = self.chunk_ratios(data), self.bands.chunk
        return sum(r < low for r in ratios) <= self.bands.low_share * len(ratios) \
            and sum(r > high for r in ratios) <= self.bands.high_share * len(ratios)


def quality(docs: DataFrame, text_col: str = "text", bands: Bands = Bands()) -> DataFrame:
    """``docs`` without ``text_col`` and with the base counts, ``base_failed`` and ``kept``.

    A NULL or empty text has no words and fails the base rule.  Rows are judged
    one by one: repeated rows get equal results, an empty table an empty result.
    Columns of ``docs`` that have the name of a result column are replaced.
    """
    made = [*BASE_FIELDS, "base_failed", "kept"]
    carried = [c for c in docs.columns if c not in made and c != text_col]
    schema = T.StructType([*[docs.schema[c] for c in carried], *[T.StructField(c, T.LongType()) for c in BASE_FIELDS],
                           T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType())])

    def run(batches):
        import pyarrow as pa

        judge = Judge(bands)
        for batch in batches:
            counts, failed, kept = [], [], []
            for text in binary_column(batch, text_col):
                text = text or b""
                counts.append(base_counts(text))
                failed.append(base_failed(counts[-1][0], counts[-1][4]))
                kept.append(not failed[-1] and judge.accepts(text))
            columns = [batch.column(batch.schema.get_field_index(c)) for c in carried]
            columns += [pa.array([x[i] for x in counts], pa.int64()) for i in range(len(BASE_FIELDS))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(failed, pa.bool_()), pa.array(kept, pa.bool_())],
                                             names=[*carried, *made])

    return docs.select(*[F.col(f"`{c}`") for c in [*carried, text_col]]).mapInArrow(run, schema)


def keep_good(docs: DataFrame, text_col: str = "text", bands: Bands = Bands()) -> DataFrame:
    """The rows of ``docs`` that ``quality`` keeps, all columns unchanged."""

    def run(batches):
        import pyarrow as pa

        judge = Judge(bands)
        for batch in batches:
            kept = []
            for text in binary_column(batch, text_col):
                words = (text or b"").split()
                kept.append(not base_failed(len(words), repeated_words(words)) and judge.accepts(text))
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
