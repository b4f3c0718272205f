"""Exact token counts by a compiled finite-state transducer.

The byte-pair vocabulary is compiled into a deterministic transducer over
bytes.  A state holds every way in which the token under the head may have
begun: the token before it, the place in the vocabulary's trie, and how many
tokens were emitted before it.  A transition on a byte moves each of them,
keeps the one ending that agrees with the merge order, and emits the tokens
that all remaining beginnings share; a final weight gives the rest.  States are
determinised when first met, as lazy automata do, and kept by the worker.

A text is cut into chunks.  Where a white-space character follows another
character the transducer is in its first state whatever came before, so the map
of a chunk from the state it is entered in to its count and last state is
constant between its first and last such boundary.  It is written as the
characters before the first one (to be run from whatever state comes in), a
count, and the characters after the last one (whose run is the state that goes
out).  Maps compose associatively, in a parallel prefix scan: within a task for
texts of ordinary length, and for longer ones over (document, chunk) rows that
are dealt to all tasks and composed in rounds, so no text is one task's work.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm.common import slices, staged, worker_cache

OVER_LIMIT = 512
CHUNK_CHARS = 1 << 16
#: Texts over this are cut into rows of ``CHUNK_CHARS``; so many neighbouring rows are composed by one task in a round.
LONG_CHARS = 1 << 20
COMPOSED = 256
#: Pre-tokens and states that a worker keeps; the tables start anew when they are full.
KEPT_WORDS = 400_000
KEPT_STATES = 200_000

# Fixed value: the pre-token pattern that defines this kind of vocabulary
# (L letters, N numbers, S white space by Unicode; see ``pretoken_pattern``).
PRETOKEN = "'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"
# The Unicode property White_Space, as the inside of a character class.
SPACES = "\\x09-\\x0d\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def byte_letters() -> dict[str, int]:
    """Letter of each byte in the vocabulary file: printable ones stand for
    themselves, the others, in order, for the code points from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def category_class(kind: str, top: int) -> str:
    """The code points up to ``top`` of a general category as the inside of a character class."""
    import unicodedata

    ranges, start = [], None
    for i in range(top + 2):
        inside = i <= top and unicodedata.category(chr(i))[0] == kind
        if inside and start is None:
            start = i
        elif not inside and start is not None:
            ranges.append(f"\\U{start:08x}-\\U{i - 1:08x}")
            start = None
    return "".join(ranges)


def pretoken_pattern(top: int = 0x10FFFF) -> str:
    """The pattern for texts whose code points are at most ``top``."""
    return PRETOKEN.replace("{L}", category_class("L", top)).replace("{N}", category_class("N", top)) \
        .replace("{S}", SPACES)


class Words(dict):
    """Token counts by pre-token, filled by the transducer."""

    def __init__(self, run):
        super().__init__()
        self.run = run

    def __missing__(self, word: str) -> int:
        n = self.run(word.encode())
        if len(word) <= 64:
            self[word] = n
        return n


class Transducer:
    """Counts the tokens of pre-tokens for one vocabulary file (the text of its JSON)."""

    def __init__(self, text: str):
        model = json.loads(text)
        known = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        before = model.get("pre_tokenizer") or {}
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
               if model["model"].get(k)]
        if model["model"].get("type") != "BPE" or model.get("normalizer") or odd or {k: before.get(k) for k in known} != known \
                or any(t.get(k) for t in model["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("only byte-level byte-pair vocabularies without a normalizer, with the usual pre-token pattern, are compiled")
        letters = byte_letters()
        spell = lambda token: bytes(letters[c] for c in token)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        self.special = [t["content"] for t in model["added_tokens"]]
        self.rank: dict[tuple[bytes, bytes], int] = {}
        for i, (a, b) in enumerate(pairs):
            self.rank.setdefault((spell(a), spell(b)), i)
        self.vocabulary = [spell(t) for t in model["model"]["vocab"] if t not in self.special]
        # trie of the tokens that stand for themselves: children by byte, token spelled by the node (or None)
        self.children: list[dict[int, int]] = [{}]
        self.spelled: list[bytes | None] = [None]
        self.made: dict[bytes, tuple[bytes, bytes, int]] = {}  # last merge of a token: its parts and their rank
        for token in sorted(self.vocabulary, key=len):
            if self.learn(token):
                at = 0
                for b in token:
                    if b not in self.children[at]:
                        self.children[at][b] = len(self.children)
                        self.children.append({})
                        self.spelled.append(None)
                    at = self.children[at][b]
                self.spelled[at] = token
        self.rims: dict[tuple[bytes, int], list[tuple[bytes, int]]] = {}
        self.agree: dict[tuple[bytes, bytes], bool] = {}
        start = ((None, 0, 0),)
        self.number = {start: 0}
        self.states = [start]
        self.final = [0]
        self.step: list[dict[int, tuple[int, int]]] = [{}]
        self.words = Words(self.run)

    def learn(self, token: bytes) -> bool:
        """Whether merging the token's bytes gives the token itself; notes its last merge."""
        parts = self.merged(token, last := [])
        if len(parts) > 1:
            return False
        if last:
            self.made[token] = last[0]
        return True

    def merged(self, data: bytes, last: list | None = None) -> list[bytes]:
        """Apply the merges in their order to a short string; ``last`` receives the final one."""
        parts = [data[i:i + 1] for i in range(len(data))]
        rank = self.rank
        while len(parts) > 1:
            best = min((rank.get(p, 1 << 60) for p in zip(parts, parts[1:])))
            if best == 1 << 60:
                break
            if last is not None and len(parts) == 2:
                last.append((*parts, best))
            out, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and rank.get((parts[i], parts[i + 1])) == best:
                    out.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def rim(self, token: bytes, side: int) -> list[tuple[bytes, int]]:
        """The pieces at the right (1) or left (0) rim of a token while it is
        merged, smallest first, each with the rank of the merge that ends it."""
        found = self.rims.get((token, side))
        if found is None:
            found, until = [], 1 << 60
            while token in self.made:
                found.append((token, until))
                until = self.made[token][2]
                token = self.made[token][side]
            found.append((token, until))
            found.reverse()
            self.rims[token if len(found) == 1 else found[-1][0], side] = found
        return found

    def follows(self, before: bytes | None, token: bytes) -> bool:
        """Whether the two tokens stay as they are when they stand side by side.

        They do unless, at some time of the merging, the pieces that meet are
        merged before either is merged into its own token; of two equal merges
        the left one comes first.
        """
        if before is None:
            return True
        found = self.agree.get((before, token))
        if found is None:
            left, right, i, j = self.rim(before, 1), self.rim(token, 0), 0, 0
            while True:
                (u, u_until), (v, v_until) = left[i], right[j]
                rank = self.rank.get((u, v))
                if rank is not None and rank < u_until and rank <= v_until:
                    found = False
                    break
                if i + 1 == len(left) and j + 1 == len(right):
                    found = True
                    break
                if u_until < v_until:
                    i += 1
                else:
                    j += 1
            if len(self.agree) > KEPT_WORDS:
                self.agree.clear()
            self.agree[before, token] = found
        return found

    def advance(self, state: int, byte: int) -> tuple[int, int]:
        """The transition, made on first use: (state, tokens emitted)."""
        alive, ended = [], None
        for before, node, extra in self.states[state]:
            child = self.children[node].get(byte)
            if child is None:
                continue
            token = self.spelled[child]
            if token is not None and ended is None and self.follows(before, token):
                ended = (token, 0, extra + 1)
            if self.children[child]:
                alive.append((before, child, extra))
        # every byte is a token, so one beginning always ends here
        alive.append(ended)
        emitted = min(x[2] for x in alive)
        key = tuple((b, n, e - emitted) for b, n, e in alive)
        to = self.number.get(key)
        if to is None:
            to = self.number[key] = len(self.states)
            self.states.append(key)
            self.final.append(key[-1][2])
            self.step.append({})
        self.step[state][byte] = (to, emitted)
        return to, emitted

    def run(self, data: bytes) -> int:
        """Tokens of one pre-token."""
        state, count, step = 0, 0, self.step
        for b in data:
            move = step[state].get(b)
            if move is None:
                move = self.advance(state, b)
            state = move[0]
            count += move[1]
        return count + self.final[state]

    def forget(self) -> None:
        """Start the lazily made tables anew when they have grown large."""
        if len(self.words) > KEPT_WORDS:
            self.words.clear()
        if len(self.states) > KEPT_STATES:
            del self.states[1:], self.final[1:], self.step[1:]
            self.step[0].clear()
            self.number = {self.states[0]: 0}


class Counter:
    """Token counts of whole texts."""

    def __init__(self, machine: Transducer):
        import re

        self.machine = machine
        self.pretokens, self.narrow = (re.compile(pretoken_pattern(top)).findall for top in (0x10FFFF, 0xFFFF))
        self.special = re.compile("|".join(map(re.escape, machine.special))) if machine.special else None
        self.boundary = re.compile(f"(?<=[^{SPACES}])(?=[{SPACES}])")
        self.space = re.compile(f"[{SPACES}]").match

    def settled(self, text: str) -> int:
        """Tokens of a stretch that begins and ends at certain boundaries; each special string in it is one token."""
        if self.special is not None and self.special.search(text):
            parts = self.special.split(text)
            return sum(self.plain(p) for p in parts if p) + len(parts) - 1
        return self.plain(text)

    def plain(self, text: str) -> int:
        """Tokens of a stretch without special strings."""
        # a class within the basic plane is matched much faster
        within = len(text.encode("utf-16-le")) == 2 * len(text)
        return sum(map(self.machine.words.__getitem__, (self.narrow if within else self.pretokens)(text)))

    def chunk_map(self, text: str) -> tuple[str, int | None, str]:
        """(head, count, tail) of a chunk; (chunk, None, "") if it has no certain boundary."""
        found = self.boundary.search(text)
        if found is None:
            return text, None, ""
        at = last = found.start()
        for i in range(len(text) - 1, at, -1):
            if self.space(text, i) and not self.space(text, i - 1):
                last = i
                break
        return text[:at], self.settled(text[at:last]), text[last:]

    def compose(self, a: tuple, b: tuple) -> tuple:
        """The map of two neighbouring stretches; only where they meet can there be a boundary that neither has."""
        (head, n, tail), (head2, n2, tail2) = a, b
        if n is not None and n2 is not None:
            return head, n + self.settled(tail + head2) + n2, tail2
        open_end = head if n is None else tail
        if self.space(head2) and not self.space(open_end, len(open_end) - 1):
            if n is None:
                return (head, 0, head2) if n2 is None else (head, self.settled(head2) + n2, tail2)
            return head, n + self.settled(tail), head2
        return (head + head2, n2, tail2) if n is None else (head, n, tail + head2)

    def scanned(self, maps: list[tuple]) -> tuple:
        """The map of a stretch from those of its neighbouring parts, pair by pair."""
        while len(maps) > 1:
            maps = [self.compose(*maps[i:i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return maps[0]

    def whole(self, found: tuple) -> int:
        """Tokens of a text from its map: it begins in the first state and ends where it ends."""
        head, n, tail = found
        return self.settled(head) + (0 if n is None else n + self.settled(tail))

    def count(self, text: str) -> int:
        """Tokens of a text."""
        if len(text) <= CHUNK_CHARS:
            return self.settled(text)
        return self.whole(self.scanned([self.chunk_map(text[i:i + CHUNK_CHARS]) for i in range(0, len(text), CHUNK_CHARS)]))


def token_counts(docs: DataFrame, tokenizer_json: str, text_col: str = "text", over: int = OVER_LIMIT) -> DataFrame:
    """``docs`` without ``text_col`` and with ``n_bytes``, ``n_tokens`` and ``over_limit``.

    ``tokenizer_json`` is the text of the vocabulary file.  A NULL or empty
    text has 0 bytes and 0 tokens.  Rows are counted one by one: repeated rows
    get equal results, an empty table an empty result; columns that have the
    name of a result column are replaced.
    """
    from pyspark.sql import types as T

    made = {"n_bytes": T.LongType(), "n_tokens": T.LongType(), "over_limit": T.BooleanType()}
    carried = [c for c in docs.columns if c not in made and c != text_col]
    schema = T.StructType([*[docs.schema[c] for c in carried], *[T.StructField(c, t) for c, t in made.items()]])
    Transducer(tokenizer_json)  # a vocabulary that can't be compiled is refused before any task runs
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(tokenizer_json)

    def of_worker() -> Counter:
        import hashlib

        cache, key = worker_cache(), "tokens-" + hashlib.sha1(shared.value.encode()).hexdigest()
        if key not in cache:
            cache[key] = Counter(Transducer(shared.value))
        return cache[key]

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        counter = of_worker()
        for whole in batches:
            for batch in slices(whole, 8 << 20, text_col):
                text = batch.column(batch.schema.get_field_index(text_col))
                n = [counter.count(t) if t else 0 for t in text.to_pylist()]
                counter.machine.forget()
                columns = [batch.column(batch.schema.get_field_index(c)) for c in carried]
                columns += [pc.cast(pc.fill_null(pc.binary_length(text), 0), pa.int64()), pa.array(n, pa.int64()),
                            pa.array([x > over for x in n], pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, names=[*carried, *made])

    rows = docs.select(*[F.col(f"`{c}`") for c in [*carried, text_col]])
    is_long = F.coalesce(F.length(text_col) > LONG_CHARS, F.lit(False))
    return rows.where(~is_long).mapInArrow(run, schema).unionByName(
        _long_counts(rows.where(is_long), carried, text_col, over, of_worker))


def _long_counts(rows: DataFrame, carried: list[str], text_col: str, over: int, of_worker) -> DataFrame:
    """The counts of long texts, from maps of their chunks that are composed in rounds."""
    spark, text = rows.sparkSession, F.col("__text")
    own = F.struct(*[F.col(f"`{c}`") for c in carried], F.octet_length(f"`{text_col}`").cast("long").alias("n_bytes"))
    n_chunks = F.ceil(F.length(text) / CHUNK_CHARS).cast("int")
    pieces = F.transform(F.sequence(F.lit(0), n_chunks - 1), lambda i: F.substr(text, i * CHUNK_CHARS + 1, F.lit(CHUNK_CHARS)))
    # written once: a chunk row knows its text by the number it had then
    chunks = staged(spark, rows.select(F.monotonically_increasing_id().alias("place"), own.alias("own"), F.col(f"`{text_col}`").alias("__text"))
                    .select("place", "own", F.posexplode(pieces).alias("i", "chunk"))
                    .select("place", "i", "chunk", F.when(F.col("i") == 0, F.col("own")).alias("first")), "chunks")
    state = "place long, i int, head string, n long, tail string"

    def maps(batches):
        import pyarrow as pa

        counter = of_worker()
        for whole in batches:
            for batch in slices(whole, 8 << 20, "chunk"):
                found = [counter.chunk_map(t) for t in batch.column(2).to_pylist()]
                counter.machine.forget()
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, t) for c, t in zip(
                    zip(*found) if found else [[]] * 3, (pa.string(), pa.int64(), pa.string())))],
                    names=["place", "i", "head", "n", "tail"])

    def composed(key, table):
        import pyarrow as pa

        parts = sorted(zip(table.column("i").to_pylist(), table.column("head").to_pylist(), table.column("n").to_pylist(),
                           table.column("tail").to_pylist()))
        head, n, tail = of_worker().scanned([p[1:] for p in parts])
        return pa.table({"place": pa.array([key[0].as_py()], pa.int64()), "i": pa.array([key[1].as_py()], pa.int32()),
                         "head": [head], "n": pa.array([n], pa.int64()), "tail": [tail]})

    spread = chunks.select("place", "i", "chunk").repartition("place", "i")
    found = staged(spark, spread.mapInArrow(maps, state), "chunk-maps")
    while (found.agg(F.max("i")).first()[0] or 0) > 0:
        group = F.floor(F.col("i") / COMPOSED).cast("int").alias("g")
        found = staged(spark, found.groupBy("place", group).applyInArrow(composed, state), "chunk-maps")

    def ends(batches):
        import pyarrow as pa

        counter = of_worker()
        for batch in batches:
            n = [counter.whole(x) for x in zip(*(batch.column(c).to_pylist() for c in (2, 3, 4)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], names=["place", "n_tokens"])

    counts = found.mapInArrow(ends, "place long, n_tokens long")
    return chunks.where("i = 0").join(counts, "place").select(
        *[F.col(f"first.`{c}`") for c in carried], F.col("first.n_bytes").alias("n_bytes"), "n_tokens",
        (F.col("n_tokens") > over).alias("over_limit"))


def tokenizer_text(spark: SparkSession, name_or_path: str) -> str:
    """The vocabulary file: a path, or the name of a public tokenizer."""
    import os

    if not os.path.exists(name_or_path):
        import public_tokenizers

        name_or_path = public_tokenizers.path(name_or_path)
    with open(name_or_path, encoding="utf-8") as f:
        return f.read()
