from __future__ import annotations

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import rivulet.llm.tokens as K
from tests.llm.conftest import DOCS

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def machine():
    with open(FILE, encoding="utf-8") as f:
        return K.Transducer(f.read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


@pytest.mark.parametrize("chunk", [7, 1 << 16])
def test_random_texts(machine, library, chunk, monkeypatch):
    monkeypatch.setattr(K, "CHUNK_CHARS", chunk)
    rng = random.Random(chunk)
    parts = ["'s", "t", "re", "'ll", " ", "  ", "\n", "\t", "a", " the", "ing", "1", "22", "é", "漢字", "😀", "!", "...", "aaaa",
             "<|endoftext|>", "x", "ñ", "\r\n", "\x0b", "==", "\x1c", "\x85", "​", "̀", "²", "\xa0", "　"]
    counter = K.Counter(machine)
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)


def test_any_two_tokens(machine, library):
    rng = random.Random(1)
    counter = K.Counter(machine)
    for _ in range(5000):
        data = b"".join(rng.choice(machine.vocabulary) for _ in range(rng.randint(1, 5)))
        text = data.decode(errors="ignore")
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)


def test_chunk_maps_compose_in_any_order(machine):
    counter = K.Counter(machine)
    text = " ".join(t for _, t, *_ in DOCS if t and len(t) < 500)
    want = counter.settled(text)
    maps = [counter.chunk_map(text[i:i + 9]) for i in range(0, len(text), 9)]
    left = maps[0]
    for m in maps[1:]:
        left = counter.compose(left, m)
    right = maps[-1]
    for m in reversed(maps[:-1]):
        right = counter.compose(m, right)
    for head, n, tail in (left, right):
        assert counter.settled(head) + (n or 0) + counter.settled(tail) == want


def test_tables_that_start_anew_count_the_same(machine, monkeypatch):
    counter = K.Counter(machine)
    texts = [t for _, t, *_ in DOCS if t]
    want = [counter.count(t) for t in texts]
    monkeypatch.setattr(K, "KEPT_WORDS", 1)
    monkeypatch.setattr(K, "KEPT_STATES", 1)
    machine.forget()
    assert [counter.count(t) for t in texts] == want


def test_token_counts(spark, docs, clashing, empty, library):
    text = K.tokenizer_text(spark, "byte_bpe_50k.json")
    want = sorted((str(i), len((t or "").encode()), n, n > 512) for i, t, *_ in DOCS
                  for n in [len(library.encode(t or "", add_special_tokens=False).ids)])
    for frame in (docs, clashing):
        got = K.token_counts(frame, text).select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()
        assert sorted((str(r[0]), *r[1:]) for r in got) == want
    assert K.token_counts(empty, text).count() == 0


def test_whole_table(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r.n_tokens for r in K.token_counts(docs, K.tokenizer_text(spark, FILE)).collect()}
    rows = docs.collect()
    assert got == {r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) for r in rows}


def test_long_texts_are_counted_in_rows(spark, library, monkeypatch):
    """Texts cut into (document, chunk) rows, composed in several rounds, give what the library gives for the whole."""
    monkeypatch.setattr(K, "CHUNK_CHARS", 11)
    monkeypatch.setattr(K, "LONG_CHARS", 30)
    monkeypatch.setattr(K, "COMPOSED", 3)
    rng = random.Random(8)
    parts = ["'s", " the", "ing", "12", "é", "漢字", "😀", "...", "<|endoftext|>", "\n", "  ", "x" * 40, " a b", "\u00a0"]
    rows = [(i % 7, "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))) for i in range(120)]
    rows += [(None, None), (None, "y" * 500), (3, " " * 100), (3, " " * 100), (9, "<|endoftext|>" * 20)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'mine' AS place", "'mine' AS i", "'mine' AS first")
    with open(FILE, encoding="utf-8") as f:
        got = sorted((tuple(r) for r in K.token_counts(df, f.read()).collect()), key=repr)
    want = []
    for d, t in rows:
        n = len(library.encode(t, add_special_tokens=False).ids) if t else 0
        want.append((d, "mine", "mine", "mine", len((t or "").encode()), n, n > 512))
    assert got == sorted(want, key=repr)


def test_other_kinds_of_vocabularies_are_refused(spark):
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        other = f.read()
    with pytest.raises(ValueError, match="byte-level"):
        K.token_counts(spark.createDataFrame([(1, "a")], "doc_id long, text string"), other)
