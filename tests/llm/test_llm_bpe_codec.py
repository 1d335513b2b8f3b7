"""Encoding and decoding against the library of the tokenizer file."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sparkretail.llm import bpe_codec, queries, token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def tables():
    return bpe_codec.load(PATH)


@pytest.fixture(scope="module")
def encoder(tables):
    return bpe_codec.Encoder(tables)


def differences(encoder, texts):
    expected = LIBRARY.encode_batch(texts, add_special_tokens=False)
    return [t for t, e in zip(texts, expected) if np.frombuffer(encoder.text(t), "<u4").tolist() != e.ids]


def test_random_texts(encoder):
    r = random.Random(5)
    mixed = [chr(c) for c in (*range(32, 127), *range(32, 127), *range(0xA0, 0x250), 10, 9, 13, 0x1C, 0x85, 0x2009, 0x3000)]
    texts = ["", "  ", "<|endoftext|>", "a<|endoftext|>b<|startoftext|>", "<|endoftext|", "x" * 5000, "日本語" * 100]
    texts += ["aaaaa aaaa", "'s's'll''", "ΑΣ ΟΔΟΣ.", "İstanbul ẞ", "word " * 30_000, "abcdefgh" * 100_000]
    texts += ["".join(r.choice(mixed) for _ in range(r.randrange(40))) for _ in range(3000)]
    texts += ["".join(r.choice("abcdeinth") for _ in range(r.randrange(1, 25))) for _ in range(5000)]
    assert differences(encoder, texts) == []


def test_every_code_point_and_every_token(encoder, tables):
    """Also what Unicode versions class differently: letters, numbers, marks, lower case."""
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x1F000 or c % 53 == 0)]
    assert differences(encoder, [f"a{c}b {c}1{c}!{c}̴́" for c in points]) == []
    byte_of = {c: i for i, c in enumerate(bpe_codec.byte_alphabet())}
    spelled = (bytes(byte_of[c] for c in t.removesuffix("</w>")) for t in tables["vocab"] if t[0] != "<")
    texts = [t.decode() for t in spelled if t.decode(errors="replace").isprintable() and "�" not in t.decode(errors="replace")]
    assert len(texts) > 40_000 and differences(encoder, texts) == []
    counter = token_counts.Counter(token_counts.load(PATH))
    chosen = points[:: 7]
    expected = [len(e.ids) for e in LIBRARY.encode_batch([f"a{c}b" for c in chosen], add_special_tokens=False)]
    assert counter.counts([f"a{c}b" for c in chosen]) == expected


def test_pairs_are_judged_as_merging_does(encoder, tables):
    """Two tokens are compatible if and only if merging their letters gives them back."""
    rank = {(a, b): (i, made) for i, (a, b, made) in enumerate(tables["merges"])}

    def letters(token):
        return [token] if encoder.made[token] < 0 else letters(encoder.left[token]) + letters(encoder.right[token])

    def merged(row):
        while True:
            found = [(rank[p], i) for i, p in enumerate(zip(row, row[1:])) if p in rank]
            if not found:
                return row
            (_, made), i = min(found)
            row = [*row[:i], made, *row[i + 2 :]]

    r, inner = random.Random(3), [m for _, _, m in tables["merges"] if not tables["names"][m].endswith("</w>")]
    for _ in range(4000):
        a, b = r.choice(inner[:2000]), r.choice(tables["merges"][:4000])[2]
        assert encoder.compatible(a, b) == (merged(letters(a) + letters(b)) == [a, b])


def test_documents_round_trip(spark):
    rows = [(1, "Hello <|endoftext|>  World's\n42, é"), (1, "Hello"), (None, "null id"), (4, None), (5, ""), (6, "ab" * 200_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("x")).withColumn("value", F.lit(1))
    encoded = bpe_codec.encode_texts(docs, PATH)
    got = sorted((r.doc_id or 0, np.frombuffer(r.ids, "<u4").tolist()) for r in encoded.collect())
    expected = sorted((i or 0, LIBRARY.encode(t or "", add_special_tokens=False).ids) for i, t in rows)
    assert got == expected
    texts = sorted((r.doc_id or 0, r.decoded) for r in bpe_codec.decode_ids(encoded, PATH).collect())
    assert texts == sorted((i, LIBRARY.decode(ids, skip_special_tokens=False)) for i, ids in expected)
    odd = spark.createDataFrame([(1, None), (2, b""), (3, np.array([320, 10**6, 321], "<u4").tobytes())], "doc_id long, ids binary")
    assert [r.decoded for r in bpe_codec.decode_ids(odd, PATH).orderBy("doc_id").collect()] == ["", "", "a</w> b</w>"]
    assert bpe_codec.decode_ids(bpe_codec.encode_texts(docs.limit(0), PATH), PATH).count() == 0


def test_query_equals_the_library(spark, sf):
    got = {r.doc_id: r for r in queries.op13_bpe(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = LIBRARY.encode(d.text or "", add_special_tokens=False).ids
        row, text = got[d.doc_id], LIBRARY.decode(ids, skip_special_tokens=False)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
