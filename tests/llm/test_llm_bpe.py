"""Byte-level BPE: against the tiktoken library, whole tables and words made to be hard."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from llm_fixtures import SF001, no_docs, odd_docs, same_rows
from pyspark.sql import functions as F

from riskweave.llm import byte_bpe, queries

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = byte_bpe.load_ranks(RANKS).rank
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def expected(library, texts):
    rows = []
    for text in texts:
        ids = library.encode_ordinary(text or "")
        sha = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        rows.append((len(ids), sha, hashlib.sha256((text or "").encode()).hexdigest()))
    return rows


def test_query_is_the_library(spark, library):
    found = queries.op13_byte_bpe(spark, SF001).toPandas().set_index("doc_id").sort_index()
    docs = spark.read.parquet(f"{SF001}/documents.parquet").toPandas().set_index("doc_id").sort_index()
    assert list(found.itertuples(index=False, name=None)) == expected(library, docs["text"])


def test_odd_rows(spark, library):
    docs = odd_docs(spark)
    encoded = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    found = byte_bpe.decode(encoded, RANKS).toPandas()
    found["decoded"] = [hashlib.sha256(d).hexdigest() for d in found["decoded"]]
    wanted = docs.select("doc_id", "text").toPandas()
    wanted[["n_tokens", "ids_sha256", "decoded"]] = expected(library, wanted["text"])
    same_rows(found, wanted.drop(columns="text"))
    assert byte_bpe.decode(byte_bpe.encode(no_docs(spark), RANKS, public_tokenizers.PATTERN), RANKS).count() == 0


def test_ids_and_cut_ids(spark, library):
    docs = spark.createDataFrame([("a", "naïve Straße 東京")], "doc_id string, text string")
    row = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN).collect()[0]
    assert np.frombuffer(row["ids"], "<u4").tolist() == library.encode_ordinary("naïve Straße 東京")
    cut = spark.createDataFrame([(bytes(row["ids"][:-4]),), (None,)], "ids binary")
    whole = "naïve Straße 東京".encode()
    back = [bytes(r["decoded"]) for r in byte_bpe.decode(cut, RANKS).collect()]
    assert whole.startswith(back[0]) and back[0] != whole and back[1] == b""


def test_replay_of_hard_words(library):
    ranks = byte_bpe.load_ranks(RANKS)
    draw = random.Random(3)
    tokens = list(ranks.rank)
    words = [b"".join(draw.choices(tokens, k=draw.randint(1, 6))) for _ in range(4000)]
    words += ["".join(draw.choices("aab esti", k=draw.randint(1, 40))).encode() for _ in range(4000)]
    words += [b"a" * k for k in range(1, 200)] + ["é".encode() * 500, b"ab" * 50_000, bytes(range(256))]
    ids, lengths = byte_bpe.replay(ranks, words)
    cut = np.split(ids, np.cumsum(lengths)[:-1])
    for word, got in zip(words, cut):
        assert got.tolist() == library._core_bpe.encode_single_piece(word) or word in ranks.rank
        if len(word) < 2000:
            assert got.tolist() == byte_bpe.one_by_one(ranks, word)


def test_ranks_that_ask_for_a_lower_merge_later(tmp_path):
    """After ``ab`` (rank 261) the pair ``ab c`` has the lower rank 257, before the other ``ab`` of the word."""
    import base64

    tokens = [bytes([b]) for b in range(256)] + [b"zz", b"abc", b"bca", b"cab", b"abcab", b"ab", b"ca"]
    path = tmp_path / "ranks"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(tokens)))
    ranks = byte_bpe.Ranks(str(path))
    draw = random.Random(5)
    words = ["".join(draw.choices("abcz", k=draw.randint(1, 14))).encode() for _ in range(3000)]
    ids, lengths = byte_bpe.replay(ranks, words)
    for word, got in zip(words, np.split(ids, np.cumsum(lengths)[:-1])):
        assert got.tolist() == byte_bpe.one_by_one(ranks, word) == greedy(ranks.rank, word)


def greedy(rank, word):
    parts = [bytes([b]) for b in word]
    while True:
        options = [(rank[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in rank]
        if not options:
            return [rank[p] for p in parts]
        _, i = min(options)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_blocks_and_steps_do_not_change_ids(spark, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "STEP", 7)
    monkeypatch.setattr(byte_bpe, "KEEP_WORDS", 5)
    ranks = byte_bpe.load_ranks(RANKS)
    words = byte_bpe.Words(ranks, public_tokenizers.PATTERN)
    for text in ["one two three four five six seven eight nine ten", "", "a\n\n b  c's", "one two"]:
        numbers = words.numbers(text)
        words.merge_new()
        ids = byte_bpe.gather(words.ids, words.starts[numbers], words.lengths[numbers])
        assert ids.tolist() == library.encode_ordinary(text)
        assert byte_bpe.digest_of(ranks, ids) == expected(library, [text])[0][1]
        if len(words.number) > byte_bpe.KEEP_WORDS:
            words.clear()


def test_many_documents_in_small_blocks(spark, library):
    texts = [f"word{i % 97} été {i}" for i in range(500)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    found = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN).orderBy("doc_id").select("n_tokens", "ids_sha256", F.sha2(F.lit(""), 256)).collect()
    assert [tuple(r)[:2] for r in found] == [e[:2] for e in expected(library, texts)]
