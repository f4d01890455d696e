"""Whole texts and hard spacing against tiktoken, through the query and the operator."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken

from riskloom.llm import bpe

SPACES = [" ", "  ", "\n", " \n", "\n ", "\t", " \u00a0", "\u00a0 ", "\u2003", " \u3000", "\x1c", " \x85", "\r\n", "\x0b", "\x0c "]
WORDS = ["a", "Zoo", "it's", "12345", "\u00e4\u00df", "\u65e5\u672c", "\U0001f600", "e\u0301", "--", "<|endoftext|>", "\ufeff", "\x00", "x" * 300]


def reference():
    from tiktoken.load import load_tiktoken_bpe

    ranks = load_tiktoken_bpe(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_any_spacing_and_any_batch():
    rng = random.Random(2)
    texts = ["", " ", "  ", "a ", " a", None, "\n", " \u00a0a"]
    for _ in range(600):
        parts = [rng.choice(WORDS) + (rng.choice(SPACES) if rng.random() < 0.3 else " ") for _ in range(rng.randrange(12))]
        texts.append("".join(parts) if rng.random() < 0.7 else " ".join(part.strip() for part in parts))
    own, expected = bpe.codec(public_tokenizers.path("byte_bpe_50k.json")), reference()
    array = pa.array(texts, pa.string())
    for column in (array, array.slice(3), array.slice(100, 50)):
        found = [np.frombuffer(ids, "<u4").tolist() for ids in own.encode(column)]
        assert found == [expected.encode_ordinary(text or "") for text in column.to_pylist()]


def test_query_equals_tiktoken(spark, folder):
    expected = reference()
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    wanted = {}
    for row in rows:
        text = row.text or ""
        ids = expected.encode_ordinary(text)
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        wanted[row.doc_id] = (len(ids), digest, hashlib.sha256(text.encode()).hexdigest())
    found = bpe.query(spark, folder).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found} == wanted
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.digests(empty, "doc_id", "text", public_tokenizers.path("byte_bpe_50k.json")).count() == 0
