"""Periodic runs against brute force: extensions, runs, collapsed texts, and the whole query."""

import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from riskloom.llm import periods
from riskloom.llm.recompression import Grammar

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words):
    """All runs by walking every period over the whole text."""
    n, found = len(words), {}
    for period in range(1, n // 4 + 1):
        start = None
        for i in range(n - period + 1):
            same = i + period < n and words[i] == words[i + period]
            if same and start is None:
                start = i
            elif not same and start is not None:
                length = i - start + period
                if length >= max(6, 4 * period):
                    found.setdefault((start, length), period)
                start = None
    return sorted((start, length, period) for (start, length), period in found.items())


def brute_row(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = " ".join(word for i, word in enumerate(words) if i not in dropped)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    milli = 1000 * best[1] // best[2] if runs else None
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *best, milli, digest(lines), digest(kept))


@pytest.mark.parametrize("letters", [1, 2, 3, 50])
def test_extensions_equal_direct_comparison(letters):
    rng = np.random.default_rng(letters)
    body = rng.integers(0, letters, 300)
    body[100:200] = np.resize(body[100:107], 100)
    sequence = np.concatenate([[letters], body, [letters + 1]])
    i, j = rng.integers(1, 301, (2, 4000))
    i, j = i[i != j], j[i != j]
    grammar = Grammar(sequence)

    def direct(a, b, step):
        n = 0
        while sequence[a] == sequence[b]:
            a, b, n = a + step, b + step, n + 1
        return n

    assert grammar.extension(i, j).tolist() == [direct(a, b, 1) for a, b in zip(i, j)]
    assert grammar.extension(i, j, back=True).tolist() == [direct(a, b, -1) for a, b in zip(i, j)]


def test_runs_of_many_small_documents():
    rng = np.random.default_rng(7)
    rows = []
    for number in range(400):
        words = rng.integers(0, 1 + number % 4, rng.integers(0, 60)).tolist()
        if number % 3 == 0:
            words = words[:10] + words[: 1 + number % 9] * (number % 7) + words[10:]
        rows.append(words)
    bounds = np.concatenate([[0], np.cumsum([len(words) for words in rows])])
    flat = np.array([word for words in rows for word in words], np.uint64)
    document, start, length, period = periods.runs_of(flat, bounds)
    found = [[] for _ in rows]
    for row, *run in zip(document.tolist(), start.tolist(), length.tolist(), period.tolist()):
        found[row].append(tuple(run))
    assert found == [brute_runs(words) for words in rows]


def test_query_equals_brute_force(spark, folder):
    found = periods.query(spark, folder).collect()
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, found)) == sorted(brute_row(r.doc_id, r.text) for r in rows)


def test_edge_cases(spark, tmp_path):
    ten = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    texts = [None, "", " \t\n", "a", "a a a a a", "a a a a a a", "x " + "b c " * 4 + "y", "ä ß " * 900, "z" * 70_000]
    rows = [(i + 2000, text) for i, text in enumerate(texts)] + [(2006, texts[6]), (None, "a " * 40), (None, None)]
    rows += [(i, text) for i in ten for text in ("p q r s t u v w x y", None, "solo")]
    schema = "doc_id long, text string, runs string, collapsed int"
    wide = spark.createDataFrame([(*row, "own", 1) for row in rows], schema)
    wide.write.parquet(str(tmp_path / "documents.parquet"))
    key = lambda row: (row[0] is None, row[0] or 0, row[1:2], row[-1])
    found = sorted(map(tuple, periods.query(spark, str(tmp_path)).collect()), key=key)
    assert found == sorted((brute_row(*row) for row in rows), key=key)
    assert periods.periodic_runs(wide.where("false")).count() == 0
