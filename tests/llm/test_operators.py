"""Edge cases of every operator against brute force: nulls, empty, ties, repeats, clashing names."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from riskloom.llm import bpe, chat, jaccard, language, packing, permutation, quality, sharding, substrings, voronoi
from riskloom.llm.queries import ORACLES, QUERIES
from tests.oracle import compare, connect

BASE = "the quick brown fox jumps over a lazy dog while seven wizards mix potions for nine brave knights near old castle walls"
TEXTS = [
    (1, BASE + " alpha beta"),
    (2, BASE + " alpha beta"),
    (3, "Start " + BASE + " omega"),
    (4, None),
    (5, ""),
    (6, " \n\t "),
    (7, "one"),
    (8, "ONE"),
    (9, "word " * 60),
    (10, " ".join(f"w{i}" for i in range(3000))),
    (11, " ".join(f"w{i}" for i in range(2990))),
    (2, BASE + " alpha beta"),
    (None, "no id here"),
]


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(i, t, "en", "src", None, 5) for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, slot int")


def empty(documents):
    return documents.where("false")


def test_permutation_of_every_size_is_complete(spark):
    for n in (0, 1, 2, 3, 7, 101, 1000):
        rows = spark.range(n).withColumn("n", F.lit(n).cast("long"))
        assert sorted(r.at for r in sharding.place(rows, "id", "n", 3, "at").collect()) == list(range(n))


def test_shards_are_even_gapless_and_keep_all_rows(documents):
    rows = sharding.assign(documents, 4, seed=1).collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter(TEXTS)
    sizes = Counter(r.shard for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for shard, size in sizes.items():
        assert sorted(r["slot_"] for r in rows if r.shard == shard) == list(range(size))
    assert sharding.assign(empty(documents), 4).count() == 0


def vectors(spark, rows):
    return spark.createDataFrame(rows, "id long, vector array<double>")


def test_vector_searches_on_small_sets(spark):
    random = np.random.default_rng(0)
    data = [(i, [float(x) for x in random.integers(-9, 10, 6)]) for i in range(60)]
    data += [(100 + i, data[0][1]) for i in range(30)] + [data[3]]
    rows = vectors(spark, data).distinct()
    whole = vectors(spark, [(i, v) for i, v in data]).selectExpr("id", "transform(vector, x -> cast(x as bigint)) AS vector")
    unique = {i: np.array(v) for i, v in data}
    asked = [0, 3, 20, 100]
    found = permutation.search(rows, rows.where(F.col("id").isin(asked)), 5).collect()
    exact = voronoi.search(whole, whole.where(F.col("id").isin(asked)), 5).collect()
    for q in asked:
        inner = sorted((-(unique[q] @ v), i) for i, v in unique.items() if i != q)[:5]
        assert [(r.vec_id, r.score) for r in sorted(exact, key=lambda r: r["rank"]) if r.query_id == q] == [
            (i, -s) for s, i in inner
        ]
        norm = np.linalg.norm
        cosine = sorted((-round(unique[q] @ v / norm(unique[q]) / norm(v), 12), i) for i, v in unique.items() if i != q)
        assert [r.vec_id for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == q] == [i for _, i in cosine[:5]]
    none = rows.where("false")
    assert permutation.search(none, none, 5).count() == 0
    assert voronoi.search(whole.where("false"), whole.where("false"), 5).count() == 0


def test_language_rejects_what_has_no_letters(spark, folder):
    train = [(i, "the cat and the dog are here " * 3, "en") for i in range(20)]
    train += [(20 + i, "der hund und die katze sind nicht hier " * 3, "de") for i in range(20)]
    train += [(40 + i, t, None) for i, t in enumerate([None, "", "12 !?", "the dog", "der hund", "é"])]
    rows = spark.createDataFrame(train, "doc_id long, text string, lang string")
    found = {r.doc_id: r for r in language.predicted(rows).collect()}
    assert [found[40 + i].lang_pred for i in range(5)] == ["und", "und", "und", "en", "de"]
    assert found[45].lang_pred != "und" and all(0 <= r.score <= 1 for r in found.values())
    assert language.predicted(rows.where("false")).count() == 0


def test_texts_in_no_learned_language_go(spark, folder):
    own = spark.read.parquet(folder.replace("sf0.001", "sf0.01") + "/documents.parquet").select("doc_id", "text", "lang")
    odd = [
        "tämä lause on kirjoitettu suomeksi eikä sitä ole opittu kukaan " * 4,
        "Это предложение написано на русском языке и его никто не учил. " * 4,
        "zxqj kvw qxz jjq wvk xzq " * 10,
        "a 1 2 3 !!",
        "12 34 56",
        None,
    ]
    rows = own.unionByName(spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate(odd)], own.schema))
    kept = {r.doc_id for r in language.recognised(rows).collect()}
    assert not [i for i in kept if i < 0]
    assert len(kept) >= 0.985 * own.count()


def test_a_letter_is_enough_if_no_language_could_be_learned(spark):
    texts = ["the dog", "12 34", None, "", "Это", "a 1 2 3 !!"]
    for lang in (None, "en"):
        rows = spark.createDataFrame([(i, t, lang) for i, t in enumerate(texts)], "doc_id long, text string, lang string")
        assert sorted(r.doc_id for r in language.recognised(rows).collect()) == [0, 4, 5]


def test_language_and_quality_on_held_out_documents(spark, folder):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = [r for r in language.query(spark, folder).collect() if r.held_out and truth[r.doc_id]]
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in rows]) > 0.9
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in quality.query(spark, folder).collect() if r.held_out and r.doc_id in labels]
    assert np.mean([labels[r.doc_id] == r.predicted for r in rows]) > 0.8


def test_quality_without_labels_is_undecided(spark, documents):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.judged(documents, labels).collect()} == {0.5}


def shingles(text, size=3):
    found = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + size]) for i in range(max(len(found) - size + 1, 1)))


def test_components_equal_brute_force(documents):
    texts = {i: t for i, t in TEXTS if i is not None}
    sets = {i: shingles(t) for i, t in texts.items()}
    owner = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                common = len(sets[a] & sets[b])
                if sets[a] and sets[b] and 100 * common >= 90 * len(sets[a] | sets[b]):
                    owner[a] = owner[b] = min(owner[a], owner[b])
    rows = jaccard.components(documents).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), owner[r.doc_id])
    assert jaccard.components(empty(documents)).count() == 0


def test_the_boundary_weighs_subsets_against_scans():
    sizes = [(n, 10) for n in range(10, 400, 10)]
    assert jaccard.boundary(sizes, 0.0, 90) <= jaccard.boundary(sizes, 50.0, 90)


def test_tokens_equal_tiktoken_and_decode(spark):
    import base64

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    exact = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["", None, "a  b\n\n c", "I'll don't 'S", "<|endoftext|>", "漢字😀 é\u0085x", "x" * 5000, "\x1c \x1f a ", "1½ ²"]
    rows = spark.createDataFrame(list(enumerate(texts)), "ids long, text string")
    coded = bpe.encode(rows, "text", public_tokenizers.path("byte_bpe_50k.json"), offsets=True)
    back = bpe.decode(coded, "ids_", public_tokenizers.path("byte_bpe_50k.json"))
    for r in back.collect():
        text = texts[r.ids] or ""
        assert r["ids_"] == exact.encode_ordinary(text) and bytes(r.decoded).decode() == text
        assert len(r.offsets) == len(r["ids_"]) and (not r.offsets or r.offsets[-1].end == len(text))


def test_packing_keeps_every_piece_and_meets_its_bound(documents):
    rows = packing.packed_documents(documents).collect()
    filled = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled.get(r.sequence_id, 0)
        filled[r.sequence_id] = r.offset + r.length
    assert max(filled.values()) <= 2048 and {r.doc_id for r in rows} == {i for i, _ in TEXTS}
    assert len(filled) == packing.lower_bound(np.array([r.length for r in rows]), 2048)
    assert [(r.start, r.length) for r in sorted(rows, key=lambda r: r.piece) if r.doc_id == 10][-1][1] == 2048
    assert packing.packed_documents(empty(documents)).count() == 0


def test_chats_with_hostile_text_come_back(spark):
    odd = ["", "</s>", "<\\s>", "<<SYS>>", "<\\<SYS>>", "[/ROLE]", "a<", "<\\", None, "é\n😀", "$1\\"]
    rows = [(i % 2, i, odd[i * 3 % len(odd)] if i % 4 else "assistant", t) for i, t in enumerate(odd * 2)]
    chats = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    for r in chats.withColumn("loss", chat.masked(F.col("formatted"), F.col("mask"))).collect():
        own = [(x[2] or "", x[3] or "") for x in rows if x[0] == r.conv_id]
        assert [(t.role, t.text) for t in r.turns] == own
        assert r.loss == "".join(text for role, text in own if role == "assistant")


def test_repeats_equal_brute_force(documents):
    texts = {i: (t or "").encode().split() for i, t in TEXTS if i is not None}
    first, kept = {}, {}
    for i in sorted(texts):
        for at in range(len(texts[i]) - 19):
            first.setdefault(tuple(texts[i][at : at + 20]), (i, at))
    for i, found in texts.items():
        gone = set()
        for at in range(len(found) - 19):
            if first[tuple(found[at : at + 20])] != (i, at):
                gone.update(range(at, at + 20))
        kept[i] = (len(found), len(gone), b" ".join(w for n, w in enumerate(found) if n not in gone).decode())
    rows = substrings.deduplicated(documents).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        if r.doc_id is not None:
            assert (r.n_words, r.n_removed, r.kept) == kept[r.doc_id]
    assert substrings.deduplicated(empty(documents)).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, folder, name):
    assert compare(spark, connect(folder), QUERIES[name], ORACLES[name], folder) is None


def test_sharding_query_digests(spark, folder):
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in sharding.query(spark, folder).collect():
        assert (r.size, r.text_crc32) == (len(texts[r.doc_id]) + 8, zlib.crc32(texts[r.doc_id]))


def test_pipeline_keeps_clean_documents(spark, folder):
    import corpus_pipeline

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = {r.doc_id for r in corpus_pipeline.run(spark, folder).collect()}
    assert found < {r.doc_id for r in docs.collect()} and len(found) > 0.5 * docs.count()


def test_one_row_of_each_group_of_near_copies_stays(spark):
    import corpus_pipeline

    copy, near = BASE + " alpha beta", BASE + " alpha beta gamma"
    other, lone = " ".join(f"w{i}" for i in range(40)), " ".join(f"v{i}" for i in range(40))
    cases = [
        ([(1, copy), (1, copy), (1, copy), (2, other)], [(1, copy), (2, other)]),
        ([(None, copy), (3, near), (4, copy), (5, other)], [(None, copy), (5, other)]),
        ([(None, copy), (None, copy), (None, near), (None, other)], 2),
        ([(7, other), (7, near), (3, copy), (8, lone)], [(3, copy), (7, other), (8, lone)]),
        ([(7, None), (7, None), (None, ""), (8, "")], [(7, None), (7, None), (None, ""), (8, "")]),
        ([(2, near), (1, copy), (3, other)], [(1, copy), (3, other)]),
    ]
    for rows, kept in cases:
        docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, row int").repartition(3)
        found = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()]
        if kept == 2:
            assert len(found) == 2 and (None, other) in found
        else:
            assert Counter(found) == Counter(kept)


def test_kept_digest_is_that_of_the_text(documents):
    plain = {r.doc_id: r.kept for r in substrings.deduplicated(documents).collect()}
    for r in substrings.deduplicated(documents, digest=True).collect():
        assert r.kept_sha256 == hashlib.sha256(plain[r.doc_id].encode()).hexdigest()
