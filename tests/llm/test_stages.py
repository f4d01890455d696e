"""Near-copy and substring stages of the pipeline against brute force on the whole small table."""

from collections import Counter

import corpus_pipeline
from tests.llm.test_operators import shingles


def test_text_stages_equal_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    sets = {i: shingles(t, 5) for i, t in texts.items()}
    owner = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]]
    links = [(a, b) for a, b in links if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in sets:
        for a, b in links:
            owner[a] = owner[b] = min(owner[a], owner[b])
    left = corpus_pipeline.drop_near_copies(spark, docs, folder)
    kept = {i: t for i, t in texts.items() if owner[i] == i}
    assert links and Counter((r.doc_id, r.text) for r in left.collect()) == Counter(kept.items())

    seen, wanted = set(), {}
    for i in sorted(kept):
        found, gone = (kept[i] or "").encode().split(), set()
        for at in range(len(found) - 19):
            run = tuple(found[at : at + 20])
            if run in seen:
                gone.update(range(at, at + 20))
            seen.add(run)
        rest = b" ".join(w for n, w in enumerate(found) if n not in gone).decode()
        if rest or not gone:
            wanted[i] = rest if gone else kept[i]
    cut = corpus_pipeline.cut_repeats(spark, spark.createDataFrame(left.collect(), left.schema), folder).collect()
    assert {r.doc_id: r.text for r in cut} == {i: t for i, t in wanted.items() if t is not None}
    assert all(r.n_chars == len(r.text) for r in cut)
