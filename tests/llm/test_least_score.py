"""The least score of a recognised document comes from all held-out documents, however many a label has."""

import numpy as np
from pyspark.sql import functions as F

from riskloom.llm import language
from riskloom.llm.common import fold


def test_least_score_is_the_exact_rank_among_all_held_out_documents(spark, monkeypatch):
    monkeypatch.setattr(language, "PER_LANGUAGE", 8)
    monkeypatch.setattr(language, "REJECTED", 0.1)
    english, german = "the cat and dog are here now ".split(), "der hund und die katze sind nicht ".split()
    random = np.random.default_rng(4)
    rows = []
    for i in range(600):
        own, other = (english, german) if i % 2 else (german, english)
        text = " ".join(random.choice(other if random.random() < 0.3 else own) for _ in range(12))
        rows.append((i, text, "en" if i % 2 else "de"))
    rows += [(600, "12 !", "en"), (601, None, "de"), (602, "the dog", None)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    documents = documents.withColumn("held_out", fold("doc_id", 4) == 2)
    model = language.fit(documents)
    held = documents.where("held_out AND lang IS NOT NULL AND text IS NOT NULL")
    known = language.identify(held, model).where(F.col("lang_pred") != "und").collect()
    scores = sorted(row.score for row in known)
    assert len(scores) > 100
    assert language.least_score(documents, model) == scores[int(0.1 * len(scores))]
