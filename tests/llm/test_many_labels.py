"""Every label that occurs is learned."""

from riskloom.llm import language


def test_more_than_64_labels_are_learned(spark):
    letters = "abcdefghij"
    words = [f"{letters[i // 10]}{letters[i % 10]}{letters[(i * 3) % 10]}" for i in range(70)]
    rows = [(4 * i + n, f"{word} " * (10 + n), f"x{i:02}") for i, word in enumerate(words) for n in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r.doc_id: r for r in language.predicted(docs).collect()}
    learned = {r[2] for r in rows if not found[r[0]].held_out}
    assert len(learned) > 64
    assert all(found[i].lang_pred == lang for i, _, lang in rows if lang in learned)
