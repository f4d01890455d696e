"""Extra columns may have the names that stages use inside."""

from riskloom.llm import packing, substrings

RUN = " ".join(f"w{i}" for i in range(25))


def test_substring_stage_carries_columns_called_key_and_found(spark):
    rows = [(1, RUN, 0, 7, "a", "x"), (2, "start " + RUN, 0, 8, "b", "y"), (3, RUN, 0, 9, "c", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, key int, found string, bucket string")
    found = sorted(map(tuple, substrings.rewritten(docs).collect()))
    assert found == [(1, RUN, len(RUN), 7, "a", "x"), (2, "start", 5, 8, "b", "y")]


def test_packing_carries_columns_with_its_own_names(spark):
    schema = "length long, _sequence int, _offset string, _kept int, sequence_id int, pack_group int"
    rows = [(n, n + 1, str(n), n % 2, n + 3, n + 4) for n in (5, 1, 7, 3, 3, 0)]
    found = packing.pack(spark.createDataFrame(rows, schema), "length", 8)
    assert found.columns == [*schema.replace(",", "").split()[::2], "sequence_id_", "offset"]
    assert sorted(tuple(r)[:6] for r in found.collect()) == sorted(rows)
    filled = {}
    for r in sorted(found.collect(), key=lambda r: (r.sequence_id_, r.offset, r.length)):
        assert r.offset == filled.get(r.sequence_id_, 0)
        filled[r.sequence_id_] = r.offset + r.length
    assert max(filled.values()) <= 8 and len(filled) == 3
