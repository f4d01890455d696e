"""New words go to the quicker library, with the ids that tokenizers gives to whole texts."""

import json
import random

import numpy as np
import public_tokenizers
import pyarrow as pa

from riskloom.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_ids_equal_tokenizers_on_whole_texts():
    rng = random.Random(8)
    latin = [chr(i) for i in range(256)]
    texts = ["".join(rng.choices(latin, k=rng.randrange(60))) + " " + "".join(rng.choices(latin, k=9)) for _ in range(4000)]
    texts += [f"x{c} a{c}b{d} 1{c}2 .{d}, I{c}ll" for c in latin for d in rng.sample(latin, 12)]
    texts += ["Über größer, naïve façade's \u0151z\u0151 слово 12\u0661 \u2014 end", "a " + "xyz" * 400 + " b", " " + "\xa0 " * 5]
    own = bpe.Codec(PATH)
    found = [bpe.unsigned(ids) for ids in own.encode(pa.array(texts))]
    assert found == [e.ids for e in own.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def test_few_words_are_left_to_tokenizers(monkeypatch):
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz\xe9\xfc", k=8)) for _ in range(5000)]
    own, slow = bpe.Codec(PATH), []
    encode = own._slow
    monkeypatch.setattr(own, "_slow", lambda text: slow.append(text) or encode(text))
    list(own.encode(pa.array(["first " + " ".join(words), "first \u0151z\u0151"])))
    assert slow == [" \u0151z\u0151"]


def test_a_vocabulary_in_another_order_is_left_to_tokenizers(tmp_path):
    with open(PATH, encoding="utf-8") as file:
        whole = json.load(file)
    whole["model"]["merges"] = whole["model"]["merges"][::-1]
    (tmp_path / "other.json").write_text(json.dumps(whole), encoding="utf-8")
    own = bpe.Codec(str(tmp_path / "other.json"))
    text = "some words that are new here"
    assert own.quick is None
    (ids,) = own.encode(pa.array([text]))
    assert np.array_equal(bpe.unsigned(ids), own.tokenizer.encode(text, add_special_tokens=False).ids)
