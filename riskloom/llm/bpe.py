"""Byte-level BPE: whole texts to token ids and back, in Arrow batches.

Ids are those of the tokenizers library. A text is cut at every space that stands before a
character other than white space; such a space always begins a piece of the split pattern, so
the parts can be encoded apart and their ids joined. Arrow splits and numbers the words of a batch,
so each different one is encoded once and the ids of the texts are gathered from a table. Words of Latin-1 characters after a
space are encoded as one text by tiktoken, which gives the same ids in less time if the
vocabulary is in the order of its merges (checked when it is loaded); all others go to tokenizers, whose Unicode tables may be
of another version. Texts with spaces that are no cut are split one by one. Each worker keeps the ids of the other words seen lately (at
most about ``CACHE_BYTES``) and gives only new ones to the library, all of a batch at once. The library turns bytes into printable characters;
``byte_table`` reverses that, which gives the bytes of every id. Decoding joins those bytes, so
a character that is split over several tokens comes back whole, and the character offsets of
tokens follow from the bytes that begin a character.

Edge cases. A null text counts as empty and gives no tokens. Special tokens in a text are
ordinary text. Repeated rows and equal ids are encoded independently. Texts of any length are
encoded whole. Other columns are carried through; a clashing name gets underscores.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType
from tokenizers import Tokenizer

from riskloom.llm.common import free_name, table

CACHE_BYTES = 96 << 20
LONGEST = 200  # bytes of a word for tiktoken
GROUP = 512  # texts whose words are numbered together
_CUT = re.compile(r" (?=\S)")
# A space that is no cut: the last character, or before white space. \s of the Arrow library is ASCII only.
_UNEVEN = (
    r" $| [\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
_loaded: dict[str, "Codec"] = {}


def byte_table() -> dict[str, int]:
    """Printable character of each byte: itself if printable, else the next one from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """A vocabulary in one worker process."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocabulary = model["vocab"]
        table = byte_table()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.bytes_of = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            if all(c in table for c in token):
                self.bytes_of[number] = bytes(table[c] for c in token)
        self.sizes = np.array([len(piece) for piece in self.bytes_of], np.int64)
        # With ids in the order of merges both libraries merge alike, and tiktoken does it in less time.
        merges = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
        made = [vocabulary[a + b] for a, b in merges]
        self.quick = None
        if made == sorted(set(made)) and set(vocabulary) == {a + b for a, b in merges} | set(table):
            ranks = dict(zip(self.bytes_of, range(len(self.bytes_of))))
            self.quick = tiktoken.Encoding(
                "quick", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
            ).encode_ordinary
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0

    def _learn(self, parts: set[str]) -> None:
        if self.held > CACHE_BYTES // 2:
            self.old, self.known, self.held = self.known, {}, 0
        new = []
        for part in parts.difference(self.known):
            ids = self.old.get(part)
            if ids is None:
                new.append(part)
            else:
                self._keep(part, ids)
        # Words that begin with a space are encoded as one text, which the library does with less
        # overhead, and its tokens are dealt back by their bytes.
        spaced = [part for part in new if part[0:1] == " "]
        for start in range(0, len(spaced), 20_000):
            some = spaced[start : start + 20_000]
            text = "".join(some)
            ids = np.array(self._slow(text), "<u4")
            sizes = [len(part) for part in some] if text.isascii() else [len(part.encode()) for part in some]
            bounds = np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum(sizes)) + 1
            flat, first = ids.tobytes(), 0
            for part, end in zip(some, (bounds * 4).tolist()):
                self._keep(part, flat[first:end])
                first = end
        rest = [part for part in new if part[0:1] != " "]
        for part, found in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
            self._keep(part, np.array(found.ids, "<u4").tobytes())

    def _slow(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _plain(self, words: pa.Array) -> np.ndarray:
        """Which words tiktoken may encode."""
        if not self.quick:
            return np.zeros(len(words), bool)
        latin = pc.invert(pc.match_substring_regex(words, r"[^\x{00}-\x{ff}]"))
        short = pc.less_equal(pc.binary_length(words), LONGEST)
        return pc.and_(latin, short).to_numpy(zero_copy_only=False)

    def _at_once(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, each with a space before it, one after the other, and how many each has."""
        if not len(words):
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        ids = np.array(self.quick(" " + " ".join(words.to_numpy(zero_copy_only=False))), "<u4")
        sizes = pc.binary_length(words).to_numpy().astype(np.int64) + 1
        ends = np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum(sizes)) + 1
        return ids, np.diff(ends, prepend=0)

    def _keep(self, part: str, ids: bytes) -> None:
        self.known[part] = ids
        self.held += 200 + 2 * len(part) + len(ids)

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        for start in range(0, len(texts), GROUP):
            some = texts.slice(start, GROUP).fill_null("")
            if pc.any(pc.match_substring_regex(some, _UNEVEN)).as_py():
                yield from self._apart(some)
            else:
                yield from self._split(some)

    def _apart(self, texts: pa.Array) -> Iterator[bytes]:
        """Texts in which some space is no cut: each by itself if that is so, the others together."""
        uneven = pc.match_substring_regex(texts, _UNEVEN)
        even = self._split(texts.filter(pc.invert(uneven)))
        for text, own in zip(texts, uneven.to_pylist()):
            if not own:
                yield next(even)
                continue
            first, *rest = _CUT.split(text.as_py())
            cut = ([first] if first else []) + [" " + part for part in rest]
            self._learn(set(cut))
            yield b"".join([self.known[part] for part in cut])

    def _split(self, texts: pa.Array) -> Iterator[bytes]:
        """Texts that are cut at all of their spaces: words are looked up once a call, in a table."""
        words = pc.split_pattern(texts, " ")
        edges = words.offsets.to_numpy().astype(np.int64)
        coded = words.flatten().dictionary_encode()
        # Every word but the first of a text takes the space before it along.
        code = coded.indices.to_numpy().astype(np.int64) * 2 + 1
        code[edges[:-1] - edges[0]] -= 1
        present = np.zeros(2 * len(coded.dictionary), bool)
        present[code] = True
        parts = np.flatnonzero(present)
        quick = (parts & 1 == 1) & self._plain(coded.dictionary)[parts >> 1]
        flat, quick_sizes = self._at_once(coded.dictionary.take(pa.array(parts[quick] >> 1)))
        others = parts[~quick]
        own = coded.dictionary.take(pa.array(others >> 1)).to_pylist()
        own = [" " + word if part & 1 else word for word, part in zip(own, others.tolist())]
        self._learn(set(own))
        found = [self.known[part] for part in own]
        table = np.concatenate([flat, np.frombuffer(b"".join(found), "<u4")])
        sizes, starts = np.zeros((2, len(parts)), np.int64)
        sizes[quick], sizes[~quick] = quick_sizes, [len(ids) // 4 for ids in found]
        for some, first in ((quick, 0), (~quick, len(flat))):
            starts[some] = np.cumsum(sizes[some]) - sizes[some] + first
        row = (np.cumsum(present) - 1)[code]
        lengths = sizes[row]
        ends = np.cumsum(lengths)
        shift = np.repeat((starts[row] - (ends - lengths)).astype(np.int32), lengths)
        ids = table[np.arange(len(shift), dtype=np.int32) + shift]
        bounds = np.concatenate([[0], ends])[edges - edges[0]].tolist()
        for a, b in zip(bounds[:-1], bounds[1:]):
            yield ids[a:b].tobytes()

    def decode(self, ids: bytes) -> bytes:
        table = self.bytes_of
        return b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()])

    def offsets(self, ids: bytes) -> list[tuple[int, int]]:
        """First and end character of each token; a split character belongs to all its tokens."""
        pieces = [self.bytes_of[i] for i in np.frombuffer(ids, "<u4").tolist()]
        ends = np.cumsum([len(piece) for piece in pieces], dtype=np.int64)
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        begun = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])  # characters begun before
        starts = ends - np.array([len(piece) for piece in pieces], np.int64)
        inside = (raw[starts] & 0xC0) == 0x80 if len(starts) else np.zeros(0, bool)
        return list(zip((begun[starts] - inside).tolist(), begun[ends].tolist()))


def codec(path: str) -> Codec:
    if path not in _loaded:
        _loaded[path] = Codec(path)
    return _loaded[path]


def unsigned(ids: bytes) -> list[int]:
    return np.frombuffer(ids, "<u4").astype(np.int32).tolist()


def encode(df: DataFrame, text: str, vocabulary: str, offsets: bool = False) -> DataFrame:
    """``df`` with ``ids`` and, if asked for, ``offsets``: (first, end) character per token."""
    ids, spans = free_name(df, "ids"), free_name(df, "offsets")
    names = df.columns
    place = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary)
        for batch in batches:
            found = list(own.encode(batch.column(place)))
            columns = [*batch.columns, pa.array([unsigned(x) for x in found], pa.list_(pa.int32()))]
            if offsets:
                pairs = [[{"first": a, "end": b} for a, b in own.offsets(x)] for x in found]
                pair = pa.struct([("first", pa.int32()), ("end", pa.int32())])
                columns.append(pa.array(pairs, pa.list_(pair)))
            yield pa.RecordBatch.from_arrays(columns, names=[*names, ids, *[spans] * offsets])

    fields = [StructField(ids, ArrayType(IntegerType()))]
    if offsets:
        pair = StructType([StructField("first", IntegerType()), StructField("end", IntegerType())])
        fields.append(StructField(spans, ArrayType(pair)))
    return df.mapInArrow(run, StructType([*df.schema.fields, *fields]))


def decode(df: DataFrame, ids: str, vocabulary: str) -> DataFrame:
    """``df`` with ``decoded``: the bytes that the ids stand for (null: none)."""
    names, out = df.columns, free_name(df, "decoded")
    place = names.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary)
        for batch in batches:
            rows = batch.column(place).to_pylist()
            found = [own.decode(np.array(row or [], "<u4").tobytes()) for row in rows]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.binary())], names=[*names, out]
            )

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField(out, BinaryType())]))


def digests(df: DataFrame, key: str, text: str, vocabulary: str) -> DataFrame:
    """Key, n_tokens and the SHA-256 of ids and decoded bytes, without shipping the ids."""
    schema = StructType(
        [df.schema[key], *_fields("n_tokens long, ids_sha256 string, decoded_sha256 string")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary)
        for batch in batches:
            counts, coded, back = [], [], []
            for ids in own.encode(batch.column(1)):
                counts.append(len(ids) // 4)
                coded.append(hashlib.sha256(ids).hexdigest())
                back.append(hashlib.sha256(own.decode(ids)).hexdigest())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(coded, pa.string())]
            columns.append(pa.array(back, pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.select(key, text).mapInArrow(run, schema)


def _fields(ddl: str) -> list[StructField]:
    return StructType.fromDDL(ddl).fields


def crc32(ids: bytes) -> int:
    return zlib.crc32(ids) & 0xFFFFFFFF


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded and decoded."""
    documents = table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return digests(documents, "doc_id", "text", public_tokenizers.path("byte_bpe_50k.json"))
