"""Byte-pair encoding and decoding with the merges of a public tokenizer file."""

from __future__ import annotations

import heapq
import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstone.llm.textkit import SLICE_ROWS, from_text

# Words up to this many bytes are merged in the rank array, longer ones with a heap.
SHORT_WORD = 96
# Encoded words a worker remembers; words beyond are encoded whenever they come.
CACHE_WORDS = 600_000
_NONE = 1 << 60


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary file.

    Bytes that print as themselves stand for themselves; the others take the code points from 256 on, in order.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    odd = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(odd)) for b in range(256)]


# Texts of these characters are cut by a plain pattern; all others by the library's own splitter. Left
# out are the characters from x1C to x1F and x85, on which pattern engines differ about white space.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
_DIGITS = "0-9²³¹¼-¾"
_BLANKS = " \t-\r "
PLAIN = re.compile("[^\x1c-\x1f\x85Ā-\U0010ffff]*")
# Fixed value: the splitting pattern of the vocabulary, for Latin-1 texts.
_SPLIT = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[{_DIGITS}]+| ?[^{_BLANKS}{_LETTERS}{_DIGITS}]+|[{_BLANKS}]+(?![^{_BLANKS}])|[{_BLANKS}]+"
)


class Vocabulary:
    """Merges, ids and bytes of a byte-level BPE file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        of_letter = {c: b for b, c in enumerate(letters)}
        ids = spec["model"]["vocab"]
        self.single = [ids[c] for c in letters]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[ids[left], ids[right]] = rank, ids[left + right]
        self.bytes_of = {i: bytes(of_letter[c] for c in token) for token, i in ids.items() if all(c in of_letter for c in token)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of |= {i: content.encode() for content, i in self.special.items()}
        self._cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self._splitter = Tokenizer.from_file(path).pre_tokenizer

    def segments(self, text: str) -> list[str]:
        """Ordinary stretches at even places, special strings between them."""
        return self._cut.split(text) if self._cut else [text]

    def words(self, stretch: str) -> list[str]:
        if PLAIN.fullmatch(stretch):
            return _SPLIT.findall(stretch)
        return [stretch[a:b] for _, (a, b) in self._splitter.pre_tokenize_str(stretch)]

    def merge_short(self, data: bytes) -> list[int]:
        """Contiguous rank array: part borders and the rank of each adjacent pair side by side; the least
        rank is found by a scan, its border deleted and the two neighbouring ranks looked up again."""
        parts = [self.single[b] for b in data]
        merges = self.merges
        ranks = [merges.get(pair, (_NONE, 0))[0] for pair in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == _NONE:
                break
            at = ranks.index(least)
            parts[at] = merges[parts[at], parts[at + 1]][1]
            del parts[at + 1], ranks[at]
            if at:
                ranks[at - 1] = merges.get((parts[at - 1], parts[at]), (_NONE, 0))[0]
            if at < len(ranks):
                ranks[at] = merges.get((parts[at], parts[at + 1]), (_NONE, 0))[0]
        return parts

    def merge_long(self, data: bytes) -> list[int]:
        """The same merges in n log n steps, for words too long to scan again and again."""
        parts = [self.single[b] for b in data]
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(self.merges[p][0], i, *p) for i, p in enumerate(zip(parts, parts[1:])) if p in self.merges]
        heapq.heapify(heap)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i] if parts[i] == left else n
            if j >= n or parts[j] != right:
                continue
            parts[i], parts[j] = self.merges[left, right][1], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (pair := (parts[a], parts[b])) in self.merges:
                    heapq.heappush(heap, (self.merges[pair][0], a, *pair))
        return [p for p in parts if p >= 0]

    def merge(self, data: bytes) -> list[int]:
        return self.merge_short(data) if len(data) <= SHORT_WORD else self.merge_long(data)


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class WordCache(dict):
    """word -> made(word), bounded; very long words are not kept."""

    def __init__(self, make):
        self.make = make

    def __missing__(self, word: str):
        value = self.make(word)
        if len(word) <= SHORT_WORD and len(self) < CACHE_WORDS:
            self[word] = value
        return value


@lru_cache(maxsize=4)
def _id_cache(path: str) -> WordCache:
    vocab = vocabulary(path)
    return WordCache(lambda word: np.asarray(vocab.merge(word.encode("utf-8")), "<i4").tobytes())


def encode_text(text: str, path: str) -> bytes:
    """Ids of a text as little-endian 32-bit integers."""
    vocab, cache = vocabulary(path), _id_cache(path)
    out = []
    for i, stretch in enumerate(vocab.segments(text)):
        if i % 2:
            out.append(np.asarray([vocab.special[stretch]], "<i4").tobytes())
        else:
            out += map(cache.__getitem__, vocab.words(stretch))
    return b"".join(out)


def _ids_column(blobs: list[bytes]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(b) // 4 for b in blobs]))).astype(np.int32)
    values = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(blobs))])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def decode_ids(ids: list[int], path: str) -> str:
    """The text of ids; an id outside the vocabulary stands for nothing, bytes that are no UTF-8 are replaced."""
    table = vocabulary(path).bytes_of
    return b"".join([table.get(i, b"") for i in ids]).decode("utf-8", "replace")


def encode_documents(docs: DataFrame, path: str, carry: list[str]) -> DataFrame:
    """carry columns and `ids` (array<int>): the whole text encoded, special strings as special tokens.

    Null and empty texts give an empty array. Repeated rows are encoded each. Texts without white
    space are merged with a heap, so their length costs no more than n log n.
    """

    def make(texts):
        return [_ids_column([encode_text(t, path) for t in texts])]

    return from_text(docs, carry, "ids ARRAY<INT>", make)


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """Replace `ids` by ids and `decoded`, the text they stand for, special tokens included.

    Bytes that are no UTF-8 become replacement characters; a null array decodes to null, an id outside
    the vocabulary to nothing.
    """
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())])

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(at, SLICE_ROWS)
                column = batch.column(batch.schema.get_field_index("ids"))
                texts = [None if not ids.is_valid else decode_ids(ids.values.to_pylist(), path) for ids in column]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row.

    Ids are decoded where they were made, so a text takes one way through Python.
    """

    def make(texts):
        blobs = [encode_text(t, path) for t in texts]
        decoded = [decode_ids(np.frombuffer(b, "<i4").tolist(), path) for b in blobs]
        return [_ids_column(blobs), pa.array(decoded, pa.string())]

    both = from_text(docs, ["doc_id"], "ids ARRAY<INT>, decoded STRING", make)
    return both.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
