"""Concatenate token ids of all documents and cut them into sequences of one length."""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstone.llm.textkit import from_text
from tillstone.session import cut_lineage

ID_BYTES = 4
# Encoded words a worker remembers; words beyond are encoded whenever they come.
CACHE_WORDS = 250_000
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
_DIGITS = "0-9²³¹¼-¾"
_BLANKS = " \t-\r "
# Texts of these characters are unchanged by normal form C and lower-cased one by one; all others go to the
# library whole, and so do texts that hold a special string.
_PLAIN = re.compile("[^\x1c-\x1f\x85Ā-\U0010ffff]*")
# Fixed value: the splitting pattern of the vocabulary, for Latin-1 texts.
_SPLIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_DIGITS}]|[^{_BLANKS}{_LETTERS}{_DIGITS}]+")


class LibraryIds:
    """Ids as the tokenizers library gives them, with the words a task has met looked up.

    The words are kept by the task, not the worker: a reused worker starts each task without them, so what it
    holds between tasks and runs does not grow with the input.
    """

    def __init__(self, path: str):
        self.library = _library(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, "<u4").tobytes() for e in self.library.encode_batch(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of each word. Words side by side stay words of their own, so many are encoded in one call."""
        out: dict[str, bytes] = {}
        for at in range(0, len(words), 2000):
            some = words[at:at + 2000]
            made = self.library.encode(" ".join(some), add_special_tokens=False)
            ids, owner = np.asarray(made.ids, "<u4"), np.asarray(made.word_ids, np.int64)
            cuts = np.searchsorted(owner, np.arange(len(some) + 1))
            if len(owner) and owner[-1] == len(some) - 1 and (np.diff(cuts) > 0).all():
                out.update((w, ids[a:b].tobytes()) for w, a, b in zip(some, cuts[:-1], cuts[1:]))
            else:
                out.update(zip(some, self._whole(some)))
        return out

    def __call__(self, texts: list[str]) -> list[bytes]:
        out: list[bytes | None] = []
        cut: list[list[str] | None] = []
        for text in texts:
            plain = _PLAIN.fullmatch(text) and not any(s in text for s in self.special)
            cut.append(_SPLIT.findall(text.lower()) if plain else None)
        known = self.known
        new = self._words(list(set().union(*(w for w in cut if w)).difference(known)))
        if len(known) + len(new) <= CACHE_WORDS:
            known.update(new)
            new = {}
        for text, words in zip(texts, cut):
            if words is None:
                out += self._whole([text])
            elif new:
                out.append(b"".join([known[w] if w in known else new[w] for w in words]))
            else:
                out.append(b"".join([known[w] for w in words]))
        return out


@lru_cache(maxsize=2)
def _library(path: str):
    """The library's tokenizer, as read from its file: the same size whatever the input."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    return library


def tokenized(docs: DataFrame, path: str, end_id: int, carry: list[str]) -> DataFrame:
    """First pass: ids of each document with the end id, its partition and the ids before it there.

    `ids` are little-endian unsigned 32-bit integers in one binary value. Written to the shared folder,
    so both passes and any retry see the same partitions.
    """

    def start():
        part, total = TaskContext.get().partitionId(), 0
        ids = LibraryIds(path)

        def make(texts):
            nonlocal total
            blobs = [b + np.asarray([end_id], "<u4").tobytes() for b in ids(texts)]
            sizes = np.array([len(b) // ID_BYTES for b in blobs], np.int64)
            before = total + np.cumsum(sizes) - sizes
            total += int(sizes.sum())
            return [pa.array(sizes), pa.array(blobs, pa.binary()), pa.array(np.full(len(sizes), part), pa.int64()), pa.array(before)]

        return make

    schema = "doc_tokens BIGINT, ids BINARY, _part BIGINT, _before BIGINT"
    return cut_lineage(from_text(docs, carry, schema, start, per_task=True))


def pack(docs: DataFrame, path: str, length: int = 4096, end_id: int = 2, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per piece: carry, start, length, ids, doc_tokens, sequence_id, offset.

    Two passes of prefix sums: each partition adds up its own ids while they are made, the totals of
    the partitions are summed, and a document's place in the one long row of ids is the sum of both.
    Sequence s holds the places s * length to (s + 1) * length - 1; a document across a border
    gives a piece on either side. Only the last sequence is short, so at most length - 1 places are
    padding. No text and no id is shuffled.

    Null or empty texts are the end id alone. Repeated rows are packed each. The order is that of the
    input partitions. An empty table gives no rows. Carried columns may not be called start, length,
    ids, doc_tokens, sequence_id or offset.
    """
    rows = tokenized(docs, path, end_id, list(carry))
    totals = rows.groupBy("_part").agg(F.sum("doc_tokens").alias("_total"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per input partition.
    bases = totals.select("_part", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_base"))
    placed = rows.join(F.broadcast(bases), "_part").withColumn("_from", F.col("_base") + F.col("_before"))
    last = F.floor((F.col("_from") + F.col("doc_tokens") - 1) / length)
    pieces = placed.withColumn("sequence_id", F.explode(F.sequence(F.floor(F.col("_from") / length), last)))
    begin = F.greatest(F.col("sequence_id") * length, F.col("_from"))
    end = F.least((F.col("sequence_id") + 1) * length, F.col("_from") + F.col("doc_tokens"))
    return pieces.select(
        *carry,
        (begin - F.col("_from")).alias("start"),
        (end - begin).alias("length"),
        F.substring("ids", ((begin - F.col("_from")) * ID_BYTES + 1).cast("int"), ((end - begin) * ID_BYTES).cast("int")).alias("ids"),
        "doc_tokens",
        "sequence_id",
        (begin - F.col("sequence_id") * length).alias("offset"),
    )
