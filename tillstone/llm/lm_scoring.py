"""Stupid-backoff scores of documents under a bigram model of all other documents."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstone.llm.textkit import chain, text_or_empty, words_of
from tillstone.session import cut_lineage

BACKOFF = 0.4
# Text bytes of a block, and n-grams of a counting task. Layout only; the scores do not depend on them.
BLOCK_BYTES = 8 << 20
BUCKET_GRAMS = 1_000_000

_ASK = "kind INT, bucket BIGINT, block BIGINT, grams BINARY, counts BINARY"
_ANSWER = "block BIGINT, kind INT, bucket BIGINT, totals BINARY"


def _packed(values: np.ndarray) -> bytes:
    """Counts as one byte each, 255 standing for the next of the eight-byte counts at the end."""
    large = values[values >= 255]
    return len(values).to_bytes(8, "little") + np.minimum(values, 255).astype(np.uint8).tobytes() + large.astype("<u8").tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    values = np.frombuffer(data, np.uint8, n, 8).astype(np.int64)
    values[values == 255] = np.frombuffer(data, "<u8", offset=8 + n).astype(np.int64)
    return values


class _Block:
    """Words and bigrams of the documents of one block as hashes, in a fixed order."""

    def __init__(self, texts: list[str]):
        per_doc = words_of(texts)
        self.sizes = np.array([len(w) for w in per_doc], np.int64)
        self.words = np.concatenate(per_doc) if per_doc else np.zeros(0, np.uint64)
        self.doc = np.repeat(np.arange(len(per_doc)), self.sizes)
        # Place of the first word of each bigram: every word but the last of its document.
        self.first = np.flatnonzero(self.doc[1:] == self.doc[:-1]) if len(self.words) else np.zeros(0, np.int64)
        self.grams = {1: self.words, 2: chain([self.words[self.first], self.words[self.first + 1]]) if len(self.first) else np.zeros(0, np.uint64)}


def _ask(bits: int):
    def run(key, table):
        block = _Block(table.column("text").to_pylist())
        rows: dict[str, list] = {"kind": [], "bucket": [], "block": [], "grams": [], "counts": []}
        for kind, grams in block.grams.items():
            if not len(grams):
                continue
            different, counts = np.unique(grams, return_counts=True)
            bucket = (different >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(different), np.int64)
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            for grams_part, counts_part, at in zip(np.split(different, cuts), np.split(counts, cuts), [0, *cuts]):
                rows["kind"].append(kind), rows["bucket"].append(int(bucket[at])), rows["block"].append(key[0].as_py())
                rows["grams"].append(grams_part.astype("<u8").tobytes()), rows["counts"].append(_packed(counts_part))
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        return pa.Table.from_arrays([pa.array(v, k) for v, k in zip(rows.values(), kinds)], names=list(rows))

    return run


def _answer(key, table):
    """The count table of one hash range: sums over blocks, sent back in the order they were asked in."""
    grams = [np.frombuffer(g, "<u8") for g in table.column("grams").to_pylist()]
    counts = np.concatenate([_unpacked(c) for c in table.column("counts").to_pylist()])
    different, place = np.unique(np.concatenate(grams), return_inverse=True)
    totals = np.zeros(len(different), np.int64)
    np.add.at(totals, place, counts)
    cuts = np.cumsum([len(g) for g in grams])[:-1]
    sent = [_packed(part) for part in np.split(totals[place], cuts)]
    return pa.Table.from_arrays(
        [table.column("block"), table.column("kind"), table.column("bucket"), pa.array(sent, pa.binary())],
        names=["block", "kind", "bucket", "totals"],
    )


def _own(doc: np.ndarray, place: np.ndarray, different: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First occurrence and count of each (document, n-gram), and the pair of each occurrence."""
    _, first, pair, count = np.unique(doc * max(different, 1) + place, return_index=True, return_inverse=True, return_counts=True)
    return first, pair, count


def _score(key, docs, answers):
    block = _Block(docs.column("text").to_pylist())
    n = len(block.sizes)
    order = np.lexsort((answers.column("bucket").to_numpy(), answers.column("kind").to_numpy()))
    sent, kinds = answers.column("totals").to_pylist(), answers.column("kind").to_pylist()
    total = {k: np.concatenate([np.zeros(0, np.int64), *(_unpacked(sent[i]) for i in order if kinds[i] == k)]) for k in (1, 2)}

    _, word_place = np.unique(block.words, return_inverse=True)
    _, pair, count = _own(block.doc, word_place, len(total[1]))
    # Per word occurrence: how often the other documents have that word.
    elsewhere = total[1][word_place] - count[pair] if len(word_place) else np.zeros(0, np.int64)
    doc2 = block.doc[block.first]
    _, gram_place = np.unique(block.grams[2], return_inverse=True)
    at, _, times = _own(doc2, gram_place, len(total[2]))
    both = total[2][gram_place[at]] - times if len(at) else np.zeros(0, np.int64)
    before, word, owner = elsewhere[block.first[at]], elsewhere[block.first[at] + 1], doc2[at]

    safe = lambda x: np.log(np.maximum(x, 1))
    back = math.log(BACKOFF)
    known = both > 0
    part = np.where(known, safe(both) - safe(before), np.where(word > 0, back + safe(word), 2 * back))
    score = np.bincount(owner, part * times, n)
    backed = np.bincount(owner, np.where(known, 0, times), n)
    found = np.bincount(owner, np.where(known, times, 0), n)
    opening = np.flatnonzero(np.diff(block.doc, prepend=-1)) if len(block.doc) else np.zeros(0, np.int64)
    first_word = elsewhere[opening]
    np.add.at(score, block.doc[opening], np.where(first_word > 0, safe(first_word), back))
    np.add.at(backed, block.doc[opening], 1)
    return pa.Table.from_arrays(
        [docs.column("doc_id").cast(pa.int64()), pa.array(block.sizes), pa.array(found.astype(np.int64)), pa.array(backed.astype(np.int64)), pa.array(score)],
        names=["doc_id", "n_words", "n_found", "n_backed", "partial"],
    )


def score_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_found (bigrams other documents have), n_backed (words scored without context) and
    log_score, the sum over the words of ln S.

    S(w | v) = c(v w) / c(v) if c(v w) > 0, else 0.4 * c(w) / N; the first word has c(w) / N; a word that no other
    document has counts as seen once after one more backoff. All counts leave the scored
    document out, since it would otherwise know each of its own bigrams. Words as in `textkit.words_of`.

    Documents are dealt into blocks of bounded size. Each block asks the count tables, which
    are partitioned by n-gram hash, for its different n-grams; the tables answer with totals in the same
    order, and the block joins them to its n-grams and sums per document. A very frequent n-gram
    thus reaches its table once per block, and documents move only once.

    Null and empty texts have no words and score 0. Every row counts as a document of its own, so
    repeated rows and copies know each other. Null ids are scored too. An empty table gives no rows.
    """
    lean = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    size = lean.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    bits = max(0, math.ceil(math.log2(max(1, size / 5 / BUCKET_GRAMS))))
    dealt = lean.withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)))
    asked = dealt.groupBy("block").applyInArrow(_ask(bits), _ASK)
    answers = asked.groupBy("kind", "bucket").applyInArrow(_answer, _ANSWER)
    scored = cut_lineage(
        dealt.groupBy("block").cogroup(answers.groupBy("block"))
        .applyInArrow(_score, "doc_id BIGINT, n_words BIGINT, n_found BIGINT, n_backed BIGINT, partial DOUBLE")
    )
    words = scored.agg(F.sum("n_words")).first()[0] or 0
    others = F.greatest(F.lit(words) - F.col("n_words"), F.lit(1))
    return scored.select("doc_id", "n_words", "n_found", "n_backed", (F.col("partial") - F.col("n_backed") * F.log(others)).alias("log_score"))
