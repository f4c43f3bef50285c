"""Alignment of two tokenizers: where tokens of both end together, and how often ids meet there, by inverted pair bitmaps."""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstone.llm.bpe import byte_letters
from tillstone.llm.textkit import text_or_empty
from tillstone.session import cut_lineage

# Texts are aligned in slices of about this many bytes; a longer text makes a slice of its own.
SLICE_BYTES = 1 << 19
# A segment of the index ends after this many links or documents, whichever comes first.
SEGMENT_LINKS = 1 << 21
SEGMENT_DOCS = 1 << 16
# Fixed value: the splitting pattern of the byte-level vocabulary.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The fast splitter runs out of stack on long runs of white space; such texts go to the library, with the same ids.
_LONG_BLANK = re.compile(r"\s{1000}")


class ByteLevel:
    """Ids of a byte-level file; special strings inside texts are plain text."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        of_letter = {c: b for b, c in enumerate(byte_letters())}
        special = {t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(of_letter[c] for c in token): i for token, i in spec["model"]["vocab"].items() if i not in special}
        self.fast = tiktoken.Encoding("byte-level", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.pieces = [b""] * (max(spec["model"]["vocab"].values()) + 1)
        for data, i in ranks.items():
            self.pieces[i] = data

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [
            self.library.encode(t, add_special_tokens=False).ids if _LONG_BLANK.search(t) else self.fast.encode_ordinary(t)
            for t in (" " + t for t in texts)
        ]


class Pieces:
    """Ids of a piece file, which puts a space before the text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [self._bytes(i) for i in range(self.library.get_piece_size())]

    def _bytes(self, i: int) -> bytes:
        piece = self.library.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.library.is_byte(i) else piece.replace("▁", " ").encode("utf-8")

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode(texts, num_threads=1)


class Coder:
    """Both tokenizers with the lengths and the printed ids of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        self.size = [np.array([len(p) for p in x.pieces], np.int64) for x in (self.a, self.b)]
        self.printed = [
            [np.array([f"{i}{sign}" for i in range(len(x.pieces))], object) for sign in (",", last)] for x, last in ((self.a, "|"), (self.b, ";"))
        ]


@lru_cache(maxsize=2)
def _coder(path_a: str, path_b: str) -> Coder:
    return Coder(path_a, path_b)


class Aligned(NamedTuple):
    """Figures per text, and the links of all texts in order: text number, id of A, id of B."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    digest: list[str]
    doc: np.ndarray
    left: np.ndarray
    right: np.ndarray


def align(texts: list[str], coder: Coder) -> Aligned:
    """Groups and links of each text.

    A text has no tokens when it is empty or when either tokenizer's bytes differ from a space and the text.
    """
    n = len(texts)
    ids: list[list[list[int]]] = [[], []]
    held: list[int] = []
    filled = [i for i, t in enumerate(texts) if t]
    for i, a, b in zip(filled, coder.a.encode([texts[i] for i in filled]), coder.b.encode([texts[i] for i in filled])):
        want = b" " + texts[i].encode("utf-8")
        if b"".join(map(coder.a.pieces.__getitem__, a)) == want and b"".join(map(coder.b.pieces.__getitem__, b)) == want:
            held.append(i)
            ids[0].append(a)
            ids[1].append(b)
    n_a, n_b, n_groups = (np.zeros(n, np.int64) for _ in range(3))
    digest = [""] * n
    place = np.array(held, np.int64)
    n_a[place], n_b[place] = [len(x) for x in ids[0]], [len(x) for x in ids[1]]
    flat_a, flat_b = (np.fromiter(chain.from_iterable(x), np.int64) for x in ids)
    # Both runs of tokens cover the same bytes, so ends count through all texts and borders of texts are common ends.
    ends_a, ends_b = np.cumsum(coder.size[0][flat_a]), np.cumsum(coder.size[1][flat_b])
    total = int(ends_a[-1]) if len(ends_a) else 0
    is_end = np.zeros(total + 1, bool)
    is_end[ends_a] = True
    last_b = np.flatnonzero(is_end[ends_b])
    common = ends_b[last_b]
    last_a = np.searchsorted(ends_a, common)

    stops_a, stops_b = np.cumsum(n_a[place]), np.cumsum(n_b[place])
    stops = np.searchsorted(last_a, stops_a - 1) + 1 if len(place) else np.zeros(0, np.int64)
    n_groups[place] = np.diff(stops, prepend=0)
    doc = np.repeat(place, n_groups[place])

    # Printed ids in the order A tokens of a group, B tokens of the group, next group.
    group_a = np.searchsorted(last_a, np.arange(len(flat_a)))
    group_b = np.searchsorted(last_b, np.arange(len(flat_b)))
    before_b = np.concatenate(([0], last_b[:-1] + 1)) if len(last_b) else np.zeros(0, np.int64)
    print_a, print_b = coder.printed[0][0][flat_a], coder.printed[1][0][flat_b]
    print_a[last_a], print_b[last_b] = coder.printed[0][1][flat_a[last_a]], coder.printed[1][1][flat_b[last_b]]
    merged = np.empty(len(flat_a) + len(flat_b), object)
    merged[np.arange(len(flat_a)) + before_b[group_a]] = print_a
    merged[np.arange(len(flat_b)) + last_a[group_b] + 1] = print_b
    at = 0
    for i, stop in zip(held, (stops_a + stops_b).tolist()):
        digest[i] = hashlib.sha256("".join(merged[at:stop])[:-1].encode()).hexdigest()
        at = stop
    return Aligned(n_a, n_b, n_groups, digest, doc, flat_a[last_a], flat_b[last_b])


class Postings(NamedTuple):
    """Compressed document bitmaps per pair, ordered by (pair, plane, byte).

    Plane k of a pair holds the documents whose number of links of this pair has bit k set. Only bytes
    that are not zero are stored: which byte of the bitmap, and its eight documents.
    """

    pair: np.ndarray
    plane: np.ndarray
    byte: np.ndarray
    bits: np.ndarray


NO_POSTINGS = Postings(np.zeros(0, np.int64), np.zeros(0, np.uint8), np.zeros(0, np.uint16), np.zeros(0, np.uint8))


def _or_equal(pair: np.ndarray, plane: np.ndarray, byte: np.ndarray, bits: np.ndarray) -> Postings:
    """OR of the bits of equal neighbours in ordered rows."""
    if not len(pair):
        return NO_POSTINGS
    new = np.ones(len(pair), bool)
    new[1:] = (pair[1:] != pair[:-1]) | (plane[1:] != plane[:-1]) | (byte[1:] != byte[:-1])
    first = np.flatnonzero(new)
    return Postings(pair[first], plane[first].astype(np.uint8), byte[first].astype(np.uint16), np.bitwise_or.reduceat(bits, first).astype(np.uint8))


def postings_of(pair: np.ndarray, doc: np.ndarray) -> Postings:
    """Bitmaps of links given as (pair, document) rows; documents are numbers below SEGMENT_DOCS."""
    if not len(pair):
        return NO_POSTINGS
    different, place = np.unique(pair, return_inverse=True)
    both, times = np.unique(place * np.int64(SEGMENT_DOCS) + doc, return_counts=True)
    owner, doc = both // SEGMENT_DOCS, both % SEGMENT_DOCS
    parts = []
    for k in range(int(times.max()).bit_length()):
        has = np.flatnonzero((times >> k) & 1)
        parts.append((owner[has], np.full(len(has), k), doc[has]))
    owner, plane, doc = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort((owner * 64 + plane) * (SEGMENT_DOCS // 8) + (doc >> 3), kind="stable")
    owner, plane, doc = owner[order], plane[order], doc[order]
    return _or_equal(different[owner], plane, doc >> 3, np.left_shift(1, doc & 7))


def or_merge(parts: list[Postings]) -> Postings:
    """One set of bitmaps out of several over different documents of the same segment."""
    if len(parts) < 2:
        return parts[0] if parts else NO_POSTINGS
    pair, plane, byte, bits = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((byte, plane, pair))
    return _or_equal(pair[order], plane[order], byte[order], bits[order])


def popcounts(postings: Postings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different pairs, their links (planes weighted by powers of two) and their documents (all planes OR-merged)."""
    if not len(postings.pair):
        return NO_POSTINGS.pair, NO_POSTINGS.pair, NO_POSTINGS.pair
    first = np.flatnonzero(np.diff(postings.pair, prepend=postings.pair[0] - 1))
    links = np.add.reduceat(np.bitwise_count(postings.bits).astype(np.int64) << postings.plane.astype(np.int64), first)
    order = np.lexsort((postings.byte, postings.pair))
    flat = _or_equal(postings.pair[order], np.zeros(len(order), np.uint8), postings.byte[order], postings.bits[order])
    starts = np.flatnonzero(np.diff(flat.pair, prepend=flat.pair[0] - 1))
    return postings.pair[first], links, np.add.reduceat(np.bitwise_count(flat.bits).astype(np.int64), starts)


def post_back(postings: Postings, value: np.ndarray, n: int) -> np.ndarray:
    """Per document the sum over its links of the value of their pair; value is given per bitmap byte."""
    out = np.zeros(n, np.int64)
    for at in range(0, len(value), 1 << 18):
        rows = slice(at, at + (1 << 18))
        has, column = np.nonzero(np.unpackbits(postings.bits[rows, None], axis=1, bitorder="little"))
        doc = postings.byte[rows].astype(np.int64)[has] * 8 + column
        np.add.at(out, doc, (value[rows] << postings.plane[rows].astype(np.int64))[has])
    return out


_SEGMENT = (
    "segment BIGINT, doc_ids ARRAY<BIGINT>, n_a ARRAY<BIGINT>, n_b ARRAY<BIGINT>, n_groups ARRAY<BIGINT>, digests ARRAY<STRING>, "
    "pairs ARRAY<BIGINT>, links ARRAY<BIGINT>, holding ARRAY<BIGINT>, entries ARRAY<INT>, plane BINARY, byte BINARY, bits BINARY"
)


class _Segment:
    """Documents of one task, gathered until the segment is full."""

    def __init__(self):
        self.docs: list[list] = [[], [], [], [], []]
        self.parts: list[Postings] = []
        self.links = 0

    def __len__(self) -> int:
        return len(self.docs[0])

    def add(self, doc_ids: list, texts: list[str], coder: Coder) -> None:
        found = align(texts, coder)
        self.parts.append(postings_of((found.left << 32) | found.right, found.doc + len(self)))
        self.links += len(found.doc)
        for have, more in zip(self.docs, (doc_ids, found.n_a.tolist(), found.n_b.tolist(), found.n_groups.tolist(), found.digest)):
            have.extend(more)

    def batch(self, number: int) -> pa.RecordBatch:
        postings = or_merge(self.parts)
        pairs, links, holding = popcounts(postings)
        entries = np.diff(np.searchsorted(postings.pair, pairs), append=len(postings.pair))
        longs, whole = pa.list_(pa.int64()), [number]
        columns = [pa.array(whole, pa.int64()), *(pa.array([x], longs) for x in self.docs[:4]), pa.array([self.docs[4]], pa.list_(pa.string()))]
        columns += [pa.array([x], longs) for x in (pairs, links, holding)] + [pa.array([entries.astype(np.int32)], pa.list_(pa.int32()))]
        columns += [pa.array([x.tobytes()], pa.binary()) for x in (postings.plane, postings.byte, postings.bits)]
        return pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in _SEGMENT.split(", ")])


def _index(path_a: str, path_b: str):
    def run(batches):
        coder, segment = _coder(path_a, path_b), _Segment()
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            sizes = batch.column(2).to_numpy()
            at = 0
            while at < batch.num_rows:
                room = SEGMENT_DOCS - len(segment)
                stop = max(at + 1, at + int(np.searchsorted(np.cumsum(sizes[at:]), SLICE_BYTES, "right")))
                stop = min(stop, at + room)
                segment.add(batch.column(0).slice(at, stop - at).to_pylist(), batch.column(1).slice(at, stop - at).to_pylist(), coder)
                at = stop
                if segment.links >= SEGMENT_LINKS or len(segment) >= SEGMENT_DOCS:
                    yield segment.batch(number)
                    segment, number = _Segment(), number + 1
        if len(segment):
            yield segment.batch(number)

    return run


def build_index(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Segments of the inverted index, written to the shared folder: figures per document, and per pair of ids the
    document bitmaps with their multiplicity planes, links and documents."""
    lean = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    return cut_lineage(lean.withColumn("size", F.octet_length("text")).mapInArrow(_index(path_a, path_b), _SEGMENT))


def pair_counts(index: DataFrame) -> DataFrame:
    """a_id, b_id, n_links and n_docs of every pair of ids that is linked anywhere."""
    rows = index.select(F.explode(F.arrays_zip("pairs", "links", "holding")).alias("x")).select("x.*")
    summed = rows.groupBy("pairs").agg(F.sum("links").alias("n_links"), F.sum("holding").alias("n_docs"))
    low = F.lit((1 << 32) - 1)
    return summed.select(F.shiftright("pairs", 32).alias("a_id"), F.col("pairs").bitwiseAND(low).alias("b_id"), "n_links", "n_docs")


def _score(key, segments, rated):
    """Documents of one segment with the counts of its pairs posted back to them."""
    out = []
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    pair = rated.column("pair").to_numpy()
    order = np.argsort(pair)
    count, best = rated.column("n_links").to_numpy()[order], rated.column("best").to_numpy(zero_copy_only=False)[order].astype(np.int64)
    for row in range(segments.num_rows):
        value = {f: segments.column(f)[row] for f in segments.column_names}
        of = {f: value[f].values for f in ("doc_ids", "n_a", "n_b", "n_groups", "digests")}
        entries = value["entries"].values.to_numpy()
        owner = np.repeat(np.arange(len(entries)), entries)
        postings = Postings(
            owner, np.frombuffer(value["plane"].as_py(), np.uint8), np.frombuffer(value["byte"].as_py(), np.uint16), np.frombuffer(value["bits"].as_py(), np.uint8)
        )
        n = len(of["doc_ids"])
        scores = [post_back(postings, x[owner], n) if len(owner) else np.zeros(n, np.int64) for x in (best, count)]
        out.append(pa.Table.from_arrays(
            [of["doc_ids"], of["n_a"], of["n_b"], of["n_groups"], of["n_groups"], pa.array(scores[0]), pa.array(scores[1]), of["digests"]], names=names
        ))
    return pa.concat_tables(out)


def align_documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row.

    A text is encoded by a byte-level file (A, over a space and the text) and by a piece file (B, which adds the
    space). Places where tokens of both end cut the text into groups; the two tokens that end at such a place are a
    link. A pair's count is how many links of the corpus hold it. n_best: links whose count is the highest of their
    B id (ties included); count_sum: the counts of all links.

    Each task builds segments of an inverted index: per pair of ids the documents as compressed bitmaps, one
    plane per bit of the multiplicity, OR-merged over slices and popcounted. Counts are summed per pair over the
    segments, and each segment posts the counts of its pairs back to its documents. Texts move only into their
    task; a pair that is everywhere sends one row per segment.

    Null and empty texts, and texts that a tokenizer does not give back byte by byte, have zeros and an
    empty digest. Repeated rows and null ids count each. Other columns are not read. An empty table gives no rows.
    """
    index = build_index(docs, path_a, path_b)
    counts = cut_lineage(pair_counts(index))
    # One row per id of B, so at most as many as the piece file has.
    most = F.broadcast(counts.groupBy("b_id").agg(F.max("n_links").alias("most")))
    pair = F.shiftleft("a_id", 32).bitwiseOR(F.col("b_id"))
    rated = counts.join(most, "b_id").select(pair.alias("pair"), "n_links", (F.col("n_links") == F.col("most")).alias("best"))
    asked = index.select(F.col("segment").alias("asker"), F.explode("pairs").alias("pair")).join(rated, "pair").select("asker", "pair", "n_links", "best")
    kept = index.select("segment", "doc_ids", "n_a", "n_b", "n_groups", "digests", "entries", "plane", "byte", "bits")
    return kept.groupBy("segment").cogroup(asked.groupBy("asker")).applyInArrow(
        _score, "doc_id BIGINT, n_a BIGINT, n_b BIGINT, n_groups BIGINT, n_links BIGINT, n_best BIGINT, count_sum BIGINT, groups_sha256 STRING"
    )
