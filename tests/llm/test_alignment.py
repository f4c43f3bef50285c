"""Tokenizer alignment against both libraries and plain Python."""

import collections
import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tillstone.llm import alignment, queries
from tillstone.llm.bpe import byte_letters

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
MORE = ["▁x", "a▁b", "日本語 😀 é́", "\x00 nul", "café   line", "<s> <unk> </s> <|endoftext|>", " lead", "the cat the cat the cat", "\U0001fae9 new", " " * 5000 + "x"]


def brute(texts):
    """Per text the figures of COLUMNS, by walking over the bytes."""
    left, right = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    left.encode_special_tokens = True
    of_letter = {c: b for b, c in enumerate(byte_letters())}

    def piece(i):
        p = right.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if right.is_byte(i) else p.replace("▁", " ").encode()

    made, count = [], collections.Counter()
    for text in texts:
        groups, n_a, n_b = [], 0, 0
        if text:
            a, b = left.encode(" " + text, add_special_tokens=False).ids, right.encode(text)
            bytes_a, bytes_b = [bytes(of_letter[c] for c in left.id_to_token(i)) for i in a], [piece(i) for i in b]
            if b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
                n_a, n_b = len(a), len(b)
                held, at = ([], []), [0, 0]
                while a or b:
                    side = 0 if at[0] <= at[1] else 1
                    held[side].append((a, b)[side].pop(0))
                    at[side] += len((bytes_a, bytes_b)[side].pop(0))
                    if at[0] == at[1]:
                        groups.append(held)
                        held = ([], [])
        made.append((n_a, n_b, groups))
        count.update((g[0][-1], g[1][-1]) for g in groups)
    most = collections.Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    out = []
    for n_a, n_b, groups in made:
        counts = [(count[g[0][-1], g[1][-1]], most[g[1][-1]]) for g in groups]
        text = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        out.append((n_a, n_b, len(groups), len(groups), sum(c == m for c, m in counts), sum(c for c, _ in counts), digest))
    return out


def check(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = sorted((str(i), *x) for (i, _), x in zip(rows, brute([t for _, t in rows])))
    got = alignment.align_documents(docs, A, B)
    assert sorted((str(r.doc_id), *(r[c] for c in COLUMNS)) for r in got.collect()) == want


def test_odd_texts(spark, odd_docs):
    more = spark.createDataFrame([(100 + i, t, "x", i, "y") for i, t in enumerate(MORE * 2)], odd_docs.schema)
    check(odd_docs.unionByName(more))


def test_small_segments_and_slices(spark, odd_docs, monkeypatch):
    """Counts over many segments and bitmaps OR-merged from many slices are the same."""
    monkeypatch.setattr(alignment, "SLICE_BYTES", 40)
    check(odd_docs.coalesce(1))


def test_supplied_documents(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    want = {i: x for (i, _), x in zip(rows, brute([t for _, t in rows]))}
    got = queries.op11_alignment(spark, folder).collect()
    assert {r.doc_id: tuple(r[c] for c in COLUMNS) for r in got} == want and len(got) == len(rows)


def test_empty_table(no_docs):
    assert alignment.align_documents(no_docs, A, B).collect() == []


def test_pair_counts(spark):
    docs = spark.createDataFrame([(1, "the cat the cat"), (2, "the dog")], "doc_id INT, text STRING").repartition(2)
    pairs = {(r.n_links, r.n_docs) for r in alignment.pair_counts(alignment.build_index(docs, A, B)).collect()}
    assert pairs == {(3, 2), (2, 1), (1, 1)}


@pytest.mark.parametrize("seed", range(3))
def test_bitmaps_hold_what_was_put_in(seed):
    rng = np.random.RandomState(seed)
    pair, doc = rng.zipf(1.5, 5000) % 300, rng.randint(0, 1000, 5000)
    half = doc < 500
    merged = alignment.or_merge([alignment.postings_of(pair[x], doc[x]) for x in (half, ~half)])
    whole = alignment.postings_of(pair, doc)
    assert all((x == y).all() for x, y in zip(merged, whole))
    pairs, links, docs = alignment.popcounts(merged)
    assert dict(zip(pairs, links)) == collections.Counter(pair.tolist())
    assert dict(zip(pairs, docs)) == collections.Counter(p for p, _ in set(zip(pair.tolist(), doc.tolist())))
    back = alignment.post_back(merged, merged.pair * 7, 1000)
    assert back.tolist() == np.bincount(doc, pair * 7, 1000).astype(int).tolist()
