"""Collocations against plain counting."""

import collections
import re

import numpy as np
import pytest

from pyspark.sql import functions as F
from tillstone.llm import collocations, queries, textkit

FOLDER = "/root/testdata/sf0.001"


def brute(rows, max_words=3, least=10, best=2000, covered=50, scale=1_000_000):
    """Rows of the result from (lang, text) rows."""
    f = collections.defaultdict(collections.Counter)
    for lang, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            for size in range(1, max_words + 1):
                f["und" if lang is None else lang].update(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        n = sum(c for p, c in counts.items() if len(p) == 1)
        candidates = {p: c for p, c in counts.items() if len(p) > 1 and c >= least}
        inside = collections.Counter()
        for p, c in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    inside[p[i:i + size]] = max(inside[p[i:i + size]], c)
        kept = []
        for p, a in candidates.items():
            if p in inside and 100 * inside[p] >= covered * a:
                continue
            score, _, l, r = min((scale * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(kept)[:best], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n, -score))
    return sorted(out)


def check(docs, **options):
    rows = [(r.lang, r.text) for r in docs.select("lang", "text").collect()]
    share = options.pop("share", 1 / 8)
    got = collocations.collocations(docs, share=share, **options).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, **options)
    return len(got)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    rng = np.random.RandomState(3)
    words = ["The", "cat", "sat", "on,", "a", "mat.", "x\ty", "Été", "no:\n", "end!", "the", "\x0b", "É"]
    rows = [(None if i % 7 == 0 else "und" if i % 7 == 1 else ("en", "fr")[i % 2], " ".join(rng.choice(words, rng.randint(0, 60)))) for i in range(150)]
    rows += [("en", None), (None, ""), ("en", " \t\n"), ("en", "solo"), ("xx", "tie one tie one. " * 12 + "two tie, " * 12), ("en", "long " * 40_000)]
    return spark.createDataFrame([(l, t, "p", 1, "w") for l, t in rows], "lang STRING, text STRING, phrase STRING, n INT, word STRING").repartition(3)


@pytest.mark.parametrize("share", [0.0, 1 / 8, 1.0])
def test_odd_texts_whatever_the_sample(odd, share):
    """An empty sample proposes nothing, a whole one everything: the result is the same."""
    assert check(odd, share=share) > 30


def test_longer_phrases(odd):
    assert check(odd, max_words=5, least=3, best=40, covered=80) > 100
    check(odd, max_words=2)


def test_supplied_documents(docs):
    assert check(docs) > 100


def test_small_blocks_and_several_parts(docs, monkeypatch):
    """Phrases across windows, blocks and owners of several parts are counted once."""
    # Windows and blocks are cut in the workers, which see patched settings only through the functions sent to them.
    scanned = collocations.scan(b"a b, c d", False, 0)
    assert scanned.joined.tolist() == [False, True, False, True] and scanned.open
    monkeypatch.setattr(collocations, "PART_BLOCKS", 0.01)
    miner = collocations._Miner(docs, 3, 10, 0)
    assert miner.parts > 1
    check(docs)


def test_a_text_in_many_windows_and_blocks(monkeypatch):
    monkeypatch.setattr(textkit, "PIECE_BYTES", 64)
    monkeypatch.setattr(collocations, "BLOCK_WORDS", 50)
    monkeypatch.setattr(collocations.TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda self: 0})())
    rng = np.random.RandomState(1)
    text = " ".join(rng.choice(["a", "b", "c,", "dd", "e. "], 700))
    counter = collocations._Counter(3, 6, 0, None)
    batches = [*counter.read("en", [text.encode(), b"a b"]), *counter.flush()]
    got = collections.Counter()
    for batch in batches:
        for row in batch.to_pylist():
            got[row["size"]] += int(np.frombuffer(row["counts"], np.int64).sum())
    want = collections.Counter()
    for piece in re.split("[.,]", text) + ["a b"]:
        n = len(piece.split())
        want.update({k: max(0, n - k + 1) for k in (1, 2, 3)})
    assert got == want and len({r for b in batches for r in b.column("part").to_pylist()}) > 5


def test_words_with_equal_hashes_are_hashed_anew(odd, monkeypatch):
    seeds = []
    plain = collocations._Miner.count

    def clash(self, docs, proposed, least):
        seeds.append(self.seed)
        out = plain(self, docs, proposed, least)
        if self.seed == 0:
            raise collocations._Clash
        return out

    monkeypatch.setattr(collocations._Miner, "count", clash)
    check(odd)
    assert seeds[0] == 0 and set(seeds[1:]) == {1}


def test_owners_notice_equal_hashes():
    import pyarrow as pa

    h = np.array([5, 9], np.uint64)
    row = {"size": 1, "bucket": 0, "part": 0, "lang": "en", "words": [h.tobytes()], "counts": np.array([1, 1]).tobytes(), "known": bytes(2)}
    table = pa.Table.from_pylist([row | {"texts": ["a", "b"]}, row | {"texts": ["a", "c"]}])
    got = collocations._own(1)((pa.scalar(1),), table).to_pylist()
    assert {(r["word"], r["clash"]) for r in got if r["size"]} == {("a", False), ("b", True)}
    assert [r["n"] for r in got if not r["size"]] == [4]


def test_empty_table(spark):
    assert collocations.collocations(spark.createDataFrame([], "lang STRING, text STRING")).collect() == []


def test_sums_are_exact_when_phrase_hashes_meet():
    words = [np.array([1, 2, 1, 2], np.uint64), np.array([7, 8, 7, 9], np.uint64)]
    at, sums = collocations._summed(np.zeros(4, np.uint64), words, np.array([1, 10, 100, 1000]))
    assert sorted(zip(words[0][at].tolist(), words[1][at].tolist(), sums.tolist())) == [(1, 7, 101), (2, 8, 10), (2, 9, 1000)]


def test_query_and_sql(spark):
    from parity import compare, connect

    name = "op12_collocations"
    ok, text = compare(spark, connect(FOLDER), FOLDER, name, queries.QUERIES[name], queries.ORACLES[name])
    assert ok, text


def test_scores_beyond_64_bits(spark):
    row = spark.createDataFrame([(10**15, 10**15, 10**15)], "a BIGINT, l BIGINT, r BIGINT")
    assert row.select(collocations.score("a", "l", "r", 1_000_000)).first()[0] == 1_000_000
