"""Every operator on odd texts, repeated rows and empty tables, against plain Python."""

import collections
import hashlib
import re
import time
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from pyspark.sql import functions as F
from tillstone.llm import bpe, exact_dedup, lm_scoring, near_dedup, neighbours, packing, quality, queries, secrets, sharding
from tillstone.llm import textkit, token_counts

BYTE, WORD = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json")
OPS = {
    "score": lm_scoring.score_documents, "exact": exact_dedup.exact_groups, "near": near_dedup.near_groups,
    "counts": lambda d: token_counts.prefix_table(d, BYTE, ["doc_id"]), "pack": lambda d: packing.pack(d, WORD),
    "bpe": lambda d: bpe.round_trip(d, BYTE), "secrets": lambda d: secrets.scan_secrets(d, ["doc_id"]),
    "quality": lambda d: quality.quality(d, ["doc_id"]), "shards": sharding.assign_shards,
}


def rows_of(frame):
    return [(r.doc_id, r.text or "") for r in frame.select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", sorted(OPS))
def test_empty_tables_give_no_rows(no_docs, name):
    assert OPS[name](no_docs).collect() == []


def brute_groups(docs):
    blank = re.compile(r"[\x20\x09-\x0D]")
    groups = collections.defaultdict(list)
    for i, t in rows_of(docs):
        groups[blank.sub("", t)].append((-len(t), i is None, i))
    return sorted(
        (str(i), str(min(g)[2]), len(g), i == min(g)[2], hashlib.sha256(b.encode()).hexdigest()) for b, g in groups.items() for _, _, i in g
    )


def top_bits(bits):
    """A hash key of so many bits, so that different texts collide."""
    return lambda body: F.shiftleft(F.shiftrightunsigned(F.xxhash64(body), 64 - bits), 64 - bits) if bits else F.lit(0).cast("bigint")


@pytest.mark.parametrize("capacity, key_of", [(exact_dedup.BUCKET_ROWS, F.xxhash64), (1, F.xxhash64), (2, top_bits(2)), (3, top_bits(0)), (100, top_bits(0))])
def test_exact_groups(odd_docs, capacity, key_of):
    got = exact_dedup.exact_groups(odd_docs, capacity, key_of)
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in got.collect()) == brute_groups(odd_docs)


def test_only_overfull_buckets_split(spark):
    # Half of the keys begin with three zero bits, the others are spread.
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 300).alias("text"))
    crowd = lambda body: F.when(F.xxhash64(body) % 2 == 0, F.shiftrightunsigned(F.xxhash64(body), 3)).otherwise(F.xxhash64(body))
    index = exact_dedup.build_index(docs, 20, crowd).collect()
    assert len(index) == 300 and sum(r.group_size for r in index) == 500
    load = collections.Counter()
    for r in index:
        load[r.bucket, r.depth] += r.group_size
        assert 0 <= r.chain < 1
    depths = {d for _, d in load}
    assert max(load.values()) <= 20 and len(load) == len({b for b, _ in load}) and len(depths) > 2
    # A bucket is a range of keys, and its parent would have been overfull.
    deepest = max(depths)
    prefixes = collections.Counter()
    for r in index:
        top = (r.key % (1 << 64)) >> (64 - deepest)
        assert top >> (deepest - r.depth) == r.bucket >> (deepest - r.depth)
        for d in range(deepest + 1):
            prefixes[d, top >> (deepest - d)] += r.group_size
    assert all(d == 0 or prefixes[d - 1, b >> (deepest - d + 1)] > 20 for b, d in load)


def test_texts_under_one_key_form_a_chain(spark):
    docs = spark.createDataFrame([(i, f"text {i % 7}") for i in range(40)], "doc_id BIGINT, text STRING")
    for capacity in (1, 1000):
        index = exact_dedup.build_index(docs, capacity, top_bits(0)).collect()
        assert sorted(r.chain for r in index) == list(range(7)) and {(r.bucket, r.depth) for r in index} == {(0, 0)}
        assert sorted(r.keep_id for r in index) == list(range(7))


def test_counts_and_ids_are_those_of_the_library(odd_docs):
    library = Tokenizer.from_file(BYTE)
    ids = {t: library.encode(t, add_special_tokens=False).ids for _, t in rows_of(odd_docs)}
    counted = token_counts.prefix_table(odd_docs, BYTE, ["doc_id", "text"]).collect()
    assert all((r.n_bytes, r.n_tokens) == (len((r.text or "").encode()), len(ids[r.text or ""])) for r in counted)
    texts = collections.defaultdict(list)
    for i, t in rows_of(odd_docs):
        texts[i].append((len(ids[t]), hashlib.sha256(",".join(map(str, ids[t])).encode()).hexdigest(),
                         hashlib.sha256(library.decode(ids[t], skip_special_tokens=False).encode()).hexdigest()))
    for r in bpe.round_trip(odd_docs, BYTE).collect():
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) in texts[r.doc_id]


def test_decoding_a_table_of_ids(spark, odd_docs):
    table = bpe.decode_documents(bpe.encode_documents(odd_docs, BYTE, ["doc_id", "text"]), BYTE)
    for r in table.collect():
        assert r.decoded == (r.text or "")
    loose = spark.createDataFrame([(1, None), (2, []), (3, [10**6])], "doc_id INT, ids ARRAY<INT>")
    assert {r.doc_id: r.decoded for r in bpe.decode_documents(loose, BYTE).collect()} == {1: None, 2: "", 3: ""}


@pytest.mark.parametrize("text", ["a  b\n\n c   ", "don't they're 'r", "x 日本́ \xa0\xa0y", "\n\n\n", "12  345 ab!! ??", " \t \r\n'll"])
def test_every_prefix_has_its_exact_count(text):
    library = Tokenizer.from_file(BYTE)
    counter, cache = token_counts._counter(BYTE)
    steps = counter.text_steps(text, cache)[1]
    for k in range(len(text) + 1):
        assert token_counts.tokens_at(steps, len(text[:k].encode())) == len(library.encode(text[:k], add_special_tokens=False).ids)
    for budget in range(6):
        fits = [k for k in range(len(text) + 1) if len(library.encode(text[:k], add_special_tokens=False).ids) <= budget]
        assert token_counts.longest_prefix(steps, text.encode(), budget) == len(text[: max(fits)].encode())


def test_truncation_over_a_table(odd_docs):
    table = token_counts.truncate(token_counts.prefix_table(odd_docs, BYTE, ["text"]), 3)
    assert {r.cut_bytes for r in table.where("text = 'one two three'").collect()} == {len("one two three")}


def test_rank_array_and_heap_agree():
    vocab = bpe.vocabulary(BYTE)
    for word in (b"internationalization", b"aaaaaaaaaaaa", "é日本".encode(), b" the", b"x" * 90, b"abcabcabc" * 9):
        assert vocab.merge_short(word) == vocab.merge_long(word)


def test_packing_places_every_id_once(odd_docs):
    library = Tokenizer.from_file(WORD)
    want = collections.Counter()
    for i, t in rows_of(odd_docs):
        want[i, tuple(library.encode(t, add_special_tokens=False).ids + [2])] += 1
    pieces = packing.pack(odd_docs, WORD, length=64).collect()
    used = collections.defaultdict(list)
    for p in pieces:
        assert len(p.ids) == 4 * p.length and p.length > 0
        used[p.sequence_id].append((p.offset, p.length))
    total = sum(p.length for p in pieces)
    for s, spans in used.items():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at == min(64, total - 64 * s)
    by_place = sorted(pieces, key=lambda p: (p.sequence_id, p.offset))
    got, held = collections.Counter(), []
    for p in by_place:
        assert p.start == len(held)
        held += np.frombuffer(bytes(p.ids), "<u4").tolist()
        if len(held) == p.doc_tokens:
            got[p.doc_id, tuple(held)] += 1
            held = []
    assert got == want


def shingles(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1)) if len(words) >= k else frozenset([tuple(words)] if words else [])


def brute_components(rows, k=3, percent=85):
    sets = {i: shingles(t, k) for i, t in rows if i is not None}
    label = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label, sets


def check_near(docs):
    label, sets = brute_components(rows_of(docs))
    for r in near_dedup.near_groups(docs).collect():
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), label[r.doc_id], label[r.doc_id] == r.doc_id)


def test_near_groups_on_odd_texts(odd_docs):
    check_near(odd_docs)


@pytest.mark.parametrize("small", [4, 256])
def test_near_groups_of_many_copies(spark, monkeypatch, small):
    """A large family of near copies, most too far from their source to be linked; split around hubs or not."""
    monkeypatch.setattr(near_dedup, "SMALL_GROUP", small)
    rng = np.random.RandomState(4)
    rows = []
    for i in range(160):
        words = [f"w{j}" for j in range(80)]
        for at in rng.randint(0, 80, rng.randint(0, 6)):
            words[at] = f"x{rng.randint(400)}"
        rows.append((i, " ".join(words[: 80 - 3 * (i % 5)])))
    rows += [(1000 + i, f"other text number {i} with words of its own {i * 7}") for i in range(20)]
    check_near(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"))


def test_table_keys_of_few_sets_a_task(spark, monkeypatch):
    """Sets that come in one partition make their keys in tasks of about SETS_A_TASK sets each, not in one."""
    monkeypatch.setattr(near_dedup, "SETS_A_TASK", 10, raising=False)
    docs = spark.createDataFrame([(i, f"text number {i} of some words {i % 7}") for i in range(50)], "doc_id BIGINT, text STRING")
    heads = near_dedup.signatures(docs).select(F.col("doc_id").alias("sid"), "n", "side_a", "side_b").coalesce(1)
    keys = near_dedup.table_keys(heads)
    counts = keys.rdd.glom().map(len).collect()
    assert sum(counts) == 50 * near_dedup.SIDE**2 and max(counts) <= 2 * 10 * near_dedup.SIDE**2


@pytest.mark.parametrize("hot, block, a_range", [(64, 4_000, 1_000_000), (2, 10, 500), (1, 7, 1_000_000)])
def test_crowded_keys(spark, monkeypatch, hot, block, a_range):
    """Keys sent as bytes to the owners of ranges: the members and sizes of all keys of two or more sets, hot ones too."""
    monkeypatch.setattr(near_dedup, "HOT_IN_BLOCK", hot, raising=False)
    monkeypatch.setattr(near_dedup, "SETS_A_BLOCK", block, raising=False)
    monkeypatch.setattr(near_dedup, "KEYS_A_RANGE", a_range, raising=False)
    words = [f"w{j}" for j in range(60)]
    rows = [(-i if i % 2 else i, " ".join(words[: 60 - i % 3] if i < 30 else [f"x{i}", *words[:40]])) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    heads = near_dedup.signatures(docs).withColumnRenamed("doc_id", "sid").localCheckpoint()
    members = collections.defaultdict(list)
    for r in near_dedup.table_keys(heads).collect():
        members[r.bucket].append(r.sid)
    want = sorted((b, i, len(ids)) for b, ids in members.items() if len(ids) > 1 for i in ids)
    assert sorted((r.bucket, r.sid, r.crowd) for r in near_dedup.crowded_keys(heads).collect()) == want and want
    none = near_dedup.crowded_keys(heads.where("n < 0"))
    assert none.count() == 0


def test_shingle_runs_are_the_sets():
    """Sets of many texts made at once equal those made one by one, in long, short and empty texts."""
    rng = np.random.RandomState(3)
    texts = [" ".join(f"w{j}" for j in rng.randint(0, 9, n)) for n in (0, 1, 2, 0, 3, 4, 50, 5, 400, 0, 2)]
    for width in (1, 3, 5):
        for some in (texts, texts[:1], texts[1:3], []):
            flat, counts = textkit.shingle_runs(some, width)
            sets = np.split(flat, np.cumsum(counts)[:-1]) if some else []
            assert [x.tolist() for x in sets] == [textkit.shingles_of(w, width).tolist() for w in textkit.words_of(some)]


def test_shared_counts_of_sets():
    rng = np.random.RandomState(5)
    x, y = ([np.unique(rng.randint(0, 40, rng.randint(0, 30))) for _ in range(50)] for _ in range(2))
    x[3] = y[3] = np.zeros(0, np.int64)
    x[-1] = y[-1] = x[0] = np.arange(4)
    columns = [pa.array(v, pa.list_(pa.int64())) for v in (x, y)]
    want = [len(np.intersect1d(a, b)) for a, b in zip(x, y)]
    assert near_dedup._shared(*columns).tolist() == want
    assert near_dedup._shared(*(c.slice(9, 20) for c in columns)).tolist() == want[9:29]
    assert near_dedup._shared(*(c.slice(0, 0) for c in columns)).tolist() == []


def brute_spans(text):
    found = []
    assign = re.compile("(?:(?ai:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
    for order, (kind, pattern, group, least) in enumerate((("assign", assign, 1, 8), ("access", re.compile("AKIA[A-Z0-9]+"), 0, 16), ("hex", re.compile("[0-9a-f]+"), 0, 32))):
        found += [(m.start(), order, m.end(), kind) for m in pattern.finditer(text) if len(m[group]) >= least]
    return [(s, e, k) for s, _, e, k in sorted(found)]


def test_secret_spans(spark, odd_docs):
    texts = {i: set() for i, _ in rows_of(odd_docs)}
    for i, t in rows_of(odd_docs):
        texts[i].add(tuple(brute_spans(t)))
    for r in secrets.scan_secrets(odd_docs, ["doc_id"]).collect():
        assert tuple((s["start"], s["end"], s["kind"]) for s in r.spans) in texts[r.doc_id]
    folder = "/root/testdata/sf0.01"
    have = {r.doc_id: r.spans for r in queries.op7_secrets(spark, folder).collect()}
    for i, t in rows_of(spark.read.parquet(f"{folder}/documents.parquet")):
        assert have[i] == ",".join(f"{k}:{s}:{e}" for s, e, k in brute_spans(t))


def test_ledger_scans_only_unseen_pairs(spark, odd_docs):
    versions = secrets.address(odd_docs)
    ledger = secrets.scan_unseen(versions)
    assert secrets.scan_unseen(versions, ledger).count() == 0
    newer = (secrets.RULES[0]._replace(version=2), *secrets.RULES[1:])
    again = secrets.scan_unseen(versions, ledger, newer)
    assert {(r.kind, r.version) for r in again.collect()} == {("assign", 2)}
    assert again.count() == versions.select("blob").distinct().count()


def test_a_second_run_scans_new_blobs_only(spark, odd_docs, tmp_path):
    path = str(tmp_path / "ledger")

    def run(docs):
        found = secrets.scan_secrets(docs, ["doc_id", "text"], path)
        for r in found.collect():
            assert [(s["start"], s["end"], s["kind"]) for s in r.spans] == brute_spans(r.text or "")
        return spark.read.parquet(path).count()

    blobs = secrets.address(odd_docs).select("blob").distinct().count()
    assert run(odd_docs) == 3 * blobs
    assert run(odd_docs) == 3 * blobs
    more = spark.createDataFrame([(900, "secret=brandnewvalue"), (901, "secret=brandnewvalue"), (902, "one two three")], "doc_id BIGINT, text STRING")
    assert run(odd_docs.select("doc_id", "text").unionByName(more)) == 3 * (blobs + 1)
    # What the ledger says is taken, not found again.
    address = secrets.address(more).first().blob
    spark.createDataFrame([(address, "hex", 1, [(1, 2)])], secrets.LEDGER_SCHEMA).write.mode("append").parquet(path)
    assert {len(r.spans) for r in secrets.scan_secrets(more, ["doc_id"], path).where("doc_id < 902").collect()} == {2}


def test_many_findings_in_one_text(spark):
    text = "".join(f"token={i:08d}é " for i in range(40_000))
    docs = spark.createDataFrame([(1, text)], "doc_id BIGINT, text STRING")
    begun = time.monotonic()
    r = secrets.scan_secrets(docs, ["doc_id", "text"]).select("spans", secrets.mask(F.col("text"), F.col("spans")).alias("m")).first()
    assert time.monotonic() - begun < 30
    assert [(s["start"], s["end"], s["kind"]) for s in r.spans] == brute_spans(text)
    assert r.m == "*" * 14 + ("é " + "*" * 14) * 39_999 + "é "


def test_masked_texts_hold_no_finding(odd_docs):
    found = secrets.scan_secrets(odd_docs, ["doc_id", "text"]).where(F.size("spans") > 0)
    masked = found.select("doc_id", "text", secrets.mask(F.col("text"), F.col("spans")).alias("m"))
    assert masked.count() >= 4
    assert all(len(r.m) == len(r.text) and not brute_spans(r.m) for r in masked.collect())


def brute_scores(rows):
    import math

    docs = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) for _, t in rows]
    one, two = [collections.Counter(d) for d in docs], [collections.Counter(zip(d, d[1:])) for d in docs]
    all1, all2 = sum(one, collections.Counter()), sum(two, collections.Counter())
    out = []
    for d, a, b in zip(docs, one, two):
        n, score = max(sum(all1.values()) - len(d), 1), 0.0
        for k, w in enumerate(d):
            pair = (d[k - 1], w) if k else None
            seen = all1[w] - a[w]
            if k and all2[pair] - b[pair] > 0:
                score += math.log(all2[pair] - b[pair]) - math.log(all1[pair[0]] - a[pair[0]])
            else:
                score += (math.log(0.4) if k else 0) + math.log(seen if seen else 0.4) - math.log(n)
        out.append((len(d), round(score, 4)))
    return out


def test_scores(odd_docs):
    want = sorted(brute_scores(rows_of(odd_docs)))
    got = sorted((r.n_words, round(r.log_score, 4)) for r in lm_scoring.score_documents(odd_docs).collect())
    assert [g[0] for g in got] == [w[0] for w in want]
    assert all(abs(g[1] - w[1]) < 1e-2 for g, w in zip(got, want))


@pytest.mark.parametrize("rows", [1, 2, 5, 39, 40, 41, 1000])
def test_permutation_and_its_inverse(spark, rows):
    place = spark.range(rows).select("id", sharding.permute(F.col("id"), rows, 3).alias("p"))
    both = place.select("id", "p", sharding.permute(F.col("p"), rows, 3, back=True).alias("b")).collect()
    assert sorted(r.p for r in both) == list(range(rows)) and all(r.b == r.id for r in both)


def test_shards(odd_docs):
    got = sharding.assign_shards(odd_docs, shards=7).collect()
    want = collections.Counter((i, len(t.encode()) + 16, zlib.crc32(t.encode())) for i, t in rows_of(odd_docs))
    assert collections.Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    again = sharding.assign_shards(odd_docs.repartition(5), shards=7).collect()
    key = lambda rows: sorted((str(r.doc_id), r.text_crc32, r.shard, r.slot) for r in rows)
    assert key(again) == key(got)


def test_neighbours(spark):
    rng = np.random.RandomState(5)
    v = rng.randn(1200, 16)
    rows = [(i, v[i].tolist()) for i in range(1200)] + [(2000 + i, v[7].tolist()) for i in range(300)]
    rows += [(1, v[1].tolist()), (3000, None), (3050, [0.0] * 16), (3100, [float("nan")] * 16), (3150, [1.0]), (3200, [None] * 16), (3250, [float("inf")] + [1.0] * 15)]
    table = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    ids = np.array([i for i, x in rows[:1500]])
    unit = np.array([x for _, x in rows[:1500]])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    got = collections.defaultdict(list)
    for r in neighbours.nearest(table).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert set(got) == {i for i in ids.tolist() if i % 50 == 0}
    hits = 0
    for q, found in got.items():
        sim = unit @ unit[np.flatnonzero(ids == q)[0]]
        want = sorted((-round(s, 9), i) for s, i in zip(sim, ids.tolist()) if i != q)[:5]
        hits += len({i for _, i in want} & {i for _, i, _ in found})
        assert sorted(r for r, _, _ in found) == [1, 2, 3, 4, 5]
        assert all(abs(s - sim[np.flatnonzero(ids == i)[0]]) < 1e-9 for _, i, s in found)
    assert hits >= 0.9 * 5 * len(got)
    few = neighbours.nearest(table.where("vec_id < 3")).collect()
    assert sorted((r.query_id, r.vec_id) for r in few) == [(0, 1), (0, 2)]
    assert neighbours.nearest(table.where("vec_id < 0")).collect() == []


def test_neighbours_over_many_parts(spark, monkeypatch):
    """Nodes dealt over many owners, whose mail goes as bytes: the graph and the searches are as exact as with one."""
    monkeypatch.setattr(neighbours, "NODES_A_PART", 40, raising=False)
    monkeypatch.setattr(neighbours, "MAIL_ROWS", 3, raising=False)
    v = np.random.RandomState(9).randn(300, 8)
    table = spark.createDataFrame([(i - 100, x.tolist()) for i, x in enumerate(v)], "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    codes = neighbours._codes(table.select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))).localCheckpoint()
    assert neighbours._parts(codes.count()) == 8
    edges = neighbours.build_graph(codes, 16, 8).collect()
    assert collections.Counter(r.id for r in edges) == {i - 100: 16 for i in range(300)}
    assert len({(r.id, r.near) for r in edges}) == len(edges) and all(abs(r.sim - unit[r.id + 100] @ unit[r.near + 100]) < 1e-9 for r in edges)
    want = [(q, rank, int(i) - 100) for q in (-100, -50, 0, 50, 100, 150) for rank, i in enumerate(np.argsort(-(unit @ unit[q + 100]))[1:6], 1)]
    got = sorted((r.query_id, r["rank"], r.vec_id) for r in neighbours.nearest(table).collect())
    assert len(set(got) & set(want)) >= 0.9 * len(want) and len(got) == len(want)


def test_best_of_each_owner():
    owner, item = np.array([7, 3, 7, 7, 3, 7]), np.array([2, 5, 1, 2, 4, 9])
    got = neighbours._best(owner, item, np.array([0.5, 0.1, 0.5, 0.4, 0.9, 0.2]), np.array([1, 1, 1, 0, 0, 1], np.uint8), 2)
    assert [x.tolist() for x in got] == [[3, 3, 7, 7], [4, 5, 1, 2], [0.9, 0.1, 0.5, 0.5], [0, 1, 1, 0]]
    assert [len(x) for x in neighbours._best(*(x[:0] for x in (owner, item, owner.astype(float), owner.astype(np.uint8))), 2)] == [0] * 4


def test_quality_against_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    kept = {r.doc_id: r.keep for r in queries.op9_quality(spark, folder).collect()}
    good, bad = [kept[i] for i in labels if labels[i]], [kept[i] for i in labels if not labels[i]]
    assert sum(good) / len(good) > 0.98 and sum(bad) / len(bad) < 0.1


def test_quality_of_odd_texts(odd_docs):
    got = {r.doc_id: r.keep for r in quality.quality(odd_docs, ["doc_id", "key"]).collect()}
    assert not got[0] and not got[1] and got[4]


def test_neighbour_search_ends_by_itself(spark):
    angles = np.arange(14) * 0.1
    vectors = spark.createDataFrame([(i, [float(np.cos(a)), float(np.sin(a))]) for i, a in enumerate(angles)], "id BIGINT, v ARRAY<DOUBLE>")
    codes = neighbours._codes(vectors)
    edges = spark.range(13).select("id", (F.col("id") + 1).alias("near"), F.lit(0.9).cast("float").alias("sim"))
    found = neighbours.greedy_search(spark.range(1), codes, edges)
    assert sorted(r.node for r in found.collect()) == list(range(14))
    with pytest.raises(RuntimeError):
        neighbours.greedy_search(spark.range(1), codes, edges, steps=3)


def test_neighbour_graph_must_settle(spark):
    vectors = np.random.default_rng(3).normal(0, 1, (150, 8))
    codes = neighbours._codes(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id BIGINT, v ARRAY<DOUBLE>"))
    with pytest.raises(RuntimeError):
        neighbours.build_graph(codes, 8, 4, rounds=1, changed=0.0)


def test_neighbours_among_nearly_equal_vectors(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(0, 1, (1500, 16))
    vectors[::3] = vectors[0] + rng.normal(0, 1e-4, (500, 16))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    got = collections.defaultdict(set)
    for r in neighbours.nearest(table, every=30).collect():
        got[r.query_id].add(r.vec_id)
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 1500, 30):
        sim = units @ units[q]
        sim[q] = -9
        hits += len(got[q] & set(np.argsort(-sim)[:5].tolist()))
    assert hits >= 0.9 * 5 * 50


def test_neighbours_of_any_magnitude_length_and_repeated_id(spark):
    rows = [(0, [1e-200, 2e-200]), (1, [2e-200, 1e-200]), (50, [1.0, 2.0]), (51, [1e200, 2e200]), (100, [1.0, 0.0, 0.0]), (101, [1.0, 1.0, 0.0]),
            (101, [0.0, 1.0, 0.0]), (150, [1.0]), (200, [5e-324, 0.0]), (200, [0.0, 1e308])]
    table = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    want = []
    for i, (q, x) in enumerate(rows):
        if q % 50 == 0:
            a = np.array(x) / np.max(np.abs(x))
            others = []
            for j, (c, y) in enumerate(rows):
                if j != i and len(y) == len(x):
                    b = np.array(y) / np.max(np.abs(y))
                    others.append((-round(float(a @ b / np.sqrt((a @ a) * (b @ b))), 9), c))
            want += [(q, rank, c, -s) for rank, (s, c) in enumerate(sorted(others)[:5], 1)]
    got = [(r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in neighbours.nearest(table).collect()]
    assert sorted(r[:2] + r[3:] for r in got) == sorted(r[:2] + r[3:] for r in want) and len(got) == len(want)
    assert {r[0] for r in got} == {0, 50, 100, 200}
