"""Phrase collocations by Toivonen mining: a sample proposes phrases, full passes count them and their negative border."""

from __future__ import annotations

import math
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstone.llm import textkit
from tillstone.llm.textkit import chain, mix, text_or_empty
from tillstone.session import cut_lineage

# Words a task counts at a time, and about how many phrases an owner of a hash range gets.
BLOCK_WORDS = 1 << 21
OWNER_PHRASES = 1 << 20
# Blocks whose phrases one owner sums; with more blocks than that, owners' sums are added up once more.
PART_BLOCKS = 4096
# Bits of a level's membership map, the only thing that is broadcast: 4 MB a level, whatever the corpus.
MAP_BITS = 1 << 25
# Share of the documents in the sample, and how often a phrase must be in it to be proposed.
SAMPLE_SHARE = 1 / 8
SAMPLE_COUNT = 2

_PIECE_END = np.zeros(256, bool)
_PIECE_END[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_NO_WORD = _PIECE_END.copy()
_NO_WORD[[0x20, 0x09]] = True
_LOWER = bytes(textkit._LOWER)


class Words(NamedTuple):
    """Words of a stretch of bytes. `joined` says whether a word follows its predecessor within a piece; `open` whether
    the next stretch goes on in the same piece."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    joined: np.ndarray
    open: bool


def scan(data: bytes, open_before: bool, seed: int) -> Words:
    """Words of lower-cased bytes that begin and end at word borders."""
    raw = np.frombuffer(data, np.uint8)
    edge = np.flatnonzero(np.diff(np.concatenate(([True], _NO_WORD[raw], [True])).astype(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    power, inverse = textkit._table(len(raw))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[: len(raw)])))
    body = (total[ends] - total[starts]) * inverse[starts]
    hashes = mix(body + mix((ends - starts).astype(np.uint64) + np.uint64(seed << 40)))
    breaks = np.concatenate(([0], np.cumsum(_PIECE_END[raw])))
    at_word = breaks[starts]
    joined = np.diff(at_word, prepend=0) == 0
    if len(joined) and not open_before:
        joined[0] = False
    after = breaks[-1] == (at_word[-1] if len(at_word) else 0)
    return Words(starts, ends, hashes, joined, bool(after and (open_before or len(starts))))


def _windows(data: bytes):
    """A long text in stretches of about textkit.PIECE_BYTES, cut behind a byte that belongs to no word."""
    at, size = 0, textkit.PIECE_BYTES
    while len(data) - at > size:
        end = at + size
        while end < len(data) and not _NO_WORD[data[end - 1]]:
            end += 1
        yield data[at:end]
        at = end
    yield data[at:]


class Proposed(NamedTuple):
    """Membership maps of the proposed phrases of 1, 2, .. words: now, and in the pass before (None in the first).

    A map has one bit per hash value of a phrase, so it may hold more than was proposed, never less; a phrase that
    is in by chance is counted for nothing, which changes no count.
    """

    before: list[np.ndarray] | None
    now: list[np.ndarray]


def _holds(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64(len(bits) * 64 - 1)
    return (bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) != 0


def lang_hash(lang: str) -> np.uint64:
    return mix(np.array([zlib.crc32(lang.encode("utf-8", "surrogatepass"))], np.uint64))[0]


def phrase_hash(lang: str, words: list[np.ndarray]) -> np.ndarray:
    return chain([np.full(len(words[0]), lang_hash(lang), np.uint64), *words])


def _summed(hashes: np.ndarray, words: list[np.ndarray], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows that stand for the different phrases, ordered by hash, and the sums of their counts."""
    order = np.argsort(hashes, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = hashes[order[1:]] != hashes[order[:-1]]
    other = np.zeros(max(len(order) - 1, 0), bool)
    for w in words:
        other |= w[order[1:]] != w[order[:-1]]
    if (other & ~new[1:]).any():
        # Two phrases share a 64-bit hash: order by the words themselves.
        order = np.lexsort((*words[::-1], hashes))
        for w in (hashes, *words):
            new[1:] |= w[order[1:]] != w[order[:-1]]
    first = np.flatnonzero(new)
    return order[first], np.add.reduceat(counts[order], first) if len(first) else counts[:0]


class _Run:
    """Words of one language in a block. The last words of a full block are kept in front, so that no phrase is torn."""

    def __init__(self, keep: int):
        self.keep = keep
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.buffers: list[bytes] = []
        self.size = 0
        self.carried = 0

    def add(self, words: Words, data: bytes) -> None:
        self.parts.append((words.hashes, words.joined, words.starts + self.size, words.ends + self.size))
        self.buffers.append(data)
        self.size += len(data)

    def take(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes, int]:
        hashes, joined, starts, ends = (np.concatenate(x) for x in zip(*self.parts))
        data, carried = b"".join(self.buffers), self.carried
        self.carried = min(self.keep, len(hashes))
        tail = slice(len(hashes) - self.carried, None)
        self.parts = [(hashes[tail], joined[tail], np.zeros(self.carried, np.int64), np.zeros(self.carried, np.int64))]
        self.buffers, self.size = [], 0
        return hashes, joined, starts, ends, data, carried


_COUNTED = "size INT, bucket BIGINT, part BIGINT, lang STRING, words ARRAY<BINARY>, counts BINARY, known BINARY, texts ARRAY<STRING>"
_NAMES = [f.split()[0] for f in _COUNTED.split(", ")]
_KINDS = [pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.binary()), pa.binary(), pa.binary(), pa.list_(pa.string())]


class _Counter:
    """Counts phrases block by block: all words, and each longer phrase whose two parts, without the last and without
    the first word, are proposed now but were not both so before. Without proposals every phrase is counted."""

    def __init__(self, max_words: int, bits: int, seed: int, proposed: Proposed | None):
        self.max_words, self.bits, self.seed, self.proposed = max_words, bits, seed, proposed
        self.runs: dict[str, _Run] = {}
        self.held = self.blocks = 0
        self.task = TaskContext.get().partitionId()

    def read(self, lang: str, texts: list[bytes]):
        """Take in texts of a language, kept apart by line feeds; full blocks come out as batches."""
        open_ = False
        for window in _windows(b"\n".join(texts)):
            words = scan(window, open_, self.seed)
            open_ = words.open
            if len(words.starts):
                self.runs.setdefault(lang, _Run(self.max_words - 1)).add(words, window)
                self.held += len(words.starts)
            if self.held >= BLOCK_WORDS:
                yield from self.flush()

    def flush(self):
        rows: dict[str, list] = {n: [] for n in _NAMES}
        part = int(mix(np.array([self.task << 24 | self.blocks], np.uint64))[0] >> np.uint64(1))
        for lang, run in self.runs.items():
            self._phrases(lang, run, part, rows)
        self.held, self.blocks = 0, self.blocks + 1
        for at in range(0, len(rows["size"]), 512):
            yield pa.RecordBatch.from_arrays([pa.array(v[at: at + 512], k) for v, k in zip(rows.values(), _KINDS)], names=_NAMES)

    def _phrases(self, lang: str, run: _Run, part: int, rows: dict[str, list]) -> None:
        hashes, joined, starts, ends, data, carried = run.take()
        n = len(hashes)
        maps = {} if self.proposed is None else {"now": self.proposed.now} | ({"before": self.proposed.before} if self.proposed.before else {})
        known: dict[str, np.ndarray] = {}
        for size in range(1, min(self.max_words, n) + 1):
            m = n - size + 1
            words = [hashes[i: m + i] for i in range(size)]
            inside = np.logical_and.reduce([joined[i: m + i] for i in range(1, size)]) if size > 1 else np.ones(m, bool)
            counted = {name: inside & held[:m] & held[1:] for name, held in known.items()} if size > 1 else dict.fromkeys(maps, inside)
            whole = phrase_hash(lang, words)
            known = {name: counted[name] & _holds(maps[name][size - 1], whole) for name in maps if size < self.max_words}
            new = counted.get("now", inside) & ~counted["before"] if "before" in maps else counted.get("now", inside)
            use = np.flatnonzero(new & (np.arange(m) + size > carried))
            at, counts = _summed(whole[use], [w[use] for w in words], np.ones(len(use), np.int64))
            at = use[at]
            if not len(at):
                continue
            bucket = whole[at] >> np.uint64(64 - self.bits)
            cuts = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist(), len(at)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                # Ordered by the first words, equal ones stand together and compress well.
                order = np.argsort(words[0][at[a:b]], kind="stable")
                place = at[a:b][order]
                rows["size"].append(size), rows["bucket"].append(int(bucket[a])), rows["part"].append(part), rows["lang"].append(lang)
                rows["words"].append([w[place].tobytes() for w in words])
                rows["counts"].append(counts[a:b][order].tobytes())
                rows["known"].append(known["now"][place].tobytes() if "now" in known else bytes(len(place)))
                texts = [data[s:e].decode("utf-8", "replace") for s, e in zip(starts[place].tolist(), ends[place].tolist())] if size == 1 else []
                rows["texts"].append(texts)


def _count(max_words: int, bits: int, seed: int, shared):
    def run(batches):
        counter = _Counter(max_words, bits, seed, None if shared is None else shared.value)
        for batch in batches:
            # Short texts of a language are scanned together.
            pending: dict[str, list[bytes]] = {}
            size = 0
            for lang, text in zip(batch.column(0), batch.column(1)):
                data = text.as_py().encode("utf-8", "surrogatepass").translate(_LOWER)
                pending.setdefault(lang.as_py(), []).append(data)
                size += len(data)
                if size >= textkit.PIECE_BYTES:
                    for name in pending:
                        yield from counter.read(name, pending[name])
                    pending, size = {}, 0
            for name in pending:
                yield from counter.read(name, pending[name])
        if counter.held:
            yield from counter.flush()

    return run


_OWNED = "lang STRING, size INT, phrase BINARY, n BIGINT, known BOOLEAN, word STRING, clash BOOLEAN"


def _binary(words: list[np.ndarray]) -> pa.Array:
    """A phrase as the hashes of its words, eight bytes each."""
    flat, width = np.column_stack(words).astype("<u8"), 8 * len(words)
    offsets = np.arange(len(flat) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(flat), [None, pa.py_buffer(offsets), pa.py_buffer(flat.tobytes())])


def _own(least: int):
    """The owner of a hash range: sums of its phrases over blocks, those below `least` left out, and how many words
    there are per language as size 0."""

    def run(key, table):
        size = key[0].as_py()
        langs = table.column("lang").to_pylist()
        out = []
        for lang in sorted(set(langs)):
            part = table.filter(pa.array([x == lang for x in langs]))
            blobs = part.column("words").to_pylist()
            words = [np.concatenate([np.frombuffer(b[i], np.uint64) for b in blobs]) for i in range(size)]
            counts = np.concatenate([np.frombuffer(b, np.int64) for b in part.column("counts").to_pylist()])
            known = np.concatenate([np.frombuffer(b, bool) for b in part.column("known").to_pylist()])
            hashes = phrase_hash(lang, words)
            at, sums = _summed(hashes, words, counts)
            clash = np.zeros(len(at), bool)
            texts = None
            if size == 1:
                texts = np.array([t for row in part.column("texts").to_pylist() for t in row], object)
                owner = np.searchsorted(hashes[at], hashes)
                clash[owner[texts != texts[at][owner]]] = True
                out.append(pa.table([[lang], pa.array([0], pa.int32()), [b""], [int(counts.sum())], [True], pa.array([None], pa.string()), [False]], names=_OWNED_NAMES))
            keep = (sums >= least) | clash
            n = int(keep.sum())
            out.append(pa.Table.from_arrays([
                pa.array([lang] * n, pa.string()), pa.array(np.full(n, size, np.int32)), _binary([w[at[keep]] for w in words]), pa.array(sums[keep]),
                pa.array(known[at[keep]]), pa.array(texts[at[keep]].tolist() if size == 1 else [None] * n, pa.string()), pa.array(clash[keep]),
            ], names=_OWNED_NAMES))
        return pa.concat_tables(out)

    return run


_OWNED_NAMES = [f.split()[0] for f in _OWNED.split(", ")]


def _map_bits(batches):
    """Where the bit of each phrase is: level, 64-bit place of the map, bit."""
    for batch in batches:
        langs, sizes = batch.column(0).to_pylist(), batch.column(1).to_numpy()
        phrases = batch.column(2).to_pylist()
        at = np.zeros(len(langs), np.uint64)
        groups: dict[tuple, list[int]] = {}
        for i, k in enumerate(zip(langs, sizes.tolist())):
            groups.setdefault(k, []).append(i)
        for (lang, size), rows in groups.items():
            words = np.frombuffer(b"".join(phrases[i] for i in rows), "<u8").reshape(-1, size)
            at[rows] = phrase_hash(lang, [np.ascontiguousarray(words[:, i]) for i in range(size)])
        at &= np.uint64(MAP_BITS - 1)
        bits = np.uint64(1) << (at & np.uint64(63))
        yield pa.RecordBatch.from_arrays(
            [batch.column(1), pa.array((at >> np.uint64(6)).astype(np.int64)), pa.array(bits.view(np.int64))], names=["size", "place", "bits"]
        )


def _maps(phrases: DataFrame, max_words: int) -> list[np.ndarray]:
    """Membership maps per level; (max_words - 1) * MAP_BITS bits come to the driver, however many phrases there are."""
    placed = phrases.select("lang", "size", "phrase").mapInArrow(_map_bits, "size INT, place BIGINT, bits BIGINT")
    table = placed.groupBy("size", "place").agg(F.bit_or("bits").alias("bits")).toArrow()
    maps = [np.zeros(MAP_BITS // 64, np.uint64) for _ in range(max_words - 1)]
    size, place, bits = (table.column(i).to_numpy() for i in range(3))
    for k, held in enumerate(maps, 1):
        held[place[size == k]] = bits[size == k].view(np.uint64)
    return maps


class _Clash(Exception):
    """Two words have one hash."""


class _Miner:
    """Passes over one corpus with the same word hashes."""

    def __init__(self, docs: DataFrame, max_words: int, least: int, seed: int):
        self.max_words, self.least, self.seed = max_words, least, seed
        self.lean = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_or_empty().alias("text"))
        size = self.lean.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        self.bits = max(6, math.ceil(math.log2(max(1, size / 6 / OWNER_PHRASES))))
        self.parts = max(1, math.ceil(size / 6 / BLOCK_WORDS / PART_BLOCKS))

    def count(self, docs: DataFrame, proposed: Proposed | None, least: int) -> DataFrame:
        """Phrases of `docs` with at least `least` occurrences, words per language as size 0; written to the shared folder."""
        shared = None if proposed is None else docs.sparkSession.sparkContext.broadcast(proposed)
        blocks = docs.mapInArrow(_count(self.max_words, self.bits, self.seed, shared), _COUNTED)
        owned = blocks.withColumn("part", F.pmod("part", F.lit(self.parts))).groupBy("size", "bucket", "part").applyInArrow(_own(least if self.parts == 1 else 1), _OWNED)
        n_words = F.col("size") == 0
        first, last = F.min("word"), F.max("word")
        sums = [F.sum("n").alias("n"), F.max("known").alias("known"), first.alias("word"), (F.max("clash") | (F.coalesce(first, F.lit("")) != F.coalesce(last, F.lit("")))).alias("clash")]
        if self.parts > 1:
            owned = owned.groupBy("lang", "size", "phrase").agg(*sums)
        out = cut_lineage(owned.where(n_words | (F.col("n") >= least) | F.col("clash")))
        if shared is not None:
            shared.unpersist()
        if out.where("clash").limit(1).count():
            raise _Clash
        return out

    def mine(self, share: float) -> DataFrame:
        """lang, size, phrase, n, word of every phrase with at least `least` occurrences, counted exactly."""
        draw = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 30)) < int(share * (1 << 30))
        shorter = F.col("size").between(1, self.max_words - 1)
        proposed = Proposed(None, _maps(self.count(self.lean.where(draw), None, SAMPLE_COUNT).where(shorter), self.max_words))
        passes = []
        while True:
            passes.append(self.count(self.lean, proposed, self.least))
            # Frequent phrases of the negative border: what they start or end was not counted yet.
            failed = passes[-1].where(shorter & ~F.col("known") & (F.col("n") >= self.least))
            if not failed.limit(1).count():
                break
            more = _maps(failed, self.max_words)
            proposed = Proposed(proposed.now, [a | b for a, b in zip(proposed.now, more)])
        whole = passes[0]
        for more in passes[1:]:
            whole = whole.unionByName(more)
        return whole


def frequent_phrases(docs: DataFrame, max_words: int = 3, least: int = 10, share: float = SAMPLE_SHARE) -> DataFrame:
    """lang, size, phrase, n and word of every phrase of up to max_words words that occurs at least `least` times in its
    language. phrase holds a hash of eight bytes per word, word the text of a single word. Rows of size 0 have the
    number of words per language.

    Toivonen's method: what a sample holds SAMPLE_COUNT times is proposed. A pass over all documents counts every
    phrase of which both parts that are one word shorter are proposed, that is the proposed phrases and their
    negative border, both exactly. As long as a phrase of the border turns out frequent, another pass counts
    what this adds. The sample decides how many passes there are, not what they find.

    Words are compared by 64-bit hashes that are checked against the words' texts; should two words share a hash, all is
    done again with other hashes.
    """
    for seed in range(8):
        try:
            return _Miner(docs, max_words, least, seed).mine(share)
        except _Clash:
            continue
    raise RuntimeError("words with equal hashes under eight hash functions")


def _words(phrase: str, start: Column | int, size: Column) -> Column:
    return F.substr(F.col(phrase), F.lit(start) * 8 + 1 if isinstance(start, int) else start * 8 + 1, size * 8)


def score(a: str, l: str, r: str, scale: int) -> Column:
    """floor(scale * a * a / (l * r)) without rounding; counts up to 10^16 and a scale up to 10^6 fit into 38 digits."""

    def digits(name: str) -> Column:
        return F.col(name).cast("decimal(16,0)")

    return F.call_function("div", digits(a) * digits(a) * F.lit(scale).cast("decimal(7,0)"), digits(l) * digits(r)).cast("bigint")


def collocations(
    docs: DataFrame, max_words: int = 3, least: int = 10, best: int = 2000, covered: int = 50, scale: int = 1_000_000, share: float = SAMPLE_SHARE
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score: the `best` phrases of each language.

    Texts are lower-cased from A to Z and split into pieces at . , ; : ! ? and line ends, pieces into words at spaces and
    tabs. A candidate has 2 to max_words words of one piece and a >= least occurrences; cut after its
    first k words into parts with l and r occurrences it scores floor(scale * a * a / (l * r)), the least over k
    (ties: least k). A candidate that lies within a longer one with at least `covered` per cent of its
    occurrences is dropped. Order: score, a, phrase. n: words of the language.

    A null language counts as `und`. Null and empty texts have no words; repeated rows count each. A text in
    one piece of any length is read whole. Other columns are not read. An empty table gives no rows.
    """
    mined = cut_lineage(frequent_phrases(docs, max_words, least, share))
    frequent = mined.where("size > 0").select("lang", "size", "phrase", "n", "word")
    totals = mined.where("size = 0").groupBy("lang").agg(F.sum("n").alias("n"))
    candidates = frequent.where("size > 1").select("lang", "size", "phrase", F.col("n").alias("a"))

    counts = frequent.select(F.col("lang").alias("of"), F.col("phrase").alias("part"), F.col("n").alias("times"))
    cut = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cut = cut.withColumns({"first": _words("phrase", 0, F.col("k")), "rest": _words("phrase", F.col("k"), F.col("size") - F.col("k"))})
    left = counts.withColumnsRenamed({"times": "l"})
    right = counts.select(F.col("of").alias("of_r"), F.col("part").alias("part_r"), F.col("times").alias("r"))
    cut = cut.join(left, (F.col("lang") == F.col("of")) & (F.col("first") == F.col("part")))
    cut = cut.join(right, (F.col("lang") == F.col("of_r")) & (F.col("rest") == F.col("part_r")))
    # Counts up to 10^16 stay exact in 38 digits.
    scored = cut.withColumn("score", score("a", "l", "r", scale)).groupBy("lang", "size", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("least"))
    scored = scored.select("lang", "size", "phrase", "a", "least.l", "least.r", "least.score")

    spans = [(start, size) for size in range(2, max_words) for start in range(max_words - size + 1)]
    if spans:
        inner = F.array(*(F.struct(F.lit(start).alias("start"), F.lit(size).alias("words")) for start, size in spans))
        longer = candidates.withColumn("at", F.explode(F.filter(inner, lambda x: (x["words"] < F.col("size")) & (x["start"] + x["words"] <= F.col("size")))))
        longer = longer.select(F.col("lang").alias("of"), _words("phrase", F.col("at.start"), F.col("at.words")).alias("part"), F.col("a").alias("within"))
        longer = longer.groupBy("of", "part").agg(F.max("within").alias("within"))
        scored = scored.join(longer, (F.col("lang") == F.col("of")) & (F.col("phrase") == F.col("part")), "left")
        scored = scored.where(F.col("within").isNull() | (100 * F.col("within") < covered * F.col("a"))).drop("of", "part", "within")

    # Ties are kept until the texts of the words are there to break them.
    place = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc())
    leading = scored.withColumn("place", F.rank().over(place)).where(F.col("place") <= best).drop("place")
    texts = frequent.where("size = 1").select(F.col("lang").alias("of"), F.col("phrase").alias("hash"), "word")
    spelt = leading.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("size") - 1)))
    spelt = spelt.withColumn("part", _words("phrase", F.col("i"), F.lit(1)))
    spelt = spelt.join(texts, (F.col("lang") == F.col("of")) & (F.col("part") == F.col("hash")))
    in_order = F.array_sort(F.collect_list(F.struct("i", "word")))
    spelt = spelt.groupBy("lang", "phrase", "a", "l", "r", "score").agg(F.array_join(F.transform(in_order, lambda x: x["word"]), " ").alias("text"))
    last = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "text")
    ranked = spelt.withColumn("rank", F.row_number().over(last).cast("bigint")).where(F.col("rank") <= best)
    return ranked.join(totals, "lang").select("lang", "rank", F.col("text").alias("phrase"), "a", "l", "r", "n", "score")
