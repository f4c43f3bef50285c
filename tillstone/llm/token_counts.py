"""Exact token counts at every prefix of a text, by dynamic programming over token ends."""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstone.llm.bpe import Vocabulary, WordCache, vocabulary
from tillstone.llm.textkit import from_text

_PAIRS = 1_000_000
# Fixed value: the white space of Unicode.
_BLANK = frozenset("\t\n\x0b\x0c\r \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B))))
_BLANK_RUN = re.compile(r"\s\s+")
# Contractions of the splitting pattern whose first two characters are no word by themselves.
_CONTRACTIONS = {"'re", "'ve", "'ll"}


class PrefixCounter:
    """Counts for one vocabulary: the last token of each prefix decides the count.

    The encoding of a prefix ends in the one token t whose pair with the encoding's last token before it
    stays unmerged when both are encoded together; then count(prefix) = count(prefix without t) + 1.
    """

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.finder = ahocorasick.Automaton()
        for i, data in vocab.bytes_of.items():
            if i not in vocab.special.values() and vocab.merge(data) == [i]:
                self.finder.add_word(data.decode("latin-1"), (i, len(data)))
        self.finder.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}

    def _stays(self, left: int, right: int) -> bool:
        known = self.pairs.get((left, right))
        if known is None:
            table = self.vocab.bytes_of
            known = self.vocab.merge(table[left] + table[right]) == [left, right]
            if len(self.pairs) >= _PAIRS:
                self.pairs.clear()
            self.pairs[left, right] = known
        return known

    def counts(self, data: bytes) -> np.ndarray:
        """Tokens of data[:1], data[:2], ... in one pass over the token ends."""
        last, count = [-1] * len(data), [0] * len(data)
        for end, (token, size) in self.finder.iter(data.decode("latin-1")):
            if last[end] < 0:
                begin = end - size
                if begin < 0:
                    last[end], count[end] = token, 1
                elif self._stays(last[begin], token):
                    last[end], count[end] = token, count[begin] + 1
        return np.asarray(count)

    def steps(self, word: str) -> tuple[int, bytes]:
        """Tokens of a word and the change of the count at each of its bytes, as signed bytes."""
        counts = self.counts(word.encode("utf-8"))
        if word in _CONTRACTIONS:
            counts[1] = 2
        return int(counts[-1]), np.diff(counts, prepend=0).astype(np.int8).tobytes()

    def text_steps(self, text: str, cache: WordCache) -> tuple[int, bytes]:
        total, out = 0, []
        for i, stretch in enumerate(self.vocab.segments(text)):
            if i % 2:
                total += 1
                out.append(bytes(len(stretch.encode()) - 1) + b"\x01")
                continue
            words = self.vocab.words(stretch)
            found = [cache[w] for w in words]
            total += sum([f[0] for f in found])
            made = b"".join([f[1] for f in found])
            out.append(self._whole_runs(stretch, words, made, cache) if _BLANK_RUN.search(stretch) else made)
        return total, b"".join(out)

    def _whole_runs(self, stretch: str, words: list[str], made: bytes, cache: WordCache) -> bytes:
        """A prefix that ends with a run of white space has that run as one word, though the whole text
        gives the last blank to the next word; mend the count at that one place."""
        steps = np.frombuffer(made, np.int8).astype(np.int64)
        counts = np.cumsum(steps)
        ends = np.cumsum([len(w.encode("utf-8")) for w in words])
        for k in range(1, len(words)):
            run = words[k - 1]
            if _BLANK.issuperset(run) and words[k][0] in _BLANK and not (len(words[k]) > 1 and _BLANK.issuperset(words[k])):
                start = int(ends[k - 1]) - len(run.encode("utf-8"))
                before = int(counts[start - 1]) if start else 0
                place = int(ends[k - 1]) + len(words[k][0].encode("utf-8")) - 1
                counts[place] = before + cache[run + words[k][0]][0]
        return np.diff(counts, prepend=0).astype(np.int8).tobytes()


@lru_cache(maxsize=2)
def _counter(path: str) -> tuple[PrefixCounter, WordCache]:
    counter = PrefixCounter(vocabulary(path))
    return counter, WordCache(counter.steps)


def prefix_table(docs: DataFrame, path: str, carry: list[str]) -> DataFrame:
    """carry columns, n_bytes, n_tokens and `steps`: per byte of the text the change of the token count.

    The running sum of `steps` at a character's last byte is the exact token count of the text cut
    there. A prefix that ends inside a special string counts that string as not begun. Null and empty
    texts have 0 bytes, 0 tokens and empty steps. Repeated rows each get a row; texts are never cut.
    """

    def make(texts):
        counter, cache = _counter(path)
        made = [counter.text_steps(t, cache) for t in texts]
        return [
            pa.array([len(t.encode("utf-8")) for t in texts], pa.int64()),
            pa.array([m[0] for m in made], pa.int64()),
            pa.array([m[1] for m in made], pa.binary()),
        ]

    return from_text(docs, carry, "n_bytes BIGINT, n_tokens BIGINT, steps BINARY", make)


def tokens_at(steps: bytes, size: int) -> int:
    """Tokens of the first `size` bytes."""
    return int(np.frombuffer(steps, np.int8)[:size].astype(np.int64).sum())


def longest_prefix(steps: bytes, text: bytes, budget: int) -> int:
    """Bytes of the longest prefix, in whole characters, with at most `budget` tokens."""
    counts = np.cumsum(np.frombuffer(steps, np.int8).astype(np.int64))
    raw = np.frombuffer(text, np.uint8)
    ends = np.append((raw[1:] & 0xC0) != 0x80, True) if len(raw) else np.zeros(0, bool)
    fits = np.flatnonzero(ends & (counts <= budget))
    return int(fits[-1]) + 1 if len(fits) else 0


def truncate(table: DataFrame, budget: int) -> DataFrame:
    """Add `cut_bytes`, the longest prefix within the budget, to a prefix table that carries `text`.

    The stored steps answer this; nothing is encoded again.
    """
    schema = T.StructType([*table.schema.fields, T.StructField("cut_bytes", T.LongType())])

    def run(batches):
        for batch in batches:
            steps = batch.column(batch.schema.get_field_index("steps")).to_pylist()
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            cut = [longest_prefix(s, (t or "").encode("utf-8"), budget) for s, t in zip(steps, texts)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cut, pa.int64())], names=[*batch.schema.names, "cut_bytes"])

    return table.mapInArrow(run, schema)


def over_budget(budget: int) -> Column:
    return F.col("n_tokens") > budget
