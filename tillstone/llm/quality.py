"""Quality classifier: noisy labellers weighed by expectation-maximisation train a hashed linear scorer."""

from __future__ import annotations

import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstone.llm.textkit import from_text, mix, words_of

# Documents the linear scorer is fitted on (a bound; votes, accuracies and scores cover all documents).
SAMPLE_ROWS = 4096
DIMENSIONS = 1024
THRESHOLD = 0.4
# What the labellers are built for: wrong about at most 3 good documents in 1000, each aimed at few kinds of bad ones.
RIGHT_GOOD, RIGHT_BAD = 0.997, 0.35

LABELLERS = ("case", "symbols", "exclamations", "columns", "repeats", "variety", "sentences", "plain")
_UPPER = np.arange(65, 91)
_LETTER = np.concatenate((np.arange(65, 91), np.arange(97, 123), np.arange(0x80, 0x100)))
_PLAIN = np.concatenate((_LETTER, np.frombuffer(b" \n\t.,;:'-\"()+=/_@?0123456789", np.uint8)))
_SYMBOL = np.array([ord(c) for c in "!#$%&*+/<=>@\\^_`{|}~"])


class Measures(NamedTuple):
    words: int
    letters: int
    upper: int
    symbols: int
    bangs: int
    bars: int
    stops: int
    repeats: int
    different: int
    plain: float


def measure(data: bytes, words: np.ndarray) -> Measures:
    seen = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    return Measures(
        len(words), int(seen[_LETTER].sum()), int(seen[_UPPER].sum()), int(seen[_SYMBOL].sum()), int(seen[ord("!")]),
        int(seen[ord("|")]), int(seen[[ord(c) for c in ".?!"]].sum()), int((words[1:] == words[:-1]).sum()), len(np.unique(words)),
        int(seen[_PLAIN].sum()) / max(len(data), 1),
    )


def votes(m: Measures) -> list[int]:
    """One vote per labeller: 1 good, -1 bad, 0 no opinion. Short texts get few opinions."""
    if m.words < 5 or not m.letters:
        return [0] * len(LABELLERS)
    upper, per_word = m.upper / m.letters, 1 / m.words
    long = m.words >= 30
    different = m.different / min(m.words, 200)
    stops = m.words / max(m.stops, 1)

    def judge(good: bool, bad: bool) -> int:
        return int(good) - int(bad)

    return [
        judge(upper < 0.15, upper > 0.5),
        judge(m.symbols * per_word < 0.05, m.symbols * per_word > 0.3),
        judge(m.bangs * per_word < 0.1, m.bangs * per_word > 0.3),
        judge(m.bars * per_word < 0.05, m.bars * per_word > 0.2),
        judge(m.repeats * per_word < 0.05, m.repeats * per_word > 0.25),
        judge(long and different > 0.5, long and m.different * per_word < 0.15 and different < 0.3),
        judge(stops < 40 and not m.bangs * per_word > 0.3, long and stops > 120),
        judge(m.plain > 0.95, m.plain < 0.85),
    ]


def features(data: bytes, words: np.ndarray) -> np.ndarray:
    """Hashed counts of byte pairs (letters as lower, upper or other letter), repeats and variety."""
    raw = np.frombuffer(data, np.uint8)
    out = np.zeros(DIMENSIONS, np.float32)
    if len(raw) > 1:
        pairs = raw[:-1].astype(np.uint16) * np.uint16(256) + raw[1:]
        out += np.sqrt(np.bincount(_PAIR_SLOT[pairs], minlength=DIMENSIONS) / len(pairs)).astype(np.float32)
    if len(words) > 1:
        repeat = float((words[1:] == words[:-1]).mean())
        different = len(np.unique(words)) / min(len(words), 200)
        out[_slot(f"repeat {min(9, int(repeat * 10))}")] += 1
        out[_slot(f"different {min(9, int(different * 10))}")] += 1
    return out


def _slot(name: str) -> int:
    return zlib.crc32(name.encode()) % DIMENSIONS


def _pair_slots() -> np.ndarray:
    """A slot per byte pair; lower-case letters and bytes of other letters count as one kind each."""
    kind = np.arange(256)
    kind[97:123] = 97
    kind[65:91] = 65
    kind[48:58] = 48
    kind[0x80:] = 0x80
    both = (kind[:, None] * 256 + kind[None, :]).ravel().astype(np.uint64)
    return (mix(both + np.uint64(0xABCDEF)) % np.uint64(DIMENSIONS)).astype(np.int64)


_PAIR_SLOT = _pair_slots()


class LabelModel(NamedTuple):
    """Share of good documents and, per labeller with an opinion, how often it is right about good and about bad ones."""

    share: float
    right_good: list[float]
    right_bad: list[float]

    def posterior(self, votes_: np.ndarray) -> np.ndarray:
        good, bad = np.asarray(self.right_good), np.asarray(self.right_bad)
        odds = np.log(self.share / (1 - self.share))
        odds = odds + (votes_ > 0) @ np.log(good / (1 - bad)) + (votes_ < 0) @ np.log((1 - good) / bad)
        return 1 / (1 + np.exp(-odds))


def cast_votes(docs: DataFrame, carry: list[str]) -> DataFrame:
    def make(texts):
        rows = [votes(measure(t.encode("utf-8", "surrogatepass"), w)) for t, w in zip(texts, words_of(texts))]
        return [pa.array([",".join(map(str, r)) for r in rows], pa.string())]

    return from_text(docs, carry, "votes STRING", make)


def fit_label_model(patterns: list[tuple[str, int]], rounds: int = 50) -> LabelModel:
    """Expectation-maximisation over vote patterns and their counts in the whole corpus.

    A good vote never speaks against a document, and half of the documents at least count as good: one that only
    gets good votes is never taken for bad, however few bad ones there are.
    """
    start = LabelModel(0.9, [0.998] * len(LABELLERS), [0.2] * len(LABELLERS))
    if not patterns:
        return start
    table = np.array([[int(x) for x in p.split(",")] for p, _ in patterns], float)
    count = np.array([c for _, c in patterns], float)
    good = np.where((table < 0).any(axis=1), 0.1, 0.95)
    for _ in range(rounds):
        def rate(weight: np.ndarray, side: np.ndarray, prior: float) -> np.ndarray:
            held = (count * weight)[:, None]
            return ((held * side).sum(0) + 4 * prior) / ((held * (table != 0)).sum(0) + 4)

        right_good = np.clip(rate(good, table > 0, 0.998), RIGHT_GOOD, 0.999)
        right_bad = np.clip(np.maximum(rate(1 - good, table < 0, 0.2), 1 - right_good), 0.001, RIGHT_BAD)
        share = float(np.clip((count * good).sum() / count.sum(), 0.5, 0.99))
        model = LabelModel(share, right_good.tolist(), right_bad.tolist())
        good = model.posterior(table)
    return model


def fit_scorer(rows: np.ndarray, target: np.ndarray, steps: int = 400, ridge: float = 1e-4) -> np.ndarray:
    """Logistic regression on soft labels; both classes weigh the same. The last weight is the bias."""
    x = np.hstack((rows, np.ones((len(rows), 1), np.float32))).astype(np.float32)
    weight = target / max(target.sum(), 1e-6) + (1 - target) / max((1 - target).sum(), 1e-6)
    weight = (weight / weight.sum()).astype(np.float32)
    w, speed = np.zeros(x.shape[1], np.float32), np.zeros(x.shape[1], np.float32)
    for _ in range(steps):
        ahead = w + 0.9 * speed
        p = 1 / (1 + np.exp(-(x @ ahead)))
        slope = x.T @ (weight * (p - target)) + ridge * ahead
        speed = 0.9 * speed - 1.0 * slope
        w = w + speed
    return w


class Fitted(NamedTuple):
    labels: LabelModel
    weights: np.ndarray


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Fitted:
    """Fit both models without any true label.

    Votes of all documents come to the driver as counts per pattern, 3 ** labellers of them at most. The
    scorer is fitted on about `sample_rows` documents spread over the corpus, 2 * sample_rows at most.
    """
    patterns = [(r[0], r[1]) for r in cast_votes(docs, []).groupBy("votes").count().collect()]
    labels = fit_label_model(patterns)
    total = sum(n for _, n in patterns)
    if not total:
        return Fitted(labels, np.zeros(DIMENSIONS + 1, np.float32))
    # A place in the table, not an id or a text, decides, so copies are sampled like all else.
    share = min(1.0, sample_rows / total)
    draw = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 30)) < int(share * (1 << 30)) + 1

    def make(texts):
        made = [(t.encode("utf-8", "surrogatepass"), w) for t, w in zip(texts, words_of(texts))]
        return [
            pa.array([votes(measure(*m)) for m in made], pa.list_(pa.int32())),
            pa.array([features(*m).tobytes() for m in made], pa.binary()),
        ]

    drawn = from_text(docs.select("text").where(draw), [], "votes ARRAY<INT>, features BINARY", make).limit(2 * sample_rows).collect()
    rows = np.array([np.frombuffer(bytes(r[1]), np.float32) for r in drawn]).reshape(-1, DIMENSIONS)
    target = labels.posterior(np.array([r[0] for r in drawn], float).reshape(-1, len(LABELLERS))).astype(np.float32)
    return Fitted(labels, fit_scorer(rows, target))


def classify(docs: DataFrame, fitted: Fitted, carry: list[str], threshold: float = THRESHOLD) -> DataFrame:
    """carry columns, posterior (of the label model), score (of the linear scorer) and keep.

    Null and empty texts have no features; they get the posterior of no votes, score 0 and are not kept. Texts
    with fewer than five words are kept whatever their score, as no labeller judges them.
    Repeated rows get equal scores; extra columns are passed on only when carried.
    """
    labels, weights = fitted

    def make(texts):
        posterior, score, keep = [], [], []
        for text, words in zip(texts, words_of(texts)):
            data = text.encode("utf-8", "surrogatepass")
            cast = votes(measure(data, words))
            posterior.append(float(labels.posterior(np.array([cast], float))[0]))
            linear = float(1 / (1 + np.exp(-(features(data, words) @ weights[:-1] + weights[-1])))) if len(words) else 0.0
            score.append(linear)
            keep.append(bool(len(words)) and (len(words) < 5 or linear >= threshold))
        return [pa.array(posterior, pa.float64()), pa.array(score, pa.float64()), pa.array(keep, pa.bool_())]

    return from_text(docs, carry, "posterior DOUBLE, score DOUBLE, keep BOOLEAN", make)


def quality(docs: DataFrame, carry: list[str]) -> DataFrame:
    return classify(docs, fit(docs), carry)
