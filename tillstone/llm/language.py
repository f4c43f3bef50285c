"""Language identification: blended-spectrum presence kernel, Nyström landmarks, one-versus-rest kernel ridge regression."""

from __future__ import annotations

import unicodedata
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstone.llm.textkit import from_text, text_or_empty

# Presence of n-grams of 1 to SPECTRUM letters, hashed to this many places.
SPECTRUM = 3
SLOTS = 1 << 14
# Different texts the classifier is fitted on, dealt evenly to the languages but 8 each at least, and the landmarks among
# them, 2 each at least. Predictions cover all rows and whole texts.
FIT_TEXTS = 4096
LANDMARKS = 256
RIDGE = 1e-4
# Scores are a softmax of the regression values, sharpened by this.
SHARPNESS = 4.0
BATCH = 128
_STEP = np.uint32(0x9E3779B1)


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """Per code point: 2 for letters, 1 for marks, which belong to words, 0 for all else."""
    kinds = {"L": 2, "M": 1}
    return np.fromiter((kinds.get(unicodedata.category(chr(c))[0], 0) for c in range(0x110000)), np.uint8, 0x110000)


def presence(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A row of 0 and 1 per text, one place per hashed n-gram, and whether the text has a letter.

    Lower case; everything but letters and marks counts as one space between words, and a text begins with one.
    """
    low = [t.lower() for t in texts]
    code = np.frombuffer(("\n" + "\n".join(low) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    doc = np.repeat(np.arange(-1, len(low)), [1, *(len(t) + 1 for t in low)])
    kind = _kinds()[code]
    letters = np.zeros(len(low), bool)
    letters[doc[kind == 2]] = True
    code = np.where(kind > 0, code, np.uint32(32))
    blank = code == 32
    keep = np.ones(len(code), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    # What is left of a run of spaces is its first one, which stands before the next text too.
    code, doc = code[keep], doc[keep]
    out = np.zeros(len(low) * SLOTS, np.float32)
    value = np.full(len(code), np.uint32(1))
    for n in range(1, SPECTRUM + 1):
        m = len(code) - n + 1
        if m <= 0:
            break
        value = (value[:m] * _STEP + code[n - 1:]) * np.uint32(0x85EBCA6B)
        value ^= value >> np.uint32(13)
        last = doc[n - 1:]
        inside = (last >= 0) & (doc[1: m + 1] == last) if n > 1 else code != 32
        slot = (value[inside] * np.uint32(0xC2B2AE35)) >> np.uint32(32 - SLOTS.bit_length() + 1)
        out[last[inside] * SLOTS + slot] = 1
    return out.reshape(len(low), SLOTS), letters


def kernel(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Shared n-grams over the geometric mean of both numbers of n-grams; 0 where a side has none."""
    size = np.sqrt(np.outer(left.sum(1), right.sum(1)))
    return (left @ right.T) / np.maximum(size, 1)


class Model(NamedTuple):
    langs: list[str]
    landmarks: np.ndarray
    weights: np.ndarray

    def values(self, rows: np.ndarray) -> np.ndarray:
        """One regression value per text and language."""
        return kernel(rows, self.landmarks) @ self.weights


def fit_rows(rows: np.ndarray, langs: list[str], landmarks: np.ndarray, ridge: float = RIDGE) -> Model:
    """Nyström features z(x) = K(x, L) K(L, L)^(-1/2), then one ridge regression per language on +1 and -1.

    Both matrices are folded into one, so a text is scored by K(x, L) times `weights`.
    """
    names = sorted(set(langs))
    marks = rows[landmarks]
    value, vector = np.linalg.eigh(kernel(marks, marks).astype(np.float64))
    root = vector @ np.diag(1 / np.sqrt(np.maximum(value, 1e-6))) @ vector.T
    z = kernel(rows, marks).astype(np.float64) @ root
    target = np.where(np.array(langs)[:, None] == np.array(names)[None, :], 1.0, -1.0)
    beta = np.linalg.solve(z.T @ z + ridge * len(z) * np.eye(z.shape[1]), z.T @ target)
    return Model(names, marks, (root @ beta).astype(np.float32))


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text is a multiple of 5; a missing id counts as empty text and is held out."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def draw(docs: DataFrame, per_lang: int | None = None) -> DataFrame:
    """lang, h and text of the different texts with least hash h per language, of documents that are not held out."""
    usable = docs.where(~held_out() & F.col("lang").isNotNull()).select(F.col("lang").cast("string").alias("lang"), text_or_empty().alias("text"))
    usable = usable.where(F.col("text").rlike("\\p{L}")).withColumn("h", F.xxhash64("text"))
    # One row per language; its number of different texts says which share of the hash range holds enough of them.
    sizes = {r[0]: r[1] for r in usable.groupBy("lang").agg(F.approx_count_distinct("h")).collect()}
    per_lang = per_lang or max(8, FIT_TEXTS // max(1, len(sizes)))
    spread = F.pmod(F.xxhash64("h"), F.lit(1 << 30))
    shares = F.create_map(*(F.lit(x) for k, n in sizes.items() for x in (k, int(min(1.0, 3 * per_lang / max(n, 1)) * (1 << 30))))) if sizes else F.lit(None)
    some = usable.where(spread < F.element_at(shares, F.col("lang"))) if sizes else usable.limit(0)
    different = some.groupBy("lang", "h").agg(F.min("text").alias("text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    return different.withColumn("place", place).where(F.col("place") <= per_lang)


def fit(docs: DataFrame) -> Model | None:
    """The model of a corpus, from its texts and languages alone; None when no text has a language.

    Which texts are drawn depends on their hashes, not on ids or file layout.
    """

    def make(texts):
        parts = [presence(texts[at: at + BATCH]) for at in range(0, len(texts), BATCH)]
        return [pa.array([np.packbits(r > 0).tobytes() for rows, _ in parts for r in rows], pa.binary())]

    drawn = from_text(draw(docs), ["lang", "place"], "bits BINARY", make).orderBy("lang", "place").toArrow()
    if not drawn.num_rows:
        return None
    langs, place = drawn.column("lang").to_pylist(), drawn.column("place").to_numpy()
    rows = np.array([np.unpackbits(np.frombuffer(b, np.uint8)) for b in drawn.column("bits").to_pylist()]).astype(np.float32)
    return fit_rows(rows, langs, np.flatnonzero(place <= max(2, LANDMARKS // len(set(langs)))))


def classify(docs: DataFrame, model: Model | None, carry: list[str]) -> DataFrame:
    """carry columns, lang_pred and score (0 to 1) of every row: kernels of a batch of texts with all landmarks in one
    matrix product, times the weights."""
    packed = None if model is None else model._replace(landmarks=np.packbits(model.landmarks > 0, axis=1))

    def make():
        whole = None if packed is None else packed._replace(landmarks=np.unpackbits(packed.landmarks, axis=1).astype(np.float32))

        def work(texts):
            names, scores = [], []
            for at in range(0, len(texts), BATCH):
                rows, letters = presence(texts[at: at + BATCH])
                if whole is None:
                    names += ["und"] * len(rows)
                    scores += [0.0] * len(rows)
                    continue
                value = whole.values(rows)
                power = np.exp(SHARPNESS * (value - value.max(1, keepdims=True)))
                best = value.argmax(1)
                names += [whole.langs[k] if has else "und" for k, has in zip(best, letters)]
                scores += np.where(letters, 1 / power.sum(1), 0.0).tolist()
            return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]

        return work

    return from_text(docs, carry, "lang_pred STRING, score DOUBLE", make, per_task=True)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row.

    The model is fitted on texts and languages of documents that are not held out (see `held_out`); lang, source
    and doc_id never enter a prediction. A language needs one such text to be learned. Null and empty texts and texts
    without a letter get `und` and score 0, and so does every text when nothing can be learned. Equal texts get
    equal languages. Repeated rows are all returned; further columns are not read. An empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out().alias("held_out"), "text")
    return classify(rows, fit(docs), ["doc_id", "held_out"])
