"""Helpers the operators share: words of a text as 64-bit hashes, and rows in and out of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts are hashed in pieces of about this many bytes, so a long text costs no more memory than short ones.
PIECE_BYTES = 1 << 20
# Rows of an Arrow batch worked on at a time, and the bytes of text after which a slice ends before that.
SLICE_ROWS = 512
SLICE_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_WEIGHT = _LOWER.astype(np.uint64) + np.uint64(1)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chain(parts: list[np.ndarray]) -> np.ndarray:
    """Hash of a sequence of hashes, position by position over equally long arrays."""
    out = np.full(len(parts[0]), len(parts), np.uint64)
    for part in parts:
        out = mix(out * _BASE + part)
    return out


def _table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, PIECE_BYTES + 64)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for k, base in enumerate((_BASE, inverse)):
            row = np.full(size, base, np.uint64)
            row[0] = 1
            _powers[k] = np.cumprod(row)
    return _powers[0], _powers[1]


def _piece_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of a piece that begins and ends at word borders."""
    raw = np.frombuffer(data, np.uint8)
    blank = np.ones(len(raw) + 2, bool)
    np.take(_SPACE, raw, out=blank[1:-1])
    edge = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edge[0::2], edge[1::2]
    power, inverse = _table(len(raw))
    total = np.zeros(len(raw) + 1, np.uint64)
    weights = _WEIGHT[raw]
    np.multiply(weights, power[: len(raw)], out=weights)
    np.cumsum(weights, out=total[1:])
    body = (total[ends] - total[starts]) * inverse[starts]
    return starts, mix(body + mix((ends - starts).astype(np.uint64)))


def _pieces(data: bytes) -> Iterator[bytes]:
    at = 0
    while len(data) - at > PIECE_BYTES:
        window = _SPACE[np.frombuffer(data, np.uint8, PIECE_BYTES, at)]
        cut = np.flatnonzero(window)
        if len(cut):
            end = at + int(cut[-1]) + 1
        else:
            later = (data.find(bytes([c]), at + PIECE_BYTES) for c in np.flatnonzero(_SPACE))
            end = min((x for x in later if x >= 0), default=len(data) - 1) + 1
        yield data[at:end]
        at = end
    yield data[at:]


def words_of(texts: list[str]) -> list[np.ndarray]:
    """Per text the hashes of its words, in order.

    Words are runs without space, tab, line feed, vertical tab, form feed and carriage return; A to Z
    count as a to z. Words are compared by 64-bit hashes.
    """
    out: list[np.ndarray] = []
    held: list[bytes] = []
    size = 0

    def flush() -> None:
        nonlocal size
        if held:
            borders = np.cumsum([0, *(len(x) + 1 for x in held)])
            starts, hashes = _piece_words(b" ".join(held))
            cuts = np.searchsorted(starts, borders)
            out.extend(hashes[a:b] for a, b in zip(cuts[:-1], cuts[1:]))
            held.clear()
            size = 0

    for text in texts:
        data = (text or "").encode("utf-8", "surrogatepass")
        if len(data) > PIECE_BYTES:
            flush()
            out.append(np.concatenate([_piece_words(p)[1] for p in _pieces(data)]))
        else:
            held.append(data)
            size += len(data)
            if size > PIECE_BYTES:
                flush()
    flush()
    return out


def shingles_of(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of `width` words in a row; a shorter text is one shingle, an empty one none."""
    if not len(words):
        return words
    width = min(width, len(words))
    return np.unique(chain([words[i: len(words) - width + 1 + i] for i in range(width)]))


def shingle_runs(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The sets of `shingles_of` for all texts, one behind the other, and how many hashes each has."""
    words = words_of(texts)
    have = np.array([len(w) for w in words], np.int64)
    counts = np.where(have >= width, have - width + 1, np.minimum(have, 1))
    ends = np.cumsum(counts)
    flat = np.empty(int(ends[-1]) if len(ends) else 0, np.uint64)
    joined = np.concatenate(words) if words else flat
    if len(joined) >= width:
        # A window is one text's own if it ends within the text it begins in.
        own = np.repeat(have >= width, have)
        borders = np.cumsum(have)[have >= width]
        for back in range(1, width):
            own[borders - back] = False
        own = own[: len(joined) - width + 1]
        flat[np.repeat(have >= width, counts)] = chain([joined[i: len(joined) - width + 1 + i] for i in range(width)])[own]
    for i in np.flatnonzero((have > 0) & (have < width)):
        flat[ends[i] - 1] = chain([words[i][k: k + 1] for k in range(have[i])])[0]
    first = np.ones(len(flat), bool)
    for at, end in zip((ends - counts).tolist(), ends.tolist()):
        flat[at:end].sort()
    np.not_equal(flat[1:], flat[:-1], out=first[1:])
    full = counts > 0
    first[(ends - counts)[full]] = True
    if full.any():
        counts[full] = np.add.reduceat(first, (ends - counts)[full], dtype=np.int64)
    return flat[first], counts


def runs(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Hashes one behind the other as a list<long> column, so many in each row."""
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(flat.astype(np.uint64, copy=False).view(np.int64)))


def longs(values: list[np.ndarray]) -> pa.Array:
    """Hash arrays as a list<long> column."""
    return runs(np.concatenate(values) if values else np.zeros(0, np.uint64), np.array([len(v) for v in values], np.int64))


def slices_of(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Start and length of slices of at most SLICE_ROWS texts and SLICE_BYTES bytes; a longer text is one by itself."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(ends):
        before = int(ends[at - 1]) if at else 0
        stop = max(at + 1, min(at + SLICE_ROWS, int(np.searchsorted(ends, before + SLICE_BYTES, "right"))))
        yield at, stop - at
        at = stop


def from_text(frame: DataFrame, carry: list[str], schema: str, make, per_task: bool = False) -> DataFrame:
    """Apply `make(texts) -> list of Arrow columns` to the text column, batch by batch.

    With `per_task`, make() is called once in each task and gives the function to apply, which may keep a state.

    `schema` names the new columns; `carry` columns are passed on. A null text counts as empty. Only
    the carried columns and the text reach Python; a text that is carried itself goes there once.
    """
    as_it_is = "text" in carry and frame.schema["text"].dataType == T.StringType()
    picked = frame.select(*carry) if as_it_is else frame.select(*carry, text_or_empty().alias("_text"))
    place = carry.index("text") if as_it_is else len(carry)
    made = T.StructType.fromDDL(schema)
    fields = [*picked.schema.fields[: len(carry)], *made.fields]

    def run(batches):
        work = make() if per_task else make
        for whole in batches:
            for at, length in slices_of(whole.column(place)):
                batch = whole.slice(at, length)
                columns = work([text or "" for text in batch.column(place).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[: len(carry)], *columns], [*batch.schema.names[: len(carry)], *made.fieldNames()]
                )

    return picked.mapInArrow(run, T.StructType(fields))
