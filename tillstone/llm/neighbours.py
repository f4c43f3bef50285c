"""Approximate nearest neighbours: NN-descent graph by Spark joins, queries by greedy graph search."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstone.llm.textkit import mix
from tillstone.session import cut_lineage

# Neighbours of a node, neighbours from the other direction that join in, and pairs a node of a neighbourhood
# hands on per round.
DEGREE = 32
REVERSE = 16
HANDED = 4
# The graph is ready when a round replaces at most this share of its edges; a graph that still changes more
# after ROUNDS rounds is an error.
CHANGED = 0.005
ROUNDS = 60
# Nodes a search keeps, and steps after which a search that has not ended is an error.
BEAM = 256
STEPS = 500
# Nodes that one part owns, rows of mail in a batch, and neighbourhoods compared at a time.
NODES_A_PART = 2_000
MAIL_ROWS = 256
GROUPS_AT_ONCE = 64


def usable(vectors: DataFrame, vec: str = "embedding") -> DataFrame:
    """vec_id and v (array<double>) of the rows that take part.

    Left out: null vectors or ids, null or non-finite components, and zero vectors.
    """
    v = F.col(vec).cast("array<double>")
    big = F.lit(float("inf"))
    fine = F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < big)) & F.exists("v", lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("v"))
    return rows.where(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False)))


def _stored(vectors: DataFrame, vec: str = "embedding") -> str:
    """The type that holds the components without loss: four bytes for a column of floats, else eight."""
    return "<f4" if vectors.schema[vec].dataType.simpleString() == "array<float>" else "<f8"


def _codes(nodes: DataFrame, stored: str = "<f8") -> DataFrame:
    """id and code: the vector's components as bytes."""

    def run(batches):
        for batch in batches:
            column = batch.column(1)
            rows = np.asarray(column.flatten()).reshape(len(column), -1) if len(column) else np.zeros((0, 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([c.tobytes() for c in rows.astype(stored)], pa.binary())], names=["id", "code"])

    return nodes.select("id", "v").mapInArrow(run, "id BIGINT, code BINARY")


def _units(codes: list[bytes], stored: str, n: int | None = None) -> np.ndarray:
    """Directions in double precision, so that cosines of nearly equal vectors still differ; n of them, or one a code."""
    rows = np.frombuffer(b"".join(codes), stored).reshape(len(codes) if n is None else n, -1).astype(np.float64)
    rows /= np.abs(rows).max(axis=1, keepdims=True, initial=1e-300)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _compare_within(groups: DataFrame, handed: int, stored: str) -> DataFrame:
    """Compare the members of each neighbourhood with each other: (id, near, sim) for the best of each
    member, as far as better than the worst neighbour it has."""

    def compare(g, own, floor, codes):
        ids, near, sims = [], [], []
        units = _units(codes, stored)
        ends = [*(np.flatnonzero(np.diff(g)) + 1), len(g)]
        for at, end in zip([0, *ends], ends):
            if end - at < 2:
                continue
            members, u = own[at:end], units[at:end]
            sim = u @ u.T
            np.fill_diagonal(sim, -9)
            k = min(handed, end - at - 1)
            best = np.argpartition(-sim, k - 1, axis=1)[:, :k]
            value = np.take_along_axis(sim, best, 1)
            keep = value > floor[at:end, None]
            ids.append(np.repeat(members, keep.sum(axis=1))), near.append(members[best][keep]), sims.append(value[keep])
        flat = [np.concatenate(x) if x else np.zeros(0) for x in (ids, near, sims)]
        return pa.RecordBatch.from_arrays([pa.array(flat[0].astype(np.int64)), pa.array(flat[1].astype(np.int64)), pa.array(flat[2])], names=["id", "near", "sim"])

    def run(batches):
        # Rows come sorted by g; the last neighbourhood of a batch waits for the next batch.
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            g, own, floor = (np.asarray(batch.column(batch.schema.get_field_index(c))) for c in ("g", "id", "floor"))
            codes = batch.column(batch.schema.get_field_index("code")).to_pylist()
            if held is not None:
                g, own, floor = (np.concatenate(x) for x in zip(held[:3], (g, own, floor)))
                codes = held[3] + codes
            cut = int(np.searchsorted(g, g[-1]))
            if cut:
                yield compare(g[:cut], own[:cut], floor[:cut], codes[:cut])
            held = g[cut:], own[cut:], floor[cut:], codes[cut:]
        if held is not None:
            yield compare(*held)

    dealt = groups.select("g", "id", "floor", "code").repartition("g").sortWithinPartitions("g")
    return dealt.mapInArrow(run, "id BIGINT, near BIGINT, sim DOUBLE")


# Mail between parts of the nodes: numbers and vectors go as bytes, one row for all that a part has for another.
MAIL = "part INT, kind INT, src INT, a BINARY, b BINARY, c BINARY, d BINARY"
POINTS, EDGES, BACK, PLACES, WISHES, VECTORS, FOUND, KEPT, EXPAND, LISTS, ASKED = range(11)


def _owner(ids: np.ndarray, parts: int) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(np.uint64)) % np.uint64(parts)).astype(np.int32)


def _post(kind: int, src: int, parts: int, to: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """One row for each part that `to` (ids) falls to, with its share of the columns."""
    owners = _owner(to, parts)
    order = np.argsort(owners, kind="stable")
    cuts = np.searchsorted(owners[order], np.arange(parts + 1))
    columns = [c[order] for c in columns]
    for part in np.unique(owners).tolist():
        share = [c[cuts[part]:cuts[part + 1]].tobytes() for c in columns]
        yield (part, kind, src, *share, *[b""] * (4 - len(share)))


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int32(), pa.int32(), pa.int32(), *[pa.binary()] * 4]
    rows = iter(rows)
    while some := list(islice(rows, MAIL_ROWS)):
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*some), kinds)], names=["part", "kind", "src", "a", "b", "c", "d"])


def _at_parts(mail: DataFrame, parts: int, step: Callable) -> DataFrame:
    """step(part, {kind: [(src, a, b, c, d)]}) gives rows of mail; it is called once for each part that has mail."""

    def run(batches):
        # Rows come sorted by part; a part's step waits until all its mail is there.
        held, now = defaultdict(list), None
        for batch in batches:
            for part, kind, *rest in zip(*(c.to_pylist() for c in batch.columns)):
                if held and part != now:
                    yield from _batches(step(now, held))
                    held = defaultdict(list)
                now = part
                held[kind].append(rest)
        if held:
            yield from _batches(step(now, held))

    return mail.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(run, MAIL)


def _joined(rows: list, *kinds) -> list[np.ndarray]:
    """The columns a, b, ... of some mail, each put together."""
    return [np.frombuffer(b"".join(r[i + 1] for r in rows), kind) for i, kind in enumerate(kinds)]


def _pack(frame: DataFrame, kind: int, parts: int, types: tuple) -> DataFrame:
    """Mail of the frame's rows to the owners of its first column."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                columns = [np.asarray(c, t) for c, t in zip(batch.columns, types)]
                yield from _batches(_post(kind, 0, parts, columns[0], *columns))

    return frame.mapInArrow(run, MAIL)


def _pack_points(codes: DataFrame, parts: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                code = batch.column(1).to_pylist()
                yield from _batches(_post(POINTS, 0, parts, np.asarray(batch.column(0)), np.asarray(batch.column(0)), np.array(code, f"V{len(code[0])}")))

    return codes.select("id", "code").mapInArrow(run, MAIL)


def _unpack(mail: DataFrame, names: list[str]) -> DataFrame:
    def run(batches):
        for batch in batches:
            for a, b, c in zip(*(batch.column(i).to_pylist() for i in range(3, 6))):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(x, t)) for x, t in ((a, np.int64), (b, np.int64), (c, np.float64))], names=names)

    return mail.mapInArrow(run, f"{names[0]} BIGINT, {names[1]} BIGINT, {names[2]} DOUBLE")


def _points_of(rows: list, stored: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted ids and directions of a part's own nodes, or of those it was sent."""
    if not rows:
        return np.zeros(0, np.int64), np.zeros((0, 1))
    ids = np.concatenate([np.frombuffer(r[1], np.int64) for r in rows])
    order = np.argsort(ids)
    return ids[order], _units([r[2] for r in rows], stored, len(ids))[order]


def _first_of_each(sorted_by: np.ndarray, n: int) -> np.ndarray:
    """Marks the first n rows of each run of equal values."""
    starts = np.flatnonzero(np.concatenate(([True], sorted_by[1:] != sorted_by[:-1]))) if len(sorted_by) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, len(sorted_by)))
    return np.arange(len(sorted_by)) - np.repeat(starts, sizes) < n


def _best(owner: np.ndarray, item: np.ndarray, sim: np.ndarray, flag: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
    """The n of each owner with the largest sim, ties to the smaller item; an item met twice is one, with its smallest flag."""
    order = np.lexsort((flag, item, owner))
    owner, item, sim, flag = owner[order], item[order], sim[order], flag[order]
    first = np.ones(len(owner), bool)
    first[1:] = (owner[1:] != owner[:-1]) | (item[1:] != item[:-1])
    if len(owner):
        sim = np.maximum.reduceat(sim, np.flatnonzero(first))
    owner, item, flag = owner[first], item[first], flag[first]
    order = np.lexsort((item, -sim, owner))
    order = order[_first_of_each(owner[order], n)]
    return owner[order], item[order], sim[order], flag[order]


def _forget_shuffles(frame: DataFrame) -> None:
    """Let Spark delete the shuffle files of finished rounds, else they stay until the driver collects its garbage."""
    frame.sparkSession._jvm.System.gc()


def _floors(held: dict, ids: np.ndarray, degree: int) -> np.ndarray:
    """What a new neighbour of each node must exceed: its worst one, if it has `degree` of them."""
    owner, _, sim = _joined(held[EDGES], np.int64, np.int64, np.float64)
    low, n = np.full(len(ids), np.inf), np.zeros(len(ids), np.int64)
    at = np.searchsorted(ids, owner)
    np.minimum.at(low, at, sim)
    np.add.at(n, at, 1)
    return np.where(n >= degree, low, -2.0)


def _merge(degree: int):
    def step(part, held):
        old, new = (_joined(held[k], np.int64, np.int64, np.float64) for k in (EDGES, FOUND))
        flag = np.repeat(np.array([0, 1], np.uint8), [len(old[0]), len(new[0])])
        owner, item, sim, flag = _best(*(np.concatenate(x) for x in zip(old, new)), flag, degree)
        yield part, EDGES, int(flag.sum()), owner.tobytes(), item.tobytes(), sim.tobytes(), b""

    return step


def _turn_back(parts: int):
    """Mail of each edge to the owner of its end."""

    def run(batches):
        for batch in batches:
            for part, a, b in zip(*(batch.column(i).to_pylist() for i in (0, 3, 4))):
                near = np.frombuffer(b, np.int64)
                yield from _batches(_post(BACK, part, parts, near, near, np.frombuffer(a, np.int64)))

    return run


def _gather(parts: int, reverse: int, turn: int):
    """Members of the neighbourhoods of a part's nodes, kept for the part, and wishes for their vectors."""

    def step(part, held):
        own = np.concatenate([np.frombuffer(r[1], np.int64) for r in held[POINTS]]) if held[POINTS] else np.zeros(0, np.int64)
        node, near, _ = _joined(held[EDGES], np.int64, np.int64, np.float64)
        end, start = _joined(held[BACK], np.int64, np.int64)
        drawn = mix(start.view(np.uint64) ^ mix(np.full(1, turn, np.uint64)))
        order = np.lexsort((start, drawn, end))
        order = order[_first_of_each(end[order], reverse)]
        g, member = np.concatenate((node, end[order], own)), np.concatenate((near, start[order], own))
        order = np.lexsort((member, g))
        g, member = g[order], member[order]
        once = np.ones(len(g), bool)
        once[1:] = (g[1:] != g[:-1]) | (member[1:] != member[:-1])
        g, member = g[once], member[once]
        yield part, PLACES, part, g.tobytes(), member.tobytes(), b"", b""
        wished = np.unique(member)
        yield from _post(WISHES, part, parts, wished, wished)

    return step


def _send_vectors(degree: int, size: int):
    def step(part, held):
        ids = np.concatenate([np.frombuffer(r[1], np.int64) for r in held[POINTS]])
        rows = np.frombuffer(b"".join(r[2] for r in held[POINTS]), f"V{size}")
        order = np.argsort(ids)
        ids, rows = ids[order], rows[order]
        floors = _floors(held, ids, degree)
        for src, wish, *_ in held[WISHES]:
            at = np.searchsorted(ids, np.frombuffer(wish, np.int64))
            yield src, VECTORS, part, wish, rows[at].tobytes(), floors[at].tobytes(), b""

    return step


def _compare(parts: int, stored: str):
    """Compare the members of each neighbourhood with each other and hand on the best of each member, as far as
    better than the worst neighbour it has."""

    def step(part, held):
        ids = np.concatenate([np.frombuffer(r[1], np.int64) for r in held[VECTORS]])
        floors = np.concatenate([np.frombuffer(r[3], np.float64) for r in held[VECTORS]])[np.argsort(ids)]
        ids, units = _points_of(held[VECTORS], stored)
        g, member = _joined(held[PLACES], np.int64, np.int64)
        at = np.searchsorted(ids, member)
        starts = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1])))
        sizes = np.diff(np.append(starts, len(g)))
        out = []
        for i in range(0, len(starts), GROUPS_AT_ONCE):
            n = sizes[i:i + GROUPS_AT_ONCE]
            if n.max() < 2:
                continue
            place = np.arange(n.max())
            there = place < n[:, None]
            members = at[np.where(there, starts[i:i + GROUPS_AT_ONCE, None] + place, 0)]
            u = units[members]
            sim = u @ u.transpose(0, 2, 1)
            sim[np.broadcast_to(~there[:, None, :], sim.shape)] = -9
            sim[:, place, place] = -9
            k = min(HANDED, int(n.max()) - 1)
            best = np.argpartition(-sim, k - 1, axis=2)[:, :, :k]
            value = np.take_along_axis(sim, best, 2)
            keep = (value > floors[members][:, :, None]) & (value > -9) & there[:, :, None]
            owner = np.broadcast_to(members[:, :, None], keep.shape)[keep]
            out.append((owner, np.take_along_axis(members[:, None, :], best.reshape(len(n), 1, -1), 2).reshape(best.shape)[keep], value[keep]))
        if out:
            owner, near, sim = (np.concatenate(x) for x in zip(*out))
            # The same pair met in several neighbourhoods goes once.
            _, once = np.unique(owner * len(ids) + near, return_index=True)
            owner, near, sim = ids[owner[once]], ids[near[once]], sim[once]
            yield from _post(FOUND, part, parts, owner, owner, near, sim)

    return step


def _parts(total: int) -> int:
    return max(1, -(-total // NODES_A_PART))


def build_graph(codes: DataFrame, degree: int = DEGREE, reverse: int = REVERSE, rounds: int = ROUNDS, changed: float = CHANGED, stored: str = "<f8") -> DataFrame:
    """Edges (id, near, sim) of the neighbour graph.

    It starts from random groups. Each round joins every node with its neighbours and with some nodes that
    have it as a neighbour, compares these neighbours with each other, and keeps the best `degree` of each
    node. Nodes taken from the other direction are drawn by hash, `reverse` per node and round: the sample
    is part of NN-descent, and the search later compares what it missed. Rounds go on until one brings at
    most the share `changed` of new edges; `rounds` only guards against a graph that never settles.

    Nodes are owned by parts of about NODES_A_PART of them. Edges, wishes for vectors and vectors go between
    parts as bytes; a vector goes to a part once in a round, however many of its neighbourhoods have it.
    """
    total = codes.count()
    crowds, parts = max(1, total // (degree + 1)), _parts(total)
    none = F.lit(-2.0).alias("floor")
    found = None
    for seed in range(2):
        dealt = codes.select(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(crowds)).alias("g"), "id", "code", none)
        some = _compare_within(dealt, degree, stored)
        found = some if found is None else found.unionAll(some)
    edges = cut_lineage(_at_parts(_pack(found, FOUND, parts, (np.int64, np.int64, np.float64)), parts, _merge(degree)))
    if crowds == 1:
        return _unpack(edges, ["id", "near", "sim"])
    points = cut_lineage(_pack_points(codes, parts))
    size = len(codes.first()["code"])
    for turn in range(rounds):
        gathered = cut_lineage(_at_parts(points.unionAll(edges).unionAll(edges.mapInArrow(_turn_back(parts), MAIL)), parts, _gather(parts, reverse, turn)))
        wishes, places = (gathered.where(F.col("kind") == kind) for kind in (WISHES, PLACES))
        vectors = _at_parts(points.unionAll(edges).unionAll(wishes), parts, _send_vectors(degree, size))
        handed = _at_parts(places.unionAll(vectors), parts, _compare(parts, stored))
        edges = cut_lineage(_at_parts(edges.unionAll(handed), parts, _merge(degree)))
        _forget_shuffles(codes)
        fresh, held = edges.agg(F.sum("src"), F.sum(F.octet_length("a")) / 8).first()
        if fresh <= changed * held:
            return _unpack(edges, ["id", "near", "sim"])
    raise RuntimeError(f"the neighbour graph still changes after {rounds} rounds")


def _expand(parts: int):
    """Mail of the kept nodes that were not expanded to their owners."""

    def run(batches):
        for batch in batches:
            for part, a, b, d in zip(*(batch.column(i).to_pylist() for i in (0, 3, 4, 6))):
                due = np.frombuffer(d, np.uint8) == 0
                q, node = (np.frombuffer(x, np.int64)[due] for x in (a, b))
                if len(q):
                    yield from _batches(_post(EXPAND, part, parts, node, q, node))

    return run


def _list_neighbours(part, held):
    node, near, _ = _joined(held[EDGES], np.int64, np.int64, np.float64)
    order = np.argsort(node, kind="stable")
    node, near = node[order], near[order]
    for src, *row in held[EXPAND]:
        q, at = (np.frombuffer(x, np.int64) for x in row[:2])
        first, last = np.searchsorted(node, at), np.searchsorted(node, at, "right")
        n = last - first
        place = np.arange(int(n.sum())) + np.repeat(first - (np.cumsum(n) - n), n)
        if len(place):
            yield src, LISTS, part, np.repeat(q, n).tobytes(), near[place].tobytes(), b"", b""


def _ask(parts: int, beam: int):
    """Mail of each (query, node) that a step meets and does not keep, with the queries' vectors and floors."""

    def step(part, held):
        q, node = _joined(held[LISTS], np.int64, np.int64)
        if not len(q):
            return
        kept_q, kept, sim = _joined(held[KEPT], np.int64, np.int64, np.float64)
        # Kept ones come first, so that a pair met again is not the first of its kind.
        met = np.concatenate((kept_q, q)), np.concatenate((kept, node)), np.repeat([0, 1], [len(kept_q), len(q)])
        order = np.lexsort(met[::-1])
        all_q, all_node, fresh = (x[order] for x in met)
        first = np.ones(len(order), bool)
        first[1:] = (all_q[1:] != all_q[:-1]) | (all_node[1:] != all_node[:-1])
        due = first & (fresh == 1)
        q, node = all_q[due], all_node[due]
        asked, at = np.unique(q, return_inverse=True)
        low, n = np.full(len(asked), np.inf), np.zeros(len(asked), np.int64)
        place = np.searchsorted(asked, kept_q)
        mine = (place < len(asked)) & (asked[np.minimum(place, len(asked) - 1)] == kept_q) if len(asked) else np.zeros(len(kept_q), bool)
        np.minimum.at(low, place[mine], sim[mine])
        np.add.at(n, place[mine], 1)
        floors = np.where(n >= beam, low, -2.0)
        ids = np.concatenate([np.frombuffer(r[1], np.int64) for r in held[POINTS]])
        codes = [r[2] for r in held[POINTS]]
        rows = np.frombuffer(b"".join(codes), f"V{sum(map(len, codes)) // len(ids)}")
        order = np.argsort(ids)
        rows = rows[order][np.searchsorted(ids[order], asked)]
        for to, kind, src, share_at, share_node, *_ in _post(ASKED, part, parts, node, at, node):
            some, local = np.unique(np.frombuffer(share_at, np.int64), return_inverse=True)
            yield to, kind, src, np.stack((asked[some], floors[some].view(np.int64))).tobytes(), rows[some].tobytes(), local.astype(np.int64).tobytes(), share_node

    return step


def _measure(stored: str):
    def step(part, held):
        ids, units = _points_of(held[POINTS], stored)
        for src, *row in held[ASKED]:
            asked, floors = np.frombuffer(row[0], np.int64).reshape(2, -1)
            floors = floors.view(np.float64)
            there = _units([row[1]], stored, len(asked))
            at, node = (np.frombuffer(x, np.int64) for x in row[2:])
            mine = np.searchsorted(ids, node)
            sim = np.concatenate([np.einsum("ij,ij->i", there[at[i:i + 4096]], units[mine[i:i + 4096]]) for i in range(0, len(at), 4096)])
            better = sim > floors[at]
            if better.any():
                yield src, FOUND, part, asked[at[better]].tobytes(), node[better].tobytes(), sim[better].tobytes(), b""

    return step


def _keep(beam: int):
    def step(part, held):
        old, new = (_joined(held[k], np.int64, np.int64, np.float64) for k in (KEPT, FOUND))
        flag = np.repeat(np.array([1, 0], np.uint8), [len(old[0]), len(new[0])])
        q, node, sim, done = _best(*(np.concatenate(x) for x in zip(old, new)), flag, beam)
        yield part, KEPT, int((done == 0).sum()), q.tobytes(), node.tobytes(), sim.tobytes(), done.tobytes()

    return step


def greedy_search(queries: DataFrame, codes: DataFrame, edges: DataFrame, beam: int = BEAM, steps: int = STEPS, stored: str = "<f8") -> DataFrame:
    """(q, node, sim): the nodes each query keeps, by walking the graph from the query's own node.

    Each step expands all kept nodes that were not expanded before and keeps the best `beam` of old and new;
    it ends when nothing is left to expand, and one that has not ended after `steps` is an error. Nodes are
    measured where their vectors are: the owner of a part gets the vectors of the queries that ask for
    nodes of it, each once a step, and a node that a query already keeps is not asked for.
    """
    parts = _parts(codes.count())
    points = cut_lineage(_pack_points(codes, parts))
    triple = (np.int64, np.int64, np.float64)
    lists = cut_lineage(_pack(edges.select("id", "near", F.col("sim").cast("double")), EDGES, parts, triple))
    asked = queries.join(codes.select("id"), "id", "left_semi").select("id", F.col("id").alias("node"), F.lit(1.0).alias("sim"), F.lit(0).cast("byte").alias("done"))
    state = cut_lineage(_pack(asked, KEPT, parts, (*triple, np.uint8)))
    for _ in range(steps):
        listed = _at_parts(lists.unionAll(state.mapInArrow(_expand(parts), MAIL)), parts, _list_neighbours)
        wanted = _at_parts(points.unionAll(state).unionAll(listed), parts, _ask(parts, beam))
        found = _at_parts(points.unionAll(wanted), parts, _measure(stored))
        state = cut_lineage(_at_parts(state.unionAll(found), parts, _keep(beam)))
        _forget_shuffles(codes)
        if not state.agg(F.sum("src")).first()[0]:
            return _unpack(state, ["q", "node", "sim"])
    raise RuntimeError(f"searches have not ended after {steps} steps")


def _in_range(v: Column) -> Column:
    """The vector times a power of two that keeps squares of its components within doubles; 1 for ordinary ones."""
    most = F.array_max(F.transform(v, F.abs))
    factor = F.when(most > 1e100, 2.0**-600).when(most < 1e-100, 2.0**600).otherwise(1.0)
    return F.transform(v, lambda x: x * factor)


def cosine(x: Column, y: Column) -> Column:
    """Cosine in double precision, whatever the magnitudes."""
    def dot(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)

    return dot(x, y) / (F.sqrt(dot(x, x)) * F.sqrt(dot(y, y)))


def _nearest(rows: DataFrame, stored: str, k: int, every: int) -> DataFrame:
    """The result for vectors of one length; rows have row, vec_id, v and the address (a, b) of the vector."""
    order = Window.partitionBy("a", "b").orderBy("vec_id", "row")
    # k + 1, since the query itself may be one of them.
    some = cut_lineage(
        rows.select("row", "vec_id", "a", "b").withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    )
    firsts = some.where("place = 1").select(F.col("row").alias("id"), "a", "b")
    members = some.join(firsts, ["a", "b"]).select(F.col("id").alias("node"), "vec_id", "row")
    nodes = rows.select(F.col("row").alias("id"), "v").join(firsts.select("id"), "id", "left_semi")
    codes = cut_lineage(_codes(nodes, stored))
    queries = rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), F.col("row").alias("query_row"), "a", "b")
    asked = cut_lineage(queries.join(firsts, ["a", "b"]).select("query_id", "query_row", F.col("id").alias("q")))
    starts = asked.select(F.col("q").alias("id")).distinct()
    found = greedy_search(starts, codes, build_graph(codes, stored=stored), stored=stored)
    close = found.select("q", "node").unionAll(starts.select(F.col("id").alias("q"), F.col("id").alias("node"))).distinct()
    level = nodes.select("id", _in_range(F.col("v")).alias("v"))
    measured = cut_lineage(
        close.join(level.select(F.col("id").alias("node"), F.col("v").alias("y")), "node")
        .join(level.select(F.col("id").alias("q"), F.col("v").alias("x")), "q")
        .select("q", "node", cosine(F.col("x"), F.col("y")).alias("score"))
    )
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return (
        asked.join(measured, "q").join(members, "node")
        .where("row != query_row").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def nearest(vectors: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for each row whose vec_id is divisible by `every`.

    Vectors are compared with those of their own length, each length by a graph of its own. Equal vectors are one
    node of the graph, so a vector that a third of the rows share costs one node; its rows with the smallest
    ids come back when the node is found. Scores are cosines of the original vectors in double precision, ties
    go to the smaller vec_id. Rows that repeat a vec_id with another vector are rows of their own, as queries too; with the
    same vector they are one. See `usable` for the rows
    that take part; with fewer than k candidates all are returned, an empty table gives no rows. Other columns are not read.
    """
    addressed = usable(vectors).withColumns({"a": F.xxhash64("v"), "b": F.xxhash64(F.lit(1), "v")})
    # Row numbers follow vec_id, so that smaller ids win ties among nodes too.
    ordered = addressed.dropDuplicates(["vec_id", "a", "b"]).repartitionByRange("vec_id", "a").sortWithinPartitions("vec_id", "a")
    rows = cut_lineage(ordered.withColumn("row", F.monotonically_increasing_id()))
    # One entry per length that occurs.
    lengths = sorted(r[0] for r in rows.select(F.size("v")).distinct().collect())
    parts = [_nearest(rows.where(F.size("v") == n) if len(lengths) > 1 else rows, _stored(vectors), k, every) for n in lengths or [0]]
    return reduce(DataFrame.unionAll, parts)
