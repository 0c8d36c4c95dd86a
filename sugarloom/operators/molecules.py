"""Graphs of many small molecules: rows dealt by molecule once, and whole molecules handled within a task.

Only molecules of few rows come here (see parted()); a larger one goes the way by joins, which no task holds whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sugarloom.operators.staging import staged

#: Rows up to which a molecule is handled within a task.
FEW = 4096
#: Rows a task, and rows that are handled at once.
TASK_ROWS, CHUNK_ROWS = 1_000_000, 100_000
WHOLE = ("tinyint", "smallint", "int", "bigint")


def parted(rows: DataFrame, keys: Sequence[str], numbers: Sequence[str], few: int | None = None, per_task: int = TASK_ROWS) -> tuple[DataFrame | None, DataFrame | None, int]:
    """rows of keys with at most `few` (else FEW) rows, the others (None: there are none), and the number of tasks the first want.
    One aggregation by key tells, of which the driver sees two numbers. Where keys are neither numbers nor text, or numbers are none, all are
    others."""
    few, types = few or FEW, dict(rows.dtypes)
    if any(types[c] not in (*WHOLE, "string") for c in keys) or any(types[c] not in WHOLE for c in numbers):
        return None, rows, 0
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("n"))
    most, every = sizes.agg(F.max("n"), F.sum("n")).first()
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), (every or 0) // per_task)
    if (most or 0) <= few:
        return rows, None, tasks
    large = staged(sizes.where(F.col("n") > few).select(*keys), "large")
    return rows.join(large, list(keys), "left_anti"), rows.join(large, list(keys), "left_semi"), tasks


def dealt(rows: DataFrame, keys: Sequence[str], per_task: int) -> DataFrame:
    """rows dealt by keys over as many tasks as there are shuffle partitions, and over more where these would get more than
    `per_task` rows each. One count tells. A file of few bytes is one task's, however many rows are made of it, and rows
    that compress well would be put together again to partitions of many: a number that is given stays."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(max(tasks, -(-rows.count() // per_task)), *keys)


def by_molecule(rows: DataFrame, keys: Sequence[str], tasks: int, f: Callable, schema: str, chunk: int = CHUNK_ROWS) -> DataFrame:
    """What f gives for whole molecules. f(m, columns) gets numpy columns of many molecules at once, m being the number of
    each row's molecule in the keys' order, and returns (m of each new row, new columns as schema has them); keys come first."""
    keys, others = list(keys), [c for c in rows.columns if c not in keys]
    types, head = dict(rows.dtypes), len(keys)
    dealt = rows.select(*keys, *others).repartition(tasks, *keys).sortWithinPartitions(*keys)
    names = [x.split(":")[0].strip() for x in schema.split(",")]
    out = ", ".join([*(f"{k}: {types[k]}" for k in keys), schema])

    def handled(table: pa.Table) -> pa.RecordBatch:
        held = [table.column(k).to_numpy() for k in keys]
        new = _changes(held)
        m = np.cumsum(new) - 1
        at, columns = f(m, {c: table.column(c).to_numpy() for c in others})
        first = np.flatnonzero(new)
        arrays = [pa.array(h[first][at], type=table.schema.field(i).type) for i, h in enumerate(held)]
        return pa.RecordBatch.from_arrays([*arrays, *(c if isinstance(c, pa.Array) else pa.array(c) for c in columns)], [*keys, *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            held.append(b)
            n += b.num_rows
            if n < chunk:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            # the last molecule may go on in the next batch
            last = int(np.flatnonzero(_changes([table.column(i).to_numpy() for i in range(head)]))[-1])
            if last:
                yield handled(table.slice(0, last))
            held, n = table.slice(last).to_batches(), table.num_rows - last
        if n:
            yield handled(pa.Table.from_batches(held).combine_chunks())

    return dealt.mapInArrow(run, out)


def _changes(columns: list[np.ndarray]) -> np.ndarray:
    new = np.zeros(len(columns[0]), bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def _merged(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The least of the nodes 0..n-1 that each one is linked with."""
    least = np.arange(n)
    while len(u):
        x, y = least[u], least[v]
        apart = x != y
        u, v, x, y = u[apart], v[apart], x[apart], y[apart]
        np.minimum.at(least, np.maximum(x, y), np.minimum(x, y))
        least = _led(least)
    return least


def _led(least: np.ndarray) -> np.ndarray:
    while True:
        on = least[least]
        if np.array_equal(on, least):
            return least
        least = on


class Graph:
    """Nodes and bonds of many molecules: m and value of each node, in that order, and lo < hi, the nodes of each bond; x and y are
    the nodes of each row. A row whose ends are one node is no bond."""

    def __init__(self, m: np.ndarray, a: np.ndarray, b: np.ndarray):
        both, values = np.concatenate([m, m]), np.concatenate([a, b]).astype(np.int64)
        order = np.lexsort((values, both))
        both, values = both[order], values[order]
        new = _changes([both, values])
        at = np.empty(len(order), np.int64)
        at[order] = np.cumsum(new) - 1
        self.m, self.value = both[new], values[new]
        self.n = len(self.m)
        self.x, self.y = x, y = at[: len(m)], at[len(m) :]
        pairs = np.unique(np.minimum(x, y)[x != y] * self.n + np.maximum(x, y)[x != y])
        self.lo, self.hi = pairs // self.n, pairs % self.n
        self.least = _merged(self.n, self.lo, self.hi)

    def grow(self) -> Graph:
        """Trees from the least nodes on, breadth first: parent (-1: none), size and total of what hangs on each node, its
        place in a walk of its tree (what hangs on it follows), and open: a bond of no tree leads from there elsewhere."""
        n, lo, hi = self.n, self.lo, self.hi
        start, end = np.concatenate([lo, hi]), np.concatenate([hi, lo])
        order = np.argsort(start * n + end)
        start, end = start[order], end[order]
        bounds = np.searchsorted(start, np.arange(n + 1))
        self.parent, seen, first = np.full(n, -1), np.zeros(n, bool), np.empty(n, np.int64)
        level = np.flatnonzero(self.least == np.arange(n))
        seen[level], levels = True, [level]
        while len(level):
            count = bounds[level + 1] - bounds[level]
            up = np.repeat(level, count)
            near = end[np.repeat(bounds[level] - np.cumsum(count) + count, count) + np.arange(len(up))]
            up, near = up[~seen[near]], near[~seen[near]]
            i = np.arange(len(near))
            first[near[::-1]] = i[::-1]  # of several ways to a node the first one
            took = first[near] == i
            level, up = near[took], up[took]
            self.parent[level], seen[level] = up, True
            levels.append(level)
        self.size, self.total, self.place = np.ones(n, np.int64), self.value.copy(), np.zeros(n, np.int64)
        for level in levels[:0:-1]:
            np.add.at(self.size, self.parent[level], self.size[level])
            np.add.at(self.total, self.parent[level], self.total[level])
        for level in levels[1:-1]:
            up, before = self.parent[level], np.cumsum(self.size[level]) - self.size[level]
            head = _changes([up])
            self.place[level] = self.place[up] + 1 + before - before[head][np.cumsum(head) - 1]
        loose = (self.parent[lo] != hi) & (self.parent[hi] != lo)
        low, high = self.place.copy(), self.place.copy()
        for x, y in ((lo[loose], hi[loose]), (hi[loose], lo[loose])):
            np.minimum.at(low, x, self.place[y])
            np.maximum.at(high, x, self.place[y])
        for level in levels[:0:-1]:
            np.minimum.at(low, self.parent[level], low[level])
            np.maximum.at(high, self.parent[level], high[level])
        self.open = (low < self.place) | (high >= self.place + self.size)
        return self


def component_rows(m: np.ndarray, c: dict) -> tuple:
    g = Graph(m, c["a"], c["b"])
    return g.m, [g.value, g.value[g.least]]


def place_rows(m: np.ndarray, c: dict) -> tuple:
    """root, node and place of every node."""
    g = Graph(m, c["a"], c["b"]).grow()
    return g.m, [g.value[g.least], g.value, g.place]


def bond_rows(m: np.ndarray, c: dict) -> tuple:
    """a, b, root, the end that hangs below (null in a ring), the places, number and sum of what hangs there, number and sum
    of the whole tree, and how many bonds the ends have."""
    g = Graph(m, c["a"], c["b"]).grow()
    down = g.parent[g.hi] == g.lo
    below = np.where(down, g.hi, g.lo)
    ring = ~(down | (g.parent[g.lo] == g.hi)) | g.open[below]
    told = lambda x: pa.array(x, mask=ring)
    root = g.least[g.lo]
    degree = np.bincount(g.lo, minlength=g.n) + np.bincount(g.hi, minlength=g.n)
    columns = [g.value[g.lo], g.value[g.hi], g.value[root], told(g.value[below]), told(g.place[below]), told(g.place[below] + g.size[below] - 1), told(g.size[below]), told(g.total[below])]
    return g.m[g.lo], [*columns, g.size[root], g.total[root], degree[g.lo], degree[g.hi]]


def _pairs(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs i < j of rows of one molecule; m ascends."""
    n = np.arange(len(m))
    left = np.searchsorted(m, m, "right") - n - 1
    i = np.repeat(n, left)
    return i, i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(left) - left, left)


def _across(m: np.ndarray, c: dict, axes: Sequence[str]) -> tuple:
    """The pairs of points of different groups of a molecule from the nearest on: rows i, j, d2, a, b; of equal distances the
    least (a, b) goes first."""
    i, j = _pairs(m)
    apart = c["g"][i] != c["g"][j]
    i, j = i[apart], j[apart]
    d2 = None
    for x in axes:
        gap = c[x][i] - c[x][j]
        d2 = gap * gap if d2 is None else d2 + gap * gap
    a, b = np.minimum(c["p"][i], c["p"][j]), np.maximum(c["p"][i], c["p"][j])
    order = np.lexsort((b, a, d2))
    return tuple(x[order] for x in (i, j, d2, a, b))


def _groups(m: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, int]:
    """Each row's group as a number, and how many groups there are."""
    order = np.lexsort((g, m))
    new = _changes([m[order], g[order]])
    at = np.empty(len(m), np.int64)
    at[order] = np.cumsum(new) - 1
    return at, int(new.sum())


def nearest_rows(axes: Sequence[str]) -> Callable:
    """Of every group the nearest pair with another one: group, other group, d2, a, b."""

    def f(m: np.ndarray, c: dict) -> tuple:
        i, j, d2, a, b = _across(m, c, axes)
        at, n = _groups(m, c["g"])
        rank, best = np.arange(len(i)), np.full(n, len(i))
        np.minimum.at(best, at[i], rank)
        np.minimum.at(best, at[j], rank)
        group = np.flatnonzero(best < len(i))
        best = best[group]
        mine = at[i[best]] == group
        own, other = np.where(mine, i[best], j[best]), np.where(mine, j[best], i[best])
        return m[own], [c["g"][own], c["g"][other], d2[best], a[best], b[best]]

    return f


#: Distances that are held at once.
PAIRS = 1_000_000


def _kth(q: np.ndarray, own: np.ndarray | None, p: np.ndarray, copies: np.ndarray, k: int) -> np.ndarray:
    """The k least squared distances, ascending, of each of the points q to the points p, of which there are so many copies;
    what is missing is infinite. own: q are p, and each has so many others on its own spot."""
    out = np.full((len(q), k), np.inf)
    single, step = bool((copies == 1).all()), max(1, PAIRS // max(1, len(p)))
    for lo in range(0, len(q), step):
        part = q[lo : lo + step]
        d2 = None
        for x, y in zip(part.T, p.T, strict=True):
            gap = x[:, None] - y
            d2 = gap * gap if d2 is None else d2 + gap * gap
        n = np.arange(len(part))
        if own is not None:
            d2[n, lo + n] = np.inf
        most = min(k, len(p))
        if single:
            least = np.partition(d2, most - 1, axis=1)[:, :most] if most < len(p) else d2
            out[lo : lo + step, :most] = np.sort(least, axis=1)
            continue
        at = np.argpartition(d2, most - 1, axis=1)[:, :most]
        at = np.take_along_axis(at, np.argsort(np.take_along_axis(d2, at, 1), axis=1), 1)
        least, times = np.take_along_axis(d2, at, 1), copies[at]
        if own is not None:
            least, times = np.column_stack([np.zeros(len(part)), least]), np.column_stack([own[lo : lo + step], times])
        least, upto = np.column_stack([least, np.full(len(part), np.inf)]), np.cumsum(times, axis=1)
        for j in range(k):
            out[lo + n, j] = least[n, (upto <= j).sum(axis=1)]
    return out


def _lists(values: np.ndarray) -> pa.Array:
    n, k = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * k, k), pa.int32()), pa.array(values.ravel()))


def _blocks(m: np.ndarray) -> list[slice]:
    bounds = np.append(np.flatnonzero(_changes([m])), len(m))
    return [slice(lo, hi) for lo, hi in zip(bounds[:-1], bounds[1:], strict=True)]


def kth_rows(axes: Sequence[str], k: int) -> Callable:
    """Of every position the k least squared distances to other points of its block: coordinates, _reach and the list."""

    def f(m: np.ndarray, c: dict) -> tuple:
        p, copies = np.column_stack([c[x] for x in axes]), c["_copies"]
        best = np.concatenate([_kth(p[b], copies[b] - 1, p[b], copies[b], k) for b in _blocks(m)])
        return m, [*(c[x] for x in axes), c["_reach"], _lists(best)]

    return f


def kth_asked_rows(axes: Sequence[str], k: int) -> Callable:
    """The same of the rows that ask, which are in other blocks, to the points of the block."""

    def f(m: np.ndarray, c: dict) -> tuple:
        p, copies, asks, best = np.column_stack([c[x] for x in axes]), c["_copies"], c["_asks"].astype(bool), [np.empty((0, k))]
        for b in _blocks(m):
            ask, there = asks[b], ~asks[b]
            if ask.any():
                best.append(_kth(p[b][ask], None, p[b][there], copies[b][there], k))
        return m[asks], [*(c[x][asks] for x in axes), np.zeros(int(asks.sum())), _lists(np.concatenate(best))]

    return f


def stitch_rows(axes: Sequence[str]) -> Callable:
    """The pairs a, b that make each molecule of bonds and atoms one: every component takes its nearest pair to another, until
    one is left."""

    def f(m: np.ndarray, c: dict) -> tuple:
        graph, atom = Graph(m, c["a"], c["b"]), c["atom"].astype(bool)
        m, at = m[atom], graph.least[graph.x[atom]]
        i, j, _, a, b = _across(m, {"g": at, "p": c["a"][atom], **{x: c[x][atom] for x in axes}}, axes)
        u, v, rank, taken, n = at[i], at[j], np.arange(len(i)), [], graph.n
        least = np.arange(n)
        while len(u):
            best = np.full(n, len(i))
            np.minimum.at(best, u, rank)
            np.minimum.at(best, v, rank)
            took = np.unique(best[best < len(i)])
            taken.append(took)
            least = _merged(n, np.concatenate([least, at[i[took]]]), np.concatenate([np.arange(n), at[j[took]]]))
            u, v = least[u], least[v]
            apart = u != v
            u, v, rank = u[apart], v[apart], rank[apart]
        took = np.concatenate(taken) if taken else rank
        return m[i[took]], [a[took], b[took]]

    return f


def centre_rows(m: np.ndarray, c: dict) -> tuple:
    """frame and cluster of points of many molecules: farthest-point centres, the molecule's k of them at most, from the
    smallest frame on; ties go to the earlier centre, and to the smaller frame."""
    order = np.lexsort((c["frame"], m))
    frame, k = c["frame"][order], c["k"][order]
    x, y, z = (c[a][order] for a in "xyz")
    cluster = np.zeros(len(m), np.int32)
    bounds = np.append(np.flatnonzero(_changes([m[order]])), len(m))
    for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
        xs, ys, zs, own = x[lo:hi], y[lo:hi], z[lo:hi], cluster[lo:hi]
        gap = lambda i: (xs - xs[i]) * (xs - xs[i]) + (ys - ys[i]) * (ys - ys[i]) + (zs - zs[i]) * (zs - zs[i])
        d2 = gap(0)
        for i in range(1, int(k[lo])):
            far = int(np.argmax(d2))  # what is no number counts as farthest, as in Spark
            if d2[far] <= 0:
                break
            new = gap(far)
            closer = new < d2
            d2[closer], own[closer] = new[closer], i
    return m[order], [frame, cluster]
