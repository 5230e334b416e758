"""Near-duplicate embeddings by a dual traversal of cover trees: all pairs at or above a cosine, none below it.

Method: unit vectors at cosine c are sqrt(2 - 2c) apart, so the threshold is a distance. The top of the tree is shared: a
sample gives at most ``MAX_PIVOTS`` centres, every vector goes under the nearest, and each centre's covering radius is
measured. Vectors are laid out centre by centre, neighbouring centres next to each other, and cut into blocks of equal
size. Over each block a cover tree is built: below a root that covers the whole block, nested levels halve the radius
(1, 1/2, 1/4, ...), every node's centre covers its points within the level's radius, and centres of one node are further
apart than that. Two blocks meet if two of their centres are no further apart than both covering radii and the threshold
together; the others are pruned before any vector travels. Blocks travel in runs of up to ``MOST_BLOCKS``: a task gets two
runs and traverses the pairs of blocks that are left, root against root and then level by level: a pair of nodes is
dropped if its centres are further apart than both covering radii and the threshold together, taken whole if even the
furthest points must link, and else opened; points are compared in double precision. Bounds have a slack of 1e-9, so no
rounding drops or adds a pair.

A root opens to the level from which a sample of the block's nodes lets expect the least work. Of its nodes, all against all, shadows are
compared first: the components along a few axes and the length of what is left, which is no further apart than the
vectors are. That is a bound, not an estimate; what it cannot drop is compared in full.

A task returns, for each vector, how many it links with, and a spanning forest of its links; linked groups are never
listed pair by pair. Equal vectors become one class with a count before the tree is built.

Cost: where vectors have no near neighbours, as random ones in 64 dimensions, centres are too far apart to be grouped
but not far enough for bounds between blocks to hold, so the first level compares all centres of two blocks, by matrix
products of their shadows, and the work grows with the square of the number of classes. That is the method's limit, see
the README. A vector travels once for each run of blocks; what one task holds is two runs, whatever the number of vectors.

Cases: a vector that is null, zero, or holds a null or a non-finite component links with nothing and is its own
component. So do vectors whose length differs from another's: only equal lengths are compared. Repeated ids are counted
as separate vectors of one component if their vectors link. A null id links with nothing and has a null component. An
empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from .common import attach, drop, numbered, saved
from .components import connected_components, smallest_ids

BLOCK, LEVELS, LEAF, SLACK = 8192, 7, 8, 1e-9
#: A block's vectors take no more than so many bytes.
BLOCK_BYTES = 32 << 20
#: Vectors travel in runs of blocks: so many runs, unless one has more blocks or bytes (as doubles) than these.
RUNS, MOST_BLOCKS, RUN_BYTES = 8, 12, 48 << 20
#: Axes of a shadow: the first of these numbers that leaves at most ``SHADOW_LEAVES`` of a sample's pairs, else all.
AXES, SHADOW_LEAVES = (16, 32, 64, 128, 256), 1 / 500
#: Bound of the sample that pivots, the centres of the tree's top, are taken from, and of the pivots.
PIVOT_SAMPLE, MAX_PIVOTS = 4096, 256


def _net(x: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Centres (indices), further than ``radius`` apart, and for each point the number of a centre within it."""
    n, least = len(x), 1 - radius * radius / 2  # a cosine
    of, centres, rest = np.full(n, -1), [], np.arange(n)
    while len(rest):
        batch = rest[:256]
        near = x[batch] @ x[batch].T >= least
        alive, chosen = np.ones(len(batch), bool), []
        for i in range(len(batch)):
            if alive[i]:
                chosen.append(i)
                alive[i:] &= ~near[i, i:]
        chosen = batch[chosen]
        cosine = x[rest] @ x[chosen].T
        best = cosine.argmax(axis=1)
        inside = cosine[np.arange(len(rest)), best] >= least
        of[rest[inside]] = len(centres) + best[inside]
        of[chosen] = len(centres) + np.arange(len(chosen))
        centres.extend(chosen)
        rest = rest[of[rest] < 0]
    return np.array(centres, int), of


def build(x: np.ndarray, levels: int = LEVELS) -> np.ndarray:
    """The tree over the rows of ``x``: (points, levels) with the index of the centre that covers a point at each level.

    Level l has radius 2^-l; a node with at most ``LEAF`` points is not divided but by its points, from there on down.
    """
    n = len(x)
    path = np.zeros((n, levels), np.int32)
    groups = [np.arange(n)]
    for level in range(levels):
        nxt = []
        for g in groups:
            if len(g) <= LEAF:
                path[g, level:] = g[:, None]
                continue
            centres, of = _net(x[g], 2.0**-level)
            path[g, level] = g[centres[of]]
            order = np.argsort(of, kind="stable")
            nxt.extend(np.split(g[order], np.cumsum(np.bincount(of))[:-1]))
        groups = nxt
    return path


class _Level:
    """The nodes of one level: centre, covering radius and points, each a run of ``order``."""

    def __init__(self, x: np.ndarray, centre_of: np.ndarray):
        self.centre, node = np.unique(centre_of, return_inverse=True)
        self.order = np.argsort(node, kind="stable")
        self.count = np.bincount(node)
        self.start = np.cumsum(self.count) - self.count
        self.node = node
        far = np.sqrt(np.maximum(0.0, 2 - 2 * np.einsum("ij,ij->i", x, x[centre_of])))
        self.radius = np.zeros(len(self.centre))
        np.maximum.at(self.radius, node, far)
        self.radius[self.count == 1] = 0.0

    def points(self, node: int) -> np.ndarray:
        return self.order[self.start[node] : self.start[node] + self.count[node]]


class _Links:
    """Links found: a count for each point, weighted with copies, and a forest of them."""

    def __init__(self, copies: np.ndarray):
        self.copies, self.n, self.edges = copies, np.zeros(len(copies), np.int64), []
        self.parent, self.label = np.arange(len(copies)), np.arange(len(copies))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = int(self.parent[i])
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
            self.edges.append((i, j))

    def pairs(self, i: np.ndarray, j: np.ndarray) -> None:
        np.add.at(self.n, i, self.copies[j])
        np.add.at(self.n, j, self.copies[i])
        # only one pair for each two groups that are not joined yet
        p, q = self.label[i], self.label[j]
        apart = p != q
        if apart.any():
            _, one = np.unique(p[apart] * len(self.label) + q[apart], return_index=True)
            for a, b in zip(i[apart][one].tolist(), j[apart][one].tolist(), strict=True):
                self.join(a, b)
            self.relabel()

    def relabel(self) -> None:
        label = self.parent
        while not np.array_equal(label, up := label[label]):
            label = up
        self.label = label.copy()

    def all_of(self, p: np.ndarray, q: np.ndarray) -> None:
        """Every point of p with every point of q; p is q: all its pairs."""
        if p is q:
            self.n[p] += self.copies[p].sum() - self.copies[p]
            q = p[:1]
        else:
            self.n[p] += self.copies[q].sum()
            self.n[q] += self.copies[p].sum()
            for b in q[self.label[q] != self.label[p[0]]].tolist():
                self.join(int(p[0]), b)
        for a in p[self.label[p] != self.label[q[0]]].tolist():
            self.join(a, int(q[0]))


def _root(x: np.ndarray) -> tuple[np.ndarray, float]:
    """The root of a block's tree: a centre and the radius that covers all points."""
    centre = x.mean(axis=0)
    return centre, float(np.sqrt(np.maximum(0.0, ((x - centre) ** 2).sum(axis=1)).max()))


def _axes(x: np.ndarray, cosine: float) -> np.ndarray:
    """The axes (columns, orthonormal) of the shadows: those along which the sample ``x`` has the most of its length."""
    every = np.linalg.eigh(x.T @ x)[1][:, ::-1]
    few = x[:1024]
    for n in AXES:
        if n < x.shape[1]:
            flat = _shadow(few, every[:, :n])
            if np.count_nonzero(flat @ flat.T >= cosine) - len(few) <= SHADOW_LEAVES * len(few) ** 2:
                return every[:, :n]
    return every


def _shadow(x: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Unit vectors of fewer components, no further apart than the rows of ``x``: those along ``axes``, and the length of the rest."""
    along = x @ axes
    rest = np.sqrt(np.maximum(0.0, 1 - np.einsum("ij,ij->i", along, along)))
    return np.concatenate([along, rest[:, None]], axis=1).astype(np.float32)


class _Tree:
    """A block's tree as it is traversed: unit vectors, levels, root, and shadows of the nodes that the root opens to."""

    #: Work on a pair of nodes that is opened to, and on one compared without shadows, in pairs of shadows.
    OPENED, DENSE = 60, 4

    def __init__(self, x: np.ndarray, path: np.ndarray, axes: np.ndarray, cosine: float, start: int = 0):
        self.x, self.start, self.root = x, start, _root(x)
        self.levels = [_Level(x, path[:, level]) for level in range(path.shape[1])]
        self.shadow, self.heads, self.top = _shadow(x, axes), {}, self._top(float(np.sqrt(2 - 2 * cosine)))

    def _top(self, tau: float) -> int:
        work, below = [], 0.0
        for nth, level in reversed(list(enumerate(self.levels))):
            some = np.arange(0, len(level.centre), -(-len(level.centre) // 256))
            c, r, many = self.x[level.centre[some]], level.radius[some], level.count[some] > 1
            open_ = np.sqrt(np.maximum(0.0, 2 - 2 * (c @ c.T))) <= r[:, None] + r + (tau + SLACK)
            open_ &= (many[:, None] | many) & ~np.eye(len(some), dtype=bool)
            share, deeper = open_.mean(), self.levels[min(nth + 1, len(self.levels) - 1)]
            below += self.OPENED * share * len(deeper.centre) ** 2
            work.append((below + (self.DENSE if share > 1 / 64 else 1) * len(level.centre) ** 2, nth))
        return min(work)[1]

    def opened(self, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The nodes of a level by covering radius, their radii and shadows."""
        if level not in self.heads:
            nodes = self.levels[level]
            order = np.argsort(nodes.radius, kind="stable")
            self.heads[level] = order, nodes.radius[order], self.shadow[nodes.centre[order]]
        return self.heads[level]


class _Sweep:
    """Pairs of rows whose product is large enough, tile by tile."""

    ROWS, COLUMNS = 512, 2048

    def __init__(self):
        self.products = np.empty(self.ROWS * self.COLUMNS, np.float32)
        self.large = np.zeros(self.ROWS * self.COLUMNS + 8, bool)

    def edges(self, radius: np.ndarray, step: int) -> list[tuple[int, int]]:
        """Tiles of nodes that lie by radius: those of one point, whose bound is the threshold itself, share none with others."""
        single = int(np.searchsorted(radius, 0.0, "right"))
        starts = [*range(0, single, step), *range(single, len(radius), step)]
        return list(zip(starts, [*starts[1:], len(radius)], strict=True))

    def tile(self, a: np.ndarray, b: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
        size = len(a) * len(b)
        products = self.products[:size].reshape(len(a), len(b))
        np.matmul(a, b.T, out=products)
        np.greater_equal(products, np.float32(least), out=self.large[:size].reshape(len(a), len(b)))
        self.large[size : size + 8] = False
        # eight at a time: hardly any is
        eights = np.flatnonzero(self.large[: -(-size // 8) * 8].view(np.uint64))
        at = (eights[:, None] * 8 + np.arange(8)).ravel()
        return np.divmod(at[self.large[at]], len(b))


def traverse(first: _Tree, second: _Tree, links: _Links, cosine: float, sweep: _Sweep | None = None) -> None:
    """Adds the links between the points of two trees, or among those of one; a tree's points are numbered from ``start``."""
    one, tau, sweep = first is second, float(np.sqrt(2 - 2 * cosine)), sweep or _Sweep()
    (ca, ra), (cb, rb) = first.root, second.root
    if not one and np.linalg.norm(ca - cb) > ra + rb + tau + SLACK:
        return
    xa, xb = first.x, second.x

    def apart(level: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        d = np.empty(len(i))
        for c in range(0, len(i), 65536):
            s = slice(c, c + 65536)
            d[s] = np.sqrt(np.maximum(0.0, 2 - 2 * np.einsum("ij,ij->i", xa[first.levels[level].centre[i[s]]], xb[second.levels[level].centre[j[s]]])))
        return d

    def sift(level: int, i: np.ndarray, j: np.ndarray, d: np.ndarray):
        """Of node pairs with centres d apart: those to open."""
        a, b = first.levels[level], second.levels[level]
        reach = a.radius[i] + b.radius[j]
        open_ = d <= reach + tau + SLACK
        whole = open_ & (d + reach <= tau - SLACK)
        for p, q in zip(i[whole].tolist(), j[whole].tolist(), strict=True):
            left = a.points(p) + first.start
            links.all_of(left, left if one and p == q else b.points(q) + second.start)
        if whole.any():
            links.relabel()
        open_ &= ~whole
        single = open_ & (a.count[i] == 1) & (b.count[j] == 1)
        if one:
            single &= i != j
            open_ &= ~((i == j) & (a.count[i] == 1))
        compare(a.order[a.start[i[single]]], b.order[b.start[j[single]]])
        open_ &= ~single
        return i[open_], j[open_]

    def compare(p: np.ndarray, q: np.ndarray) -> None:
        for at in range(0, len(p), 65536):
            u, v = p[at : at + 65536], q[at : at + 65536]
            good = np.einsum("ij,ij->i", xa[u], xb[v]) >= cosine
            if good.any():
                links.pairs(u[good] + first.start, v[good] + second.start)

    # the roots are opened: their nodes, all against all, by tiles. Shadows in single precision, with a slack far above their error, choose what
    # to look at; nodes lie by radius, so a tile's bound is hardly wider than its nodes'
    top = min(first.top, second.top)
    a, b, found, lone = first.levels[top], second.levels[top], [], []
    (na, ra, fa), (nb, rb, fb) = first.opened(top), second.opened(top)
    slack = 1e-5 + 2e-7 * fa.shape[1]
    for at, end in sweep.edges(ra, sweep.ROWS):
        rows = slice(at, end)
        for to, last in sweep.edges(rb, sweep.COLUMNS):
            if one and last <= at:
                continue
            columns = slice(to, last)
            wide = ra[rows][-1] + rb[columns][-1]
            p, q = sweep.tile(fa[rows], fb[columns], 1 - min(2.0, wide + tau + SLACK) ** 2 / 2 - slack)
            if wide and len(p) > len(fa[rows]) * len(fb[columns]) / 64:  # shadows decide too little here
                d = np.sqrt(np.maximum(0.0, 2 - 2 * (xa[a.centre[na[rows]]] @ xb[b.centre[nb[columns]]].T)))
                p, q = np.nonzero(d <= ra[rows, None] + rb[None, columns] + (tau + SLACK))
            if one:  # a pair of nodes comes up once
                once = p + at <= q + to
                p, q = p[once], q[once]
            i, j = na[p + at], nb[q + to]
            points = (a.count[i] == 1) & (b.count[j] == 1)
            lone.append((i[points], j[points]))
            found.append((i[~points], j[~points]))
    i, j = (np.concatenate(f) for f in zip(*lone, strict=True))
    if one:
        i, j = i[i != j], j[i != j]
    compare(a.order[a.start[i]], b.order[b.start[j]])
    i, j = (np.concatenate(f) for f in zip(*found, strict=True))
    i, j = sift(top, i, j, apart(top, i, j))
    for level in range(top + 1, len(first.levels)):
        if not len(i):
            break
        kids = []
        for tree in (first.levels, second.levels):
            parent = tree[level - 1].node[tree[level].centre]
            order = np.argsort(parent, kind="stable")
            count = np.bincount(parent, minlength=len(tree[level - 1].centre))
            kids.append((order, np.cumsum(count) - count, count))
        (oa, sa, ca), (ob, sb, cb) = kids
        opened = []
        for at in range(0, len(i), 4096):
            p, q = i[at : at + 4096], j[at : at + 4096]
            size = ca[p] * cb[q]
            pair = np.repeat(np.arange(len(p)), size)
            nth = np.arange(len(pair)) - np.repeat(np.cumsum(size) - size, size)
            u, v = oa[sa[p[pair]] + nth // cb[q[pair]]], ob[sb[q[pair]] + nth % cb[q[pair]]]
            if one:
                upper = (p[pair] != q[pair]) | (u <= v)
                u, v = u[upper], v[upper]
            opened.append(sift(level, u, v, apart(level, u, v)))
        i, j = (np.concatenate(f) for f in zip(*opened, strict=True))
    for p, q in zip(i.tolist(), j.tolist(), strict=True):
        left, right = first.levels[-1].points(p), second.levels[-1].points(q)
        for at in range(0, len(left), 1024):
            good = xa[left[at : at + 1024]] @ xb[right].T >= cosine
            if one and p == q:
                good &= left[at : at + 1024, None] < right[None, :]
            u, v = np.nonzero(good)
            links.pairs(left[at + u] + first.start, right[v] + second.start)


def _unit(raw, kind: str) -> np.ndarray:
    return _scaled(np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1))


def _scaled(raw: np.ndarray) -> np.ndarray:
    x = raw.astype(np.float64)
    return x / np.linalg.norm(x, axis=1)[:, None]


def _sample(classes: DataFrame, kind: str) -> np.ndarray:
    """At most ``PIVOT_SAMPLE`` vectors."""
    return _unit([bytes(r.v) for r in classes.orderBy(F.xxhash64("v"), "v").select("v").limit(PIVOT_SAMPLE).collect()], kind)


def _pivots(x: np.ndarray) -> np.ndarray:
    """At most ``MAX_PIVOTS`` vectors of a sample, further than 1 apart where there are such, each followed by the nearest one left."""
    x = x[_net(x, 1.0)[0][:MAX_PIVOTS]]
    order, cosine = [0], x @ x.T
    while len(order) < len(x):
        nearest = cosine[order[-1]].copy()
        nearest[order] = -2
        order.append(int(nearest.argmax()))
    return x[order]


def _nearest(pivots: np.ndarray, kind: str):
    def near(batches):
        for pdf in batches:
            if len(pdf):
                cosine = _unit(pdf["v"], kind) @ pivots.T
                pdf["pivot"] = cosine.argmax(axis=1)
                pdf["far"] = np.sqrt(np.maximum(0.0, 2 - 2 * cosine.max(axis=1)))
                yield pdf

    return near


def _planted(pdf: pd.DataFrame, kind: str) -> pd.DataFrame:
    pdf["path"] = [p.tobytes() for p in build(_unit(pdf["v"], kind))]
    return pdf[["block", "cls", "copies", "v", "path"]]


def _packed_rows(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    """Binary values of equal length as the rows of a matrix."""
    a = pa.concat_arrays(column.chunks)
    ends = np.frombuffer(a.buffers()[1], np.int64 if pa.types.is_large_binary(a.type) else np.int32)[a.offset : a.offset + len(a) + 1]
    return np.frombuffer(a.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(kind).reshape(len(a), -1)


def _paired(cosine: float, axes: np.ndarray, kind: str, run: int):
    """Links between the blocks of two runs of ``run`` blocks; a bit of ``meets`` for each block of the second that a block meets."""

    def pair(table: pa.Table) -> pa.Table:
        block, cls = (table[c].to_numpy() for c in ("block", "cls"))
        # a path names rows by their place in the block, as it was built: sorted by class
        order = np.lexsort((cls, block))
        block, cls, second = block[order], cls[order], table["second"][0].as_py() * run
        copies, meets = (table[c].to_numpy()[order] for c in ("copies", "meets"))
        raw, path = _packed_rows(table["v"], kind)[order], _packed_rows(table["path"], "<i4")[order]
        names, starts = np.unique(block, return_index=True)
        trees = {
            name: _Tree(_scaled(raw[at:to]), path[at:to], axes, cosine, at)
            for name, at, to in zip(names.tolist(), starts.tolist(), [*starts[1:].tolist(), len(block)], strict=True)
        }
        links, sweep = _Links(copies), _Sweep()
        for a, tree in trees.items():
            for nth in range(run):
                if int(meets[tree.start]) >> nth & 1:
                    traverse(tree, trees[second + nth], links, cosine, sweep)
        hit = np.flatnonzero(links.n)
        edges = np.array(links.edges, np.int64).reshape(-1, 2)
        return pa.table(
            {
                "cls": np.concatenate([cls[hit], cls[edges[:, 0]]]),
                "n": np.concatenate([links.n[hit], np.zeros(len(edges), np.int64)]),
                "other": np.concatenate([cls[hit], cls[edges[:, 1]]]),
            }
        )

    return pair


def _keyed(kind: str, whole: bool):
    """(id, key) of rows (id, v), ``whole``: with dim and v; v is the vector's bytes and null, as its key, where it links with nothing."""

    def keyed(batches):
        for batch in batches:
            ids, lists = batch.column(0), batch.column(1)
            size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            # nulls become NaN, and minus zero is zero
            values = lists.flatten().to_numpy(zero_copy_only=False).astype(kind) + np.zeros(1, kind)
            row = np.repeat(np.arange(len(size)), size)
            odd = np.bincount(row, ~np.isfinite(values), len(size)) > 0
            fine = ~odd & (np.bincount(row, values != 0, len(size)) > 0) & ids.is_valid().to_numpy(zero_copy_only=False)
            data, ends = values.tobytes(), np.cumsum(size) * values.itemsize
            v = [data[a:b] if f else None for a, b, f in zip((ends - size * values.itemsize).tolist(), ends.tolist(), fine.tolist(), strict=True)]
            out = {"id": ids, "key": pa.array([None if e is None else hashlib.sha256(e).digest() for e in v], pa.binary())}
            if whole:
                out |= {"dim": pa.array(size.astype(np.int32)), "v": pa.array(v, pa.binary())}
            yield pa.RecordBatch.from_pydict(out)

    return keyed


def near_vectors(vectors: DataFrame, cosine: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK) -> DataFrame:
    """A row per vector: id_col, n_links (other vectors at or above ``cosine``), component_id (smallest id that links reach), kept."""
    spark = vectors.sparkSession
    given = vectors.schema[vector_col].dataType
    kind = "<f4" if isinstance(given, ArrayType) and isinstance(given.elementType, FloatType) else "<f8"  # floats are doubles, in half the bytes
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<float>" if kind == "<f4" else "array<double>").alias("v"))
    classes = rows.mapInArrow(_keyed(kind, True), "id long, key binary, dim int, v binary").filter("key is not null")
    classes = classes.groupBy("key", "dim").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("v").alias("v"))
    rows = saved(rows.mapInArrow(_keyed(kind, False), "id long, key binary"), "vectors")
    # an id may occur with several vectors, so it cannot name a class
    classes = saved(classes.withColumn("cls", F.monotonically_increasing_id()), "vector-classes")
    dims = [r.dim for r in classes.select("dim").distinct().collect()]  # lengths of vectors, not vectors
    links = None
    for dim in dims:
        found = _block_links(classes.filter(F.col("dim") == dim).select("cls", "copies", "v"), cosine, block, kind)
        links = found if links is None else links.unionByName(found)
    if links is None:
        links = spark.createDataFrame([], "cls long, n long, other long")
    counts = links.groupBy("cls").agg(F.sum("n").alias("n"))
    found = connected_components(links.select(F.col("cls").alias("a"), F.col("other").alias("b")))
    groups = (
        classes.select("key", "cls", "least", "copies").join(counts, "cls", "left").join(smallest_ids(classes, found), "cls", "left")
        .select("key", "copies", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "least").alias("component_id"))
    )
    out = attach(rows.select("id", F.coalesce("key", F.lit(b"")).alias("key")), groups, "key", "copies", rows.count())
    return out.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "id").alias("component_id")
    ).withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def _block_links(classes: DataFrame, cosine: float, block: int, kind: str) -> DataFrame:
    sample = _sample(classes, kind)
    pivots, axes, dim = _pivots(sample), _axes(sample, cosine), sample.shape[1]
    block = max(1, min(block, BLOCK_BYTES // (8 * dim)))
    placed = classes.mapInPandas(_nearest(pivots, kind), "cls long, copies long, v binary, pivot long, far double").withColumn("everything", F.lit(0))
    placed = saved(placed, "pivots")
    # gapless numbers in the order of pivots, so that blocks are of equal size however many vectors a pivot has
    chunk = F.col("pivot") * 64 + F.pmod(F.xxhash64("cls"), F.lit(64))
    ranked = numbered(placed, "everything", chunk, [F.col("cls")], "rank").withColumn("block", F.expr(f"rank div {block}"))
    ranked = saved(ranked.select("cls", "copies", "v", "pivot", "far", "block"), "blocks")
    drop(placed)
    nodes = saved(ranked.groupBy("block", "pivot").agg(F.max("far").alias("far")), "nodes")
    planted = ranked.groupBy("block").applyInPandas(
        lambda pdf: _planted(pdf.sort_values("cls", kind="stable"), kind), "block long, cls long, copies long, v binary, path binary"
    )
    planted = saved(planted, "trees")
    drop(ranked)
    near = saved(block_pairs(nodes, pivots, cosine), "block-pairs")
    blocks = nodes.agg(F.max("block")).first()[0] + 1
    run = max(1, min(-(-blocks // RUNS), MOST_BLOCKS, RUN_BYTES // (8 * dim * block)))
    runs = -(-blocks // run)
    met = near.select(F.expr(f"a div {run}").alias("first"), F.expr(f"b div {run}").alias("second"), "a", "b", F.expr(f"shiftleft(1L, cast(b % {run} as int))").alias("bit"))
    met = met.select("first", "second", F.col("a").alias("block"), "bit").unionByName(met.select("first", "second", F.col("b").alias("block"), F.lit(0).cast("long").alias("bit")))
    met = saved(met.groupBy("first", "second", "block").agg(F.expr("bit_or(bit)").alias("meets")), "run-pairs")
    both = planted.join(met, "block").select("first", "second", "block", "meets", "cls", "copies", "v", "path")
    # pairs of runs are few and long, so they get partitions of their own
    both = both.repartition(min(1024, 2 * runs * (runs + 1)), "first", "second")
    out = both.groupBy("first", "second").applyInArrow(_paired(cosine, axes, kind, run), "cls long, n long, other long")
    out = saved(out, "vector-links")
    drop(planted, nodes, near, met)
    return out


def block_pairs(nodes: DataFrame, pivots: np.ndarray, cosine: float) -> DataFrame:
    """(a, b), a <= b: the pairs of blocks of which two nodes (block, pivot, far: covering radius) are near enough.

    What is broadcast are the pivots' distances, at most ``MAX_PIVOTS`` squared; blocks are joined, never vectors.
    """
    tau = float(np.sqrt(2 - 2 * cosine))
    distance = np.sqrt(np.maximum(0.0, 2 - 2 * (pivots @ pivots.T)))
    np.fill_diagonal(distance, 0.0)
    reach = {r.pivot: r.far for r in nodes.groupBy("pivot").agg(F.max("far").alias("far")).collect()}  # one row a pivot
    used = sorted(reach)
    apart = [
        (p, q, float(distance[p, q])) for p in used for q in used if distance[p, q] <= reach[p] + reach[q] + tau + SLACK
    ]
    apart = F.broadcast(nodes.sparkSession.createDataFrame(apart, "p long, q long, d double"))
    a, b = (nodes.select(*[F.col(c).alias(c + x) for c in nodes.columns]) for x in "ab")
    pairs = a.join(apart, F.col("pivota") == F.col("p")).join(b, F.col("pivotb") == F.col("q"))
    pairs = pairs.filter((F.col("blocka") <= F.col("blockb")) & (F.col("d") <= F.col("fara") + F.col("farb") + (tau + SLACK)))
    return pairs.select(F.col("blocka").alias("a"), F.col("blockb").alias("b")).distinct()


def op1_cover_tree_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
