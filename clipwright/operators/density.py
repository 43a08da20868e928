"""Density clustering of embeddings (HDBSCAN) within partitions of any size.

The costly part, the minimum spanning tree under mutual reachability, takes two passes over all pairs of rows, in blocks that tasks read from a table of
packed vectors. The first finds each row's nearest rows. Within a partition, edges between these that are surely the shortest out of a component join rows to components (Boruvka);
the shortest joins known so far, among them some to a sample of rows, give each component a length of the longest edge on its way to a common root. The second pass
finds all edges between components that aren't longer than that; the tree lies within these, as an edge longer than each on another way between its ends is in no shortest tree.
Pairs are sifted by a lower bound of their distance in single precision and measured in double. No vectors, but the numbers and distances of each row's nearest rows and of the
found edges, are read in one task, which cuts the tree into clusters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow.dataset as ds
from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipwright.operators.metadata import dense_numbers
from clipwright.storage import Scratch

MIN_CLUSTER, MIN_SAMPLES = 50, 10
BLOCK = 2048
#: blocks whose rows a task compares with all others; rows by columns compared at once; listed nearest rows; rows of the sample; edges held before they are thinned
BLOCKS, ROWS, COLUMNS, NEAR, SAMPLE, HELD = 2, 512, 4096, 16, 1024, 300_000
#: share of the squared lengths by which a squared distance in single precision may be too large
SLACK = 2e-5


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1)[None] - 2 * x @ y.T, 0))


def core_distances(x: np.ndarray, k: int) -> np.ndarray:
    """Distance to the k-th nearest point, the point itself counting as the first."""
    out = np.empty(len(x))
    at = min(k, len(x)) - 1
    for lo in range(0, len(x), 512):
        d = distances(x[lo : lo + 512], x)
        d[np.arange(len(d)), np.arange(lo, lo + len(d))] = 0.0
        out[lo : lo + 512] = np.partition(d, at, axis=1)[:, at]
    return out


def spanning_tree(x: np.ndarray, core: np.ndarray) -> np.ndarray:
    """Prim's minimum spanning tree under mutual reachability; rows (a, b, distance) by distance."""
    n = len(x)
    reach = np.maximum(np.maximum(distances(x, x), core[:, None]), core[None])
    best, source = reach[0].copy(), np.zeros(n, np.int64)
    best[0] = np.inf
    inside = np.zeros(n, bool)
    inside[0] = True
    edges = np.empty((max(n - 1, 0), 3))
    for step in range(n - 1):
        nxt = int(best.argmin())
        edges[step] = source[nxt], nxt, best[nxt]
        inside[nxt] = True
        closer = reach[nxt] < best
        closer &= ~inside
        best[closer], source[closer] = reach[nxt][closer], nxt
        best[nxt] = np.inf
    return edges[np.argsort(edges[:, 2], kind="stable")]


def forest(a: np.ndarray, b: np.ndarray, d: np.ndarray, n: int, bound: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(edges of a minimum spanning forest of n nodes, component of each node) by Boruvka's rounds; ties by a, then b.

    With ``bound``, the least length that edges not given can have at each node, only edges that are the shortest out of a component for sure are taken.
    """
    order = np.lexsort((b, a, d))
    a, b, d = a[order], b[order], d[order]
    comp, alive, kept = np.arange(n), np.arange(len(a)), []
    while True:
        alive = alive[comp[a[alive]] != comp[b[alive]]]
        ca, cb = comp[a[alive]], comp[b[alive]]
        best = np.full(n, len(a))
        best[ca[::-1]] = alive[::-1]
        other = np.full(n, len(a))
        other[cb[::-1]] = alive[::-1]
        best = np.minimum(best, other)
        c = np.flatnonzero(best < len(a))
        if bound is not None:
            least = np.full(n, np.inf)
            np.minimum.at(least, comp, bound)
            c = c[d[best[c]] <= least[c]]
        if not len(c):
            return order[np.concatenate(kept)] if kept else np.zeros(0, np.int64), comp
        e = best[c]
        kept.append(np.unique(e))
        parent = np.arange(n)
        parent[c] = np.where(comp[a[e]] == c, comp[b[e]], comp[a[e]])
        both = (parent[parent] == np.arange(n)) & (np.arange(n) < parent)
        parent[both] = np.flatnonzero(both)
        while not np.array_equal(up := parent[parent], parent):
            parent = up
        comp = parent[comp]


def heights(a: np.ndarray, b: np.ndarray, d: np.ndarray, n: int) -> np.ndarray:
    """The longest edge of a spanning tree on the way from each node to a root, which lies where the larger parts meet."""
    parent, size, head = list(range(n)), [1] * n, list(range(n))
    near: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    order = np.argsort(d, kind="stable")
    top = 0
    for i, j, w in zip(a[order].tolist(), b[order].tolist(), d[order].tolist(), strict=True):
        near[i].append((j, w))
        near[j].append((i, w))
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        while parent[j] != j:
            parent[j] = parent[parent[j]]
            j = parent[j]
        if size[i] < size[j]:
            i, j = j, i
        parent[j] = i
        size[i] += size[j]
        top = head[i]
    out = np.full(n, np.inf)
    out[top] = 0.0
    stack = [top]
    while stack:
        i = stack.pop()
        for j, w in near[i]:
            if out[j] == np.inf:
                out[j] = max(out[i], w)
                stack.append(j)
    return out


def _exact(x: np.ndarray, y: np.ndarray, r: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of the pairs (x[r], y[c])."""
    out = np.empty(len(r))
    for lo in range(0, len(r), 8192):
        gap = x[r[lo : lo + 8192]] - y[c[lo : lo + 8192]]
        out[lo : lo + 8192] = np.einsum("ij,ij->i", gap, gap)
    return out


class Sieve:
    """Lower bounds of squared distances of some rows to blocks of others, in single precision."""

    def __init__(self, x: np.ndarray) -> None:
        self.x = x
        self.left = np.column_stack([-2 * x, np.ones(len(x)), (1 - SLACK) * (x * x).sum(1)]).astype(np.float32)

    def pairs(self, y: np.ndarray, most: np.ndarray, near: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Row and column numbers of all pairs whose squared distance may be at most the row's ``most``; with ``near``, infinite ones are first lowered to what that many columns keep."""
        square = (y * y).sum(1)
        right = np.column_stack([y, (1 - SLACK) * square, np.ones(len(y))]).astype(np.float32).T
        for lo in range(0, len(self.x), ROWS):
            low = self.left[lo : lo + ROWS] @ right
            limit = most[lo : lo + ROWS]
            if near and near <= len(y) and np.isinf(limit).any():
                some = slice(0, max(near, BLOCK))
                high = low[:, some] + 2 * SLACK * (self.left[lo : lo + ROWS, -1:] + square[some].astype(np.float32))
                limit = np.minimum(limit, np.partition(high, near - 1, axis=1)[:, near - 1] * (1 + 1e-6))
            # written so that pairs beyond single precision are measured
            r, c = np.divmod(np.flatnonzero(~(low > np.nextafter(limit.astype(np.float32), np.float32(np.inf))[:, None])), len(y))
            yield r + lo, c


def nearest_rows(x: np.ndarray, columns: Iterator[tuple[int, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, distances) of each row's k nearest among blocks of rows (first number, vectors), ties by number."""
    sieve, n = Sieve(x), len(x)
    at, far = np.full((n, k), np.iinfo(np.int64).max), np.full((n, k), np.inf)
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def settle() -> None:
        r = np.concatenate([np.repeat(np.arange(n), k), *(h[0] for h in held)])
        i, d = np.concatenate([at.ravel(), *(h[1] for h in held)]), np.concatenate([far.ravel(), *(h[2] for h in held)])
        order = np.lexsort((i, d, r))
        r = r[order]
        place = np.arange(len(r)) - np.searchsorted(r, np.arange(n))[r]
        order = order[place < k]
        at[:], far[:] = i[order].reshape(n, k), d[order].reshape(n, k)
        held.clear()

    for first, y in columns:
        waiting = sum(len(h[0]) for h in held)
        for r, c in sieve.pairs(y, far[:, -1], k):
            d = _exact(x, y, r, c)
            fits = d <= far[r, -1]
            held.append((r[fits], c[fits] + first, d[fits]))
            waiting += int(fits.sum())
            if waiting > max(k * n, HELD):
                settle()
                waiting = 0
        if waiting > k * n // 2 or np.isinf(far[:, -1]).any():
            settle()
    settle()
    return at, np.sqrt(far)


def cross_edges(x: np.ndarray, first: int, columns: Iterator[tuple[int, np.ndarray]], comp: np.ndarray, core: np.ndarray, height: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A minimum spanning forest over components of the edges from these rows to others that aren't longer than the row's height; numbers count from the partition's first row."""
    sieve, mine = Sieve(x), slice(first, first + len(x))
    most = height[mine] * (1 + 1e-9)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def thinned() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a, b, d = (np.concatenate([f[j] for f in found]) for j in range(3))
        ends, flat = np.unique(np.concatenate([comp[a], comp[b]]), return_inverse=True)
        keep, _ = forest(flat[: len(a)], flat[len(a) :], d, len(ends))
        return a[keep], b[keep], d[keep]

    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    found.append(none)
    waiting = 0
    for start, y in columns:
        for r, c in sieve.pairs(y, most * most):
            other = c + start
            fits = (comp[r + first] != comp[other]) & (core[other] <= most[r]) & (core[r + first] <= most[r])
            r, c, other = r[fits], c[fits], other[fits]
            d = np.maximum(np.maximum(np.sqrt(_exact(x, y, r, c)), core[other]), core[r + first])
            fits = d <= most[r]
            found.append((np.minimum(r + first, other)[fits], np.maximum(r + first, other)[fits], d[fits]))
            waiting += int(fits.sum())
            if waiting > HELD:
                found[:] = [thinned()]
                waiting = 0
    return thinned()


def condensed(tree: np.ndarray, n: int, least: int) -> list[tuple[int, int, float, int]]:
    """(parent, child, lambda, size): clusters get numbers from n on; a split counts if both sides have at least ``least`` points."""
    parent = list(range(2 * n - 1))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    left, right, dist, size = {}, {}, {}, dict.fromkeys(range(n), 1)
    for k, (a, b, d) in enumerate(tree):
        node, ra, rb = n + k, find(int(a)), find(int(b))
        left[node], right[node], dist[node], size[node] = ra, rb, d, size[ra] + size[rb]
        parent[ra] = parent[rb] = node

    def leaves(i: int) -> list[int]:
        out, stack = [], [i]
        while stack:
            j = stack.pop()
            if j < n:
                out.append(j)
            else:
                stack += [left[j], right[j]]
        return out

    rows, nxt = [], n + 1
    stack = [(2 * n - 2, n)] if n > 1 else []
    while stack:
        node, label = stack.pop()
        if node < n:
            continue
        lam = 1 / dist[node] if dist[node] > 0 else np.inf
        kids = [left[node], right[node]]
        big = [c for c in kids if size[c] >= least]
        if len(big) == 2:
            for c in kids:
                rows.append((label, nxt, lam, size[c]))
                stack.append((c, nxt))
                nxt += 1
            continue
        for c in kids:
            if c in big:
                stack.append((c, label))
            else:
                rows += [(label, p, lam, 1) for p in leaves(c)]
    return rows


def hdbscan(x: np.ndarray, least: int = MIN_CLUSTER, samples: int = MIN_SAMPLES) -> tuple[np.ndarray, np.ndarray]:
    """(labels, probabilities) of points that fit one machine."""
    x = np.asarray(x, dtype=np.float64)
    return cut_tree(spanning_tree(x, core_distances(x, samples)) if len(x) > 1 else np.zeros((0, 3)), len(x), least)


def cut_tree(tree: np.ndarray, n: int, least: int = MIN_CLUSTER) -> tuple[np.ndarray, np.ndarray]:
    """(labels, probabilities) by excess of mass; -1 is noise. Fewer than ``least`` points are all noise. The whole set is never one cluster."""
    labels, strength = np.full(n, -1), np.zeros(n)
    if n < max(least, 2):
        return labels, strength
    rows = condensed(tree, n, least)
    born = {n: 0.0} | {c: lam for _, c, lam, _ in rows if c >= n}
    finite = max([lam for *_, lam, _ in rows if np.isfinite(lam)], default=1.0)
    stability, kids, points = dict.fromkeys(born, 0.0), {c: [] for c in born}, {c: [] for c in born}
    for p, c, lam, size in rows:
        lam = min(lam, finite)
        stability[p] += (lam - min(born[p], finite)) * size
        (kids if c >= n else points)[p].append((c, lam))
    chosen = dict.fromkeys(born, False)
    for c in sorted(born, reverse=True):
        if c == n:
            continue
        below = sum(stability[k] for k, _ in kids[c])
        if kids[c] and below > stability[c]:
            stability[c] = below
        else:
            chosen[c] = True
            stack = [k for k, _ in kids[c]]
            while stack:
                k = stack.pop()
                chosen[k] = False
                stack += [j for j, _ in kids[k]]
    for label, c in enumerate(sorted(c for c in born if chosen[c])):
        stack, members = [c], []
        while stack:
            k = stack.pop()
            members += points[k]
            stack += [j for j, _ in kids[k]]
        top = max(lam for _, lam in members)
        for p, lam in members:
            labels[p], strength[p] = label, lam / top if top > 0 else 1.0
    return labels, strength


def cluster_partitions(df: DataFrame, *, record: str, vector: str, partition: str, least: int = MIN_CLUSTER, samples: int = MIN_SAMPLES, block: int = BLOCK) -> DataFrame:
    """(record, partition, raw_label, cluster_confidence) of each row with a vector and a partition, clustered within its partition.

    Vectors are packed in blocks of ``block`` rows, which tasks read from the folder all executors share; the size of blocks doesn't change the tree's distances. Labels are numbers within a
    partition, -1 for noise. An empty table gives no rows; repeated rows are points of their own.
    """
    scratch = Scratch(df.sparkSession, "density")
    kind = "float" if df.schema[vector].dataType.simpleString() == "array<float>" else "double"
    rows = df.select(F.col(record).alias("record"), F.col(partition).cast("string").alias("partition"), F.col(vector).cast(f"array<{kind}>").alias("v")).filter("v is not null and partition is not null")
    # numbers in order of partition and record, fixed by the written table
    points = scratch.keep(dense_numbers(rows, [F.asc("partition"), F.asc("record"), F.asc("v")], "i").withColumn("i", F.col("i").cast("long")))
    span = points.groupBy("partition").agg(F.min("i").alias("start"), F.count(F.lit(1)).alias("n"))
    placed = points.drop("record").join(span, "partition").withColumn("i", F.col("i") - F.col("start")).withColumn("block", F.floor(F.col("i") / F.lit(block)).cast("int"))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("i")
        return pd.DataFrame({**{c: [pdf[c].iloc[0]] for c in ("partition", "block", "start", "n")}, "first": [pdf["i"].iloc[0]], "size": [len(pdf)], "x": [np.stack(pdf["v"].to_numpy()).astype(kind).tobytes()]})

    packed = scratch.keep(placed.groupBy("partition", "block").applyInPandas(pack, "partition string, block int, start long, n long, first long, size int, x binary"))
    # tasks read vectors themselves, but for those that hold a whole partition
    tasks = packed.withColumn("task", F.floor(F.col("block") / F.lit(BLOCKS))).withColumn("x", F.when(F.col("n") <= block * BLOCKS, F.col("x")))
    count = max(1, tasks.select("partition", "task").distinct().count())
    # a number of its own, as few bytes here mean much work
    tasks = tasks.repartition(count, "partition", "task").groupBy("partition", "task")

    def unpacked(x: bytes, size: int) -> np.ndarray:
        return np.frombuffer(x, kind).astype(np.float64).reshape(size, -1)

    def stored(path: str, name: str, columns: list[str], blocks: list[int] | None = None) -> Iterator[dict]:
        system, root = FileSystem.from_uri(path) if ":" in path else (LocalFileSystem(), path)
        # read as a stream: a row group of packed vectors may be large
        streamed = ds.ParquetFileFormat(default_fragment_scan_options=ds.ParquetFragmentScanOptions(use_buffered_stream=True, buffer_size=1 << 20, pre_buffer=False))
        table, rows = ds.dataset(root, filesystem=system, format=streamed), ds.field("partition") == name
        for batch in table.to_batches(columns=columns, filter=rows if blocks is None else rows & ds.field("block").isin(blocks), batch_size=2, batch_readahead=0, fragment_readahead=0, use_threads=False):
            yield from batch.to_pylist()

    at_packed = packed._cw_path  # type: ignore[attr-defined]

    def own(pdf: pd.DataFrame) -> tuple[np.ndarray, int, int]:
        name, first, n = pdf["partition"].iloc[0], int(pdf["first"].min()), int(pdf["n"].iloc[0])
        given = pdf.to_dict("records") if n <= block * BLOCKS else stored(at_packed, name, ["first", "size", "x"], pdf["block"].tolist())
        return np.concatenate([unpacked(r["x"], r["size"]) for r in sorted(given, key=lambda r: r["first"])]), first, n

    def others(name: str, n: int, x: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """All rows of a partition in stretches of neighbouring numbers."""
        if x is not None and len(x) == n:
            for lo in range(0, n, COLUMNS):
                yield lo, x[lo : lo + COLUMNS]
            return
        begin, some = 0, []
        for r in stored(at_packed, name, ["first", "size", "x"]):
            y = unpacked(r["x"], r["size"])
            if some and (r["first"] != begin + sum(map(len, some)) or sum(map(len, some)) + len(y) > COLUMNS):
                yield begin, np.concatenate(some)
                some = []
            begin, some = (begin, [*some, y]) if some else (r["first"], [y])
        if some:
            yield begin, np.concatenate(some)

    def near(pdf: pd.DataFrame) -> pd.DataFrame:
        x, first, n = own(pdf)
        name = pdf["partition"].iloc[0]
        at, far = nearest_rows(x, others(name, n, x), min(max(samples, NEAR), n))
        return pd.DataFrame({"partition": [name], "start": [pdf["start"].iloc[0]], "first": [first], "n": [n], "at": [at.astype(np.int32).tobytes()], "far": [far.tobytes()]})

    listed = scratch.keep(tasks.applyInPandas(near, "partition string, start long, first long, n long, at binary, far binary"))

    at_listed = listed._cw_path  # type: ignore[attr-defined]

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        name, n = pdf["partition"].iloc[0], int(pdf["n"].iloc[0])
        k = min(max(samples, NEAR), n)
        at, far = np.empty((n, k), np.int32), np.empty((n, k))
        for r in stored(at_listed, name, ["first", "at", "far"]):
            some = np.frombuffer(r["far"]).reshape(-1, k)
            far[r["first"] : r["first"] + len(some)] = some
            at[r["first"] : r["first"] + len(some)] = np.frombuffer(r["at"], np.int32).reshape(-1, k)
        core = far[:, min(samples, k) - 1]
        # each pair once: of two rows that surely list each other, the first one's edge
        once = (np.arange(n)[:, None] < at) | (far >= far[at, -1])
        once &= np.arange(n)[:, None] != at
        a, b = np.nonzero(once)[0].astype(np.int32), at[once].astype(np.int32)
        d = np.maximum(np.maximum(far[once], core[a]), core[b])
        lo, hi, last = np.minimum(a, b), np.maximum(a, b), far[:, -1].copy()
        del at, far, once, a, b
        kept, comp = forest(lo, hi, d, n, last if k < n else np.full(n, np.inf))
        ends, flat = np.unique(comp, return_inverse=True)
        height = np.zeros(len(ends))
        if len(ends) > 1:
            pick = np.sort(np.random.default_rng(0).choice(n, min(SAMPLE, n), replace=False))
            some = {f: y[pick[(pick >= f) & (pick < f + len(y))] - f] for f, y in others(name, n)}
            xs = np.concatenate([some[f] for f in sorted(some)])
            tree = spanning_tree(xs, core[pick])
            out = flat[lo] != flat[hi]
            ea, eb, ed = [lo[out], pick[tree[:, 0].astype(np.int64)]], [hi[out], pick[tree[:, 1].astype(np.int64)]], [d[out], tree[:, 2] * (1 + 1e-9) + 1e-12]
            for f, y in ((f + lo, y[lo : lo + ROWS]) for f, y in others(name, n) for lo in range(0, len(y), ROWS)):
                reach = np.maximum(distances(y, xs), core[pick][None])
                reach[flat[f : f + len(y), None] == flat[pick][None]] = np.inf
                best = reach.argmin(axis=1)
                ea.append(np.arange(f, f + len(y)))
                eb.append(pick[best])
                ed.append(np.maximum(np.maximum(np.sqrt(_exact(y, xs, np.arange(len(y)), best)), core[pick][best]), core[f : f + len(y)]))
            ea, eb, ed = flat[np.concatenate(ea)], flat[np.concatenate(eb)], np.concatenate(ed)
            way, _ = forest(ea, eb, ed, len(ends))
            height = heights(ea[way], eb[way], ed[way], len(ends))
        columns = {"comp": flat.astype(np.int64), "core": core, "height": height[flat], "a": lo[kept].astype(np.int64), "b": hi[kept].astype(np.int64), "d": d[kept]}
        return pd.DataFrame({"partition": [name], "parts": [len(ends)], **{c: [v.tobytes()] for c, v in columns.items()}})

    state = scratch.keep(listed.select("partition", "n").distinct().groupBy("partition").applyInPandas(link, "partition string, parts long, comp binary, core binary, height binary, a binary, b binary, d binary"))
    at_state = state._cw_path  # type: ignore[attr-defined]

    def cross(pdf: pd.DataFrame) -> pd.DataFrame:
        x, first, n = own(pdf)
        name = pdf["partition"].iloc[0]
        known = next(stored(at_state, name, ["parts", "comp", "core", "height"]))
        a, b, d = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        if known["parts"] > 1:
            a, b, d = cross_edges(x, first, others(name, n, x), np.frombuffer(known["comp"], np.int64), np.frombuffer(known["core"]), np.frombuffer(known["height"]))
        return pd.DataFrame({"partition": [name], "start": [pdf["start"].iloc[0]], "n": [n], "a": [a.tobytes()], "b": [b.tobytes()], "d": [d.tobytes()]})

    edges = scratch.keep(tasks.applyInPandas(cross, "partition string, start long, n long, a binary, b binary, d binary"))

    def label(pdf: pd.DataFrame) -> pd.DataFrame:
        n, known = int(pdf["n"].iloc[0]), next(stored(at_state, pdf["partition"].iloc[0], ["a", "b", "d"]))
        a, b = (np.concatenate([np.frombuffer(v, np.int64) for v in (known[c], *pdf[c])]) for c in "ab")
        d = np.concatenate([np.frombuffer(v) for v in (known["d"], *pdf["d"])])
        keep, _ = forest(a, b, d, n)
        keep = keep[np.lexsort((b[keep], a[keep], d[keep]))]
        labels, strength = cut_tree(np.column_stack([a[keep], b[keep], d[keep]]), n, least)
        return pd.DataFrame({"i": int(pdf["start"].iloc[0]) + np.arange(n), "raw_label": labels.astype(np.int32), "cluster_confidence": strength})

    found = edges.groupBy("partition").applyInPandas(label, "i long, raw_label int, cluster_confidence double")
    out = points.select("i", "record", "partition").join(found, "i")
    return out.select("record", "partition", "raw_label", "cluster_confidence").withColumnRenamed("record", record)

