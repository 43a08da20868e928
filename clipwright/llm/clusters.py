"""Clusters of mutually similar records, each described by its size and its most typical members.

Records are vectors (given embeddings, or texts hashed to weighted features). Clusters are the components of all pairs with a cosine of at least a
threshold, that is with an angle of at most t. Distributed k-means with parallel oversampled seeding, on a bounded sample, gives centroids, and these
index all vectors so that no alike pair is missed:

* The core of a cell are the vectors within t / 2 of its centroid. Any two of them are alike, so each is linked to the cell's pivot and to no other.
* A vector that is alike to one of the core lies within 1.5 t of the centroid. There are few such vectors; most are alike to the pivot, and the
  others, guests of the cell, are compared with the core in blocks.
* So all pairs with a vector of a core are done. The vectors that are in no core go through the same again with centroids of their own, and what no
  round gathers (vectors far from all others, mostly) is compared inside cells of k-means, with those as guests that are near enough to a border. That
  last step has a bound on memory and shuffle for each cell, but its work grows with the square of such vectors, as vectors of many dimensions without near ones can't be told apart by cells.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.ml.feature import IDF, HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipwright.llm.related import components
from clipwright.operators.skew import heavy_keys, salted_join
from clipwright.storage import Scratch

MAX_CELLS = 4096  # bounds what is broadcast; fewer cells than vectors ask for mean more work, not other results
SAMPLE_PER_CELL = 64
ROUNDS = 4
FEW = 40_000  # up to so many vectors comparing all costs less than another round
BLOCK = 16_384
LOOSE_CELL = 16_384
SLACK = 1e-5
TEXT_DIMS = 256


def hashed_features(df: DataFrame, text: str, into: str = "embedding", *, dims: int = TEXT_DIMS) -> DataFrame:
    """``df`` with ``into``: tf-idf of the text's words, hashed to ``dims`` features, as array<float>; null and empty texts give zeros, which no cluster takes."""
    words = F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+")
    terms = HashingTF(numFeatures=dims, inputCol="_w", outputCol="_tf").transform(df.withColumn("_w", F.filter(words, lambda w: w != "")))
    weighted = IDF(inputCol="_tf", outputCol="_tfidf").fit(terms).transform(terms)
    return weighted.withColumn(into, vector_to_array("_tfidf", "float32")).drop("_w", "_tf", "_tfidf")


def common_length(df: DataFrame, vector: str) -> int:
    """The length most vectors have, of equally frequent ones the smaller; 1 without vectors."""
    sizes = df.select(F.size(vector).alias("d")).filter("d > 0").groupBy("d").agg(F.count(F.lit(1)).alias("n"))
    top = sizes.orderBy(F.desc("n"), "d").first()
    return top["d"] if top else 1


def usable_vectors(df: DataFrame, *, record: str, vector: str, ok: str | None, dims: int | None, packed: bool = False) -> DataFrame:
    """(record, h, v): unit vectors with a 128-bit digest, as array<float> or, ``packed``, as the bytes of their 32-bit floats, which are cheaper to move. Left out: null records, ``ok`` false, and vectors that are null, zero, hold null, NaN or infinity, or have another length than ``dims`` (without it: than most have)."""
    rows = df.filter(F.coalesce(F.col(ok), F.lit(True))) if ok else df
    dims = dims or common_length(rows, vector)
    rows = rows.select(F.col(record).cast("string").alias("record"), F.col(vector).cast("array<float>").alias("x")).filter(F.col("record").isNotNull() & (F.size("x") == dims))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), dims).astype(np.float64)
            with np.errstate(all="ignore"):
                n = np.sqrt((x * x).sum(axis=1))
                good = np.isfinite(n) & (n > 0)
                v = (x[good] / n[good, None]).astype(np.float32)
            digests = pa.array([xxhash.xxh3_128_digest(r.tobytes()) for r in v], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(good)), digests, _packed(v) if packed else _lists(v)], names=["record", "h", "v"])

    return rows.mapInArrow(run, f"record string, h binary, v {'binary' if packed else 'array<float>'}")


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of an Arrow column of lists or packed vectors as one array, without a copy for each row; null items become NaN."""
    if pa.types.is_binary(column.type):
        _, offsets, data = column.buffers()
        if not len(column) or data is None:
            return np.zeros((0, dims), np.float32)
        ends = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
        return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].view(np.float32).reshape(-1, dims)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _packed(x: np.ndarray) -> pa.Array:
    """Each row's 32-bit floats as bytes."""
    x = np.ascontiguousarray(x, np.float32)
    offsets = np.arange(len(x) + 1, dtype=np.int32) * (x.shape[1] * 4)
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(offsets), pa.py_buffer(x)])


def _lists(x: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * (x.shape[1] if x.ndim > 1 else 0)), pa.array(x.reshape(-1)))


def _stack(s: pd.Series) -> np.ndarray:
    if len(s) and isinstance(s.iloc[0], bytes):
        return np.frombuffer(b"".join(s), np.float32).reshape(len(s), -1)
    return np.stack(s.to_numpy()).astype(np.float32) if len(s) else np.zeros((0, 1), np.float32)


def _unit(c: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(c, axis=1, keepdims=True)
    return (c / np.where(n > 0, n, 1)).astype(np.float32)


def _chance(h: pa.Array, seed: int) -> np.ndarray:
    """A number in (0, 1) for each digest, the same in a task that runs again."""
    return (np.asarray([xxhash.xxh3_64_intdigest(b, seed) >> 11 for b in h.to_pylist()], np.float64) + 0.5) / 2.0**53


def thin_out(points: np.ndarray, weights: np.ndarray, k: int, seed: int, steps: int = 3) -> np.ndarray:
    """``k`` unit centroids of weighted points, at most a few times k: seeding by distance, then Lloyd steps."""
    if len(points) <= k:
        return points
    rng = np.random.default_rng(seed)
    picked = [int(weights.argmax())]
    gap = 1 - points @ points[picked[0]]
    for _ in range(k - 1):
        p = np.cumsum(np.maximum(gap, 0) * weights)
        if p[-1] <= 0:
            break
        picked.append(int(min(np.searchsorted(p, rng.random() * p[-1], side="right"), len(points) - 1)))
        gap = np.minimum(gap, 1 - points @ points[picked[-1]])
    c = points[picked]
    for _ in range(steps):
        own = (points @ c.T).argmax(1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, points * weights[:, None])
        c = np.where(np.linalg.norm(sums, axis=1, keepdims=True) > 0, _unit(sums), c)
    return c


def fit_centroids(vectors: DataFrame, k: int, dims: int, scratch: Scratch, *, n: int, seed: int = 7, rounds: int = 2, steps: int = 2) -> tuple[np.ndarray, list[str | None], np.ndarray]:
    """(unit centroids, name of each one's nearest vector or None, that vector) by k-means|| seeding and Lloyd steps over tasks.

    They are fitted on about ``SAMPLE_PER_CELL`` times ``k`` of the ``n`` vectors, taken by hash; all if there are fewer. Only candidates for
    centroids, some 3 k rows at most, and sums by cell come to the driver.
    """
    share = min(1.0, SAMPLE_PER_CELL * k / max(n, 1))
    wanted = F.pmod(F.xxhash64("h"), F.lit(1 << 20)) < max(1, round(share * (1 << 20)))
    sample = scratch.keep(vectors.filter(wanted).select("record", "h", "v") if share < 1 else vectors.select("record", "h", "v"))
    context = vectors.sparkSession.sparkContext

    def draw(known: np.ndarray | None, count: int, turn: int) -> np.ndarray:
        """``count`` different rows, with chances in proportion to their distance from the known centroids: the smallest exponential draws."""
        shared = context.broadcast(known)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best: list[tuple[np.ndarray, np.ndarray]] = []
            for batch in batches:
                x = _matrix(batch.column(2), dims)
                gap = np.ones(len(x)) if shared.value is None else np.maximum(1 - (x @ shared.value.T).max(axis=1), 0)
                with np.errstate(divide="ignore"):
                    key = -np.log(_chance(batch.column(1), seed + turn)) / gap
                best.append((key, x))
                keys, rows = np.concatenate([b[0] for b in best]), np.concatenate([b[1] for b in best])
                at = np.argsort(keys, kind="stable")[:count]
                best = [(keys[at], rows[at])]
            for keys, rows in best:
                fine = np.isfinite(keys)
                yield pa.RecordBatch.from_arrays([pa.array(keys[fine]), _lists(rows[fine])], names=["key", "v"])

        got = sample.mapInArrow(run, "key double, v array<float>").orderBy("key").limit(count).toPandas()
        return _stack(got["v"]) if len(got) else np.zeros((0, dims), np.float32)

    def gather(c: np.ndarray) -> pd.DataFrame:
        """By cell: rows, their sum, and the row nearest the centroid."""
        shared = context.broadcast(c)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            k = len(shared.value)
            sums, count = np.zeros((k, dims)), np.zeros(k, np.int64)
            cos, name, row = np.full(k, -2.0), np.full(k, None, object), np.zeros((k, dims), np.float32)
            for batch in batches:
                x, names = _matrix(batch.column(2), dims), batch.column(0).to_pylist()
                s = x @ shared.value.T
                own = s.argmax(axis=1)
                near = s[np.arange(len(x)), own]
                np.add.at(sums, own, x)
                count += np.bincount(own, minlength=k)
                order = np.lexsort((-near, own))
                first = order[np.unique(own[order], return_index=True)[1]]
                first = first[near[first] > cos[own[first]]]
                cos[own[first]], row[own[first]] = near[first], x[first]
                name[own[first]] = [names[i] for i in first]
            at = np.flatnonzero(count)
            columns = [pa.array(at.astype(np.int32)), pa.array(count[at]), _lists(sums[at]), pa.array(cos[at]), pa.array(list(name[at]), pa.string()), _lists(row[at])]
            yield pa.RecordBatch.from_arrays(columns, names=["cell", "n", "total", "cos", "name", "row"])

        def merge(pdf: pd.DataFrame) -> pd.DataFrame:
            """Several cells at once, as there are many small ones."""
            pdf = pdf.sort_values(["cell", "cos", "name"], ascending=[True, False, True])
            cells, first, of = np.unique(pdf["cell"].to_numpy(), return_index=True, return_inverse=True)
            total = np.zeros((len(cells), dims))
            np.add.at(total, of, np.stack(pdf["total"].to_numpy()))
            count = np.bincount(of, weights=pdf["n"].to_numpy()).astype(np.int64)
            best = pdf.iloc[first]
            return pd.DataFrame({"cell": cells, "n": count, "total": list(total), "name": best["name"].to_numpy(), "row": list(best["row"])})

        parts = sample.mapInArrow(run, "cell int, n long, total array<double>, cos double, name string, row array<float>")
        merged = parts.groupBy(F.pmod("cell", F.lit(32))).applyInPandas(merge, "cell int, n long, total array<double>, name string, row array<float>")
        return merged.toPandas().sort_values("cell")

    c = draw(None, max(1, k // 2), 0)
    for turn in range(1, rounds + 1):
        c = np.concatenate([c, draw(c, k, turn)])
    found = gather(c)
    c = thin_out(c[found["cell"].to_numpy()], found["n"].to_numpy(np.float64), k, seed)
    names: list[str | None] = []
    rows = np.zeros((0, dims), np.float32)
    for _ in range(steps):
        found = gather(c)  # cells without rows fall out
        c, names, rows = _unit(np.stack(found["total"].to_numpy())), found["name"].tolist(), _stack(found["row"])
    scratch.free(sample)
    return c, names, rows


def border_cells(x: np.ndarray, c: np.ndarray, least: float) -> tuple[np.ndarray, list[np.ndarray]]:
    """The nearest centroid of each row and the cells of smaller number it is a guest of, such that of two rows with a cosine of at least ``least`` one is in the other's home.

    The way between two such rows is at most ``sqrt(2 - 2 * least)`` long and crosses the border of their homes, so both are within that of the border. Each
    pair meets in the one of the two homes with the smaller number, hence once.
    """
    home, guests = np.empty(len(x), np.int64), []
    reach = math.sqrt(2 * (1 - least + SLACK))
    wide = c.astype(np.float64)
    apart = np.sqrt(np.maximum((wide * wide).sum(1)[:, None] + (wide * wide).sum(1)[None] - 2 * wide @ wide.T, 0))
    half = (wide * wide).sum(1) / 2
    for lo in range(0, len(x), 4096):
        part = x[lo : lo + 4096] @ c.T - half
        h = part.argmax(1)
        home[lo : lo + 4096] = h
        near = (part[np.arange(len(h)), h][:, None] - part) <= reach * apart[h] + SLACK
        near &= np.arange(len(c))[None] < h[:, None]
        guests += [np.flatnonzero(r) for r in near]
    return home, guests


def spanning_links(x: np.ndarray, guest: np.ndarray | None, least: float) -> list[tuple[int, int]]:
    """Pairs of rows that join them as all pairs with a cosine of at least ``least`` do, but for pairs of two guests.

    Rows are compared in tiles; of a tile's alike pairs only those that join two groups are taken, so dense groups make few links.
    """
    n = len(x)
    guest = np.zeros(n, bool) if guest is None else guest
    own, label = np.flatnonzero(~guest), np.arange(n)
    order = np.concatenate([own, np.flatnonzero(guest)])
    out: list[tuple[int, int]] = []
    for lo in range(0, len(own), 512):
        rows = own[lo : lo + 512]
        for at in range(lo, n, 8192):
            cols = order[at : at + 8192]
            hit = x[rows] @ x[cols].T >= least
            some = np.flatnonzero(hit.any(axis=0))
            hit, cols = hit[:, some], cols[some]
            while True:
                new = hit & (label[rows][:, None] != label[cols][None])
                c = np.flatnonzero(new.any(axis=0))
                if not len(c):
                    break
                r = new[:, c].argmax(axis=0)
                parent: dict[int, int] = {}
                for a, b in zip(rows[r].tolist(), cols[c].tolist(), strict=True):
                    p, q = int(label[a]), int(label[b])
                    while p in parent:
                        p = parent[p]
                    while q in parent:
                        q = parent[q]
                    if p != q:
                        parent[max(p, q)] = min(p, q)
                        out.append((a, b))
                moved = np.arange(n)
                for p in sorted(parent):  # parents are smaller, so theirs are known
                    moved[p] = moved[parent[p]]
                label = moved[label]
    return out


class Cores:
    """Centroids whose cells have a pivot in their core, for placing vectors (see the module's text)."""

    def __init__(self, centroids: np.ndarray, names: list[str | None], rows: np.ndarray, least: float) -> None:
        angle = math.acos(max(-1.0, min(1.0, least)))
        self.least, self.core, self.meet = least, math.cos(angle / 2) + SLACK, math.cos(min(math.pi, 1.5 * angle)) - SLACK
        usable = (centroids * rows).sum(axis=1) >= self.core if len(centroids) else np.zeros(0, bool)
        self.centroids, self.rows, self.names = centroids[usable], rows[usable], [n for n, u in zip(names, usable, strict=True) if u]

    def place(self, x: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """Home of each core row (-1 for the others), (row, cell) of rows alike to a pivot, and (row, cell) of guests."""
        home = np.full(len(x), -1, np.int32)
        if not len(self.centroids) or not len(x):
            none = np.zeros(0, np.int64)
            return home, (none, none), (none, none)
        linked, guests = [], []
        for lo in range(0, len(x), 4096):
            part = x[lo : lo + 4096]
            s = part @ self.centroids.T
            h = s.argmax(axis=1)
            inside = s[np.arange(len(h)), h] >= self.core
            home[lo : lo + 4096][inside] = h[inside]
            meets = s >= self.meet
            meets[np.flatnonzero(inside), h[inside]] = False
            row, cell = np.nonzero(meets)
            alike = np.einsum("ij,ij->i", part[row], self.rows[cell]) >= self.least
            linked.append((np.concatenate([np.flatnonzero(inside), row[alike]]) + lo, np.concatenate([h[inside], cell[alike]])))
            guests.append((row[~alike] + lo, cell[~alike]))
        both = lambda parts: tuple(np.concatenate([p[i] for p in parts]) for i in (0, 1))
        return home, both(linked), both(guests)


def _grouped(row: np.ndarray, values: np.ndarray, n: int, kind: pa.DataType) -> pa.ListArray:
    """A list of values for each of n rows."""
    order = np.argsort(row, kind="stable")
    offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values[order].tolist(), kind))


def core_links(vectors: DataFrame, cores: Cores, dims: int, scratch: Scratch, *, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(links (a, b), vectors that are in no core). The links join the records as all alike pairs do of which one vector is in a core.

    Broadcast are centroids and pivots, at most ``MAX_CELLS`` each. Guests meet the core of a cell in blocks of both, so no task holds a whole large cell.
    """
    shared = vectors.sparkSession.sparkContext.broadcast(cores)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        for batch in batches:
            home, (row, cell), (guest, of) = c.place(_matrix(batch.column(2), dims))
            to = np.asarray(c.names, dtype=object)[cell] if len(cell) else np.zeros(0, object)
            columns = [*batch.columns, pa.array(home), _grouped(row, to, len(home), pa.string()), _grouped(guest, of, len(home), pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["record", "h", "v", "home", "to", "guest"])

    placed = scratch.keep(vectors.select("record", "h", "v").mapInArrow(place, "record string, h binary, v binary, home int, to array<string>, guest array<int>"))
    links = placed.select(F.col("record").alias("a"), F.explode("to").alias("b"))
    guests = placed.filter(F.size("guest") > 0).select("record", "h", "v", F.explode("guest").alias("cell"))
    visited = {r["cell"]: r["n"] for r in guests.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most a row for each cell
    if visited:
        sizes = placed.filter(F.col("home").isin(list(visited))).groupBy("home").agg(F.count(F.lit(1)).alias("n")).collect()
        plan = [(r["home"], math.ceil(r["n"] / block), math.ceil(visited[r["home"]] / block)) for r in sizes]
        where = vectors.sparkSession.createDataFrame(plan, "cell int, own int, other int")
        mine = placed.filter("home >= 0").select("record", "h", "v", F.col("home").alias("cell"))
        links = links.unionByName(_met_in_blocks(mine, guests, where, cores.least))
    return links, placed.filter("home < 0").select("record", "h", "v")


def _met_in_blocks(own: DataFrame, other: DataFrame, plan: DataFrame, least: float, *, among: bool = False) -> DataFrame:
    """(a, b): links between own and other rows (record, h, v) of each cell, by blocks of both; ``among`` own ones too. ``plan`` has the numbers of blocks (cell, own, other)."""
    part = lambda c: F.pmod(F.xxhash64("h"), F.col(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    left = own.join(F.broadcast(plan), "cell").select("cell", "record", "v", part("own").alias("i"), every("other").alias("j"), F.lit(True).alias("left"))
    right = other.join(F.broadcast(plan), "cell").select("cell", "record", "v", every("own").alias("i"), "other").select(
        "cell", "record", "v", "i", F.pmod(F.xxhash64("record"), F.col("other")).cast("int").alias("j"), F.lit(False).alias("left")
    )

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        x, left, names = _stack(pdf["v"]), pdf["left"].to_numpy(bool), pdf["record"].to_numpy()
        if among:
            out = [(names[a], names[b]) for a, b in spanning_links(x, ~left, least)]
            return pd.DataFrame(out, columns=["a", "b"])
        mine, theirs = np.flatnonzero(left), np.flatnonzero(~left)
        out = []
        for lo in range(0, len(theirs) if len(mine) else 0, 1024):
            some = theirs[lo : lo + 1024]
            hit = x[some] @ x[mine].T >= least
            found = hit.any(axis=1)  # own rows are joined with each other already, so one of them is enough
            out += zip(names[some[found]], names[mine[hit[found].argmax(axis=1)]], strict=True)
        return pd.DataFrame(out, columns=["a", "b"])

    return left.unionByName(right).groupBy("cell", "i", "j").applyInPandas(link, "a string, b string")


def loose_links(vectors: DataFrame, n: int, least: float, dims: int, scratch: Scratch, *, cells: int | None = None, block: int = BLOCK, seed: int = 7) -> DataFrame:
    """(a, b): links that join the records as all alike pairs do. Cells have some ``LOOSE_CELL`` rows, and large ones are met in blocks."""
    k = cells or min(MAX_CELLS, max(1, math.ceil(n / LOOSE_CELL)))
    centroids = fit_centroids(vectors, k, dims, scratch, n=n, seed=seed)[0] if k > 1 else np.zeros((1, dims), np.float32)
    shared = vectors.sparkSession.sparkContext.broadcast(centroids)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            home, guests = border_cells(_matrix(batch.column(2), dims), shared.value, least)
            lists = _grouped(np.repeat(np.arange(len(home)), [len(g) for g in guests]), np.concatenate([*guests, np.zeros(0, np.int64)]), len(home), pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home.astype(np.int32)), lists], names=["record", "h", "v", "home", "guest"])

    placed = scratch.keep(vectors.select("record", "h", "v").mapInArrow(place, "record string, h binary, v binary, home int, guest array<int>"))
    own = placed.select("record", "h", "v", F.col("home").alias("cell"))
    other = placed.select("record", "h", "v", F.explode("guest").alias("cell"))
    # a large cell's own rows meet each other in blocks too, so they come as other ones then
    sizes = {r["cell"]: r["n"] for r in own.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    visits = {r["cell"]: r["n"] for r in other.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    large = [c for c, m in sizes.items() if m > block]
    if large:
        other = other.unionByName(own.filter(F.col("cell").isin(large)))
    blocks = [(c, math.ceil(m / block), max(1, math.ceil((visits.get(c, 0) + (m if m > block else 0)) / block))) for c, m in sizes.items()]
    plan = vectors.sparkSession.createDataFrame(blocks, "cell int, own int, other int")
    return _met_in_blocks(own, other, plan, least, among=True)


def similarity_clusters(
    df: DataFrame, *, record: str, vector: str, ok: str | None = None, least: float = 0.8, dims: int | None = 64, cells: int | None = None, seed: int = 7, few: int = FEW, block: int = BLOCK
) -> DataFrame:
    """(record, cluster_key): each usable record and the smallest record of its cluster, singles included.

    ``cells`` defaults to three times the square root of the number of different vectors, at most ``MAX_CELLS``; like ``few`` (rounds after the first go on above it) and ``block`` it
    decides about the work only, as each two alike vectors meet. Rows of one record are one node, whatever their vectors. Equal vectors are compared once. Unusable rows
    (see ``usable_vectors``) are left out; an empty table gives no rows.
    """
    if not 0 < least < 1:
        raise ValueError("least must be between 0 and 1")
    scratch = Scratch(df.sparkSession, "clusters")
    dims = dims or common_length(df.filter(F.coalesce(F.col(ok), F.lit(True))) if ok else df, vector)
    rows = scratch.keep(usable_vectors(df, record=record, vector=vector, ok=ok, dims=dims, packed=True))
    # equal vectors once, told by their digests
    left = scratch.keep(rows.groupBy("h").agg(F.min("record").alias("record"), F.any_value("v").alias("v")))
    firsts = left.select("h", F.col("record").alias("first"))
    edges = salted_join(rows.select("record", "h"), firsts, "h", heavy=heavy_keys(rows, "h")).select(F.col("record").alias("a"), F.col("first").alias("b")).filter("a <> b")
    n = left.count()
    for turn in range(ROUNDS):
        if n <= (few if turn else 1):  # the first round is for tables of every size
            break
        k = cells or min(MAX_CELLS, round(3 * math.sqrt(n)))
        cores = Cores(*fit_centroids(left, k, dims, scratch, n=n, seed=seed + turn), least)
        links, left = core_links(left, cores, dims, scratch, block=block)
        edges = edges.unionByName(links)
        before, n = n, left.count()
        if n > 0.75 * before:
            break
    if n > 1:
        edges = edges.unionByName(loose_links(left, n, least, dims, scratch, cells=cells, block=block, seed=seed))
    found = components(edges, scratch=scratch).select(F.col("node").alias("record"), F.col("root").alias("cluster_key"))
    every = scratch.keep(rows.select("record").distinct().join(found, "record", "left").select("record", F.coalesce("cluster_key", "record").alias("cluster_key")))
    scratch.free_all(every)
    return every


def describe_clusters(df: DataFrame, members: DataFrame, *, record: str, vector: str, ok: str | None = None, dims: int | None = 64, typical: int = 3) -> DataFrame:
    """(cluster_key, size, typical): records of each cluster and the ``typical`` ones nearest its centroid, nearest first, ties by record.

    A record with several vectors counts once in ``size`` and by its nearest vector in ``typical``.
    """
    scratch = Scratch(df.sparkSession, "describe")
    rows = scratch.keep(usable_vectors(df, record=record, vector=vector, ok=ok, dims=dims))
    once = rows.groupBy("record", "h").agg(F.any_value("v").alias("v"))
    joined = scratch.keep(salted_join(once, members, "record", heavy=heavy_keys(once, "record")).drop("h"))
    head = joined.first()
    scratch.free(rows)
    width = dims or (len(head["v"]) if head else 1)
    sums = joined.groupBy("cluster_key").agg(*(F.sum(F.col("v")[i].cast("double")).alias(f"s{i}") for i in range(width)))
    centre = sums.select("cluster_key", F.array(*(F.col(f"s{i}") for i in range(width))).alias("c"))
    near = salted_join(joined, centre, "cluster_key", heavy=heavy_keys(joined, "cluster_key"))
    dot = F.aggregate(F.zip_with("v", "c", lambda a, b: a * b), F.lit(0.0), lambda s, e: s + e)
    length = F.sqrt(F.aggregate("c", F.lit(0.0), lambda s, e: s + e * e))
    scored = near.select("cluster_key", "record", F.round(dot / F.greatest(length, F.lit(1e-12)), 6).alias("cos")).groupBy("cluster_key", "record").agg(F.max("cos").alias("cos"))
    size = members.groupBy("cluster_key").agg(F.count(F.lit(1)).alias("size"))
    # rank limits are applied before the shuffle, so a large cluster sends few rows from each task
    place = Window.partitionBy("cluster_key").orderBy(F.desc("cos"), "record")
    best = scored.withColumn("r", F.row_number().over(place)).filter(F.col("r") <= typical)
    top = best.groupBy("cluster_key").agg(F.array_sort(F.collect_list(F.struct("r", "record"))).alias("t")).select("cluster_key", F.col("t.record").alias("typical"))
    return size.join(top, "cluster_key")
