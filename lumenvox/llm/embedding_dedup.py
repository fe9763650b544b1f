"""Near-duplicate embeddings: spherical k-means cells and blocked cosine products.

Every vector is at home in the cell of its nearest centroid. Two unit vectors with a cosine of at
least t are at most d = sqrt(2 - 2t) apart, so a vector can only have a partner in another cell if
it lies within d of the plane between both centroids. It visits exactly those cells, which
makes the search exact; how many they are is a matter of how well the vectors cluster, not of
correctness. A pair from two cells is compared once, in the cell with the smaller number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenvox.llm.common import cut, lookup
from lumenvox.llm.components import components
from lumenvox.llm.unions import merge

#: Vectors that the centroids are fitted on by the driver, about, and cells that it fits at most. More cells are fitted in two steps, the second one
#: by tasks, on SAMPLE_PER_CELL vectors for each cell. All vectors are assigned and compared.
FIT_ROWS, FIT_CELLS, SAMPLE_PER_CELL = 20_000, 256, 16
#: Vectors of a label wanted in a cell, while that needs no more cells than the square root of their number.
CELL_ROWS = 2048
#: Rows of one block; a cell with more is compared block by block, and a row is sent once for each of them.
BLOCK_ROWS = 16_384
_SLACK = 1e-9


def cells_for(n: int, cell_rows: int = CELL_ROWS) -> int:
    """Cells for labels of at most ``n`` different vectors: two at least, and about the square root of n for very many."""
    return min(n, max(2, min(-(-n // cell_rows), math.isqrt(max(0, n - 1)) + 1)))


def usable(vector: Column) -> Column:
    """True for a vector with numbers only, all finite, and a norm above zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Unit centroids of unit rows ``x``; the start is spread out by distance, the same on every run."""
    rng = np.random.default_rng(seed)
    chosen = [int(rng.integers(len(x)))]
    nearest = x @ x[chosen[0]]
    while len(chosen) < min(k, len(x)):
        weight = np.maximum(1 - nearest, 0) ** 2
        if weight.sum() <= 0:
            break
        chosen.append(int(rng.choice(len(x), p=weight / weight.sum())))
        nearest = np.maximum(nearest, x @ x[chosen[-1]])
    centroids = x[chosen].copy()
    for _ in range(rounds):
        home = np.concatenate([(x[at : at + 4096] @ centroids.T).argmax(axis=1) for at in range(0, len(x), 4096)])
        sums = np.zeros_like(centroids)
        np.add.at(sums, home, x)
        norms = np.linalg.norm(sums, axis=1)
        moved = norms > 1e-12
        centroids[moved] = sums[moved] / norms[moved, None]
    return centroids


def _unit(x: np.ndarray) -> np.ndarray:
    scaled = x / np.abs(x).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten()).astype(np.float64).reshape(len(column), dim)


def _sampled(nodes: DataFrame, dim: int, share: float) -> DataFrame:
    """Vectors of a length, a share of them by hash."""
    return nodes.filter((F.size("vector") == dim) & (F.pmod(F.xxhash64("vector"), F.lit(1 << 30)) < int(min(1.0, share) * (1 << 30)))).select("node", "vector")


def fitted(nodes: DataFrame, dim: int, total: int, k: int, fit_rows: int = FIT_ROWS, fit_cells: int = FIT_CELLS) -> np.ndarray | None:
    """About ``k`` centroids of the ``total`` vectors of a length; None where the sample is empty.

    The driver fits ``fit_cells`` cells at most, on about ``fit_rows`` vectors, so what it holds besides the centroids is bounded. For more, it
    fits the square root of k, and tasks fit as many again in each of these.
    """
    coarse = k if k <= fit_cells else int(np.ceil(np.sqrt(k)))
    rows = _sampled(nodes, dim, fit_rows / total).toArrow().combine_chunks().sort_by("node")
    if not rows.num_rows:
        return None
    centroids = spherical_kmeans(_unit(_matrix(rows.column("vector").combine_chunks(), dim)), coarse)
    if coarse == k:
        return centroids

    def at_home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _unit(_matrix(b.column("vector"), dim))
            home = np.concatenate([(x[at : at + 4096] @ centroids.T).argmax(axis=1) for at in range(0, len(x), 4096)]) if len(x) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(home, pa.int64()), b.column("node"), pa.array([v.tobytes() for v in x], pa.binary())], ["cell", "node", "vector"])

    def fine(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("node")
        x = np.frombuffer(b"".join(v.as_py() for v in rows.column("vector")), np.float64).reshape(rows.num_rows, dim)
        found = [c.tobytes() for c in spherical_kmeans(x, -(-k // coarse))]
        return pa.table({"cell": pa.array([rows.column("cell")[0].as_py()] * len(found), pa.int64()), "centroid": pa.array(found, pa.binary())})

    dealt = _sampled(nodes, dim, max(fit_rows, SAMPLE_PER_CELL * k) / total).mapInArrow(at_home, "cell long, node long, vector binary")
    found = dealt.groupBy("cell").applyInArrow(fine, "cell long, centroid binary").orderBy("cell", "centroid").collect()
    return np.stack([np.frombuffer(r["centroid"], np.float64) for r in found])


def _assigned(centroids: dict[int, np.ndarray], threshold: float):
    """mapInArrow function: a row at home and one for each cell that the vector visits."""
    reach = np.sqrt(max(0.0, 2 - 2 * threshold)) + _SLACK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            lengths = np.asarray(whole.column("vector").value_lengths())
            for dim in np.unique(lengths):
                b = whole.filter(pa.array(lengths == dim))
                x = _unit(_matrix(b.column("vector"), dim))
                c = centroids.get(int(dim), np.eye(1, dim))
                scores = x @ c.T
                home = scores.argmax(axis=1)
                apart = np.maximum(np.linalg.norm(c[:, None, :] - c[None, :, :], axis=2), 1e-12) if len(c) <= 64 else None
                for at in range(0, b.num_rows, 4096):
                    part = slice(at, at + 4096)
                    h, s = home[part], scores[part]
                    gap = apart[h] if apart is not None else np.maximum(np.sqrt(np.maximum(2 - 2 * (c[h] @ c.T), 0)), 1e-12)
                    near = (s[np.arange(len(h)), h][:, None] - s) <= reach * gap + _SLACK
                    near &= np.arange(len(c))[None, :] <= h[:, None]
                    near[np.arange(len(h)), h] = True
                    row, cell = np.nonzero(near)
                    data = b.slice(at, len(h))
                    keys = [f"{label}/{dim}/{k}" for label, k in zip(data.column("label").take(pa.array(row)).to_pylist(), cell, strict=True)]
                    raw = [x.tobytes() for x in np.asarray(_matrix(data.column("vector"), dim))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys), data.column("node").take(pa.array(row)), data.column("copies").take(pa.array(row)), pa.array(cell == h[row]), pa.array([raw[i] for i in row], pa.binary())],
                        ["cell", "node", "copies", "home", "vector"],
                    )

    return run


def _compared(threshold: float):
    """applyInArrow function over a pair of blocks: of each linked row its links and the smallest row reachable here."""
    out = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("node")
        node, copies, home, block = (rows.column(c).to_numpy() for c in ("node", "copies", "home", "block"))
        vectors = [v.as_py() for v in rows.column("vector")]
        x = _unit(np.frombuffer(b"".join(vectors), np.float64).reshape(len(vectors), -1))
        links, roots = np.zeros(len(node), np.int64), np.arange(len(node))
        a, b = int(rows.column("a")[0].as_py()), int(rows.column("b")[0].as_py())
        left, right = np.flatnonzero(block == a), np.flatnonzero(block == b)
        for at in range(0, len(left), 512):
            i = left[at : at + 512]
            near = x[i] @ x[right].T >= threshold
            near &= home[i][:, None] | home[right][None, :]  # two visitors meet in another cell
            if a == b:
                near &= i[:, None] != right[None, :]
            links[i] += near @ copies[right]
            if a != b:
                links[right] += copies[i] @ near
            some = near.any(axis=1)
            if some.any():
                # join each row with its first partner, and the partners of a row with each other
                p, q = np.nonzero(near)
                merge(roots, i[p], right[q])
        found = links > 0
        return pa.Table.from_arrays([pa.array(node[found]), pa.array(links[found]), pa.array(node[roots[found]])], schema=out)

    return run


def embedding_links(nodes: DataFrame, threshold: float, fit_rows: int = FIT_ROWS, fit_cells: int = FIT_CELLS, cell_rows: int = CELL_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Links of distinct vectors (node, label, vector, copies): node, links, root; a node can have several rows.

    ``links`` counts linked vectors with their copies; the roots connect what is linked.
    """
    sizes = nodes.groupBy(F.size("vector").alias("dim"), "label").agg(F.count("*").alias("n"))
    largest = {r.dim: (r.n, r.total) for r in sizes.groupBy("dim").agg(F.max("n").alias("n"), F.sum("n").alias("total")).collect()}
    centroids: dict[int, np.ndarray] = {}
    for dim, (n, total) in largest.items():
        k = cells_for(n, cell_rows)
        if k > 1 and (found := fitted(nodes, dim, total, k, fit_rows, fit_cells)) is not None:
            centroids[dim] = found
    dealt = cut(nodes.mapInArrow(_assigned(centroids, threshold), "cell string, node long, copies long, home boolean, vector binary"))
    cells = cut(dealt.groupBy("cell").agg(F.count("*").alias("rows")))
    dealt = lookup(dealt, "cell", cells, "rows", F.col("node")).withColumn("blocks", F.ceil(F.col("rows") / block_rows).cast("int"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    pairs = dealt.withColumn("other", other).select("cell", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "block", "node", "copies", "home", "vector")
    return pairs.groupBy("cell", "a", "b").applyInArrow(_compared(threshold), "node long, links long, root long")


def embedding_duplicates(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", **sizes: int) -> DataFrame:
    """One row for each row of ``vectors``: vec_id, n_links, component_id, kept.

    Rows with equal labels and equal lengths are linked when their cosine in double precision is
    at least ``threshold``. A row with a null label or id, or a vector that is null, empty,
    zero or holds null or non-finite numbers, links with nothing and is kept, as a component of
    its own. Equal vectors of a label are compared once and count as often as they occur; repeated
    ids are rows of their own. component_id is the smallest id reachable. An empty table gives
    no rows; other columns are not read.
    """
    vector = F.col(vector_col)
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.when(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & usable(vector), F.struct(F.col(label_col).cast("string").alias("label"), vector.alias("vector"))).alias("what"),
    )
    distinct = rows.filter("what is not null").groupBy("what").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
    nodes = cut(distinct.select("what", "what.label", "what.vector", "first", "copies", F.monotonically_increasing_id().alias("node")))
    found = cut(embedding_links(nodes.select("node", "label", "vector", "copies"), threshold, **sizes))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    linked = components(found.select(F.col("node").alias("src"), F.col("root").alias("dst")))
    known = nodes.select("node", "what", "first", "copies").join(links, "node", "left").join(linked.withColumnRenamed("id", "node"), "node", "left")
    smallest = nodes.select("node", "first").join(linked.withColumnRenamed("id", "node"), "node").groupBy("component").agg(F.min("first").alias("smallest"))
    known = known.join(smallest, "component", "left").select(
        "what",
        "copies",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
        F.coalesce("smallest", "first").alias("component_id"),
    )
    joined = lookup(rows, "what", cut(known), "copies", F.col("vec_id"))
    component = F.coalesce("component_id", "vec_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
