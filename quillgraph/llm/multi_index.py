"""Near-duplicate vectors by an inverted multi-index.

Independent codebooks on the two halves of a unit vector form a grid of cells. Each vector is kept in the cell of its
nearest centroids and visits, in the order of the multi-sequence algorithm, the cells whose borders are nearest, until
the cells passed hold the target share of a vector's neighbours. Pairs met in a cell are verified in double precision.

Equal vectors of a label are one node with a weight, so copies are never compared. Rows travel once: with the raw
vector, and with the list of cells only in the vector's own cell.
"""

from __future__ import annotations

import heapq
import math
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from quillgraph.llm.common import connected_components, materialise

#: The codebooks are fitted on about this many vectors, or this many for each centroid, chosen by a hash.
SAMPLE = 20_000
SAMPLE_BY_CENTROID = 16
#: Vectors of the largest label that a cell of the grid holds on average: centroids grow with the root of the table.
CELL = 256
THRESHOLD = 0.98
RECALL = 0.999
#: Rows of a cell compared in one task on each side.
BLOCK = 4096
#: Cells larger than that are listed; a list of at most so many is broadcast, a longer one is joined by shuffle.
MOST_BROADCAST = 100_000


def unit(vectors) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors in double precision, and which of the given ones have a direction (equal lengths assumed)."""
    x = np.array(vectors, np.float64)
    with np.errstate(all="ignore"):
        top = np.abs(x).max(axis=1, keepdims=True) if x.size else np.zeros((len(x), 1))
        x = x / top
        x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x, np.isfinite(x).all(axis=1)


def k_means(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    rng = np.random.default_rng(7)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = ((c * c).sum(1) - 2 * x @ c.T).argmin(1)
        n = np.bincount(near, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


class MultiIndex:
    """Codebooks of both halves and the budget of the traversal."""

    def __init__(self, sample: np.ndarray, centroids: int, threshold: float, recall: float):
        self.cut = max(1, sample.shape[1] // 2)
        self.books = [k_means(sample[:, : self.cut], centroids), k_means(sample[:, self.cut :], centroids)] if sample.shape[1] > 1 else [k_means(sample, centroids), np.zeros((1, 0))]
        # Vectors just at the threshold, in random directions: the cost at which the traversal reaches their cells.
        rng = np.random.default_rng(11)
        q = sample[:4000]
        step = rng.normal(size=q.shape)
        step -= (step * q).sum(1, keepdims=True) * q
        size = np.sqrt((step * step).sum(1, keepdims=True))
        x = threshold * q + math.sqrt(1 - threshold**2) * step / np.where(size > 0, size, 1)
        i, j = (self.far(x, h).argmin(1) for h in (0, 1))
        a, b = self.borders(q, 0), self.borders(q, 1)
        at = np.arange(len(q))
        self.budget = float(np.quantile(a[at, i] + b[at, j], recall)) if len(q) else 0.0

    def far(self, x: np.ndarray, half: int) -> np.ndarray:
        """Squared distances to the centroids of a half, less the vector's own square."""
        c = self.books[half]
        return (c * c).sum(1) - 2 * (x[:, : self.cut] if half == 0 else x[:, self.cut :]) @ c.T

    def borders(self, x: np.ndarray, half: int) -> np.ndarray:
        """Squared distance from each vector to its border with each centroid's region; zero in its own region."""
        c, d = self.books[half], self.far(x, half)
        near = d.argmin(1)
        which, back = np.unique(near, return_inverse=True)
        square = (c * c).sum(1)
        gap = np.maximum(square[which][:, None] + square - 2 * c[which] @ c.T, 1e-12)
        out = (d - d[np.arange(len(x)), near][:, None]) ** 2 / (4 * gap[back])
        out[np.arange(len(x)), near] = 0
        return out

    def visits(self, x: np.ndarray) -> list[list[int]]:
        """By the multi-sequence algorithm: each vector's cells in order of cost, its own first, within the budget."""
        out = []
        k = len(self.books[1])
        for a, b in zip(self.borders(x, 0), self.borders(x, 1)):
            u, v = (np.argsort(c, kind="stable")[: int((c <= self.budget).sum())].tolist() for c in (a, b))
            heap, cells = [(a[u[0]] + b[v[0]], 0, 0)], []
            while heap:
                cost, i, j = heapq.heappop(heap)
                if cost > self.budget:
                    break
                cells.append(u[i] * k + v[j])
                if j + 1 < len(v):
                    heapq.heappush(heap, (a[u[i]] + b[v[j + 1]], i, j + 1))
                if j == 0 and i + 1 < len(u):
                    heapq.heappush(heap, (a[u[i + 1]] + b[v[0]], i + 1, 0))
            out.append(cells)
        return out


def _visit(batches, shared, kind: str):
    """The cells of each node: its own, and the others that it visits."""
    for p in batches:
        length = p["vector"].map(len)
        for q, d in ((q.iloc[at : at + 1024], d) for d, q in p.groupby(length) for at in range(0, len(q), 1024)):
            index: MultiIndex | None = shared.value.get(d)
            if index is None:
                continue
            x, ok = unit(q["vector"].tolist())
            x, q = x[ok], q[ok]
            if len(x):
                cells = index.visits(x)
                raw = [np.asarray(v, kind).tobytes() for v in q["vector"]]
                yield q.drop(columns="vector").assign(length=d, own=[c[0] for c in cells], cells=cells, raw=raw)


def _verify(pdf: pd.DataFrame, threshold: float, kind: str) -> pd.DataFrame:
    """Links of one cell: how many vectors each node is linked to (n > 0), and a spanning forest of ids (n = 0).

    A pair is met from both sides if each visits the other's cell; it then counts where the smaller node visits.
    """
    q, x = pdf[pdf["is_q"]], pdf[pdf["is_x"]]
    out = {"a": [], "b": [], "n": []}
    if len(q) and len(x):
        a, b = (unit(np.frombuffer(b"".join(p["raw"]), kind).reshape(len(p), -1))[0] for p in (q, x))
        qid, xid = q["node"].to_numpy(np.int64), x["node"].to_numpy(np.int64)
        own, code = np.unique(q["own"].to_numpy(), return_inverse=True)
        seen = np.array([np.isin(own, c) for c in x["cells"]]).reshape(len(x), len(own))
        both = pd.concat((q, x)).drop_duplicates("node").sort_values("node")
        nodes, ids, weight = both["node"].to_numpy(np.int64), both["id"].to_numpy(np.int64), both["m"].to_numpy(np.int64)
        qn, xn = np.searchsorted(nodes, qid), np.searchsorted(nodes, xid)
        qo, xo = (p["owner"].fillna(-1).to_numpy(np.int64) for p in (q, x))
        qh, xh = (p["owner"].notna().to_numpy() for p in (q, x))
        count, group = np.zeros(len(nodes), np.int64), np.arange(len(nodes))
        for at in range(0, len(q), 256):
            rows = slice(at, at + 256)
            hit = a[rows] @ b.T >= threshold
            hit &= qid[rows, None] != xid[None]
            hit &= ~seen.T[code[rows]] | (qid[rows, None] < xid[None])
            if qh.any():
                hit &= ~(qh[rows, None] & xh[None] & (qo[rows, None] == xo[None]))
            count += np.bincount(xn, weights=weight[qn[rows]] @ hit, minlength=len(nodes)).astype(np.int64)
            count += np.bincount(qn[rows], weights=hit @ weight[xn], minlength=len(nodes)).astype(np.int64)
            for i in np.flatnonzero(hit.any(1)):
                me = qn[at + i]
                met = np.unique(group[xn[hit[i]]])
                met = met[met != group[me]]
                if len(met):
                    out["a"] += [int(ids[me])] * len(met)
                    out["b"] += ids[met].tolist()
                    out["n"] += [0] * len(met)
                    group[np.isin(group, met)] = group[me]
        linked = np.flatnonzero(count)
        out["a"] += nodes[linked].tolist()
        out["b"] += nodes[linked].tolist()
        out["n"] += count[linked].tolist()
    return pd.DataFrame(out, columns=["a", "b", "n"]).astype("int64")


def fit(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, sample: int = SAMPLE) -> MultiIndex | None:
    """Fit on a bounded sample of the distinct rows of ``vectors`` (label, vector, h1); None without a usable vector."""
    by_label = vectors.groupBy("label").agg(F.count("*").alias("n")).agg(F.sum("n"), F.max("n")).first()
    n, largest = (x or 0 for x in by_label)
    centroids = max(2, round(math.sqrt(largest / CELL)))
    share = min(1.0, max(sample, SAMPLE_BY_CENTROID * centroids) / max(1, n))
    rows = vectors if share == 1 else vectors.where(F.pmod("h1", F.lit(1 << 40)) < max(1, round(share * (1 << 40))))
    got = rows.select("vector").toPandas()["vector"].tolist()
    if not got:
        return None
    x, ok = unit(got)
    x = x[ok]
    if not len(x):
        return None
    return MultiIndex(x, min(centroids, len(x)), threshold, recall)


def near_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """Link vectors of equal label and length with cosine at least ``threshold``, found by the multi-index.

    Returns a row for each input row: ``vec_id``, ``n_links``, ``component_id`` (smallest id reachable) and ``kept``.

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, and so do rows with
    a null label or id. Each length of vector has an index of its own. Rows that are equal in id, label and vector count
    once; rows that repeat an id with other vectors don't link with each other and share its links and component. A
    null id has no component and is kept. An empty table gives no rows; other columns are ignored.
    """
    spark = table.sparkSession
    given = table.schema[vector_col].dataType
    kind = "float32" if isinstance(given, ArrayType) and isinstance(given.elementType, FloatType) else "float64"
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), F.col(label_col).cast("string").alias("label"))
    usable = rows.where("id is not null and label is not null and size(vector) > 0 and not exists(vector, v -> v is null or isnan(v) or abs(v) = double('infinity'))")
    usable = usable.withColumns({"h1": F.xxhash64("label", "vector"), "h2": F.xxhash64(F.lit(1), "label", "vector"), "owner": F.lit(None).cast("long")})
    ids = materialise(usable.groupBy("id").agg(F.min(F.struct("h1", "h2")).alias("lo"), F.max(F.struct("h1", "h2")).alias("hi")))
    nodes_of = ids.select("id", "lo.h1", "lo.h2")
    many = ids.where("lo <> hi").select("id", F.col("id").alias("owner"))
    if many.head(1):  # an id with several vectors keeps each as a node of its own
        usable = usable.drop("owner").join(many, "id", "left").withColumn("h1", F.when(F.col("owner").isNull(), F.col("h1")).otherwise(F.xxhash64("h1", "owner")))
        nodes_of = usable.select("id", "h1", "h2").distinct()
    members = nodes_of.groupBy("h1", "h2").agg(F.count("*").alias("m"), F.min("id").alias("id"))
    nodes = usable.groupBy("h1", "h2").agg(F.first(F.struct("label", "vector", "owner")).alias("v")).join(members, ["h1", "h2"])
    nodes = materialise(nodes.select("h1", "h2", F.monotonically_increasing_id().alias("node"), "id", "m", "v.owner", "v.label", "v.vector"))
    lengths = [r["d"] for r in nodes.select(F.size("vector").alias("d")).distinct().collect()]
    index = {d: fit(nodes.where(F.size("vector") == d), threshold, recall) for d in lengths}
    base = rows.select(F.col("id").alias("vec_id"))
    if not any(index.values()):
        return base.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    shared = spark.sparkContext.broadcast(index)
    schema = "h1 long, h2 long, node long, id long, m long, owner long, label string, length int, own int, cells array<int>, raw binary"
    placed = materialise(nodes.repartition("node").mapInPandas(partial(_visit, shared=shared, kind=kind), schema))
    where = ["label", "length", "cell"]
    sizes = placed.select("label", "length", F.explode("cells").alias("cell")).groupBy(*where).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    large = materialise(sizes.where("blocks > 1"))
    visits = placed.select("label", "length", "node", "id", "m", "owner", "own", "cells", "raw", F.explode("cells").alias("cell"))
    visits = visits.withColumn("cells", F.when(F.col("cell") == F.col("own"), F.col("cells")))
    visits = visits.join(F.broadcast(large) if large.count() <= MOST_BROADCAST else large, where, "left").fillna(1, "blocks")
    dealt = visits.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # A row meets every block of the other side; in a cell of one block it stands for both sides.
    meets = """
        if(blocks = 1, array(named_struct('q', 0, 'x', 0, 'is_q', true, 'is_x', own = cell)), concat(
            transform(sequence(0, blocks - 1), i -> named_struct('q', block, 'x', i, 'is_q', true, 'is_x', false)),
            if(own = cell, transform(sequence(0, blocks - 1), i -> named_struct('q', i, 'x', block, 'is_q', false, 'is_x', true)), array())))"""
    dealt = dealt.withColumn("p", F.explode(F.expr(meets))).select(*where, "node", "id", "m", "owner", "own", "cells", "raw", "p.*")
    found = materialise(dealt.groupBy(*where, "q", "x").applyInPandas(partial(_verify, threshold=threshold, kind=kind), "a long, b long, n long"))
    links = found.where("n > 0").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    groups = connected_components(found.where("n = 0").select(F.col("a").alias("u"), F.col("b").alias("v")))
    by_node = placed.select("h1", "h2", "node", "m", "owner", F.col("id").alias("low")).join(links, "node", "left").join(groups.withColumnRenamed("node", "low"), "low", "left")
    by_node = by_node.select("h1", "h2", (F.coalesce("n", F.lit(0)) + F.when(F.col("owner").isNull(), F.col("m") - 1).otherwise(0)).alias("n"), F.coalesce("component", "low").alias("component"))
    by_id = nodes_of.join(by_node, ["h1", "h2"]).groupBy(F.col("id").alias("vec_id")).agg(F.sum("n").alias("n_links"), F.min("component").alias("component"))
    out = base.join(by_id, "vec_id", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op5_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
