"""Nearest vectors by largest inner product, with multiprobe p-stable hashing."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import bounded, stable


class Hashes:
    """``tables`` x ``width`` Gaussian projections in cells of length ``cell``, p-stable for the Euclidean distance.

    Vectors x are lifted by sqrt(M^2 - |x|^2), where M is the greatest norm, and queries are brought to the norm M with 0
    there: then the least distance is the largest inner product.
    """

    def __init__(self, dim: int, greatest: float, tables: int, width: int, cell: float, seed: int):
        rng = np.random.default_rng(seed)
        self.tables, self.width, self.greatest = tables, width, max(greatest, 1e-300)
        self.a = rng.standard_normal((dim + 1, tables * width)) / cell
        self.b = rng.uniform(0, 1, tables * width)

    def data(self, x: np.ndarray) -> np.ndarray:
        """Projections of data, (rows, tables, width); their floor is the cell."""
        x = x / self.greatest
        lift = np.sqrt(np.clip(1 - (x * x).sum(axis=1, keepdims=True), 0, None))
        return (np.hstack([x, lift]) @ self.a + self.b).reshape(len(x), self.tables, self.width)

    def queries(self, q: np.ndarray) -> np.ndarray:
        norm = np.linalg.norm(q / np.abs(q).max(axis=1, keepdims=True), axis=1, keepdims=True) * np.abs(q).max(axis=1, keepdims=True)
        return (np.hstack([q / norm, np.zeros((len(q), 1))]) @ self.a + self.b).reshape(len(q), self.tables, self.width)


def steps_out(projected: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """Squared distance of a projection to a cell in each coordinate: 0 inside. Their sum orders cells by the estimated
    chance that a near vector lies there, best first."""
    d = np.maximum(np.maximum(cells - projected, projected - cells - 1), 0)
    return d * d


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.empty((0, 0))


def top(x: np.ndarray, ids: np.ndarray, q: np.ndarray, queries: np.ndarray, k: int, allowed: np.ndarray | None = None) -> pd.DataFrame:
    """The best ``k`` rows of ``x`` for every query, ties to the smaller id, a query's own id left out.

    A matrix product, whose last bits depend on the shape of the block, only sorts out the far; what is within rounding of
    the best ``k`` is ranked again by inner products summed in one order, so that equal vectors score alike everywhere.
    """
    s = q @ x.T
    s[ids[None] == queries[:, None]] = -np.inf
    if allowed is not None:
        s[~allowed] = -np.inf
    slack = 1e-9 * np.linalg.norm(q, axis=1) * (np.linalg.norm(x, axis=1).max() if len(x) else 0.0)
    least = -np.partition(-s, k - 1, axis=1)[:, k - 1] - slack if s.shape[1] > k else np.full(len(s), -np.inf)
    out_q, out_i, out_s = [], [], []
    for r in range(len(s)):
        near = np.flatnonzero((s[r] >= least[r]) & (s[r] > -np.inf))
        score = (x[near] * q[r]).sum(axis=1)
        if len(near) > k:
            first = np.lexsort((ids[near], -score))[:k]
            near, score = near[first], score[first]
        out_q.append(np.full(len(near), queries[r]))
        out_i.append(ids[near])
        out_s.append(score)
    cat = lambda x, t: np.concatenate(x).astype(t) if x else np.empty(0, t)
    return pd.DataFrame({"query_id": cat(out_q, np.int64), "vec_id": cat(out_i, np.int64), "score": cat(out_s, np.float64)})


def cell_scores(projected: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """Summed squared steps from each query to each row's cell, as one product: a column for each value a coordinate takes."""
    total = np.zeros((len(projected), len(cells)))
    parts, ones = [], []
    for j in range(cells.shape[1]):
        values, inv = np.unique(cells[:, j], return_inverse=True)
        parts.append(steps_out(projected[:, j : j + 1], values[None]))
        ones.append(np.eye(len(values))[inv.ravel()])
    return np.hstack(parts) @ np.hstack(ones).T if parts else total


def _search_block(hashes_, bound: float, k: int, slice_: int = 512):
    """Rows of one part of a table against its queries: a query's buckets are those whose estimated distance, the sum of
    squared steps to the bucket's cell, is within ``bound``; a slice of queries at a time is held as a matrix."""
    def search(key, data: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if data.empty or queries.empty:
            return pd.DataFrame({"query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64), "score": np.empty(0)})
        h, t = hashes_.value, int(key[0])
        x, ids = matrix(data.embedding), data.vec_id.to_numpy()
        buckets, of = np.unique(np.floor(h.data(x)[:, t]), axis=0, return_inverse=True)
        out = []
        for i in range(0, len(queries), slice_):
            some = queries.iloc[i : i + slice_]
            q = matrix(some.embedding)
            visited = cell_scores(h.queries(q)[:, t], buckets) <= bound
            out.append(top(x, ids, q, some.vec_id.to_numpy(), k, visited[:, of.ravel()]))
        return pd.concat(out, ignore_index=True)

    return search


def neighbours(vectors: DataFrame, is_query, k: int = 20, key: str = "vec_id", vector: str = "embedding", tables: int = 4, width: int = 10, cell: float = 1.5, coarse: int = 2, recall: float = 0.96, sample_queries: int = 128, chunk: int = 4096, query_chunk: int = 4096, seed: int = 11) -> DataFrame:
    """The ``k`` vectors of largest inner product for every row that ``is_query`` (a condition on columns) picks:
    ``query_id, rank, vec_id, score``.

    Each of ``tables`` hash tables visits its buckets in the order of the estimated chance of success, the squared distance
    of the query's projections to the bucket's cell, up to one bound; what the tables find is merged and ranked by the
    exact inner product in double precision; a query that finds too few goes on with a wider bound. The bound is fitted on at most ``sample_queries`` queries, whose true
    neighbours among all rows are found directly: so many of those lie within it that ``recall`` of them are visited.

    Rows are dealt by table and the first ``coarse`` coordinates of their cell, and a query goes to the parts that its bound
    reaches; a part of many rows is split into chunks, and so are its queries, so no task holds an unbounded bucket, however
    many vectors are alike. Vectors that are null or zero, hold null or non-finite components, or have another length than
    most, take no part, nor does a null key; repeated rows with one key count once. Fewer than ``k`` candidates give all;
    an empty table gives an empty one; other columns are left out.
    """
    spark = vectors.sparkSession
    schema = "query_id long, vec_id long, score double"
    v = F.col(f"`{vector}`").cast("array<double>")
    good = F.col(f"`{key}`").isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.where(good).select(F.col(f"`{key}`").cast("long").alias("vec_id"), v.alias("embedding"), F.coalesce(is_query, F.lit(False)).alias("asks")).dropDuplicates(["vec_id"])
    rows = stable(rows, "vectors")
    sizes = rows.groupBy(F.size("embedding").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.max(F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x))).alias("norm")).orderBy(F.desc("n"), "d").first()
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, greatest = sizes.d, sizes.norm
    rows = rows.where(F.size("embedding") == dim)
    hashes = spark.sparkContext.broadcast(Hashes(dim, greatest, tables, width, cell, seed))

    sample = rows.where("asks").orderBy(F.xxhash64("vec_id", F.lit(seed)), "vec_id").limit(sample_queries).select("vec_id", "embedding").toPandas()
    if sample.empty:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    given = spark.sparkContext.broadcast((sample.vec_id.to_numpy(), matrix(sample.embedding)))

    def nearest(batches):
        ids, q = given.value
        h, p = hashes.value, None
        p = h.queries(q)
        for b in batches:
            if not len(b):
                continue
            x = matrix(b.embedding)
            found = top(x, b.vec_id.to_numpy(), q, ids, k)
            at, row = {i: j for j, i in enumerate(ids)}, {i: j for j, i in enumerate(b.vec_id)}
            cells = np.floor(h.data(x))
            qi, xi = [at[i] for i in found.query_id], [row[i] for i in found.vec_id]
            found["step"] = steps_out(p[qi], cells[xi]).sum(axis=2).min(axis=1) if len(found) else np.empty(0)
            yield found

    truth = rows.select("vec_id", "embedding").mapInPandas(nearest, schema + ", step double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    bound = truth.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).agg(F.percentile("step", F.lit(recall))).first()[0]
    bound = float(bound if bound is not None else 0.0) + 1e-9

    def deal(batches):
        h = hashes.value
        for b in batches:
            if len(b):
                c = np.floor(h.data(matrix(b.embedding))[:, :, :coarse]).astype(np.int64)
                for t in range(h.tables):
                    yield pd.DataFrame({"t": np.int32(t), "part": [",".join(map(str, r)) for r in c[:, t].tolist()], "vec_id": b.vec_id.to_numpy(), "embedding": b.embedding.to_numpy()})

    def ask_within(bound):
        def ask(batches):
            h = hashes.value
            reach = math.isqrt(int(bound)) + 1
            moves = np.stack(np.meshgrid(*[np.arange(-reach, reach + 1)] * coarse, indexing="ij"), axis=-1).reshape(-1, coarse)
            for b in batches:
                if len(b):
                    p = h.queries(matrix(b.embedding))[:, :, :coarse]
                    for t in range(h.tables):
                        cells = np.floor(p[:, t])[:, None] + moves[None]
                        r, m = np.nonzero(steps_out(p[:, t][:, None], cells).sum(axis=2) <= bound)
                        yield pd.DataFrame({"t": np.int32(t), "part": [",".join(map(str, c)) for c in cells[r, m].astype(np.int64).tolist()], "vec_id": b.vec_id.to_numpy()[r], "embedding": b.embedding.to_numpy()[r]})

        return ask

    shape = "t int, part string, vec_id long, embedding array<double>"
    laid = rows.select("vec_id", "embedding").mapInPandas(deal, shape)

    def visited(queries: DataFrame, bound: float) -> DataFrame:
        asked = queries.mapInPandas(ask_within(bound), shape)
        counts = laid.groupBy("t", "part").agg(F.count(F.lit(1)).alias("nd")).join(asked.groupBy("t", "part").agg(F.count(F.lit(1)).alias("nq")), ["t", "part"])
        counts = stable(counts.select("t", "part", F.ceil(F.col("nd") / chunk).cast("int").alias("cd"), F.ceil(F.col("nq") / query_chunk).cast("int").alias("cq")), "counts")
        small = bounded(counts, counts.count(), 64)
        of = lambda n: F.pmod(F.xxhash64("vec_id", F.lit(n)), F.col(n).cast("long")).cast("int")
        dealt = laid.join(small, ["t", "part"]).withColumn("i", of("cd")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("cq") - 1))).drop("cd", "cq")
        asked = asked.join(small, ["t", "part"]).withColumn("j", of("cq")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("cd") - 1))).drop("cd", "cq")
        group = ["t", "part", "i", "j"]
        found = dealt.groupBy(*group).cogroup(asked.groupBy(*group)).applyInPandas(_search_block(hashes, bound, k), schema)
        merged = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        out = merged.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        return stable(out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"), "visited")

    # a query whose buckets held too few vectors goes on to further ones, until it has k or all that there are
    full = min(k, sizes.n - 1)
    asking = rows.where("asks").select("vec_id", "embedding")
    out = visited(asking, bound)
    while full:
        done = out.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= full).select(F.col("query_id").alias("vec_id"))
        short = stable(asking.join(done, "vec_id", "left_anti"), "short")
        if short.isEmpty():
            break
        bound = 4 * bound + 1
        again = visited(short, bound)
        out = out.join(again.select("query_id").distinct(), "query_id", "left_anti").select("query_id", "rank", "vec_id", "score").union(again)
    return out
