"""Approximate nearest neighbours by an adaptive dimension scan within probed lists.

Every vector belongs to the list of its nearest centre (centres from a bounded sample); a query
probes the lists of its nearest centres, as many as a trial on the sample needs for the wanted
recall, and further ones until they hold more than enough vectors; a query that then still has fewer
neighbours than there are looks through all lists. Within a list vectors are rotated at random and scanned in blocks of columns: after each
block a test on the partial distance abandons candidates that are too far with near certainty.
Those left are compared exactly, in double precision, on the original vectors.

Lists are dealt in blocks of bounded size, so a list of many equal vectors is many tasks; queries
of a list too. Vectors that are null, zero, of another dimension than most, or hold null or
non-finite components, and rows without vec_id, take no part. Rows that repeat a vec_id count as
one candidate, at the nearest of their vectors, and as one query, with the least of them by
components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import cut, table

NEAREST = 10
#: Rows that the centres and the number of probes are fitted to, at most.
SAMPLE = 65_536
#: Lists hold about LIST_ROWS rows each; beyond MOST_LISTS of them (4 million rows) they grow.
LIST_ROWS, MOST_LISTS = 1024, 4096
BLOCK_ROWS, BLOCK_QUERIES = 4096, 2048
#: Recall that the probes must reach in the trial.
RECALL = 0.97
COLUMNS = 16
#: Vectors with larger components are searched in double precision, as their squares overflow.
LARGE = 1e15
#: Of the test: how many deviations a partial distance may be beyond the bound.
CAUTION = 2.1


def rotation(dim: int, seed: int = 5) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return (q * np.sign(np.diag(r))).astype(np.float32)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a**2).sum(1)[:, None] - 2 * a @ b.T + (b**2).sum(1)[None], 0)


def centres(sample: np.ndarray, lists: int, seed: int = 6) -> np.ndarray:
    at = np.random.default_rng(seed).permutation(len(sample))[:lists]
    c = sample[np.sort(at)].copy()
    for _ in range(8):
        own = squared(sample, c).argmin(1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, sample)
        n = np.bincount(own, minlength=len(c))
        c[n > 0] = sums[n > 0] / n[n > 0, None]
    return c


def probes(sample: np.ndarray, c: np.ndarray, recall: float, k: int = NEAREST) -> int:
    """The least number of lists whose search finds so many of the sample's neighbours."""
    some = sample[:: max(1, len(sample) // 256)][:256]
    own = squared(sample, c).argmin(1)
    near = np.argsort(squared(some, sample), 1)[:, 1 : k + 1]
    order = np.argsort(np.argsort(squared(some, c), 1), 1)
    needed = np.take_along_axis(order, own[near], 1)
    for n in range(1, len(c) + 1):
        if (needed < n).mean() >= recall:
            return n
    return len(c)


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    out = np.asarray(column.flatten(), np.float32).reshape(-1, dim)
    return out.astype(np.float64) if np.abs(out).max(initial=0) > LARGE else out


def _assigned(index):
    def run(batches):
        c = index.value
        for batch in batches:
            own = squared(_matrix(batch.column("vector"), c.shape[1]), c).argmin(1)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("vector"), pa.array(own, pa.int32())], names=["vec_id", "vector", "list"])

    return run


def _probed(index):
    def run(batches):
        c, n, sizes, k = index.value
        for batch in batches:
            near = np.argsort(squared(_matrix(batch.column("vector"), c.shape[1]), c), 1)
            held = np.cumsum(sizes[near], 1)
            enough = np.maximum(n, (held < k + 1).sum(1) + 1)  # lists that hold k besides the query itself
            lists = [row[:m].astype(np.int32) for row, m in zip(near, enough.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("vector"), pa.array(lists, pa.list_(pa.int32()))], names=["query_id", "vector", "lists"])

    return run


def scan(query: np.ndarray, turned: np.ndarray, vectors: np.ndarray, ids: np.ndarray, first: np.ndarray, own: int, k: int, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """ids and exact distances of the k nearest, ties to smaller ids. first: of some ids a row each,
    from which the bound comes."""
    exact = lambda at: np.sqrt(((vectors[at].astype(np.float64) - query.astype(np.float64)) ** 2).sum(1))
    near = exact(first[ids[first] != own])
    bound = np.partition(near, k - 1)[k - 1] if len(near) >= k else np.inf
    left = np.flatnonzero(ids != own)
    if np.isfinite(bound):
        q = query @ turn
        dim = len(q)
        partial = np.zeros(len(left), turned.dtype)
        for a in range(0, dim, COLUMNS):
            b = min(a + COLUMNS, dim)
            partial += ((turned[left, a:b] - q[a:b]) ** 2).sum(1)
            limit = bound * (1 + CAUTION / np.sqrt(b)) * np.sqrt(b / dim) if b < dim else bound * (1 + 1e-4) + 1e-6
            kept = partial <= limit**2
            left, partial = left[kept], partial[kept]
        left = np.union1d(left, first[ids[first] != own])
    d = exact(left)
    order = np.lexsort((ids[left], d))
    at, d = ids[left][order], d[order]
    _, unique = np.unique(at, return_index=True)  # the nearest row of each vec_id
    unique = np.sort(unique)[:k]
    return at[unique], d[unique]


def _searched(index):
    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        dim, k = index.value
        out_q, out_v, out_d = [], [], []
        if vectors.num_rows and queries.num_rows:
            x, ids = _matrix(vectors.column("vector"), dim), vectors.column("vec_id").to_numpy()
            turn = rotation(dim)
            turned = x @ turn
            first = np.unique(ids, return_index=True)[1][: 4 * k]
            for q, own in zip(_matrix(queries.column("vector"), dim), queries.column("query_id").to_numpy(), strict=True):
                at, d = scan(q, turned, x, ids, first, own, k, turn)
                out_q.append(np.full(len(at), own))
                out_v.append(at)
                out_d.append(d)
        one = lambda parts, kind: pa.array(np.concatenate(parts) if parts else [], kind)
        return pa.table({"query_id": one(out_q, pa.int64()), "vec_id": one(out_v, pa.int64()), "score": one(out_d, pa.float64())})

    return run


def valid(embeddings: DataFrame) -> DataFrame:
    v = F.col("vector")
    return embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("vector")).filter(
        F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    )


def search(embeddings: DataFrame, is_query: F.Column, k: int = NEAREST, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every query."""
    spark = embeddings.sparkSession
    rows = valid(embeddings)
    sizes = rows.groupBy(F.size("vector").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dim").first()
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, n = sizes
    rows = rows.filter(F.size("vector") == dim)
    lists = int(min(max(1, n // LIST_ROWS), MOST_LISTS))
    sample = np.array([r[0] for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(min(SAMPLE, max(16_384, 16 * lists))).select("vector").collect()], np.float32)
    sample = sample.astype(np.float64) if np.abs(sample).max() > LARGE else sample
    lists = max(1, min(lists, len(sample) // 16))
    c = centres(sample, lists)
    share = lambda x: spark.sparkContext.broadcast(x)
    assigned = cut(rows.mapInArrow(_assigned(share(c)), "vec_id long, vector array<float>, list int"), "lists")
    sizes, held = np.zeros(lists, np.int64), np.zeros(lists, np.int64)
    for r in assigned.groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("vec_id").alias("ids")).collect():  # MOST_LISTS rows
        held[r["list"]], sizes[r["list"]] = r["n"], r["ids"]
    asking = rows.filter(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    asked = cut(asking.mapInArrow(_probed(share((c, probes(sample, c, recall, k), sizes, k))), "query_id long, vector array<float>, lists array<int>"), "probes")
    near = cut(_nearest(assigned, held, asked, dim, k), "nearest")
    ids = assigned.select("vec_id").distinct().limit(k + 1).count() - 1  # neighbours that a query can have, as far as it matters
    few = asked.join(near.groupBy("query_id").agg(F.count(F.lit(1)).alias("found")), "query_id", "left").filter(F.coalesce("found", F.lit(0)) < min(k, ids))
    few = cut(few.select("query_id", "vector", F.sequence(F.lit(0), F.lit(lists - 1)).alias("lists")), "few")
    if few.isEmpty():
        return near
    return near.join(few, "query_id", "left_anti").unionByName(_nearest(assigned, held, few, dim, k))


def _nearest(assigned: DataFrame, held: np.ndarray, asked: DataFrame, dim: int, k: int) -> DataFrame:
    """The k nearest of each query in the lists that it asks; held: rows of each list."""
    spark, lists = assigned.sparkSession, len(held)
    asked = asked.select("query_id", "vector", F.explode("lists").alias("list"))
    wanted = {r["list"]: r["n"] for r in asked.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()}
    blocks = F.element_at(F.lit([-(-max(int(x), 1) // BLOCK_ROWS) for x in held]), F.col("list") + 1)
    query_blocks = F.element_at(F.lit([-(-wanted.get(i, 1) // BLOCK_QUERIES) for i in range(lists)]), F.col("list") + 1)
    left = assigned.withColumn("block", F.pmod(F.xxhash64("vec_id"), blocks)).withColumn("query_block", F.explode(F.sequence(F.lit(0), query_blocks - 1)))
    right = asked.withColumn("query_block", F.pmod(F.xxhash64("query_id"), query_blocks).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), (blocks - 1).cast("long"))))
    key = ["list", "block", "query_block"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_searched(spark.sparkContext.broadcast((dim, k))), "query_id long, vec_id long, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest of every vector whose vec_id is divisible by 100."""
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
