"""Approximate nearest neighbours by balanced posting lists.

Centroids come from size-penalised k-means on a bounded sample (``SAMPLE``
vectors, lowest hash of the id first); every row is indexed. A vector near a
boundary is replicated to each list whose centroid is at most ``REPLICA`` times
as far (squared) as the nearest, ``REPLICAS`` at most. Centroids are searched by
a graph in memory, in tasks. A query reads the lists within a distance ratio of
its nearest one; the ratio is set by measurement: for ``CHECKED`` queries the
true neighbours are found by brute force over all rows, and the ratio that
reaches ``RECALL`` of them is taken. Posting lists are dealt into parts of about
``PART`` vectors and queries into parts as well, so copies of one vector never
meet in one task.

Inner product is turned into distance by one more coordinate that brings every
vector to the largest norm. Candidates are scored exactly: double precision on
the original vectors, one order of summation, ties to the smaller id.

Defined cases: vectors that are null, zero, hold null or non-finite components
or have another length than most, and rows without id take no part; repeated
rows of an id are one candidate and one query, with the best score; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, table

TOP = 20
QUERY_EVERY = 20
SAMPLE = 20_000
MAX_LISTS = 8_192
REPLICAS, REPLICA = 4, 1.15
CHECKED, RECALL = 128, 0.97
PART = 2_000
LINKS, LONG_LINKS = 16, 4


def _distance(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1), 0)


def centroids(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """k-means whose lists pay for their size, so that they stay balanced."""
    rng = np.random.default_rng(7)
    c = x[rng.choice(len(x), k, replace=False)].copy()
    fine = np.zeros(k)
    for _ in range(rounds):
        d = _distance(x, c)
        a = (d + fine).argmin(1)
        size = np.bincount(a, minlength=k)
        fine = 0.02 * d.min(1).mean() * size / (len(x) / k)
        sums = np.zeros_like(c)
        np.add.at(sums, a, x)
        c = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], x[rng.choice(len(x), k)])
    return c


def graph(c: np.ndarray) -> np.ndarray:
    """Neighbours of each centroid: the nearest ones, some at random, and its successor (so all are reached)."""
    rng = np.random.default_rng(11)
    out = []
    for at in range(0, len(c), 1_024):
        d = _distance(c[at:at + 1_024], c)
        out.append(np.argsort(d, 1, kind="stable")[:, 1:LINKS + 1])
    near = np.concatenate(out)
    far = rng.integers(0, len(c), (len(c), LONG_LINKS))
    return np.concatenate([near, far, ((np.arange(len(c)) + 1) % len(c))[:, None]], 1)


def search(x: np.ndarray, c: np.ndarray, links: np.ndarray, ratio: float) -> np.ndarray:
    """Distances (rows x centroids, infinite where not visited): the graph is walked from a few entries over
    every centroid within ``ratio`` of the best seen so far."""
    n = len(x)
    d = np.full((n, len(c)), np.inf)
    entry = np.unique(np.linspace(0, len(c) - 1, min(16, len(c))).astype(int))
    d[:, entry] = _distance(x, c[entry])
    done = np.zeros(d.shape, bool)
    while True:
        best = d.min(1)
        row, node = np.nonzero(~done & (d <= ratio * best[:, None] + 1e-12))
        if not len(row):
            return d
        done[row, node] = True
        pair = np.unique((row[:, None] * len(c) + links[node]).ravel())
        row, node = pair // len(c), pair % len(c)
        new = np.isinf(d[row, node])
        row, node = row[new], node[new]
        for at in range(0, len(row), 100_000):
            r, m = row[at:at + 100_000], node[at:at + 100_000]
            d[r, m] = ((x[r] - c[m]) ** 2).sum(1)


def _lift(x: np.ndarray, norm2: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(norm2 - (x * x).sum(1), 0))
    return np.concatenate([x, rest[:, None]], 1)


def _matrix(column, dim: int) -> np.ndarray:
    if isinstance(column, pd.Series):
        return np.array(column.tolist(), np.float64).reshape(len(column), dim)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(len(column), dim)


def _score(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (v * q).sum(1)


def _best(ids: np.ndarray, v: np.ndarray, q_ids: np.ndarray, q: np.ndarray, top: int) -> pd.DataFrame:
    """Exact top ids of each query among the candidates of one part; ``row`` is the place of an id's best row."""
    out = []
    by_id = np.argsort(ids, kind="stable")
    first = np.flatnonzero(np.diff(ids[by_id], prepend=ids[by_id[:1]] - 1)) if len(ids) else by_id
    for at in range(0, len(q_ids), 256):
        rough = q[at:at + 256] @ v.T
        for i, r in enumerate(rough):
            me = q_ids[at + i]
            r = np.where(ids == me, -np.inf, r)
            each = np.maximum.reduceat(r[by_id], first) if len(first) < len(r) else r
            floor = np.partition(each, len(each) - top)[len(each) - top] if len(each) > top else -np.inf
            take = np.flatnonzero(r >= floor - 1e-9 * max(1.0, abs(floor)) if np.isfinite(floor) else r > -np.inf)
            s = _score(v[take], q[at + i])
            order = np.lexsort((ids[take], -s))
            order = order[np.sort(np.unique(ids[take][order], return_index=True)[1])][:top]
            out.append(pd.DataFrame({"query_id": me, "vec_id": ids[take][order], "score": s[order], "row": take[order]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": [], "row": []})


def _ranked(hits: DataFrame, top: int) -> DataFrame:
    """The best ``top`` of each query; a candidate met in several lists counts once."""
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    one = hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return one.withColumn("rank", F.row_number().over(order)).filter(f"rank <= {top}")


def usable(vectors: DataFrame) -> tuple[DataFrame, int]:
    """(vec_id, v array<double>) of the rows that take part, and the vectors' length."""
    rows = vectors.filter("vec_id is not null and embedding is not null").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    fine = (F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists("v", lambda x: x != 0))
    rows = rows.filter(fine)
    size = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "n").first()
    dim = size["n"] if size else 0
    return rows.filter(F.size("v") == dim), dim


def once(rows: DataFrame) -> DataFrame:
    """Equal rows (id and vector) as one; only vectors of ids met more than once are dealt out."""
    again = cut(rows.groupBy("vec_id").agg(F.count("*").alias("n")).filter("n > 1").select("vec_id"), "ann-again")
    return rows.join(again, "vec_id", "left_anti").unionByName(rows.join(again, "vec_id", "left_semi").distinct())


def nearest(vectors: DataFrame, every: int = QUERY_EVERY, top: int = TOP) -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    rows, dim = usable(vectors)
    rows = cut(once(rows), "ann-rows")
    n, norm2 = rows.agg(F.count("*"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).first()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    step = max(1, n // SAMPLE)
    picked = rows.filter(F.expr(f"pmod(xxhash64(vec_id), {step}) = 0")).select("v").orderBy(F.xxhash64("v")).limit(SAMPLE)
    x = _lift(np.array([r["v"] for r in picked.collect()], np.float64).reshape(-1, dim), norm2)
    k = int(min(MAX_LISTS, max(1, 0.8 * np.sqrt(n)), len(x))) or 1
    c = centroids(x, k) if len(x) else np.zeros((1, dim + 1))
    links = graph(c)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1_000):
                part = b.slice(at, 1_000)
                v = _matrix(part.column(1), dim)
                d = search(_lift(v, norm2), c, links, REPLICA)
                near = np.argsort(d, 1, kind="stable")[:, :REPLICAS]
                nd = np.take_along_axis(d, near, 1)
                row, col = np.nonzero(nd <= REPLICA * nd[:, :1] + 1e-12)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(near[row, col].astype(np.int32)), part.column(0).take(pa.array(row)), part.column(1).take(pa.array(row))],
                    names=["list", "vec_id", "v"])

    lists = cut(rows.mapInArrow(assign, "list int, vec_id long, v array<double>"), "ann-lists")
    queries = rows.filter(f"pmod(vec_id, {every}) = 0")
    # Ids of each list; one with several vectors, in more than REPLICAS lists, counts as REPLICAS over all of them.
    filled = np.zeros(len(c))
    held = lists.groupBy("vec_id").agg(F.collect_set("list").alias("lists"))
    held = held.select(F.explode("lists").alias("list"), F.least(F.lit(1.0), REPLICAS / F.size("lists")).alias("n"))
    for r in held.groupBy("list").agg(F.sum("n").alias("n")).collect():  # MAX_LISTS rows at most
        filled[r["list"]] = r["n"]
    ratio, walk = _ratio(rows, lists, queries, c, links, norm2, dim, top)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                q = _matrix(part.column(1), dim)
                d = search(np.concatenate([q, np.zeros((len(q), 1))], 1), c, links, walk)
                # The nearest lists up to enough vectors for a full answer are read whatever their distance.
                order = np.argsort(d, 1, kind="stable")
                before = np.empty(d.shape)
                np.put_along_axis(before, order, np.cumsum(filled[order], 1) - filled[order], 1)
                row, node = np.nonzero((d <= ratio * d.min(1)[:, None] + 1e-12) | (before < (top + 1) * REPLICAS))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node.astype(np.int32)), part.column(0).take(pa.array(row)), part.column(1).take(pa.array(row))],
                    names=["list", "query_id", "q"])

    probes = cut(queries.mapInArrow(probe, "list int, query_id long, q array<double>"), "ann-probes")
    # Parts of a list and of its queries: a task holds one part of each.
    sizes = lists.groupBy("list").agg(F.expr(f"cast(ceil(count(*) / {PART}) as int)").alias("parts"))
    asked = probes.groupBy("list").agg(F.expr(f"cast(ceil(count(*) / {PART}) as int)").alias("asks"))
    plan = cut(sizes.join(asked, "list"), "ann-plan")
    left = (lists.join(F.broadcast(plan), "list").withColumn("part", F.expr("cast(pmod(xxhash64(vec_id, v), parts) as int)"))
            .withColumn("ask", F.explode(F.expr("sequence(0, asks - 1)"))).select("list", "part", "ask", "vec_id", "v"))
    right = (probes.join(F.broadcast(plan), "list").withColumn("ask", F.expr("cast(pmod(xxhash64(query_id), asks) as int)"))
             .withColumn("part", F.explode(F.expr("sequence(0, parts - 1)"))).select("list", "part", "ask", "query_id", "q"))

    def match(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return _best(a["vec_id"].to_numpy(), _matrix(a["v"], dim), b["query_id"].to_numpy(), _matrix(b["q"], dim), top).drop(columns="row")

    keys = ["list", "part", "ask"]
    hits = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(match, "query_id long, vec_id long, score double")
    return _ranked(hits, top).select("query_id", "rank", "vec_id", "score")


def _ratio(rows: DataFrame, lists: DataFrame, queries: DataFrame, c: np.ndarray, links: np.ndarray, norm2: float,
           dim: int, top: int) -> tuple[float, float]:
    """The distance ratios up to which lists are read and the graph is walked: the least whose lists hold
    ``RECALL`` of the true neighbours of some queries, and one at which the walk comes by that many."""
    # Only a share of all hashes that holds some times as many queries is ordered.
    share = 4 * CHECKED / max(queries.select("vec_id").count(), 1)
    some = queries if share >= 1 else queries.filter(F.xxhash64("vec_id") < F.lit(int(share * 2 ** 64) - 2 ** 63))
    some = some.orderBy(F.xxhash64("vec_id")).limit(CHECKED).collect()
    if not some:
        return 1.0, 1.0
    ids = np.array([r["vec_id"] for r in some])
    q = np.array([r["v"] for r in some], np.float64)

    def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = _best(b.column(0).to_numpy(), _matrix(b.column(1), dim), ids, q, top)
            got["h"] = b.column(2).to_numpy()[got.pop("row").to_numpy(int)]
            yield pa.RecordBatch.from_pandas(got.astype({"query_id": "int64", "vec_id": "int64"}), preserve_index=False)

    # An id with several vectors is found where its best one is.
    marked = F.xxhash64("v").alias("h")
    hits = rows.select("vec_id", "v", marked).mapInArrow(brute, "query_id long, vec_id long, score double, h long")
    best = hits.groupBy("query_id", "vec_id").agg(F.max_by("h", "score").alias("h"))
    true = _ranked(hits, top).join(best, ["query_id", "vec_id"])
    where = lists.select("list", "vec_id", marked).join(true, ["vec_id", "h"]).select("query_id", "vec_id", "list").collect()  # CHECKED x TOP x REPLICAS
    flat = np.concatenate([q, np.zeros((len(q), 1))], 1)
    d = _distance(flat, c)
    rel = d / np.maximum(d.min(1), 1e-12)[:, None]
    rows_of: dict = {}
    for k, i in enumerate(ids):
        rows_of.setdefault(i, []).append(k)
    holds: dict = {}  # a true neighbour of a query: the (row, list) pairs that lead to it
    for r in where:
        holds.setdefault((r["query_id"], r["vec_id"]), []).extend((k, r["list"]) for k in rows_of[r["query_id"]])
    if not holds:
        return 1.0, 1.0
    ratio = float(np.quantile([min(rel[k, j] for k, j in x) for x in holds.values()], RECALL, method="higher")) * (1 + 1e-9)
    walk = ratio
    while walk < rel.max() and walked(flat, c, links, ratio, walk, holds) < RECALL:
        walk *= 1.1
    return ratio, walk


def walked(q: np.ndarray, c: np.ndarray, links: np.ndarray, ratio: float, walk: float, holds: dict) -> float:
    """Share of ``holds`` with a list that is read up to ``ratio`` after a walk up to ``walk``."""
    d = search(q, c, links, walk)
    read = d <= ratio * d.min(1)[:, None] + 1e-12
    return float(np.mean([any(read[k, j] for k, j in x) for x in holds.values()]))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))
