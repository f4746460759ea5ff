"""Quality classifier: random-indexing word vectors, pooled, and a small calibrated network.

Tokens are words, numbers and runs of marks, as written. Each falls into one of
``VOCAB`` hash buckets; a bucket's index vector has two entries of +-1 set by its
number. A bucket's context vector is the sum of the index vectors of the two
tokens on either side of every occurrence in all texts: tasks sum their own
texts, Spark adds the sums by bucket. A document is the mean of its tokens'
normalised context vectors, and three pooled counts (length, share of distinct
tokens, share of tokens in repeated five-token windows). A two-layer network in
numpy is trained on labelled documents whose crc32(doc_id) mod 3 is not 1, at most
``TRAIN_ROWS`` of them (by hash of the id); its probabilities are calibrated by a
temperature fitted on a fifth of them that it was not trained on. Labels, lang,
source and doc_id are no inputs of a score.

Defined cases: a null or empty text has the zero vector and still gets a score;
without labels of both kinds every score is the share of label 1 (0.5 without
any); conflicting labels of one document count once each; repeated rows give
repeated rows; a null doc_id stays null and is not held out; other columns are
not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, mix, table

VOCAB = 8_192
DIM = 64
REACH = 2
TRAIN_ROWS = 20_000
HIDDEN, EPOCHS, BATCH, RATE = 32, 40, 128, 0.01
EXTRA = 3
_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+")
_CHUNK = 200_000  # tokens handled together
_U = np.uint64


class _Buckets(dict):
    def __missing__(self, token: str) -> int:
        if len(self) >= 400_000:
            self.clear()
        b = self[token] = xxhash.xxh3_64_intdigest(token.encode("utf-8", "replace")) % VOCAB
        return b


def tokens(text: str | None, buckets: _Buckets) -> np.ndarray:
    found = _TOKEN.findall(text or "")
    return np.fromiter(map(buckets.__getitem__, found), np.int64, len(found))


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """(VOCAB x 2) places and signs of the index vectors."""
    h = mix(np.arange(1, 2 * VOCAB + 1, dtype=_U) * _U(0x9E3779B97F4A7C15)).reshape(VOCAB, 2)
    return (h % _U(DIM)).astype(np.int64), np.where((h >> _U(40)) & _U(1), 1.0, -1.0)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    buckets, (place, sign) = _Buckets(), index_vectors()
    total = np.zeros(VOCAB * DIM)
    held, size = [], 0

    def add() -> None:
        # Texts are kept apart by gaps as wide as the reach.
        gap = np.full(REACH, -1)
        t = np.concatenate([x for d in held for x in (d, gap)])
        for k in range(1, REACH + 1):
            a, b = t[:-k], t[k:]
            ok = (a >= 0) & (b >= 0)
            for own, near in ((a[ok], b[ok]), (b[ok], a[ok])):
                for z in range(2):
                    total[:] += np.bincount(own * DIM + place[near, z], weights=sign[near, z], minlength=VOCAB * DIM)

    for batch in batches:
        for text in batch.column(0):
            t = tokens(text.as_py(), buckets)
            held.append(t)
            size += len(t)
            if size >= _CHUNK * 2:
                add()
                held, size = [], 0
    if held:
        add()
    rows = total.reshape(VOCAB, DIM)
    used = np.flatnonzero(np.any(rows != 0, 1))
    if len(used):
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(list(rows[used].astype(np.float32)), pa.list_(pa.float32()))],
            names=["bucket", "v"])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """(VOCAB x DIM) normalised context vectors, learned from all texts; of fixed size."""
    parts = docs.select("text").mapInArrow(_contexts, "bucket int, v array<float>")
    sums = parts.select("bucket", *[F.col("v")[i].cast("double").alias(f"v{i}") for i in range(DIM)]).groupBy("bucket").agg(
        *[F.sum(f"v{i}").alias(f"v{i}") for i in range(DIM)])
    out = np.zeros((VOCAB, DIM))
    for r in cut(sums, "quality-vectors").collect():
        out[r["bucket"]] = r[1:]
    return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def _repeated(t: np.ndarray) -> float:
    n = len(t)
    if n < 10:
        return 0.0
    h = np.zeros(n - 4, _U)
    for i in range(5):
        h = mix(h * _U(0x9E3779B97F4A7C15) + t[i:n - 4 + i].astype(_U) + _U(1))
    _, at, count = np.unique(h, return_inverse=True, return_counts=True)
    edge = np.zeros(n + 1, np.int64)
    hit = np.flatnonzero(count[at] > 1)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + 5, -1)
    return float((np.cumsum(edge[:-1]) > 0).mean())


def features(texts: list[str | None], vectors: np.ndarray, buckets: _Buckets) -> np.ndarray:
    out = np.zeros((len(texts), DIM + EXTRA), np.float32)
    for i, text in enumerate(texts):
        t = tokens(text, buckets)
        n = len(t)
        if not n:
            continue
        total = np.zeros(DIM)
        for at in range(0, n, _CHUNK):
            total += vectors[t[at:at + _CHUNK]].sum(0, dtype=np.float64)
        out[i, :DIM] = total / n
        out[i, DIM:] = np.log1p(n) / 10, len(np.unique(t)) / n, _repeated(t)
    return out


def _pooled(vectors: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = _Buckets()
        for b in batches:
            for at in range(0, b.num_rows, 1_000):
                part = b.slice(at, 1_000)
                x = features(part.column(1).to_pylist(), vectors, buckets)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(list(x), pa.list_(pa.float32()))], names=["doc_id", "x"])

    return run


def train(x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Two-layer network (Adam, cross entropy) and its temperature."""
    if not len(y) or y.min() == y.max():
        p = min(max(float(y.mean()), 1e-6), 1 - 1e-6) if len(y) else 0.5
        return {"mean": np.zeros(x.shape[1]), "scale": np.ones(x.shape[1]), "w1": np.zeros((x.shape[1], 1)), "b1": np.zeros(1),
                "w2": np.zeros(1), "b2": np.log(p / (1 - p)), "t": np.float64(1.0)}
    rng = np.random.default_rng(5)
    order = rng.permutation(len(y))
    hold = max(1, len(y) // 5) if len(y) >= 20 else 0
    test, fit = order[:hold], order[hold:]
    net = {"mean": x[fit].mean(0), "scale": x[fit].std(0) + 1e-6}
    z = (x - net["mean"]) / net["scale"]
    p = {"w1": rng.normal(0, z.shape[1] ** -0.5, (z.shape[1], HIDDEN)), "b1": np.zeros(HIDDEN),
         "w2": rng.normal(0, HIDDEN ** -0.5, HIDDEN), "b2": np.zeros(())}
    m, v = ({k: np.zeros_like(w) for k, w in p.items()} for _ in range(2))
    step = 0
    for epoch in range(EPOCHS):
        rng.shuffle(fit)
        for at in range(0, len(fit), BATCH):
            a, t = z[fit[at:at + BATCH]], y[fit[at:at + BATCH]]
            h = np.tanh(a @ p["w1"] + p["b1"])
            e = (1 / (1 + np.exp(-np.clip(h @ p["w2"] + p["b2"], -40, 40))) - t) / len(t)
            back = np.outer(e, p["w2"]) * (1 - h * h)
            grad = {"w1": a.T @ back + 1e-4 * p["w1"], "b1": back.sum(0), "w2": h.T @ e + 1e-4 * p["w2"], "b2": e.sum()}
            step += 1
            for k in p:
                m[k] = 0.9 * m[k] + 0.1 * grad[k]
                v[k] = 0.999 * v[k] + 0.001 * grad[k] ** 2
                p[k] = p[k] - RATE * (1 - epoch / EPOCHS) * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    net |= p | {"t": np.float64(1.0)}
    if hold:
        logit, t = _logit(net, x[test]), y[test]
        loss = lambda c: np.logaddexp(0, np.where(t > 0.5, -1, 1) * logit / c).mean()
        net["t"] = np.float64(min(np.geomspace(0.25, 8, 61), key=loss))
    return net


def _logit(net: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    h = np.tanh((x - net["mean"]) / net["scale"] @ net["w1"] + net["b1"])
    return (h @ net["w2"] + net["b2"]) / net["t"]


def training_rows(pooled: DataFrame, known: DataFrame) -> DataFrame:
    """(x, y) of at most ``TRAIN_ROWS`` labelled rows, those whose doc_id hashes lowest.

    Rows of a share of all hashes that holds about twice as many are ordered, so
    that what a partition sends on does not grow with their number.
    """
    rows = pooled.join(known, "doc_id")
    share = 2 * TRAIN_ROWS / max(rows.select("doc_id").count(), 1)
    if share < 1:
        rows = rows.filter(F.xxhash64("doc_id") < F.lit(int(share * 2 ** 64) - 2 ** 63))
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(TRAIN_ROWS).select("x", "y")


def score_quality(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    docs = docs.select("doc_id", "text")
    vectors = word_vectors(docs)
    pooled = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                 .mapInArrow(_pooled(vectors), "doc_id long, x array<float>"), "quality-features")
    held = F.expr("coalesce(pmod(crc32(cast(cast(doc_id as string) as binary)), 3) = 1, false)")
    known = labels.filter(F.col(label).isin(0, 1)).select(F.col("doc_id").cast("long").alias("doc_id"),
                                                          F.col(label).cast("double").alias("y")).distinct()
    # Learned from a bounded number of labelled rows that are not held out.
    sample = training_rows(pooled, known.filter(~held)).collect()
    x = np.array([r["x"] for r in sample], np.float64).reshape(-1, DIM + EXTRA)
    net = train(x, np.array([r["y"] for r in sample]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(1).flatten().to_numpy().astype(np.float64).reshape(b.num_rows, DIM + EXTRA)
            p = 1 / (1 + np.exp(-np.clip(_logit(net, x), -700, 700)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                                             names=["doc_id", "score", "predicted"])

    return pooled.mapInArrow(run, "doc_id long, score double, predicted int").select(
        "doc_id", held.alias("held_out"), "score", "predicted")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
