"""Near-duplicate groups: SuperMinHash signatures, banding, exact verification, union-find.

A document's set holds the 64-bit hashes of its distinct five-word shingles.
Rows with equal sets form one class, a node of the graph under a number of its
own; only classes are compared. The signature has 60 bands of 6 slots: a pair at similarity 0.75
shares no band with probability 8e-6, one at 0.8 with 1e-8, and a pair at 0.2
shares one with 0.4 per cent. Candidate links go from a bucket's centre to its members, never all
pairs; buckets that still hold several components take another centre, and
what that leaves is settled exactly by a prefix-filter join on rare items.

Defined cases: a null text is empty; an empty text has an empty set and is its
own component; fewer than five words are one element; every row gives a row,
repeated ones the same; rows of one doc_id with different texts are one document
with several sets: whatever one of them is linked with, all are (rows of it
without words stay alone); a null doc_id is kept, with a null component and no
part in any link. Columns other than doc_id and text are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WordHash, byte_texts, components, cut, discard, mix, table

WORDS = 5
PERCENT = 75
BANDS, ROWS = 60, 6
SLOTS = BANDS * ROWS
_U = np.uint64
_BATCH = 60_000  # shingles signed together; bounds a worker's memory
_STEP = _U(0x9E3779B97F4A7C15)
_MUL = [_U(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3,
                        0x589965CC75374CC3)]


def shingles(body: bytes, hashes: WordHash) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the five-word windows of one text."""
    words = body.lower().split()  # bytes: A-Z only, and exactly the white space of the definition
    n = len(words)
    if not n:
        return np.empty(0, _U)
    h = np.fromiter(map(hashes.__getitem__, words), _U, n)
    if n < WORDS:
        one = _U(n)
        with np.errstate(over="ignore"):
            for x in h:
                one = mix(one * _STEP + x)
        return np.array([one], _U)
    acc = np.zeros(n - WORDS + 1, _U)
    for i in range(WORDS):
        acc += h[i:n - WORDS + 1 + i] * _MUL[i]
    return np.unique(mix(acc))


def superminhash(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """One signature row per non-empty set.

    Element e visits, in step j, the j-th slot of its own random permutation
    (a Fisher-Yates shuffle carried on step by step) with the value j + r,
    0 <= r < 1; each slot keeps its smallest value. A set stops early: once
    all its slots are below j, no later step can lower one.
    """
    n = len(sets)
    sig = np.full(n * slots, np.inf)
    e = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    perm = rows = None
    for j in range(slots):
        value = j + (mix(e ^ mix(np.array([2 * j + 1], _U) * _STEP)) >> _U(11)) * 2.0 ** -53
        k = j + ((mix(e ^ mix(np.array([2 * j + 2], _U) * _STEP)) >> _U(33)) * _U(slots - j) >> _U(31)).astype(np.int64)
        if j:
            slot = perm[rows, k].astype(np.int64)
            perm[rows, k] = perm[rows, j]
        else:
            slot = k
        np.minimum.at(sig, owner * slots + slot, value)
        going = sig.reshape(n, slots).max(1) > j + 1
        keep = going[owner]
        if not keep.all():
            e, owner = e[keep], owner[keep]
            if j:
                rows = rows[keep]
        if not len(e):
            break
        if not j:
            perm = np.tile(np.arange(slots, dtype=np.uint16), (len(e), 1))
            rows = np.arange(len(e))
            perm[rows, slot[keep]] = 0
    return sig.reshape(n, slots)


def bands(sig: np.ndarray) -> np.ndarray:
    """(sets, BANDS) bucket keys; the band's number is part of the key."""
    bits = np.ascontiguousarray(sig).view(_U).reshape(len(sig), BANDS, ROWS)
    key = np.tile(mix(np.arange(1, BANDS + 1, dtype=_U) * _STEP), (len(sig), 1))
    for r in range(ROWS):
        key = mix(key * _STEP + bits[:, :, r])
    return key.view(np.int64)


def set_key(items: bytes) -> bytes | None:
    """128-bit digest of a set's sorted hashes; none for the empty set."""
    return xxhash.xxh3_128_digest(items) if items else None


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHash()
    # Short sets need many steps, long ones few: they are signed apart.
    held = {True: [], False: []}
    size = {True: 0, False: 0}

    def out(items):
        full = [x for x in items if len(x[1])]
        keys = iter(bands(superminhash([s for _, s in full])) if full else ())
        cols = [[], [], [], []]
        for doc, s in items:
            cols[0].append(doc)
            cols[1].append(len(s))
            cols[2].append(set_key(s.tobytes()))
            cols[3].append(next(keys) if len(s) else np.empty(0, np.int64))
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary()),
             pa.array(cols[3], pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "set_key", "bands"])

    for b in batches:
        for doc, body in zip(b.column(0).to_pylist(), b.column(1)):
            s = shingles(body.as_buffer().to_pybytes(), hashes)
            short = len(s) < 100
            held[short].append((doc, s))
            size[short] += len(s) + 1
            if size[short] >= _BATCH:
                yield out(held[short])
                held[short], size[short] = [], 0
    for items in held.values():
        if items:
            yield out(items)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHash()
    for b in batches:
        for at in range(0, b.num_rows, 500):
            sets = [shingles(x.as_buffer().to_pybytes(), hashes).tobytes() for x in b.column(1)[at:at + 500]]
            yield pa.RecordBatch.from_arrays([pa.array([set_key(x) for x in sets], pa.binary()), pa.array(sets, pa.binary())],
                                             names=["set_key", "items"])


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep the pairs (a, b) whose whole sets reach the similarity."""
    for b in batches:
        keep = []
        for x, y in zip(b.column(2), b.column(3)):
            x, y = np.frombuffer(x.as_buffer(), _U), np.frombuffer(y.as_buffer(), _U)
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * both >= PERCENT * (len(x) + len(y) - both))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    one = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("items").alias("x")), "a")
    two = one.join(sets.select(F.col("doc_id").alias("b"), F.col("items").alias("y")), "b")
    return two.select("a", "b", "x", "y").mapInArrow(_linked, "a long, b long")


def _similar_size(a: str, b: str):
    return F.expr(f"100 * least({a}, {b}) >= {PERCENT} * greatest({a}, {b})")


def _merge(members: DataFrame, edges: DataFrame) -> DataFrame:
    """members (doc, comp) after the links ``edges`` (a, b)."""
    named = (edges.join(members.select(F.col("doc").alias("a"), F.col("comp").alias("ca")), "a")
             .join(members.select(F.col("doc").alias("b"), F.col("comp").alias("cb")), "b"))
    roots = components(named.select(F.col("ca").alias("a"), F.col("cb").alias("b")), "near-cc")
    roots = roots.select(F.col("node").alias("comp"), F.col("comp").alias("root"))
    return cut(members.join(roots, "comp", "left").select("doc", "n", F.coalesce("root", "comp").alias("comp")),
               "near-members")


def _star_round(rows: DataFrame, members: DataFrame, degree: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One more centre for every bucket that holds several components: the member linked most often so
    far, against the members of other components. Returns the documents of such buckets, and members."""
    rows = cut(rows.join(members, "doc").join(degree, "doc", "left").select(
        "bucket", "doc", "n", "comp", F.coalesce("degree", F.lit(0)).alias("degree")), "near-rows")
    centre = (rows.groupBy("bucket")
              .agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                   F.max(F.struct("degree", (-F.col("doc")).alias("minus"), "n", "comp")).alias("c"))
              .filter("lo < hi")
              .select("bucket", (-F.col("c.minus")).alias("centre"), F.col("c.n").alias("cn"), F.col("c.comp").alias("cc")))
    open_ = cut(rows.join(centre, "bucket"), "near-open")
    pairs = open_.filter("doc <> centre and comp <> cc").filter(_similar_size("n", "cn"))
    edges = cut(_verify(pairs.select(F.col("centre").alias("a"), F.col("doc").alias("b")).distinct(), sets), "near-edges")
    left = open_.select("bucket", "doc")
    if edges.isEmpty():
        return left.select("doc").distinct(), members
    merged = _merge(members, edges)
    named = left.join(merged, "doc")
    still = named.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi")
    return named.join(still.select("bucket"), "bucket").select("doc").distinct(), merged


def _degrees(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("doc")).union(edges.select("b")).groupBy("doc").agg(F.count("*").alias("degree"))


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for doc, x in zip(b.column(0).to_pylist(), b.column(1)):
            x = np.frombuffer(x.as_buffer(), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), doc), pa.int64()), pa.array(x)],
                                             names=["doc", "item"])


def _prefix_buckets(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """(bucket, doc, lead) that hold together every pair of ``docs`` at the similarity t or above.

    With a set's items in order of rarity, two sets that reach t share an item
    within the first n - ceil(t n) + 1 of the larger and the first
    m - ceil(2 t m / (1 + t)) + 1 of the smaller; in the latter a member leads.
    Text that many documents share is common and so late in the order.
    """
    items = sets.join(docs.select(F.col("doc").alias("doc_id")), "doc_id", "left_semi").mapInArrow(
        _heads, "doc long, item long")
    items = cut(items, "near-items")
    count = items.groupBy("item").agg(F.count("*").alias("f")).filter("f > 1")
    # Items of one document alone still fill places of its prefix.
    counted = items.join(count, "item", "left").select("doc", F.struct(F.coalesce("f", F.lit(1)).alias("f"), "item").alias("x"))
    ordered = counted.groupBy("doc").agg(F.sort_array(F.collect_list("x")).alias("xs")).withColumn("n", F.size("xs"))
    t, lead = PERCENT, 2 * PERCENT
    first = F.expr(f"slice(xs, 1, cast(n - (n * {t} + 99) div 100 + 1 as int))")
    return (ordered.select("doc", "n", F.posexplode(first).alias("at", "x")).filter("x.f > 1")
            .select(F.col("x.item").alias("bucket"), "doc", "at",
                    F.expr(f"at < n - (n * {lead} + {99 + t}) div {100 + t} + 1").alias("lead")))


def _leaders_pairs(rows: DataFrame) -> DataFrame:
    """(a, b): leaders with the members, at least as large, that the first item they share leaves possible.

    rows: bucket, doc, at, lead, n, comp. From places p and q of that item on,
    two sets have at most 1 + min(n - p - 1, m - q - 1) items in common.
    """
    step = f"cast(floor(ln(%s) / ln({100 / PERCENT})) as int)"  # sizes of a linked pair are at most a step apart
    lead = rows.filter("lead").select("bucket", F.col("doc").alias("a"), F.col("at").alias("q"), F.col("n").alias("m"),
                                      F.col("comp").alias("ca"), F.expr(step % "n").alias("k"))
    lead = lead.withColumn("step", F.explode(F.expr("array(k, k + 1, k + 2)"))).drop("k")
    return (rows.withColumn("step", F.expr(step % "n")).join(lead, ["bucket", "step"])
            .filter("doc <> a and comp <> ca and n >= m").filter(_similar_size("n", "m"))
            .filter(f"(1 + least(n - at - 1, m - q - 1)) * {100 + PERCENT} >= {PERCENT} * (n + m)")
            .select("a", F.col("doc").alias("b")).distinct())


def _one_id(named: DataFrame, comps: DataFrame) -> DataFrame:
    """comps (set_key, low, comp) with the components joined in which one doc_id has different sets."""
    several = (named.groupBy("doc_id").agg(F.min("set_key").alias("first"), F.max("set_key").alias("last"))
               .filter("first < last").select("doc_id", "first"))
    links = cut(named.join(several, "doc_id").filter("set_key <> first").select("set_key", "first").distinct(), "near-ids")
    if links.isEmpty():
        return comps
    edges = (links.join(comps.select("set_key", F.col("comp").alias("a")), "set_key")
             .join(comps.select(F.col("set_key").alias("first"), F.col("comp").alias("b")), "first").select("a", "b"))
    roots = components(edges, "near-cc").select(F.col("node").alias("comp"), F.col("comp").alias("root"))
    return cut(comps.join(roots, "comp", "left").select("set_key", "low", F.coalesce("root", "comp").alias("comp")), "near-comps")


def near_groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of ``docs``."""
    texts = byte_texts(docs)
    signed = cut(texts.mapInArrow(_sign, "doc_id long, n_shingles long, set_key binary, bands array<long>"), "near-signed")
    # Rows with equal sets are one class, however many there are (map-side min). Its number is fixed by the written file.
    named = signed.filter("set_key is not null and doc_id is not null")
    classes = cut(named.groupBy("set_key").agg(F.min("doc_id").alias("low"))
                  .withColumn("doc", F.monotonically_increasing_id()), "near-classes")
    keyed = (named.join(classes, "set_key").filter("doc_id = low").dropDuplicates(["set_key"])
             .select("doc", F.col("n_shingles").alias("n"), "bands"))
    slots = cut(keyed.select("doc", "n", F.explode("bands").alias("bucket")), "near-buckets")
    centre = (slots.groupBy("bucket").agg(F.min(F.struct("doc", "n")).alias("c"), F.max("doc").alias("hi"))
              .filter("c.doc < hi").select("bucket", F.col("c.doc").alias("centre"), F.col("c.n").alias("cn")))
    met = cut(slots.join(centre, "bucket"), "near-met")
    discard(slots)
    members = cut(met.select("doc", "n", F.col("doc").alias("comp")).distinct(), "near-members")
    compared = classes.join(members.select("doc"), "doc")
    sets = cut(texts.join(compared.select(F.col("low").alias("doc_id")), "doc_id", "left_semi")
               .mapInArrow(_sets, "set_key binary, items binary").dropDuplicates(["set_key"])
               .join(compared, "set_key").select(F.col("doc").alias("doc_id"), "items"), "near-sets")
    # First each document against the centre that it meets in most bands.
    best = (met.filter("doc <> centre").filter(_similar_size("n", "cn"))
            .groupBy("doc", "centre").agg(F.count("*").alias("bands"))
            .groupBy("doc").agg(F.max(F.struct("bands", (-F.col("centre")).alias("minus"))).alias("c"))
            .select((-F.col("c.minus")).alias("a"), F.col("doc").alias("b")))
    edges = cut(_verify(best, sets), "near-edges")
    members = _merge(members, edges)
    left, members = _star_round(met.select("bucket", "doc"), members, _degrees(edges), sets)
    left = cut(left, "near-left")
    discard(met)
    if not left.isEmpty():
        exact = cut(_prefix_buckets(left, sets).join(members, "doc"), "near-prefix")
        mixed = exact.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi")
        edges = cut(_verify(_leaders_pairs(exact.join(mixed.select("bucket"), "bucket")), sets), "near-edges")
        if not edges.isEmpty():
            members = _merge(members, edges)
    comps = classes.join(members.select("doc", "comp"), "doc", "left").select("set_key", "low", F.coalesce("comp", "doc").alias("comp"))
    comps = _one_id(named, cut(comps, "near-comps"))
    lowest = comps.groupBy("comp").agg(F.min("low").alias("lowest"))
    comp = comps.join(lowest, "comp").select("set_key", "lowest")
    return (signed.select("doc_id", "n_shingles", "set_key").join(comp, "set_key", "left")
            .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("lowest", "doc_id")))
            .select("doc_id", "n_shingles", "component_id",
                    F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)).alias("kept")))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))
