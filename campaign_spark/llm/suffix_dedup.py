"""Repeated passages: shard Burrows-Wheeler transforms merged by interleave refinement.

Which bytes lie in a 200-byte string that starts at two or more places?

1. Every 200-byte window is owned by its anchor: the 32-byte gram in it with
   the smallest hash (the last such). Equal windows have equal anchors at equal
   offsets, so a window can only repeat among the spans (the text of all
   windows of one anchor) whose anchors are equal. A task keeps one row per
   span: gram hash, span hash, place. Equal spans are counted before any text
   moves, and anchors found once drop out.
2. The distinct spans of the anchors left form shards. Each shard builds the
   Burrows-Wheeler transform of its (circular) spans over an alphabet of
   25-byte symbols, weighted by the spans' counts.
3. The shards of a bucket are merged by iterative interleave refinement: start
   with any interleaving, deal its rows stably by their symbols, and repeat; k
   rounds order all suffixes by 25 k bytes, and rows that no round separated
   share a common prefix of that length. After 8 rounds the blocks are the
   repeated 200-byte intervals; no suffix is sorted anew.
4. An anchor with over ``HOT_SPANS`` distinct spans would make a bucket grow
   with the corpus. Its spans are cut into parts of 16 windows, told apart by the
   bytes that a part's windows share, and parts that are still too many into
   single windows, which are counted; what is equal is summed in the map tasks.

Hashes have 64 bits (spans and windows: together with the gram's, 128).
Defined cases: a null text is empty; an empty or short text loses nothing; every
row gives a row, and rows that repeat a doc_id are separate texts; a null doc_id
stays null. Columns other than doc_id and text are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import cut, mix, table

LENGTH = 200
GRAM = 32
SYMBOL = 25  # LENGTH is a multiple
HOT_SPANS = 256
PART_WINDOWS = 16
SHARDS = 4
BUCKET_SPANS = 8_000  # distinct spans in a merge bucket, about 2.5 MB of text
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 2 ** 64)


_POWERS: dict[int, np.ndarray] = {}


def _powers(x: int, n: int) -> np.ndarray:
    """x^0 .. x^n, kept for the next text."""
    have = _POWERS.get(x)
    if have is None or len(have) <= n:
        have = np.full(max(n + 1, 65_536), x, _U)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if len(have) <= 4_000_000:
            _POWERS[x] = have
    return have[:n + 1]


class Prefix:
    """Prefix sums of a polynomial hash; the hash of any slice is one subtraction."""

    table = mix(np.arange(1, 257, dtype=_U) * _U(0xD1342543DE82EF95))

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, _U)
        np.cumsum(self.table[data] * _powers(_BASE, n)[:n], out=self.sums[1:])
        self.back = _powers(_INV, n)

    def slices(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.back[start]
        return mix(h + (end - start).astype(_U) * _U(0xA0761D6478BD642F))

    def grams(self, k: int) -> np.ndarray:
        """Hashes of all slices of length k."""
        h = (self.sums[k:] - self.sums[:-k]) * self.back[:len(self.sums) - k]
        return mix(h + _U(k * 0xA0761D6478BD642F % 2 ** 64))


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(gram hash, span hash, span start, span end) for each anchor of one text."""
    n = len(data)
    if n < LENGTH:
        return (np.empty(0, _U),) * 2 + (np.empty(0, np.int64),) * 2
    hashes = Prefix(data)
    g = hashes.grams(GRAM)
    # Each window's minimum and its last place: of the rest of the window's first block and of the
    # start of the next one, in blocks as long as a window has grams.
    w = LENGTH - GRAM + 1
    m = len(g) - w + 1
    full = np.concatenate([g, np.full(-len(g) % w, ~_U(0))]).reshape(-1, w)
    at = np.arange(w, dtype=np.int32)
    fwd = np.minimum.accumulate(full, 1)
    fwd_at = np.maximum.accumulate(np.where(full == fwd, at, 0), 1)
    back = full[:, ::-1]
    bwd = np.minimum.accumulate(back, 1)
    new = np.ones(full.shape, bool)
    new[:, 1:] = back[:, 1:] < bwd[:, :-1]
    bwd_at = w - 1 - np.maximum.accumulate(np.where(new, at, 0), 1)[:, ::-1]
    block = np.arange(len(full))[:, None] * w
    fwd, bwd = fwd.ravel()[w - 1:w - 1 + m], bwd[:, ::-1].ravel()[:m]
    own = np.where(fwd <= bwd, (fwd_at + block).ravel()[w - 1:w - 1 + m], (bwd_at + block).ravel()[:m])
    s = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    e = np.append(s[1:], m) - 1 + LENGTH
    return g[own[s]], hashes.slices(s, e) ^ mix((own[s] - s).astype(_U)), s, e


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows, marks = b.column(0).to_pylist(), b.column(1).to_pylist()
        cols, size = [], 0
        for i, body in enumerate(b.column(2)):
            g, d, s, e = anchors(np.frombuffer(body.as_buffer(), np.uint8))
            cols.append((np.full(len(s), rows[i], np.int64), np.full(len(s), marks[i], np.int64), g.view(np.int64),
                         d.view(np.int64), s.astype(np.int32), e.astype(np.int32)))
            size += len(s)
            if size > 50_000 or i == len(rows) - 1:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in zip(*cols)], names=["row", "mark", "gram", "span", "s", "e"])
                cols, size = [], 0


def _symbols(texts: list[np.ndarray], size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every position of the circular texts: the number of the 25-byte symbol before it (numbers
    in the order of the symbols' hashes), and the position 25 bytes before it."""
    ring = np.concatenate([x for t in texts for x in (t[-SYMBOL:], t)])
    start = np.cumsum(size) - size
    text = np.repeat(np.arange(len(texts)), size)
    at = np.arange(len(text))
    _, symbol = np.unique(Prefix(ring).grams(SYMBOL)[at + text * SYMBOL], return_inverse=True)
    before = at - SYMBOL
    before[before < start[text]] += size[text[before < start[text]]]
    return symbol.astype(np.int32), before


def _stable(ids: np.ndarray) -> np.ndarray:
    """Stable order of integer ids: two counting passes over 16 bits."""
    low = np.argsort((ids & 0xFFFF).astype(np.uint16), kind="stable")
    if len(ids) and ids.max() > 0xFFFF:
        low = low[np.argsort((ids[low] >> 16).astype(np.uint16), kind="stable")]
    return low


def transform(symbol: np.ndarray, before: np.ndarray) -> np.ndarray:
    """One shard's suffixes in the order of their first 200 bytes; the transform is ``symbol`` in that order."""
    order = np.arange(len(symbol))
    for _ in range(LENGTH // SYMBOL):
        order = before[order[_stable(symbol[order])]]
    return order


def merge(shards: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Interleave the shards' transforms (symbols in suffix order).

    Returns, in merged order, the row of the concatenated shards, and the number
    of its block: rows of one block share a common prefix of 200 bytes or more.
    """
    symbols = np.concatenate(shards)
    source = np.repeat(np.arange(len(shards), dtype=np.uint8), [len(s) for s in shards])
    block = np.zeros(len(source), np.int32)
    place = np.arange(len(source))
    for _ in range(LENGTH // SYMBOL):
        symbol = symbols[place]
        deal = _stable(symbol)
        symbol, block, source = symbol[deal], block[deal], source[deal]
        step = np.zeros(len(block), np.int32)
        step[1:] = (symbol[1:] != symbol[:-1]) | (block[1:] != block[:-1])
        block = np.cumsum(step, dtype=np.int32)
        # The rows of a shard keep their order, so the k-th row of a shard is its k-th suffix.
        place[np.argsort(source, kind="stable")] = np.arange(len(source))
    return place, block


def _bucket(pdf: pd.DataFrame) -> pd.DataFrame:
    """One bucket of spans -> covered ranges (gram, span, lo, hi) within each span."""
    gram, span, weight = (pdf[c].to_numpy(np.int64) for c in ("gram", "span", "weight"))
    texts = [np.frombuffer(x, np.uint8) for x in pdf["text"]]
    size = np.array([len(t) for t in texts])
    symbol, before = _symbols(texts, size)
    shard = np.cumsum(size) * SHARDS // (size.sum() + 1)  # of each text, in order
    edge = np.concatenate([[0], np.cumsum(np.bincount(shard, weights=size, minlength=SHARDS)).astype(np.int64)])
    orders = [transform(symbol[a:b], before[a:b] - a) + a for a, b in zip(edge, edge[1:]) if b > a]
    rows = np.concatenate(orders)
    place, block = merge([symbol[o] for o in orders])
    at = rows[place]
    own = np.repeat(np.arange(len(texts)), size)[at]
    off = at - (np.cumsum(size) - size)[own]
    window = off <= size[own] - LENGTH  # suffixes that start a whole window; the rest wrap round
    total = np.bincount(block[window], weights=weight[own[window]], minlength=int(block[-1]) + 1)
    hit = np.flatnonzero(window)[total[block[window]] >= 2]
    return _ranges(gram, span, own[hit], off[hit])


def _ranges(gram: np.ndarray, span: np.ndarray, own: np.ndarray, off: np.ndarray) -> pd.DataFrame:
    """Starts of repeated windows -> maximal covered ranges per span."""
    order = np.lexsort((off, own))
    own, off = own[order], off[order]
    first = np.ones(len(own), bool)
    first[1:] = (own[1:] != own[:-1]) | (off[1:] > off[:-1] + LENGTH)
    last = np.append(first[1:], True) if len(own) else first
    return pd.DataFrame({"gram": gram[own[first]], "span": span[own[first]], "lo": off[first].astype(np.int32),
                         "hi": (off[last] + LENGTH).astype(np.int32)})


def _parts(step: int):
    """Spans in parts of ``step`` windows at fixed places around their anchor. A part's key is the hash of
    the bytes that all windows there have in common: equal windows of two spans get equal keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for gram, span, weight, x in zip(*(b.column(i).to_pylist() for i in range(4))):
                h = Prefix(np.frombuffer(x, np.uint8))
                last = len(x) - LENGTH
                g = h.grams(GRAM)[:LENGTH - GRAM + 1]
                anchor = int(np.flatnonzero(g == g.min())[-1])
                number = np.arange(-anchor // step, (last - anchor) // step + 1)
                begin = anchor + number * step
                lo, end = np.maximum(begin, 0), np.minimum(begin + step - 1, last)
                key = mix(h.slices(begin + step - 1, begin + LENGTH) ^ mix(number.astype(_U) + _U(gram % 2 ** 64)))
                part = h.slices(lo, end + LENGTH) ^ mix((lo - begin).astype(_U))
                out += [(gram, span, weight, k, p, i, x[i:j + LENGTH]) for k, p, i, j in
                        zip(key.view(np.int64).tolist(), part.view(np.int64).tolist(), lo.tolist(), end.tolist())]
            cols = list(zip(*out)) or [()] * 7
            kinds = (pa.int64(),) * 5 + (pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=["gram", "span", "weight", "key", "part", "at", "text"])

    return run


def _split(spans: DataFrame, step: int) -> tuple[DataFrame, DataFrame]:
    """(which parts a span has, the distinct parts as spans of their own with their counts)."""
    cut_ = cut(spans.select("gram", "span", "weight", "text")
               .mapInArrow(_parts(step), "gram long, span long, weight long, key long, part long, at int, text binary"),
               f"repeat-parts-{step}")
    parts = cut_.groupBy(F.col("key").alias("gram"), F.col("part").alias("span")).agg(
        F.sum("weight").alias("weight"), F.min("text").alias("text"))  # one text under one hash
    kinds = parts.groupBy("gram").agg(F.count("*").alias("kinds"))
    return cut_.select("gram", "span", "key", "part", "at"), cut(parts.join(kinds, "gram"), f"repeat-split-{step}")


def _joined(ranges: Column) -> Column:
    """Ranges (lo, hi) with those that touch made one."""
    def add(done: Column, x: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        one = F.struct(last["lo"].alias("lo"), F.greatest(last["hi"], x["hi"]).alias("hi"))
        return F.when((F.size(done) > 0) & (last["hi"] >= x["lo"]),
                      F.concat(F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))), F.array(one))).otherwise(
            F.concat(done, F.array(x)))

    return F.aggregate(F.array_sort(ranges), F.array().cast("array<struct<lo:int,hi:int>>"), add)


def _back(found: DataFrame, has: DataFrame) -> DataFrame:
    """Ranges within parts -> ranges within the spans that have them."""
    f = found.select(F.col("gram").alias("key"), F.col("span").alias("part"), "lo", "hi")
    return has.join(f, ["key", "part"]).select("gram", "span", (F.col("lo") + F.col("at")).alias("lo"),
                                               (F.col("hi") + F.col("at")).alias("hi"))


def _alike(parts: DataFrame) -> DataFrame:
    """Parts that occur twice or more are covered whole."""
    return parts.filter("weight > 1").select("gram", "span", F.lit(0).alias("lo"), F.length("text").alias("hi"))


def _cut_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for body, picks in zip(b.column(0), b.column(1).to_pylist()):
            body = body.as_buffer()
            out += [(p["gram"], p["span"], p["weight"], p["kinds"], body[p["s"]:p["e"]].to_pybytes()) for p in picks]
        cols = list(zip(*out)) or [()] * 5
        yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.binary())],
                                         names=["gram", "span", "weight", "kinds", "text"])


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        cols = [[], [], [], [], []]
        for body, lo, hi in zip(b.column(1), b.column(2).to_pylist(), b.column(3).to_pylist()):
            data = np.frombuffer(body.as_buffer(), np.uint8)
            edge = np.zeros(len(data) + 1, np.int32)
            if lo:
                np.add.at(edge, np.array(lo), 1)
                np.add.at(edge, np.array(hi), -1)
            gone = np.cumsum(edge[:-1]) > 0
            kept = data[~gone].tobytes()
            cols[0].append(len(data))
            cols[1].append(int(gone.sum()))
            cols[2].append(int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()))
            cols[3].append(hashlib.sha256(kept).hexdigest())
            cols[4].append(kept.decode("utf-8", "ignore"))
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays([b.column(0)] + [pa.array(c, t) for c, t in zip(cols, types)], names=_OUT)


_OUT = ["document", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"]


def remove_repeats(docs: DataFrame) -> DataFrame:
    """document (struct of the input's columns), n_bytes, n_removed, n_spans, kept_sha256, kept_text."""
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    # A row's key; equal rows share it, and so get equal results.
    key = [F.coalesce(F.col("doc_id").cast("long"), F.lit(-2 ** 63)).alias("row"), F.xxhash64(body).alias("mark")]
    texts = docs.select(*key, body.alias("body"))
    spans = cut(texts.mapInArrow(_spans, "row long, mark long, gram long, span long, s int, e int"), "repeat-spans")
    grams = (spans.groupBy("gram").agg(F.count("*").alias("places"), F.min("span").alias("lo"), F.max("span").alias("hi"))
             .filter("places > 1").select("gram", (F.col("lo") == F.col("hi")).alias("alike")))
    again = cut(spans.join(grams, "gram"), "repeat-again")
    kinds = again.filter("not alike").groupBy("gram", "span").agg(
        F.count("*").alias("weight"), F.min(F.struct("row", "mark", "s", "e")).alias("at"))
    number = kinds.groupBy("gram").agg(F.count("*").alias("kinds"), F.min("weight").alias("least"))
    counted = cut(kinds.join(number, "gram"), "repeat-kinds")
    # Spans that all occur twice or more need no comparison: each is covered whole.
    sure = counted.filter("least > 1").select("gram", "span", F.lit(0).alias("lo"), (F.col("at.e") - F.col("at.s")).alias("hi"))
    mixed = counted.filter("least = 1")
    picks = (mixed.groupBy(F.col("at.row").alias("row"), F.col("at.mark").alias("mark"))
             .agg(F.collect_list(F.struct("gram", "span", "weight", "kinds", F.col("at.s").alias("s"),
                                          F.col("at.e").alias("e"))).alias("picks")))  # of one text
    cuts = cut(texts.join(picks, ["row", "mark"]).select("body", "picks")
               .mapInArrow(_cut_texts, "gram long, span long, weight long, kinds long, text binary"), "repeat-texts")
    cuts = cut(cuts.dropDuplicates(["gram", "span"]), "repeat-cuts")
    few, many = f"kinds <= {HOT_SPANS}", f"kinds > {HOT_SPANS}"
    has, parts = _split(cuts.filter(many), PART_WINDOWS)
    has1, windows = _split(parts.filter(many), 1)
    compare = cuts.filter(few).union(parts.filter(f"kinds > 1 and {few}").select(*cuts.columns))
    # Spans of one anchor share a bucket; HOT_SPANS bounds what they add to it.
    buckets = max(1, -(-compare.count() // BUCKET_SPANS))
    merged = cut(compare.groupBy(F.expr(f"pmod(xxhash64(gram), {buckets})")).applyInPandas(
        _bucket, "gram long, span long, lo int, hi int"), "repeat-merged")
    hot = merged.union(_alike(parts)).union(_back(_alike(windows), has1))
    found = cut(merged.union(_back(hot, has)).union(sure).groupBy("gram", "span")
                .agg(_joined(F.collect_list(F.struct("lo", "hi"))).alias("r")), "repeat-found")  # of one span
    whole = again.filter("alike").select("row", "mark", F.array(F.struct(F.col("s").alias("lo"), F.col("e").alias("hi"))).alias("r"))
    parts = again.filter("not alike").join(found, ["gram", "span"]).select("row", "mark", F.transform(
        "r", lambda x: F.struct((x["lo"] + F.col("s")).alias("lo"), (x["hi"] + F.col("s")).alias("hi"))).alias("r"))
    places = whole.union(parts).groupBy("row", "mark").agg(F.flatten(F.collect_list("r")).alias("r"))  # of one text
    places = places.select("row", "mark", F.col("r.lo").alias("lo"), F.col("r.hi").alias("hi"))
    none = F.array().cast("array<int>")
    rows = docs.select(*key, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"), body.alias("body"))
    rows = rows.join(places, ["row", "mark"], "left").select(
        "document", "body", F.coalesce("lo", none).alias("lo"), F.coalesce("hi", none).alias("hi"))
    schema = StructType([rows.schema["document"], *StructType.fromDDL(
        "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string").fields])
    return rows.mapInArrow(_remove, schema)


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("document.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def drop_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated bytes taken out of ``text``; characters cut in half go too.

    A null text stays null; an n_chars column, if any, is counted anew.
    """
    found = remove_repeats(docs)
    text = F.when(F.col("document.text").isNotNull(), F.col("kept_text"))
    out = found.select("document.*", text.alias("__text"))
    named = {"text": F.col("__text")}
    if "n_chars" in docs.columns:
        named["n_chars"] = F.length("__text").cast(docs.schema["n_chars"].dataType)
    return out.withColumns(named).select(*docs.columns)
