"""Best-fit packing: configuration LP over the length histogram, then rounding.

Only the histogram of piece lengths (at most one row per length up to the
sequence length) reaches the driver. There the configuration LP - cover every
length with as few sequences as possible - is solved by multiplicative weights:
each step prices the lengths, a knapsack over the sequence's capacity finds the
dearest configuration, and the lengths it covers become cheaper. Configurations
are rounded down to what is there, the rest goes best-fit decreasing, both on
counts. The plan's size depends on the sequence length alone; tasks look each
piece's place up by its length and its rank among the pieces of that length.

Defined cases: a null or empty text is one piece, the end token; a null doc_id
stays null; repeated rows are separate documents; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import byte_texts, cut, table
from .word_codes import Words, unreachable

CAPACITY = 4096
END = 1
STEPS = 96  # of the multiplicative weights
RATE = 0.5
RANK_ROWS = 5_000  # pieces of a bucket in which ranks are counted
_WORDS = 300_000  # words whose ids a Python worker keeps


def public_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _pieces(path: str, capacity: int):
    left_out = unreachable(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Words(path, left_out)
        known: dict[bytes, bytes] = {}
        end = np.uint32(END).astype("<u4").tobytes()
        for b in batches:
            ids_of = b.column(0).to_pylist()
            for at in range(0, len(ids_of), 256):
                # The tokenizer drops white space and never joins across it, so words are coded once.
                split = [x.as_buffer().to_pybytes().split() for x in b.column(1)[at:at + 256]]
                new = list(set().union(*split).difference(known))
                if len(known) + len(new) > _WORDS:
                    known.clear()
                    new = list(set().union(*split))
                known.update(coder.codes(new))
                cols = [[], [], [], [], []]
                for doc, words in zip(ids_of[at:at + 256], split):
                    data = b"".join(map(known.__getitem__, words)) + end
                    n = len(data) // 4
                    for p, start in enumerate(range(0, n, capacity)):
                        size = min(capacity, n - start)
                        for c, v in zip(cols, (doc, p, start, size, zlib.crc32(data[4 * start:4 * (start + size)]))):
                            c.append(v)
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                                 names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def _dearest(price: dict[int, float], count: dict[int, int], capacity: int) -> Counter:
    """Knapsack: the configuration of the highest total price, with no more of a length than there is."""
    best = np.zeros(capacity + 1)
    takes = []
    for size, p in price.items():
        copies, left = 1, min(count[size], capacity // size)
        while left > 0:  # copies in powers of two
            k = min(copies, left)
            new = best[:-k * size] + k * p
            better = new > best[k * size:]
            takes.append((size, k, better))
            best[k * size:][better] = new[better]
            left -= k
            copies *= 2
    config, room = Counter(), capacity
    for size, k, better in reversed(takes):
        if room >= k * size and better[room - k * size]:
            config[size] += k
            room -= k * size
    return config


def configurations(count: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Counter, int]]:
    """(configuration, how many sequences): every counted length is used exactly as often as it occurs."""
    left = {s: n for s, n in sorted(count.items(), reverse=True) if n > 0}
    plan = []
    if capacity in left:
        plan.append((Counter({capacity: 1}), left.pop(capacity)))
    weight = {s: s / capacity for s in left}
    found: dict[tuple, float] = defaultdict(float)
    for _ in range(STEPS if left else 0):
        config = _dearest(weight, left, capacity)
        width = min(left[s] / k for s, k in config.items())
        found[tuple(sorted(config.items()))] += RATE * width
        for s, k in config.items():
            weight[s] *= np.exp(-RATE * k * width / left[s])
    total = sum(s * n for s, n in left.items()) / capacity
    scale = total / max(sum(found.values()), 1e-9)
    for key, x in sorted(found.items(), key=lambda kv: -kv[1]):
        uses = min([int(x * scale + 1e-9), *(left[s] // k for s, k in key)])
        if uses:
            plan.append((Counter(dict(key)), uses))
            for s, k in key:
                left[s] -= k * uses
    return plan + _best_fit(left, capacity)


def _best_fit(left: dict[int, int], capacity: int) -> list[tuple[Counter, int]]:
    """Best-fit decreasing on counts: alike sequences are filled together."""
    open_: dict[int, list[tuple[tuple, int]]] = defaultdict(list)  # free room -> (contents, sequences)
    for size, n in sorted(left.items(), reverse=True):
        while n:
            room = min((r for r in open_ if r >= size), default=None)
            if room is None:
                each = capacity // size
                if n >= each:
                    open_[capacity - each * size].append(((size,) * each, n // each))
                if n % each:
                    open_[capacity - n % each * size].append(((size,) * (n % each), 1))
                break
            contents, uses = open_[room].pop()
            if not open_[room]:
                del open_[room]
            each = min(room // size, n)
            filled = min(uses, n // each)
            if uses > filled:
                open_[room].append((contents, uses - filled))
            open_[room - each * size].append((contents + (size,) * each, filled))
            n -= each * filled
    return [(Counter(contents), uses) for groups in open_.values() for contents, uses in groups]


def _places(plan: list[tuple[Counter, int]]) -> tuple[np.ndarray, ...]:
    """Sorted lookup: (length, first rank) -> first sequence and offset."""
    rank, base, rows = Counter(), 0, []
    for config, uses in plan:
        offset = 0
        for size, k in sorted(config.items(), reverse=True):
            for _ in range(k):
                rows.append((size, rank[size], base, offset))
                rank[size] += uses
                offset += size
        base += uses
    rows.sort()
    return tuple(np.array(c, np.int64) for c in (zip(*rows) if rows else [()] * 4))


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece."""
    pieces = byte_texts(docs).mapInArrow(_pieces(tokenizer or public_tokenizer(), capacity),
                                         "doc_id long, piece int, start long, length long, ids_crc32 long")
    pieces = cut(pieces.withColumn("row", F.monotonically_increasing_id()), "pack-pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    buckets = sum(histogram.values()) // RANK_ROWS + 1
    sizes, firsts, bases, offsets = _places(configurations(histogram, capacity))
    # A length's ranks are counted in buckets: a length that a third of all pieces have is spread.
    dealt = pieces.withColumn("bucket", F.expr(f"pmod(xxhash64(row), {buckets}L)"))
    before = (dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
              .select("length", "bucket", (F.sum("n").over(W.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("before")))
    ranked = dealt.withColumn("r", F.row_number().over(W.partitionBy("length", "bucket").orderBy("row")) - 1)
    ranked = ranked.join(before, ["length", "bucket"]).withColumn("rank", F.col("before") + F.col("r"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = sizes * 2 ** 44 + firsts
        for b in batches:
            size, rank = b.column(3).to_numpy(), b.column(5).to_numpy()
            at = np.searchsorted(key, size * 2 ** 44 + rank, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], pa.array(bases[at] + rank - firsts[at]), pa.array(offsets[at])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
