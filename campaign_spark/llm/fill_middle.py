"""Fill-in-the-middle: texts cut at two token ranks found in an indexable skip list, and put in a new order.

A document's tokens (``[blanks]*word`` or trailing blanks) are the units of an
indexable skip list. Its base lane has one link a unit; every express lane
keeps the units whose tower reaches it. Each link carries two widths, the units
and the code points that it steps over; a lane's widths are sums of those of
the lane below. A cut rank is reached from the top lane down, following a link
while the units passed do not exceed the rank; the code points passed are the
exact cut. Both cuts take about log2(units) steps a lane deep.

The cuts and the form follow from sha256 of ``seed:doc_id`` alone, so every run,
retry and partitioning gives the same rows.

Defined cases: a null or empty text has no tokens, form plain and output ''; a
null doc_id is hashed as the empty string after the seed; every row gives a
row, repeated ones the same; an empty table gives no rows; other columns,
whatever their names, are left out; texts are never shortened, a task holds one
text's arrays at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import byte_texts, mix, table

# Fixed values of the output format.
SEED = 42
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
FIM_PERCENT = 50  # of the documents; the rest stay plain
SPM_PERCENT = 80  # of those cut; the rest are psm

_BLANKS = np.zeros(256, bool)
_BLANKS[[32, *range(9, 14)]] = True
_FLUSH = 16 << 20  # bytes of text in one batch of results
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


class Towers:
    """Tower height of each unit: one more for every two zero bits that end a hash of its place."""

    def __init__(self) -> None:
        self._heights = np.zeros(0, np.int8)

    def upto(self, n: int) -> np.ndarray:
        if len(self._heights) < n:
            h = mix(np.arange(1, max(n, 1024, 2 * len(self._heights)) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            low = h & (~h + np.uint64(1))  # the lowest set bit
            self._heights = (np.log2(np.maximum(low, np.uint64(1)).astype(np.float64)) / 2).astype(np.int8)
        return self._heights[:n]


_TOWERS = Towers()


class SkipList:
    """Units in order, with their widths in code points.

    ``units[k]`` and ``chars[k]`` are the widths of the links of lane ``k``;
    after ``i`` links of lane ``k`` the walk goes on at link ``down[k][i]`` of
    the lane below.
    """

    def __init__(self, chars: np.ndarray, heights: np.ndarray | None = None) -> None:
        n = len(chars)
        heights = _TOWERS.upto(n) if heights is None else heights
        self.n_units = n
        self.units = [np.ones(n, np.int64)]
        self.chars = [np.asarray(chars, np.int64)]
        self.down: list[np.ndarray | None] = [None]
        level = 1
        while n:
            at = np.flatnonzero(heights >= level)  # places, in the lane below, of the nodes that reach this lane
            if not len(at):
                break
            begins = np.concatenate(([0], at[:-1] + 1))
            end = at[-1] + 1
            self.units.append(np.add.reduceat(self.units[-1][:end], begins))
            self.chars.append(np.add.reduceat(self.chars[-1][:end], begins))
            self.down.append(np.concatenate(([0], at + 1)))
            heights = heights[at]
            n = len(at)
            level += 1

    def locate(self, rank: int) -> int:
        """Code points before unit ``rank`` (0 to n_units)."""
        if not 0 <= rank <= self.n_units:
            raise IndexError(rank)
        passed = place = link = 0
        for lane in range(len(self.units) - 1, -1, -1):
            units, chars = self.units[lane], self.chars[lane]
            while link < len(units) and passed + units[link] <= rank:
                passed += int(units[link])
                place += int(chars[link])
                link += 1
            if lane:
                link = int(self.down[lane][link])
        return place


def token_widths(text: str) -> np.ndarray:
    """Code points of each token: blanks and the word after them, or the blanks that end the text."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(points):
        return np.zeros(0, np.int64)
    blank = _BLANKS[np.minimum(points, 255)]
    last = ~blank
    last[:-1] &= blank[1:]
    last[-1] = True  # a word or blanks, whichever ends the text
    return np.diff(np.flatnonzero(last), prepend=-1)


def cut_and_order(doc_id: int | None, text: str, seed: int = SEED, fim_percent: int = FIM_PERCENT,
                  spm_percent: int = SPM_PERCENT) -> tuple[int, str, int | None, int | None, str]:
    """(tokens, form, code points of the prefix, of the middle, output) of one text."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k:8 * k + 8], 16) for k in range(4))
    widths = token_widths(text)
    n = len(widths)
    if not n or h3 % 100 >= fim_percent or PREFIX in text or SUFFIX in text or MIDDLE in text:
        return n, "plain", None, None, text
    units = SkipList(widths)
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = units.locate(low), units.locate(high)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm_percent:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(docs: DataFrame, seed: int = SEED, fim_percent: int = FIM_PERCENT,
                   spm_percent: int = SPM_PERCENT) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output: one row per row of ``docs``; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for b in batches:
            rows, size = [], 0
            for doc_id, body in zip(b.column(0).to_pylist(), b.column(1)):
                rows.append((doc_id, *cut_and_order(doc_id, body.as_buffer().to_pybytes().decode("utf-8"), seed,
                                                    fim_percent, spm_percent)))
                size += len(rows[-1][-1])
                if size > _FLUSH:
                    yield batch(rows)
                    rows, size = [], 0
            if rows:
                yield batch(rows)

    return byte_texts(docs).mapInArrow(run, SCHEMA)


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from: markers are found and taken out, the parts put back in order."""

    def between(begin: str, end: str) -> Column:
        first = F.instr(output, begin) + F.lit(len(begin))
        return F.substring(output, first, F.instr(output, end) - first)

    middle = F.substring(output, F.instr(output, MIDDLE) + F.lit(len(MIDDLE)), F.char_length(output))
    psm = F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, form = F.col("output"), F.col("form")
    return fill_in_middle(table(spark, sf_dir, "documents")).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(out.cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(out, form).cast("binary"), 256).alias("restored_sha256"))


OP13_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS body, sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
t AS (SELECT *, regexp_extract_all(body, '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS tokens FROM d),
k AS (SELECT *, len(tokens)::BIGINT AS n, ('0x' || h[1:8])::UBIGINT % (len(tokens) + 1) AS h1,
             ('0x' || h[9:16])::UBIGINT % (len(tokens) + 1) AS h2,
             ('0x' || h[17:24])::UBIGINT % 100 AS h3, ('0x' || h[25:32])::UBIGINT % 100 AS h4 FROM t),
p AS (SELECT doc_id, body, n,
             CASE WHEN body = '' OR contains(body, '{PREFIX}') OR contains(body, '{SUFFIX}') OR contains(body, '{MIDDLE}')
                       OR h3 >= {FIM_PERCENT} THEN 'plain' WHEN h4 < {SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form,
             array_to_string(tokens[1:least(h1, h2)::BIGINT], '') AS pre,
             array_to_string(tokens[least(h1, h2)::BIGINT + 1:greatest(h1, h2)::BIGINT], '') AS mid,
             array_to_string(tokens[greatest(h1, h2)::BIGINT + 1:], '') AS suf FROM k)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '{PREFIX}' || pre || '{SUFFIX}' || suf || '{MIDDLE}' || mid
                        ELSE '{SUFFIX}' || suf || '{PREFIX}' || pre || '{MIDDLE}' || mid END) AS output_sha256,
       sha256(body) AS restored_sha256
FROM p
"""
