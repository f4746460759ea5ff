"""Source divergence audit: how far each (lang, source) group's use of terms departs from its language's.

Terms are runs of letters A-Z (lower-cased) and non-ASCII code points. A
language keeps the terms that at least ``MIN_DOCS`` of its documents have; V is
their number, N the occurrences of them in a group or language, and a term's
scaled share is p = 1 + floor(10^9 (count + 5) / (N + 5 V)), in whole numbers
throughout.

Strongest terms (part ``term``) by a dominance skyband: within a group the
value p - q grows with the group's count and falls with the language's, so a
term that ``TOP`` others dominate (count no lower, language count no higher,
earlier in UTF-8) can't be among the first ``TOP``. Every partition keeps the
terms dominated by fewer than ``TOP`` others, the skybands are merged by
(group, slice of the terms) and then by group, and what is left is ranked
exactly. No task holds more than a skyband and a buffer.

Distances of sources (part ``pair``): the sum of |p - q| over all kept terms is
taken from the counts above zero alone. With z the share of a term that does not
occur, the sum is that of |p_a - z_b| over a's terms and |p_b - z_a| over b's, of
|z_a - z_b| over the others, and a correction for each term of both (an equi-join
on the term).

Defined cases: null text, lang and source count as ''; a row is a document,
repeated ones count each; a language without kept terms has V = 0, its pairs
have value 0 and it has no ``term`` rows; a language with one source has no
pairs; a group without terms takes part with all counts zero; an empty table
gives no rows; doc_id is not read; other columns, whatever their names, are
left out. Whole texts are read, in whatever length.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, table

MIN_DOCS = 30
SCALE, SMOOTH = 1_000_000_000, 5
TOP = 50
SLICES = 64  # parts of a group's terms that the first merge takes apart
_HELD_TERMS = 200_000  # terms a task counts before it emits them; memory only, no effect on results
_BUFFER = 50_000  # rows of a group gathered before its skyband is renewed; likewise

# Every byte that is no part of a term becomes a blank; A-Z become a-z. Bytes of non-ASCII code points stay.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, count, docs) of a task's documents; each group also gives term '' with zeros."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), (count, docs) in held.items():
            terms = [b"", *count]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(terms)), pa.array([source] * len(terms)), pa.array(terms, pa.binary()).cast(pa.string()),
                 pa.array([0, *count.values()], pa.int64()), pa.array([0, *(docs[t] for t in count)], pa.int64())],
                names=["lang", "source", "term", "count", "docs"])
        held.clear()

    size = 0
    for b in batches:
        for lang, source, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            count, docs = held.setdefault((lang, source), (Counter(), Counter()))
            before = len(count)
            found = Counter(body.as_buffer().to_pybytes().translate(_FOLD).split())
            count.update(found)
            docs.update(found.keys())
            size += len(count) - before
            if size > _HELD_TERMS:
                yield from out()
                size = 0
    yield from out()


def group_terms(docs: DataFrame) -> DataFrame:
    """(lang, source, term, count, docs): whole counts, combined in each task before the shuffle."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
                        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("body"))
    counted = texts.mapInArrow(_terms, "lang string, source string, term string, count long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def share(count: str, total: str) -> Column:
    """1 + floor(SCALE (count + SMOOTH) / (total + SMOOTH v)), exact; null where the language keeps no term."""
    return F.expr(f"case when v > 0 then 1 + cast({count} + {SMOOTH} as decimal(20,0)) * cast({SCALE} as decimal(10,0))"
                  f" div cast({total} + {SMOOTH} * v as decimal(20,0)) end")


def skyband(count: np.ndarray, spread: np.ndarray, terms: list[str], k: int) -> np.ndarray:
    """Places of the rows that fewer than ``k`` others dominate: count no lower, spread no higher, term earlier.

    In the order of count, spread and term all that dominate a row come before
    it; of those at least ``k`` are kept if there are ``k`` at all, as the first
    ``k`` of them have fewer than ``k`` of their own. So kept rows suffice.
    """
    by_term = sorted(range(len(terms)), key=lambda i: terms[i].encode())
    place = np.empty(len(terms), np.int64)
    place[by_term] = np.arange(len(terms))
    kept = np.empty(len(terms), np.int64)
    s, p, n = np.empty(len(terms), np.int64), np.empty(len(terms), np.int64), 0
    for i in np.lexsort((place, spread, -count)):
        if n < k or np.count_nonzero((s[:n] <= spread[i]) & (p[:n] < place[i])) < k:
            kept[n], s[n], p[n] = i, spread[i], place[i]
            n += 1
    return kept[:n]


def _skybands(k: int):
    """mapInArrow over (lang, source, term, count, spread): the skyband of each group in a partition.

    It may be emitted in parts, as later steps make one of several.
    """

    def reduce(parts: list[tuple]) -> tuple:
        terms = [t for part in parts for t in part[0]]
        count, spread = (np.concatenate([part[j] for part in parts]) for j in (1, 2))
        at = skyband(count, spread, terms, k)
        return [terms[i] for i in at], count[at], spread[at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], list[tuple]] = {}
        rows: Counter = Counter()

        def out() -> Iterator[pa.RecordBatch]:
            for (lang, source), parts in held.items():
                terms, count, spread = reduce(parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(terms)), pa.array([source] * len(terms)), pa.array(terms, pa.string()),
                     pa.array(count), pa.array(spread)], names=["lang", "source", "term", "count", "spread"])
            held.clear()
            rows.clear()

        for b in batches:
            groups: dict[tuple[str, str], list[int]] = {}
            for i, key in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                groups.setdefault(key, []).append(i)
            terms, count, spread = b.column(2).to_pylist(), b.column(3).to_numpy(), b.column(4).to_numpy()
            for key, at in groups.items():
                held.setdefault(key, []).append(([terms[i] for i in at], count[at], spread[at]))
                rows[key] += len(at)
                if rows[key] > _BUFFER:
                    held[key] = [reduce(held[key])]
                    rows[key] = len(held[key][0][0])
            if sum(rows.values()) > 4 * _BUFFER:
                yield from out()
        yield from out()

    return run


def strongest_terms(kept: DataFrame, groups: DataFrame, top: int = TOP) -> DataFrame:
    """lang, source, item, value, rank: the first ``top`` terms of each group by p - q above zero.

    kept: lang, source, term, count, spread (the language's count); groups: lang, source, n, v, lang_n.
    """
    schema = "lang string, source string, term string, count long, spread long"
    band = kept.mapInArrow(_skybands(top), schema)
    slice_of = F.pmod(F.xxhash64("term"), F.lit(SLICES))
    band = band.repartition("lang", "source", slice_of).mapInArrow(_skybands(top), schema)
    band = band.repartition("lang", "source").mapInArrow(_skybands(top), schema)
    valued = band.join(groups, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"), (share("count", "n") - share("spread", "lang_n")).alias("value"))
    best = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return valued.filter("value > 0").withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)


def source_distances(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item (another source of the language), value: the sum of |p - q| over all kept terms."""
    g = groups.withColumn("z", share("0", "n"))
    shares = kept.join(g.select("lang", "source", "n", "v", "z"), ["lang", "source"]).select(
        "lang", "source", "term", "z", share("count", "n").alias("p"))
    other = g.select("lang", F.col("source").alias("item"), F.col("z").alias("zo"), F.col("used").alias("used_o"))
    # Terms with one share are one row, so this join has few rows a group.
    alike = shares.groupBy("lang", "source", "p").agg(F.count("*").alias("m"))
    alone = (alike.join(other.select("lang", "item", "zo"), "lang").filter("source <> item")
             .groupBy("lang", "source", "item").agg(F.sum(F.expr("m * abs(p - zo)")).alias("s")))
    a = shares.select("lang", "term", F.col("source").alias("a"), F.col("p").alias("pa"), F.col("z").alias("za"))
    b = shares.select("lang", "term", F.col("source").alias("b"), F.col("p").alias("pb"), F.col("z").alias("zb"))
    both = (a.join(b, ["lang", "term"]).filter("a < b").groupBy("lang", "a", "b")
            .agg(F.sum(F.expr("abs(pa - pb) - abs(pa - zb) - abs(pb - za) + abs(za - zb)")).alias("s")))
    one_way = both.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "s")
    other_way = both.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "s")
    reverse = alone.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "s")
    parts = alone.unionByName(reverse).unionByName(one_way).unionByName(other_way)
    sums = parts.groupBy("lang", "source", "item").agg(F.sum("s").alias("s"))
    return (g.join(other, "lang").filter("source <> item").join(sums, ["lang", "source", "item"], "left")
            .select("lang", "source", "item",
                    F.expr("case when v > 0 then coalesce(s, 0) + (v - used - used_o) * abs(z - zo) else 0 end").alias("value")))


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank."""
    counted = cut(group_terms(docs), "divergence-terms")
    terms = counted.filter("term <> ''")
    vocabulary = (terms.groupBy("lang", "term").agg(F.sum("count").alias("spread"), F.sum("docs").alias("docs"))
                  .filter(F.col("docs") >= min_docs).select("lang", "term", "spread"))
    kept = cut(terms.join(vocabulary, ["lang", "term"]).select("lang", "source", "term", "count", "spread"), "divergence-kept")
    used = kept.groupBy("lang", "source").agg(F.sum("count").alias("n"), F.count("*").alias("used"))
    # A kept term's language count is that of any of its rows.
    langs = (kept.groupBy("lang", "term").agg(F.max("spread").alias("spread"))
             .groupBy("lang").agg(F.sum("spread").alias("lang_n"), F.count("*").alias("v")))
    groups = (counted.filter("term = ''").select("lang", "source").join(used, ["lang", "source"], "left")
              .join(langs, "lang", "left").select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "used", "lang_n", "v")]))
    groups = cut(groups, "divergence-groups")
    ranked = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = source_distances(kept, groups).withColumn("rank", F.row_number().over(ranked))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (pairs.withColumn("part", F.lit("pair")).select(*columns)
            .union(strongest_terms(kept, groups, top).withColumn("part", F.lit("term")).select(*columns)))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents").select("text", "lang", "source"))


OP12_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS body FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(translate(body, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS c, count(DISTINCT r) AS docs FROM w GROUP BY ALL),
voc AS (SELECT lang, term, sum(c)::BIGINT AS lc FROM c GROUP BY lang, term HAVING sum(docs) >= {MIN_DOCS}),
size AS (SELECT lang, count(*) AS v, sum(lc)::BIGINT AS ln FROM voc GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM d),
dense AS (SELECT grp.lang, grp.source, voc.term, voc.lc, coalesce(c.c, 0) AS c
          FROM grp JOIN voc USING (lang) LEFT JOIN c ON c.lang = grp.lang AND c.source = grp.source AND c.term = voc.term),
n AS (SELECT lang, source, sum(c)::BIGINT AS n FROM dense GROUP BY ALL),
p AS (SELECT lang, source, term, c, 1 + ({SCALE}::HUGEINT * (c + {SMOOTH})) // (n + {SMOOTH} * v) AS p,
             1 + ({SCALE}::HUGEINT * (lc + {SMOOTH})) // (ln + {SMOOTH} * v) AS q
      FROM dense JOIN n USING (lang, source) JOIN size USING (lang)),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
         FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sums.value, 0)::BIGINT AS value
          FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM p WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
           FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {TOP}
"""
