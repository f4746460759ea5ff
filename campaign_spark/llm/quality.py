"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Each rule says when a document is rejected. On a sample (``SAMPLE`` rows, by a
hash of the key) every rule's time and share of rejections are measured; the
rules then run in the order of rejections per second. ``keep_good`` is the
cascade proper: a rule's counts are worked out only for documents that no
earlier rule rejected. ``judge`` returns the five counts of every document, so
there the order saves the comparisons alone. The order changes the cost and the
name of the first rule that rejects, never ``kept``.

The sample steers the order alone; every row's verdict comes from its whole
text. Defined cases: a null text has no words; every row gives a row, repeated
ones the same; a null doc_id stays null; other columns are passed or ignored.
Repeated windows are found by a 64-bit hash of their five words, within a text.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, table

SAMPLE = 2_000
WINDOW = 5
_SYMBOLS = "[#*$%&|<>]"

# Rejection rules: name -> SQL condition over the text ``body`` and the counts below.
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
MAX_SYMBOLS_PER_WORD = 0.25
MAX_SHOUTED = 0.5  # share of words with two marks of exclamation
MEAN_WORD = (2, 20)
MAX_DUP_LINES_PERCENT = 50
RULES = {
    "too_short": f"n_words < {MIN_WORDS}",
    "repeated_windows": f"100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words",
    "symbols": f"n_symbols > {MAX_SYMBOLS_PER_WORD} * n_words",
    "shouting": f"(length(body) - length(replace(body, '!!', ''))) / 2 > {MAX_SHOUTED} * n_words",
    "word_length": f"word_chars < {MEAN_WORD[0]} * n_words or word_chars > {MEAN_WORD[1]} * n_words",
    "repeated_lines": f"100 * n_dup_lines > {MAX_DUP_LINES_PERCENT} * size(split(body, '\\n'))",
}
BASE_RULES = ("too_short", "repeated_windows")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def words_of(body: Column) -> Column:
    """The words of a text: the six blanks are made one kind, so that the split needs no pattern."""
    for blank in "\t\n\x0b\x0c\r":
        body = F.replace(body, F.lit(blank), F.lit(" "))
    return F.array_remove(F.split(body, " "), "")


def bodies(docs: DataFrame) -> DataFrame:
    """(document struct, body, words): the rows of ``docs`` with their text, null as empty."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document")
    d = docs.select(row, F.coalesce(F.col("text"), F.lit("")).alias("body"))
    return d.withColumn("words", words_of(F.col("body")))


def add_count(d: DataFrame, name: str, gate: Column | None = None) -> DataFrame:
    """``d`` with the count ``name``; where ``gate`` is false it is null and is not worked out."""
    where = (lambda c: c) if gate is None else (lambda c: F.when(gate, c))
    if name == "n_words":
        return d.withColumn(name, where(F.size("words").cast("long")))
    if name == "word_chars":
        return d.withColumn(name, where(F.char_length(F.array_join("words", "")).cast("long")))
    if name == "n_symbols":
        return d.withColumn(name, where(F.regexp_count("body", F.lit(_SYMBOLS)).cast("long")))
    if name == "n_dup_lines":
        lines = F.filter(F.split("body", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        d = d.withColumn("lines", where(lines))
        return d.withColumn(name, (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")).drop("lines")
    if name != "n_repeat_words":
        raise ValueError(f"unknown count {name!r}")
    d = d.withColumn("hashes", where(F.transform("words", lambda w: F.xxhash64(w))))
    firsts = F.slice("hashes", 1, F.greatest(F.size("hashes") - (WINDOW - 1), F.lit(0)))
    d = d.withColumn("windows", F.transform(firsts, lambda h, i: F.xxhash64(h, *[F.col("hashes")[i + k] for k in range(1, WINDOW)])))
    # Only in a text with a repeated window: (hash, start) of each in hash order, neighbours with one hash are repeats.
    placed = F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    d = d.withColumn("sorted", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.sort_array(placed)).otherwise(F.expr("cast(array() as array<struct<h: bigint, i: int>>)")))
    n = F.greatest(F.size("sorted") - 1, F.lit(0))
    pairs = F.zip_with(F.slice("sorted", 1, n), F.slice("sorted", 2, n),
                       lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    d = d.withColumn("starts", F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda x: x.isNotNull())))))
    m = F.greatest(F.size("starts") - 1, F.lit(0))
    gaps = F.zip_with(F.slice("starts", 1, m), F.slice("starts", 2, m), lambda a, b: F.least(F.lit(WINDOW), b - a))
    repeat = F.when(F.size("starts") > 0, F.aggregate(gaps, F.lit(WINDOW), lambda a, g: a + g)).otherwise(0)
    return d.withColumn(name, where(repeat.cast("long"))).drop("hashes", "windows", "sorted", "starts")


def with_counts(docs: DataFrame) -> DataFrame:
    """docs as (document struct, body) plus the five counts.

    Cut the rows (``common.cut``) before a filter on anything made from these
    counts: a filter is pushed below the projections, which then work the
    counts out once per use, inside their own lambdas too.
    """
    d = bodies(docs)
    for name in COUNTS:
        d = add_count(d, name)
    return d.select("document", "body", *COUNTS)


def _seconds(make, repeats: int = 2) -> tuple[float, int]:
    """The least time of some runs of a one-row query, and its value; the first run warms and is left out."""
    times = []
    for _ in range(repeats + 1):
        began = time.perf_counter()
        value = make().first()[0]
        times.append(time.perf_counter() - began)
    return min(times[1:]), value


def order_rules(docs: DataFrame, rules: dict[str, str] = RULES) -> list[str]:
    """The rules by rejections per second on a sample, dearest last.

    A rule's seconds are those of a query that works out its own counts alone,
    less those of a query that only reads the sample; warmed and repeated.
    """
    rows = docs.count()
    step = max(1, rows // SAMPLE)
    sample = cut(docs.filter(F.expr(f"pmod(xxhash64(doc_id, text), {step}) = 0")), "quality-sample")
    reading, _ = _seconds(lambda: bodies(sample).agg(F.count_if(F.length("body") > 0)))
    rate = {}
    for name, rule in rules.items():
        took, hits = _seconds(lambda: with_counts(sample).agg(F.count_if(F.expr(rule))))
        rate[name] = hits / max(took - reading, 1e-3)
    return sorted(rules, key=lambda r: -rate[r])


def cascade(order: list[str], rules: dict[str, str] = RULES) -> Column:
    """Name of the first rule, in ``order``, that rejects; null if none does."""
    out = F.when(F.expr(rules[order[0]]), F.lit(order[0]))
    for name in order[1:]:
        out = out.when(F.expr(rules[name]), F.lit(name))
    return out


def judge(docs: DataFrame, rules: dict[str, str] = RULES) -> DataFrame:
    """document (struct of the input's columns), the counts, failed_rule, kept."""
    order = order_rules(docs, rules)
    judged = with_counts(docs).withColumn("failed_rule", cascade(order, rules))
    return judged.withColumn("kept", F.col("failed_rule").isNull()).drop("body")


def survivors(docs: DataFrame, order: list[str], rules: dict[str, str] = RULES) -> DataFrame:
    """(document struct, kept): the cascade proper. A rule's counts are worked out only for the
    documents that no earlier rule of ``order`` rejected; for the others they stay null."""
    d = bodies(docs).withColumn("kept", F.lit(True))
    for rule in order:
        for count in COUNTS:
            if count in rules[rule] and count not in d.columns:
                d = add_count(d, count, F.col("kept"))
        d = d.withColumn("kept", F.col("kept") & ~F.coalesce(F.expr(rules[rule]), F.lit(False)))
    return d.select("document", "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that no rule rejects; repeated rows stay as often as they come."""
    judged = cut(survivors(docs, order_rules(docs)), "quality-judged")
    return judged.filter("kept").select("document.*")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = " or ".join(f"({RULES[r]})" for r in BASE_RULES)
    return judge(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "document.doc_id", *COUNTS, F.expr(base).alias("base_failed"), "kept")


OP6_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS body FROM documents),
w AS (SELECT *, list_filter(string_split_regex(body, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words,
             list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
g AS (SELECT r, unnest(list_transform(range(1, len(words) - 3), lambda i: {{'i': i, 'k': words[i:i + 4]}})) AS x FROM w WHERE len(words) >= 5),
twice AS (SELECT r, x.i AS i FROM g QUALIFY count(*) OVER (PARTITION BY r, x.k) > 1),
gaps AS (SELECT r, least(5, coalesce(lead(i) OVER (PARTITION BY r ORDER BY i) - i, 5)) AS n FROM twice),
rep AS (SELECT r, sum(n)::BIGINT AS n FROM gaps GROUP BY r),
f AS (SELECT doc_id, body, len(words)::BIGINT AS n_words,
             coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
             len(regexp_extract_all(body, '[#*$%&|<>]'))::BIGINT AS n_symbols,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
             coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
             len(string_split(body, chr(10))) AS n_lines, len(regexp_extract_all(body, '!!')) AS shouts
      FROM w LEFT JOIN rep USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words
            OR n_symbols > {MAX_SYMBOLS_PER_WORD} * n_words OR shouts > {MAX_SHOUTED} * n_words
            OR word_chars < {MEAN_WORD[0]} * n_words OR word_chars > {MEAN_WORD[1]} * n_words
            OR 100 * n_dup_lines > {MAX_DUP_LINES_PERCENT} * n_lines) AS kept
FROM f
"""
