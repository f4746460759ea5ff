"""Temperature mixing of sources, realised as budgeted block permutations.

Source s with token share p_s gets the weight p_s^a / sum p^a. The exponent a is
found by bisection: the largest a in [0, 1] whose weights reach the target
entropy (a fraction of that of equal weights), raised where needed until no
source is repeated more than the limit. The budget is the largest that passes
over no text of the source with the most tokens per weight: that one is read
once, every other at least once, so a mixture never loses a row.

A source's rows are dealt into blocks of about ``BLOCK_TOKENS`` tokens by hash.
Each epoch is a permutation of its blocks (a hash of source, block and epoch);
whole epochs take all blocks, the last one whole blocks in permuted order until
the source's budget is reached. ``place`` in [0, 1) orders the mixture; sorting
by it interleaves all sources at their weights.

Sources are rows of a table, never collected: each bisection step is one
aggregate. Defined cases: a null source is one source of its own; a null or
empty text has no tokens and comes along with its block; sources without tokens
are read once; repeated rows are separate rows; other columns are passed on
(columns named epoch, place, n_tokens or block of the input are replaced).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, table

TARGET_ENTROPY = 0.95
MAX_EPOCHS = 2.0
BLOCK_TOKENS = 50_000
BINS = 1_024
_STEPS = 40


def _bisect(reaches, low: float = 0.0, high: float = 1.0) -> float:
    """Largest a in [low, high] with ``reaches(a)`` true; it is true at ``low`` and turns false once."""
    if reaches(high):
        return high
    for _ in range(_STEPS):
        mid = (low + high) / 2
        low, high = (mid, high) if reaches(mid) else (low, mid)
    return low


def exponent(sources: DataFrame, target_entropy: float = TARGET_ENTROPY, max_epochs: float = MAX_EPOCHS) -> float:
    """The exponent for sources (source, tokens)."""
    shares = sources.filter("tokens > 0")
    total, least, most, n = shares.agg(F.sum("tokens"), F.min("tokens"), F.max("tokens"), F.count("*")).first()
    if not n or least == most:
        return 1.0
    p = F.col("tokens") / F.lit(float(total))
    # Entropy of p^a / z is log z - a * sum(p^a log p) / z; all grid points in one aggregate.
    low, high = 0.0, 1.0
    for _ in range(6):
        grid = [low + (high - low) * k / 16 for k in range(17)]
        sums = shares.agg(*[x for a in grid for x in (F.sum(F.pow(p, F.lit(a))), F.sum(F.pow(p, F.lit(a)) * F.log(p)))]).first()
        goal = target_entropy * _log(n)
        ok = [k for k in range(17) if _log(sums[2 * k]) - grid[k] * sums[2 * k + 1] / sums[2 * k] >= goal - 1e-12]
        k = max(ok, default=0)
        if k == 16:
            low = high = grid[16]
            break
        low, high = grid[k], grid[k + 1]
    # Epochs of source s relative to the largest: (most / tokens)^(1 - a); the limit sets a least exponent.
    flat = _bisect(lambda b: (most / least) ** b <= max_epochs)
    return max(low, 1.0 - flat)


def _log(x: float) -> float:
    import math

    return math.log(x)


def mix(docs: DataFrame, target_entropy: float = TARGET_ENTROPY, max_epochs: float = MAX_EPOCHS,
        block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``docs`` with epoch, n_tokens, block, place: a row for each time that a row is read."""
    given = docs.drop("epoch", "n_tokens", "block", "place")
    body = F.coalesce("text", F.lit(""))
    counted = given.select(
        F.struct(*[F.col(f"`{c}`") for c in given.columns]).alias("document"), "source",
        F.regexp_count(body, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("n_tokens"),
        F.xxhash64("doc_id", "text").alias("__h"))
    slim = cut(counted.select("source", "n_tokens", "__h"), "mix-rows")
    sources = cut(slim.groupBy("source").agg(F.sum("n_tokens").alias("tokens")), "mix-sources")
    a = exponent(sources, target_entropy, max_epochs)
    most = sources.agg(F.max("tokens")).first()[0] or 0
    plan = sources.select("source", "tokens", F.when(F.col("tokens") > 0, F.pow(F.lit(float(most)) / F.col("tokens"), F.lit(1.0 - a)))
                          .otherwise(1.0).alias("epochs"),
                          F.greatest(F.lit(1), F.ceil(F.col("tokens") / block_tokens)).cast("long").alias("blocks"))
    plan = plan.withColumn("budget", F.col("tokens") * F.col("epochs"))
    # The last, partial epoch: whole blocks in permuted order up to the rest of the budget.
    block = F.expr("pmod(__h, blocks)")
    rank = F.expr("(xxhash64(source, block, epoch) & 9007199254740991) / 9007199254740992D")
    last = (slim.join(plan, slim["source"].eqNullSafe(plan["source"])).drop(plan["source"])
            .withColumn("block", block).withColumn("epoch", F.floor(F.col("epochs")).cast("int"))
            .groupBy("source", "block", "epoch", "tokens", "epochs")
            .agg(F.sum("n_tokens").alias("n")).withColumn("rank", rank)
            .withColumn("rest", F.col("tokens") * (F.col("epochs") - F.floor("epochs")))
            .withColumn("bin", F.floor(F.col("rank") * BINS)))
    last = cut(last, "mix-blocks")
    bins = last.groupBy("source", "bin", "rest").agg(F.sum("n").alias("n"))
    bins = bins.withColumn("before", F.sum("n").over(W.partitionBy("source").orderBy("bin")) - F.col("n"))
    edge = bins.filter("before < rest and before + n >= rest").select("source", "bin", "before")
    inside = (last.alias("l").join(edge.alias("e"), F.expr("l.source <=> e.source and l.bin = e.bin"))
              .select("l.source", "l.rank", "l.n", "l.rest", "e.before"))
    run = F.sum("n").over(W.partitionBy("source").orderBy("rank")) - F.col("n") + F.col("before")
    stop = inside.withColumn("run", run).filter("run < rest").groupBy("source").agg(F.max("rank").alias("stop"))
    plan = cut(plan.alias("p").join(stop.alias("s"), F.expr("p.source <=> s.source"), "left")
               .select("p.*", F.coalesce("s.stop", F.lit(-1.0)).alias("stop")), "mix-plan")
    rows = counted.join(plan.withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source")))
    rows = (rows.withColumn("block", block)
            .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.floor("epochs").cast("int"))))
            .withColumn("rank", rank)
            .filter((F.col("epoch") < F.floor("epochs")) | (F.col("rank") <= F.col("stop")))
            .withColumn("place", F.least((F.col("epoch") + F.col("rank")) / F.col("epochs"), F.lit(0.9999999999999999))))
    return rows.select("document.*", "epoch", "n_tokens", "block", "place")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mixture with the columns of ``docs``, in its order of reading."""
    columns = docs.columns
    out = mix(docs)
    return out.repartitionByRange("place").sortWithinPartitions("place").select(*[F.col(f"`{c}`") for c in columns])


def op4_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).drop("text")
