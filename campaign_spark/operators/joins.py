"""Joins: star join to label dimensions, per-group attribute lookups.

Broadcast is used only where a side's size is checked first: either it is a
bounded lookup (``fits_broadcast`` counts at most ``max_rows + 1`` rows), or
the choice is left to Spark, whose planner and AQE compare the measured size
against ``spark.sql.(adaptive.)autoBroadcastJoinThreshold`` and otherwise run
a shuffled join (with AQE skew splitting for hot keys).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campaign_spark.functions.nulls import drop_null_keys
from campaign_spark.operators.ordering import written

# Default ceiling on dimension rows broadcast to every executor.
DEFAULT_BROADCAST_ROWS = 1_000_000


def fits_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> bool:
    """True when ``df`` has at most ``max_rows`` rows.

    The check reads no more than ``max_rows + 1`` rows, so it stays cheap even
    when the table turns out to be large.
    """
    return df.limit(max_rows + 1).count() <= max_rows


def maybe_broadcast(df: DataFrame, max_rows: int | None = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only when the row count is proven below ``max_rows``.

    ``max_rows=None`` skips the check and leaves the strategy to Spark/AQE,
    which broadcast only sides whose size is below the configured threshold.
    """
    if max_rows is not None and fits_broadcast(df, max_rows):
        return F.broadcast(df)
    return df


@dataclass
class Dimension:
    """A lookup joined to a fact: ``fact[fact_key] = dim[dim_key]``.

    ``labels`` maps dimension column -> output name. Only the key and the
    labels are read from the dimension (column pruning reaches the scan).
    """

    df: DataFrame
    fact_key: str
    dim_key: str
    labels: dict[str, str] = field(default_factory=dict)
    # None: Spark decides from the dimension's measured/estimated size
    # (autoBroadcastJoinThreshold at planning, AQE at run time). An int:
    # broadcast only if a bounded count proves at most that many rows.
    max_broadcast_rows: int | None = None


def star_join(fact: DataFrame, dims: list[Dimension], how: str = "left") -> DataFrame:
    """Fact LEFT JOIN each dimension on its id, adding the label columns.

    Duplicate ids in a dimension fan the fact rows out, as a plain SQL join
    does. A NULL fact key never matches.
    """
    out = fact
    for i, d in enumerate(dims):
        key_alias = f"__dim{i}_key"
        lookup = d.df.select(
            F.col(d.dim_key).alias(key_alias),
            *[F.col(src).alias(dst) for src, dst in d.labels.items()],
        )
        lookup = maybe_broadcast(lookup, d.max_broadcast_rows)
        out = out.join(lookup, out[d.fact_key] == lookup[key_alias], how).drop(key_alias)
    return out


def attach_group_value(
    df: DataFrame, keys: list[str], agg: Column, name: str
) -> DataFrame:
    """Left-join each row to one aggregate of its group (e.g. its last date).

    The per-group table is computed with map-side partial aggregation, written
    once and joined back on the keys: its size is known when the join is
    planned, so a small one is broadcast and the rows stay where they are (an
    aggregate of unknown size has both sides shuffled before AQE sees that one
    is small). A large one gets a sort-merge join whose hot keys AQE splits.
    Unlike a window over the group, no group is ever gathered into a single
    task. Rows with a NULL key get NULL.
    """
    per_group = written(drop_null_keys(df, keys).groupBy(*keys).agg(agg.alias(name)), "group-value")
    return df.join(per_group, keys, "left").select(*df.columns, name)
