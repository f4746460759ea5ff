"""Incremental delivery of results to a client.

The analysed workload has no stream processing (no event-time windows,
watermarks or state). What it has is a batched pull of a query result to a
client; ``batched_rows`` provides it over Spark's partition-at-a-time local
iterator, so the driver holds one partition at a time, never the result.
"""

from campaign_spark.streaming.batches import batched_rows

__all__ = ["batched_rows"]
