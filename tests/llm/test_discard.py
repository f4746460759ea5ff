"""Files that no later step reads do not stay on the disk."""

import os

from campaign_spark.llm.near_dup import near_groups
from campaign_spark.session import scratch_path


def _kept(spark) -> set[str]:
    folder = scratch_path(spark, "llm").removeprefix("file:")
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def test_buckets_are_deleted_once_compared(spark):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(i, base + f" e{i}") for i in range(8)] + [(i, f"other {i} text " + " ".join(f"x{i}y{j}" for j in range(20))) for i in range(20, 24)]
    docs = spark.createDataFrame([*rows, (30, None), (31, "")], "doc_id long, text string")
    before = _kept(spark)
    out = near_groups(docs)
    made = {name.rsplit("-", 1)[0] for name in _kept(spark) - before}
    got = {r.doc_id: r.component_id for r in out.collect()}
    assert got == {i: 0 if i < 8 else i for i in [*range(8), *range(20, 24), 30, 31]}
    assert any(x.startswith("near-signed") for x in made)
    assert not [x for x in made if x.startswith(("near-buckets", "near-met"))]
