import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from campaign_spark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    s = build_session(
        "local[4]",
        app_name="campaign_spark_tests",
        shuffle_partitions=4,
        conf={
            "spark.checkpoint.dir": os.path.join(scratch, "checkpoints"),
            "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
        },
    )
    yield s
    s.stop()


def rows(df, order=None):
    """Collected rows as tuples, sorted for order-insensitive comparison."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((v is None, str(v)) for v in t)) if order is None else out
