"""String-valued helpers: code-format compliance and value-count text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from campaign_spark.fixed import CODE_PARTS, CODE_SEPARATOR
from campaign_spark.fixed import COMPLIANT_LABEL as COMPLIANT
from campaign_spark.fixed import COUNT_ITEM_SEPARATOR as ITEM_SEPARATOR
from campaign_spark.fixed import COUNT_PAIR_SEPARATOR as PAIR_SEPARATOR


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def code_compliance_label(code: str | Column, sep: str = CODE_SEPARATOR, parts: int = CODE_PARTS) -> Column:
    """``'compliant'`` when the code splits into exactly ``parts`` pieces on
    ``sep`` (empty pieces count, lengths are not checked), else the code."""
    c = _col(code)
    pattern = "\\Q" + sep + "\\E"
    return F.when(F.size(F.split(c, pattern, -1)) == parts, F.lit(COMPLIANT)).otherwise(c)


def count_text(pairs: Column) -> Column:
    """Render an array<struct<value:string, n:bigint>> already in display
    order as ``"v1: n1;; v2: n2"``."""
    return F.array_join(
        F.transform(pairs, lambda p: F.concat(p["value"], F.lit(PAIR_SEPARATOR), p["n"].cast("string"))),
        ITEM_SEPARATOR,
    )
