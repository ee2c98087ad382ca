"""Plan text helpers: what `explain` prints, and counts of operators in it."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "simple") -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def operator_count(df: DataFrame, operator: str) -> int:
    """How many times a physical operator stands in the plan (one per line)."""
    return len(re.findall(rf"(?m)^[\s|:+\-*()\d]*{re.escape(operator)}\b", plan_text(df)))


def exchange_count(df: DataFrame) -> int:
    return operator_count(df, "Exchange")
