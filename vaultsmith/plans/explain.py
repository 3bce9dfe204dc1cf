"""Plan inspection: the text ``DataFrame.explain`` prints, and simple checks
on it used by the tests and the benchmark report."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

# Operators a vault load must never plan: they mean a cross product or a
# per-row Python round trip.
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def plan_summary(df: DataFrame) -> dict:
    """Counts of the operators that matter at scale (one per plan node)."""
    tree = plan_text(df, "simple")
    return {
        "exchanges": len(re.findall(r"\bExchange\b", tree)),
        "broadcasts": len(re.findall(r"BroadcastExchange", tree)),
        "windows": len(re.findall(r"\bWindow \[", tree)),
        "window_group_limits": len(re.findall(r"WindowGroupLimit", tree)),
        "forbidden": [op for op in FORBIDDEN if op in tree],
        # The formatted plan prints each scan's schema in full (the tree cuts long strings).
        "read_schemas": re.findall(r"ReadSchema: (struct<[^\n]*>)", plan_text(df, "formatted")),
    }
