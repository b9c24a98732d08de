"""Checks on physical plans, through the public ``DataFrame.explain`` output."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame

FORBIDDEN_NODES = ("CartesianProduct", "BroadcastNestedLoopJoin")


def explain_string(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def forbidden_joins(df: DataFrame) -> list[str]:
    """Names of cross-product join nodes present in the plan."""
    plan = explain_string(df, "simple")
    return [n for n in FORBIDDEN_NODES if n in plan]


def shuffle_count(df: DataFrame) -> int:
    """Number of shuffle exchanges in the (initial) physical plan."""
    return explain_string(df, "simple").count("Exchange hashpartitioning") + \
        explain_string(df, "simple").count("Exchange rangepartitioning")
