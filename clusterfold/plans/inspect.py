"""Plan inspection helpers used by tests and by the plan review in the
README: the physical plan as text, and the operators it contains."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame


def physical_plan(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def count_operator(df: DataFrame, name: str) -> int:
    """How many nodes of the formatted plan's tree are named ``name``."""
    tree = physical_plan(df).split("\n\n")[0]
    return sum(1 for line in tree.splitlines() if name in line)
