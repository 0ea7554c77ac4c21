"""Delimited records to labelled points (S2, with P5 and P6).

A record is split on ``sep``; the first ``n_features`` fields are the
features (as double), the last field is the label.  Blank lines are
dropped (and counted by ``delimited_counts``) instead of producing a
label ``""``.

``mode='strict'``: a field that is not a number, or a record with too few
fields, fails the job, as ``toDouble`` does (an explicit ``raise_error``
filter, so it holds whatever the session's ANSI setting).
``mode='permissive'``: such a record is dropped and counted as rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _fields(line: Column, sep: str) -> Column:
    import re

    return F.split(line, re.escape(sep), -1)


def parse_points(
    lines: DataFrame, n_features: int, sep: str = ",", mode: str = "strict",
    line_col: str = "line", keep: list[str] | None = None,
) -> DataFrame:
    """``keep... , x array<double>, label string`` from delimited lines."""
    keep = keep or []
    f = _fields(F.col(line_col), sep)
    raw = F.slice(f, 1, n_features)
    if mode not in ("strict", "permissive"):
        raise ValueError(f"unknown mode {mode!r}")
    x = F.transform(raw, lambda v: v.try_cast("double"))
    label = F.element_at(f, -1)
    out = lines.where(F.col(line_col) != "").select(
        *keep, x.alias("x"), label.alias("label"), F.col(line_col).alias("_line"))
    ok = (F.size("x") == n_features) & F.forall("x", lambda v: v.isNotNull())
    if mode == "strict":
        bad = F.concat(F.lit(f"not a record of {n_features} numeric features: "), F.col("_line"))
        out = out.where(F.when(ok, F.lit(True)).otherwise(F.raise_error(bad)))
    else:
        out = out.where(ok)
    return out.drop("_line")


def delimited_counts(lines: DataFrame, n_features: int, sep: str = ",",
                     line_col: str = "line") -> DataFrame:
    """One row: lines, blank lines, records rejected by the permissive rule."""
    f = _fields(F.col(line_col), sep)
    raw = F.slice(f, 1, n_features)
    bad = (F.size(raw) < n_features) | F.exists(raw, lambda v: v.try_cast("double").isNull())
    blank = F.col(line_col) == ""
    return lines.agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(blank).alias("n_blank"),
        F.count_if(~blank & bad).alias("n_rejected"),
    )


def read_points(spark, path: str, n_features: int, sep: str = ",", mode: str = "strict",
                ) -> DataFrame:
    """S1 + S2 + P4 from text files: ``(id, x, label)`` labelled points with
    a 0-based id in file order (the reference's textFile, split, zipWithIndex)."""
    lines = spark.read.text(path).withColumnRenamed("value", "line")
    # file order: input file and position within it, then a gap-free index
    ordered = lines.select(F.input_file_name().alias("_f"),
                           F.monotonically_increasing_id().alias("_p"), "line")
    pts = parse_points(ordered, n_features, sep, mode, keep=["_f", "_p"])
    from clusterfold.operators.indexing import row_index

    return row_index(pts, ["_f", "_p"], "id").select("id", "x", "label")
