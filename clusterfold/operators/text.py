"""Tokenising with quality counters.

Word rule (as the reference's ``f``): a line equal to ``''`` is blank (no
words, counted); otherwise trailing spaces are dropped and the rest is
split on single spaces, keeping empty inner words (two spaces in a row)
and leading ones.  A line of spaces only is not blank but has no word.

Counters use ``DataFrame.observe``: the metrics are computed by the first
action over the frame and are not added twice when a second action runs,
which is the failure mode of accumulators updated inside transformations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def _trimmed(line: Column) -> Column:
    return F.rtrim(line)  # spaces only, in one pass from the end


def words(line: Column | str) -> Column:
    """array<string> of the words of a line (empty array for no word)."""
    line = F.col(line) if isinstance(line, str) else line
    t = _trimmed(line)
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, " ", -1))


def tokenize(lines: DataFrame, line_col: str = "line", keep: list[str] | None = None) -> DataFrame:
    """``keep..., pos int, word`` for every word of every line."""
    keep = keep or []
    return lines.select(*keep, F.posexplode(words(line_col)).alias("pos", "word")).select(
        *keep, F.col("pos").cast("int").alias("pos"), "word"
    )


def line_counters(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """One row: lines, blank lines, words (one aggregate, partial per task)."""
    return lines.agg(*_counters(line_col))


def _counters(line_col: str) -> list[Column]:
    line = F.col(line_col)
    return [
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(line == "").alias("n_blank"),
        F.coalesce(F.sum(F.size(words(line))), F.lit(0)).cast("bigint").alias("n_words"),
    ]


def tokenize_observed(
    lines: DataFrame, line_col: str = "line", keep: list[str] | None = None,
    name: str = "line_counters",
) -> tuple[DataFrame, Observation]:
    """Words plus an Observation holding ``n_lines``, ``n_blank`` and
    ``n_words``; the values appear once an action has run on the words."""
    obs = Observation(name)
    observed = lines.observe(obs, *_counters(line_col))
    return tokenize(observed, line_col, keep), obs
