"""Text sources (S1) and the derived line fixtures.

``read_lines`` is ``spark.read.text``: one row per line, split by the
file reader itself, so a file of any size is read in parallel splits.
``text_lines`` does the same for a text column: ``posexplode(split)``
is a generator inside one projection, no shuffle.  Line-end rule of a
text file reader: ``\n``, ``\r\n`` and ``\r`` all end a line, and a final
line break does not start an extra empty line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(line string)`` from text files."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def text_lines(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """S1 over a text column: ``(id_col, line_no int, line)``, 0-based."""
    # literal replacements and a one-character split keep the fast paths
    # (a regex alternation split was measured 6x slower on sf0.1 documents)
    t = F.col(text_col)
    nl = F.when(F.instr(t, "\r") > 0,
                F.replace(F.replace(t, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
                ).otherwise(t)
    # the normalised text is computed once, in a projection below the generator
    norm = df.select(id_col, nl.alias("_t"))
    t = F.col("_t")
    body = F.when(t.endswith("\n"), t.substr(F.lit(1), F.length(t) - 1)).otherwise(t)
    lines = F.split(body, "\n", -1)
    return norm.select(id_col, F.posexplode(lines).alias("line_no", "line")).select(
        id_col, F.col("line_no").cast("int").alias("line_no"), "line"
    )


def log_lines(events: DataFrame) -> DataFrame:
    """Edge-case lines derived from ``events`` (fixed rule, one per event):
    id % 5 = 0 -> '' (blank); % 7 = 0 -> three spaces (not blank, no word);
    % 3 = 0 -> type, two spaces, user, one trailing space (an inner empty
    word, a dropped trailing one); else type, comma and space, user."""
    e = F.col("event_id")
    t = F.col("event_type")
    u = F.col("user_id").cast("string")
    line = (
        F.when(e % 5 == 0, F.lit(""))
        .when(e % 7 == 0, F.lit("   "))
        .when(e % 3 == 0, F.concat(t, F.lit("  "), u, F.lit(" ")))
        .otherwise(F.concat(t, F.lit(", "), u))
    )
    return events.select("event_id", line.alias("line"))


def csv_lines(df: DataFrame, id_col: str, cols: list[str], sep: str = ",") -> DataFrame:
    """Render rows as delimited text ``(id_col, line)`` (a text-file stand-in
    that grows with the table)."""
    return df.select(id_col, F.concat_ws(sep, *[F.col(c).cast("string") for c in cols]).alias("line"))


def csv_edge_lines(df: DataFrame, id_col: str, cols: list[str], sep: str = ",") -> DataFrame:
    """Delimited lines with derived edge cases (fixed rule on the id):
    id % 11 = 0 -> '' (blank); % 13 = 0 -> first field not a number;
    % 17 = 0 -> trailing separator (empty label); else the plain record."""
    plain = F.concat_ws(sep, *[F.col(c).cast("string") for c in cols])
    head_bad = F.concat_ws(sep, F.lit("n/a"), *[F.col(c).cast("string") for c in cols[1:]])
    no_label = F.concat(F.concat_ws(sep, *[F.col(c).cast("string") for c in cols[:-1]]), F.lit(sep))
    i = F.col(id_col)
    line = (F.when(i % 11 == 0, F.lit("")).when(i % 13 == 0, head_bad)
            .when(i % 17 == 0, no_label).otherwise(plain))
    return df.select(id_col, line.alias("line"))
