"""Line dedup by a log-template tree, in DataFrame operations only.

Lines parse into a tree of fixed depth: token count, then the first
``DEPTH`` tokens.  Tokens with a digit are variable fields (``<*>``).  A leaf
whose lines come from ``MIN_DOCS`` or more documents and differ holds
templates: the tokens that most of its distinct lines have at each
position are one, to which those lines belong that agree with it at
``CONSTANT_SHARE`` or more of their positions (all other positions are
variable fields); the lines that do not agree vote for the next one among
themselves.  So a line is judged against its own template, and unrelated or
rarely edited lines of a leaf do not undo the others.  After ``ROUNDS`` votes
the lines that belong to no template yet part by their token at the position
where the leaf's voters had the fewest tokens, but more than one (the first
of several): a position that tells families apart, not a variable field.
Each part votes as a leaf and parts again, until every line has a template or
is alone, so a leaf holds any number of templates, in at most as many steps
as a line has tokens beyond the ``ROUNDS``.  A line that is left alone,
masked, is a template of its own.  A template found in ``MIN_DOCS``
or more documents is recurring: the document with the smallest id keeps its
lines, all others drop them.

Lines are parsed once and kept as two 64-bit hashes; the distinct lines of
the leaves in question, one place of each, are then cut out of their texts.
Every count is pre-aggregated, and a line that a third of all documents share
meets only its template's one row, in a join whose skewed partitions Spark
splits.

Defined results: a null text stays null and has no lines; an empty text has
one blank line; blank lines have no template and stay; a null id counts as
the largest; rows that repeat an id are one document; of tokens that equally
many lines have at a position the smallest (by bytes) stands in the template.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clusterfold.llm.frames import saved

DEPTH = 3
MIN_DOCS = 3
CONSTANT_SHARE = 0.7
ROUNDS = 3
LARGEST_ID = (1 << 63) - 1
BROADCAST_ROWS = 1_000_000  # rows of a few numbers each; more are joined by shuffle
_SPACES = "[ \\t\\x0B\\f\\r]+"
_UNEVEN = "[\\t\\x0B\\f\\r]|  "
_FIELD = "(?<!\\S)[^\\s0-9]*+[0-9]\\S*"  # a token with a digit, tried at token starts only


def _masked(text: Column) -> Column:
    """The text with variable fields and single spaces; line ends stay.  Most
    texts without digits and uneven spaces skip the replacements."""
    fields = F.when(F.rlike(text, F.lit("[0-9]")), F.regexp_replace(text, _FIELD, "<*>")).otherwise(text)
    return F.when(F.rlike(fields, F.lit(_UNEVEN)), F.regexp_replace(fields, _SPACES, " ")).otherwise(fields)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, mark, text`` (masked)."""
    own = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LARGEST_ID)).alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return own.select("id", F.xxhash64("text").alias("mark"), _masked(F.col("text")).alias("text"))


def _lines(masked: DataFrame) -> DataFrame:
    """``id, mark, pos, template, check, leaf`` of all lines with a token."""
    lines = masked.select("id", "mark", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    lines = lines.select("id", "mark", "pos", F.trim("line").alias("line")).where("line <> ''")
    n = F.octet_length("line") - F.octet_length(F.replace("line", F.lit(" "))) + 1
    return lines.select("id", "mark", "pos", F.xxhash64("line").alias("template"), F.xxhash64(F.lit(1), "line").alias("check"),
                        F.xxhash64(n, F.substring_index("line", " ", DEPTH)).alias("leaf"))


def _side(df: DataFrame) -> DataFrame:
    """A saved table to join with: broadcast if it has few rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df.hint("merge")


def _open_lines(lines: DataFrame, masked: DataFrame, min_docs: int) -> DataFrame:
    """``leaf, template, check, n, tokens`` of the distinct lines of leaves that
    ``min_docs`` documents share and that hold more than one line, with their
    number of places; saved."""
    per_doc = lines.groupBy("leaf", "id").agg(F.min("template").alias("a"), F.max("template").alias("b"))
    open_ = per_doc.groupBy("leaf").agg(F.count(F.lit(1)).alias("docs"), F.min("a").alias("a"), F.max("b").alias("b")) \
        .where((F.col("docs") >= min_docs) & (F.col("a") != F.col("b"))).select("leaf")
    places = lines.join(_side(saved(open_)), "leaf", "left_semi").groupBy("leaf", "template", "check").agg(F.min(F.struct("mark", "pos")).alias("at"), F.count(F.lit(1)).alias("n"))
    wanted = saved(places.groupBy("at.mark").agg(F.collect_list(F.struct("at.pos", "leaf", "template", "check", "n")).alias("wanted")))
    # a text is cut once for all of its wanted lines
    cut = masked.join(_side(wanted), "mark").select(F.split("text", "\n").alias("all"), "wanted")
    found = cut.select("all", F.explode("wanted").alias("w")).select("w.leaf", "w.template", "w.check", "w.n", F.split(F.trim(F.get("all", F.col("w.pos"))), " ").alias("tokens"))
    return saved(found.dropDuplicates(["leaf", "template", "check"]))  # copies of a text hold the same line


def _general_lines(distinct: DataFrame, min_docs: int, constant_share: float, rounds: int) -> DataFrame:
    """``template, check, general``: the template that a distinct line belongs to."""
    out = None
    for k in itertools.count():
        votes = distinct.select("leaf", "n", F.posexplode("tokens").alias("at", "token")).groupBy("leaf", "at", "token").agg(F.count(F.lit(1)).alias("lines"), F.sum("n").alias("n"))
        most = votes.groupBy("leaf", "at").agg(F.min(F.struct(-F.col("lines"), "token")).alias("best"), F.count(F.lit(1)).alias("kinds"), F.sum("lines").alias("lines"), F.sum("n").alias("n"))
        fewest = F.min(F.when(F.col("kinds") > 1, F.struct("kinds", "at")))["at"].alias("parting")
        # a leaf that cannot recur, or of one line, is as good as its exact lines
        shape = most.where((F.col("lines") > 1) & (F.col("n") >= min_docs)).groupBy("leaf").agg(F.array_sort(F.collect_list(F.struct("at", "best.token"))).alias("shape"), fewest)
        same = F.aggregate(F.zip_with("tokens", "shape.token", lambda a, b: (a == b).cast("int")), F.lit(0), lambda t, x: t + x)
        judged = saved(distinct.join(shape, "leaf").select("leaf", "template", "check", "tokens", "n", "parting", (same >= constant_share * F.size("tokens")).alias("agrees")))
        found = judged.where("agrees").select("template", "check", F.xxhash64("leaf", F.lit("leaf"), F.lit(k)).alias("general"))
        out = found if out is None else out.unionByName(found)
        distinct = judged.where("not agrees").drop("agrees", "parting")
        if k >= rounds - 1:
            part = F.xxhash64("leaf", F.lit("part"), "parting", F.get("tokens", F.col("parting")))
            distinct = judged.where("not agrees").select(part.alias("leaf"), "template", "check", "tokens", "n")
        if distinct.isEmpty():
            return out


def _recurring(lines: DataFrame, min_docs: int) -> DataFrame:
    """``template, check, keeper``: recurring templates, and the id that keeps them."""
    return lines.groupBy("template", "check", "id").agg(F.lit(1).alias("one")).groupBy("template", "check") \
        .agg(F.count(F.lit(1)).alias("docs"), F.min("id").alias("keeper")).where(F.col("docs") >= min_docs).select("template", "check", "keeper")


def drop_recurring(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS,
                   constant_share: float = CONSTANT_SHARE, rounds: int = ROUNDS) -> DataFrame:
    """``row`` (struct of the document's own columns), ``text`` (the lines
    that stay), ``n_lines`` and ``n_dropped``."""
    masked = _texts(docs, id_col, text_col)
    lines = saved(_lines(masked))
    general = saved(_general_lines(_open_lines(lines, masked, min_docs), min_docs, constant_share, rounds))
    # a general template has one hash of its leaf and round, and its check says so
    named = lines.join(_side(general), ["template", "check"], "left").select(
        "id", "mark", "pos", F.coalesce("general", "template").alias("template"), F.when(F.col("general").isNull(), F.col("check")).otherwise(F.lit(0)).alias("check"))
    named = saved(named)
    found = saved(_recurring(named, min_docs))
    gone = named.join(found, ["template", "check"]).where(F.col("id") > F.col("keeper")) \
        .groupBy("id", "mark").agg(F.collect_set("pos").alias("gone"))
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                      F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LARGEST_ID)).alias("id"),
                      F.xxhash64(F.col(f"`{text_col}`").cast("string")).alias("mark"))
    joined = own.join(gone, ["id", "mark"], "left")
    text = F.col(f"row.`{text_col}`").cast("string")
    cut = joined.select("row", F.when(F.col("gone").isNotNull(), F.split(text, "\n")).alias("lines"), "gone",
                        (F.length(text) - F.length(F.replace(text, F.lit("\n"))) + 1).alias("n_lines"))
    # kept places by a hash set, each line then by its place: linear in the lines
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n")
    return cut.select("row", F.when(F.col("gone").isNull(), F.col(f"row.`{text_col}`").cast("string")).otherwise(kept).alias("text"),
                      F.coalesce(F.col("n_lines"), F.lit(0)).cast("long").alias("n_lines"),
                      F.when(F.col("gone").isNull(), F.lit(0)).otherwise(F.size("gone")).cast("long").alias("n_dropped"))


def cleaned(docs: DataFrame, *, text_col: str = "text", **options) -> DataFrame:
    """The documents with the lines that stay, other columns unchanged."""
    found = drop_recurring(docs, text_col=text_col, **options)
    return found.select(*[F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
