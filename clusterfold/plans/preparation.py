"""Registered data-preparation jobs (sources, tokenising, indexing,
joins) and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from clusterfold.operators import joins as J
from clusterfold.operators import text as TX
from clusterfold.operators.indexing import row_index
from clusterfold.operators.profile import partition_profile, row_counts, run_noop
from clusterfold.sources import delimited as D
from clusterfold.sources import generators as G
from clusterfold.sources import text as S
from clusterfold.sources.tables import TABLES, table

# The reference's three-entry lookup map (keys 1..3).
SMALL_MAP = [(1, "a"), (2, "b"), (3, "c")]
CSV_COLS = ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"]
CSV_FEATURES = 3
HOT_KEY = 0  # the order that the skewed join's hot lines are given to


def q_text_lines(spark, sf_dir):
    return S.text_lines(table(spark, sf_dir, "documents"), "doc_id", "text")


def q_tokenize(spark, sf_dir):
    lines = S.log_lines(table(spark, sf_dir, "events"))
    return TX.tokenize(lines, keep=["event_id"])


def q_blank_line_count(spark, sf_dir):
    return TX.line_counters(S.log_lines(table(spark, sf_dir, "events")))


def q_token_counters(spark, sf_dir):
    """A8 inside the pipeline: the counters that one action over the words fills."""
    words, counters = TX.tokenize_observed(S.log_lines(table(spark, sf_dir, "events")))
    run_noop(words)
    got = counters.get
    return spark.createDataFrame([(got["n_lines"], got["n_blank"], got["n_words"])],
                                 "n_lines bigint, n_blank bigint, n_words bigint")


def q_delimited_points(spark, sf_dir):
    lines = S.csv_lines(table(spark, sf_dir, "customer"), "c_custkey", CSV_COLS)
    pts = D.parse_points(lines, CSV_FEATURES, ",", "strict", keep=["c_custkey"])
    return pts.select("c_custkey", F.posexplode("x").alias("pos", "v"), "label").select(
        "c_custkey", F.col("pos").cast("int").alias("pos"), "v", "label")


def _edge_lines(spark, sf_dir):
    return S.csv_edge_lines(table(spark, sf_dir, "customer"), "c_custkey", CSV_COLS)


def q_delimited_permissive(spark, sf_dir):
    pts = D.parse_points(_edge_lines(spark, sf_dir), CSV_FEATURES, ",", "permissive",
                         keep=["c_custkey"])
    return pts.select("c_custkey", F.posexplode("x").alias("pos", "v"), "label").select(
        "c_custkey", F.col("pos").cast("int").alias("pos"), "v", "label")


def q_delimited_counts(spark, sf_dir):
    return D.delimited_counts(_edge_lines(spark, sf_dir), CSV_FEATURES)


def q_gen_pairs(spark, sf_dir):
    return G.key_pairs(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


def q_lookup_pairs(spark, sf_dir):
    pairs = G.key_pairs(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")
    small = spark.createDataFrame(SMALL_MAP, "k int, v string")
    return J.lookup_join(pairs, small, "k").select("k", "v", "n")


def q_gen_line(spark, sf_dir):
    pts = G.line_points(table(spark, sf_dir, "orders"), "o_orderkey", normalise=True)
    return pts.select("o_orderkey", F.col("x")[0].alias("z"), "y")


def q_minmax_scale(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return G.minmax_scale(li, "l_quantity", "z")


def q_row_counts(spark, sf_dir):
    return row_counts({t: table(spark, sf_dir, t) for t in TABLES})


def q_row_index(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return row_index(o, ["o_orderdate", "o_orderkey"], "idx").select("o_orderkey", "idx")


def _cust_nation(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return c, n


def q_join_shuffle(spark, sf_dir):
    c, n = _cust_nation(spark, sf_dir)
    return J.shuffle_join(c, n, "c_nationkey", "merge").select("c_custkey", "c_nationkey", "n_name")


def q_join_broadcast(spark, sf_dir):
    c, n = _cust_nation(spark, sf_dir)
    return J.lookup_join(c, n, "c_nationkey").select("c_custkey", "c_nationkey", "n_name")


def q_join_skewed(spark, sf_dir):
    """J1 where one key holds a third of the left rows."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_partkey") % 3 == 0, HOT_KEY).otherwise(F.col("l_orderkey")).cast("bigint").alias("k"))
    prices = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("bigint").alias("k"), "o_totalprice")
    return J.skew_join(lines, prices, "k").select("l_orderkey", "l_linenumber", "k", "o_totalprice")


def q_partition_profile(spark, sf_dir):
    """Rows of all partitions together, and of those that the profile lists empty."""
    profile = partition_profile(table(spark, sf_dir, "lineitem").select("l_orderkey"))
    return profile.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count_if(F.col("n") < 1).alias("n_empty"))


QUERIES = {
    "text_lines": q_text_lines,
    "tokenize": q_tokenize,
    "blank_line_count": q_blank_line_count,
    "token_counters": q_token_counters,
    "delimited_points": q_delimited_points,
    "delimited_permissive": q_delimited_permissive,
    "delimited_counts": q_delimited_counts,
    "gen_pairs": q_gen_pairs,
    "lookup_pairs": q_lookup_pairs,
    "gen_line": q_gen_line,
    "minmax_scale": q_minmax_scale,
    "row_counts": q_row_counts,
    "row_index": q_row_index,
    "join_shuffle": q_join_shuffle,
    "join_broadcast": q_join_broadcast,
    "join_skewed": q_join_skewed,
    "partition_profile": q_partition_profile,
}


# ---- DuckDB oracles -----------------------------------------------------------

_LOG = (
    "ll AS (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN '' "
    "WHEN event_id % 7 = 0 THEN '   ' "
    "WHEN event_id % 3 = 0 THEN event_type || '  ' || user_id::VARCHAR || ' ' "
    "ELSE event_type || ', ' || user_id::VARCHAR END AS line FROM events)"
)

_EDGE = (
    "el AS (SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN '' "
    "WHEN c_custkey % 13 = 0 THEN 'n/a,' || c_nationkey::VARCHAR || ',' || c_acctbal::VARCHAR "
    "|| ',' || c_mktsegment "
    "WHEN c_custkey % 17 = 0 THEN c_custkey::VARCHAR || ',' || c_nationkey::VARCHAR || ',' "
    "|| c_acctbal::VARCHAR || ',' "
    "ELSE c_custkey::VARCHAR || ',' || c_nationkey::VARCHAR || ',' || c_acctbal::VARCHAR "
    "|| ',' || c_mktsegment END AS line FROM customer)"
)

_PAIRS = (
    "SELECT (1 + (l_orderkey + l_linenumber) % 3)::INTEGER AS k, "
    "((l_orderkey * 31 + l_linenumber * 17) % 100)::INTEGER AS n FROM lineitem"
)

_JOIN = (
    "SELECT c_custkey, c_nationkey, n_name FROM customer "
    "JOIN nation ON c_nationkey = n_nationkey"
)

_COUNTERS = (
    f"WITH {_LOG} SELECT count(*) AS n_lines, count(*) FILTER (WHERE line = '') AS n_blank, "
    "coalesce(sum(CASE WHEN rtrim(line, ' ') = '' THEN 0 "
    "ELSE len(string_split(rtrim(line, ' '), ' ')) END), 0)::BIGINT AS n_words FROM ll"
)

ORACLES = {
    "join_skewed": (
        f"SELECT l_orderkey, l_linenumber, k, o_totalprice FROM (SELECT l_orderkey, l_linenumber, "
        f"(CASE WHEN l_partkey % 3 = 0 THEN {HOT_KEY} ELSE l_orderkey END)::BIGINT AS k FROM lineitem) JOIN orders ON k = o_orderkey"
    ),
    "partition_profile": "SELECT count(*) AS n_rows, 0::BIGINT AS n_empty FROM lineitem",
    "token_counters": _COUNTERS,
    "text_lines": (
        "SELECT doc_id, (generate_subscripts(string_split(text, chr(10)), 1) - 1)::INTEGER AS line_no, "
        "unnest(string_split(text, chr(10))) AS line FROM documents"
    ),
    "tokenize": (
        f"WITH {_LOG}, t AS (SELECT event_id, rtrim(line, ' ') AS t FROM ll "
        "WHERE rtrim(line, ' ') <> '') "
        "SELECT event_id, (generate_subscripts(string_split(t, ' '), 1) - 1)::INTEGER AS pos, "
        "unnest(string_split(t, ' ')) AS word FROM t"
    ),
    "blank_line_count": _COUNTERS,
    "delimited_points": (
        "SELECT c_custkey, (pos - 1)::INTEGER AS pos, v, label FROM (SELECT c_custkey, "
        "c_mktsegment AS label, unnest([c_custkey::DOUBLE, c_nationkey::DOUBLE, c_acctbal]) AS v, "
        "unnest(range(1, 4)) AS pos FROM customer)"
    ),
    "delimited_permissive": (
        f"WITH {_EDGE}, f AS (SELECT c_custkey, string_split(line, ',') AS parts FROM el "
        "WHERE line <> ''), "
        "p AS (SELECT c_custkey, parts[-1] AS label, [TRY_CAST(parts[1] AS DOUBLE), "
        "TRY_CAST(parts[2] AS DOUBLE), TRY_CAST(parts[3] AS DOUBLE)] AS x FROM f "
        "WHERE len(parts) >= 3) "
        "SELECT c_custkey, (pos - 1)::INTEGER AS pos, x[pos] AS v, label FROM "
        "(SELECT *, unnest(range(1, 4)) AS pos FROM p "
        "WHERE x[1] IS NOT NULL AND x[2] IS NOT NULL AND x[3] IS NOT NULL)"
    ),
    "delimited_counts": (
        f"WITH {_EDGE}, f AS (SELECT line, string_split(line, ',') AS parts FROM el) "
        "SELECT count(*) AS n_lines, count(*) FILTER (WHERE line = '') AS n_blank, "
        "count(*) FILTER (WHERE line <> '' AND (len(parts) < 3 "
        "OR TRY_CAST(parts[1] AS DOUBLE) IS NULL OR TRY_CAST(parts[2] AS DOUBLE) IS NULL "
        "OR TRY_CAST(parts[3] AS DOUBLE) IS NULL)) AS n_rejected FROM f"
    ),
    "gen_pairs": _PAIRS,
    "lookup_pairs": (
        f"WITH p AS ({_PAIRS}), m(k, v) AS (VALUES "
        + ", ".join(f"({k}, '{v}')" for k, v in SMALL_MAP)
        + ") SELECT p.k, m.v, p.n FROM p JOIN m ON p.k = m.k"
    ),
    "gen_line": (
        "WITH z AS (SELECT o_orderkey, ((2 * o_orderkey + 1)::DOUBLE - 1.0) / "
        "(2.0 * (SELECT count(*) FROM orders) - 1.0) AS z FROM orders) "
        "SELECT o_orderkey, z, z * 1.0 + 2.0 AS y FROM z"
    ),
    "minmax_scale": (
        "WITH b AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem) "
        "SELECT l_orderkey, l_linenumber, l_quantity, (l_quantity - lo) / (hi - lo) AS z "
        "FROM lineitem, b"
    ),
    "row_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS name, count(*) AS n FROM {t}" for t in TABLES
    ),
    "row_index": (
        "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS idx "
        "FROM orders"
    ),
    "join_shuffle": _JOIN,
    "join_broadcast": _JOIN,
}
