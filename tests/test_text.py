
from clusterfold.operators import text as TX
from clusterfold.sources import delimited as D
from clusterfold.sources import text as S
from clusterfold.sources.tables import table

from conftest import SF_SMALL

# name_lines fixture (inline in the reference)
NAME_LINES = ["Michael, 29", "", "", "Andy, 30", "", "Justin, 19"]


def test_name_lines_words_and_blanks(spark):
    lines = spark.createDataFrame([(i, l) for i, l in enumerate(NAME_LINES)], "id int, line string")
    words = TX.tokenize(lines, keep=["id"]).orderBy("id", "pos")
    assert [r["word"] for r in words.collect()] == ["Michael,", "29", "Andy,", "30", "Justin,", "19"]
    c = TX.line_counters(lines).first()
    assert (c["n_lines"], c["n_blank"], c["n_words"]) == (6, 3, 6)


def test_observed_counters_not_doubled(spark):
    lines = spark.createDataFrame([(l,) for l in NAME_LINES], "line string")
    words, obs = TX.tokenize_observed(lines)
    assert words.count() == 6
    assert words.count() == 6  # a second action must not add again
    m = obs.get
    assert (m["n_lines"], m["n_blank"], m["n_words"]) == (6, 3, 6)


def test_space_rules(spark):
    lines = spark.createDataFrame([("   ",), ("a  b ",), (" a",)], "line string")
    got = [r["word"] for r in TX.tokenize(lines).collect()]
    # all-space line: not blank, no word; inner empty kept; trailing dropped; leading kept
    assert got == ["a", "", "b", "", "a"]
    c = TX.line_counters(lines).first()
    assert c["n_blank"] == 0 and c["n_words"] == 5


def test_log_lines_rule(spark):
    ev = table(spark, SF_SMALL, "events")
    ll = S.log_lines(ev)
    r = {x["event_id"]: x["line"] for x in ll.where("event_id in (0, 7, 3, 1)").collect()}
    assert r[0] == "" and r[7] == "   "
    assert r[3].endswith(" ") and "  " in r[3]
    assert ", " in r[1]


def test_text_lines_trailing_newline(spark):
    df = spark.createDataFrame([(1, "a\nb\n"), (2, "a\n\nb")], "id int, text string")
    rows = [(r["id"], r["line_no"], r["line"]) for r in S.text_lines(df, "id", "text").orderBy("id", "line_no").collect()]
    assert rows == [(1, 0, "a"), (1, 1, "b"), (2, 0, "a"), (2, 1, ""), (2, 2, "b")]


def test_read_lines_file(spark, tmp_path):
    p = tmp_path / "iris.txt"
    p.write_text("5.1,3.5,1.4,0.2,Iris-setosa\n4.9,3.0,1.4,0.2,Iris-setosa\n\n")
    lines = S.read_lines(spark, str(p))
    pts = D.parse_points(lines, 4).collect()
    assert len(pts) == 2 and pts[0]["label"] == "Iris-setosa" and pts[1]["x"] == [4.9, 3.0, 1.4, 0.2]


def test_delimited_modes(spark):
    # csv_lines fixture: blank line, non-numeric feature, trailing comma
    lines = spark.createDataFrame([("0,0,ALGERIA",), ("",), ("x,1,BAD",), ("3,1,",)], "line string")
    c = D.delimited_counts(lines, 2).first()
    assert (c["n_lines"], c["n_blank"], c["n_rejected"]) == (4, 1, 1)
    perm = D.parse_points(lines, 2, mode="permissive").collect()
    assert [(r["x"], r["label"]) for r in perm] == [([0.0, 0.0], "ALGERIA"), ([3.0, 1.0], "")]
    import pytest
    with pytest.raises(Exception):
        D.parse_points(lines, 2, mode="strict").collect()


def test_strict_mode_independent_of_ansi(spark):
    import pytest

    lines = spark.createDataFrame([("1,2,A",), ("x,2,B",)], "line string")
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="numeric features"):
            D.parse_points(lines, 2, mode="strict").collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_text_lines_crlf(spark):
    df = spark.createDataFrame([(1, "a\r\nb\r\n"), (2, "a\rb")], "id int, text string")
    rows = [(r["id"], r["line"]) for r in S.text_lines(df, "id", "text").orderBy("id", "line_no").collect()]
    assert rows == [(1, "a"), (1, "b"), (2, "a"), (2, "b")]


def test_read_points_file_order(spark, tmp_path):
    p = tmp_path / "pts.txt"
    p.write_text("5.1,3.5,1.4,0.2,A\n\n4.9,3.0,1.4,0.2,B\n4.7,3.2,1.3,0.2,A\n")
    pts = D.read_points(spark, str(p), 4).orderBy("id").collect()
    assert [(r["id"], r["label"]) for r in pts] == [(0, "A"), (1, "B"), (2, "A")]


def test_read_lines_crlf_file_counters(spark, tmp_path):
    p = tmp_path / "crlf.txt"
    p.write_bytes(b"Michael, 29\r\n\r\nAndy, 30\r\n")
    lines = S.read_lines(spark, str(p))
    assert [r["line"] for r in lines.collect()] == ["Michael, 29", "", "Andy, 30"]
    c = TX.line_counters(lines).first()
    assert (c["n_lines"], c["n_blank"], c["n_words"]) == (3, 1, 4)
