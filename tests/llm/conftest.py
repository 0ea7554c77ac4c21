import random

import pytest

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(rng: random.Random, n: int) -> str:
    parts = ["the", "of", "and", "Stone", "river,", "élan", "Öl", "x1", "cold", "WATER", "a", "b", "naïve", "日本", "…", "tin"]
    out = []
    for _ in range(n):
        out.append(rng.choice(parts) + (rng.choice(["", "s", "ed", "ly"]) if rng.random() < 0.4 else ""))
        out.append(rng.choice([" ", " ", " ", "  ", "\n", "\t"]))
    return "".join(out)


def edge_texts() -> list[str | None]:
    rng = random.Random(7)
    base = prose(rng, 60)
    words = base.split()
    near = " ".join(words[:30] + ["changed"] + words[31:])
    texts: list[str | None] = [
        None, "", " ", "\n\n", "one", "Two words", "the the the the the the the the the the the the the the the the the the",
        base, base, near, base.upper(), "prefix words here " + base, " nbsp wide", "\x00nul\x0bvt\x0cff\r\nend",
        "Licensed under the Apache License, Version 2.0.\nmit license MIT-License", "GNU General Public License, version 3",
        "KKelvin İstanbul mit license", prose(rng, 4000), "ab" * 400, "line 1\nline 2\nline 3", "line 9\nline 4",
        "line 7", "line 8\nother", "😀 emoji 😀 words", "#*$ % & | < > !!", "a\n\na\nb\na",
    ]
    return texts + [prose(rng, rng.randint(1, 120)) for _ in range(40)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, fp long, row string, id long, n_words string, ids string, mark int"


@pytest.fixture(scope="session")
def edge_rows():
    texts = edge_texts()
    rows = [(i, t, None if i % 5 == 0 else "en", None if i % 7 == 0 else "src0", None, 0.5, 1, "r", 2, "w", "i", 3) for i, t in enumerate(texts)]
    return rows + [rows[7], rows[0]]  # repeated rows


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    """Nulls, empty and long texts, copies, repeated rows, and extra columns
    named like the operators' own."""
    return spark.createDataFrame(edge_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
