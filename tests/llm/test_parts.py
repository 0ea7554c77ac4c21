"""Shared parts of the corpus operators, the pipeline, and the isolation of the subpackage."""

import os
import re
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from clusterfold.llm import words as W
from clusterfold.llm.components import components

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"


def test_words_of_a_block(edge_rows):
    texts = [r[1] for r in edge_rows]
    column = pa.array(["skipped", *texts])[1:]
    for limit in (1, 50, 1 << 20):
        found, keys = [], {}
        for lo, hi, data, offsets in W.blocks(column, limit):
            words = W.scan(data, offsets, W.SPACED)
            raw = data.tobytes()
            hashes = W.word_hashes(data, words)
            for k in range(hi - lo):
                own = range(words.first[k], words.first[k + 1])
                found.append([raw[words.starts[i] : words.ends[i]].decode() for i in own])
                for i in own:
                    keys.setdefault(raw[words.starts[i] : words.ends[i]], set()).add(int(hashes[i]))
        assert found == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
        assert all(len(k) == 1 for k in keys.values())  # wherever a word stands
        assert len({k for own in keys.values() for k in own}) == len(keys)


def test_windows_stay_in_their_text():
    data = np.frombuffer(b"a b ca b", np.uint8)
    words = W.scan(data, np.array([0, 5, 8]), W.SPACED)
    starts = W.window_starts(words, 2)
    assert starts.tolist() == [0, 1, 3]
    keys = W.window_hashes(W.word_hashes(data, words), starts, 2)
    assert keys[0] == keys[2] != keys[1]
    assert W.covered(np.array([True, False, True]), starts, 2, 5).tolist() == [True, True, False, True, True]


def brute(links):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {x: find(x) for x in root}


@pytest.mark.parametrize("links", [
    [], [(3, 3)], [(2, 1), (1, 2), (5, 4)],
    [(i, i + 1) for i in range(60)],  # a long chain
    [(100, i) for i in range(80)] + [(200, 300)],  # a hub
    [(int(a), int(b)) for a, b in np.random.default_rng(1).integers(0, 150, (120, 2))],
])
def test_components(spark, links):
    frame = spark.createDataFrame(links, "a long, b long")
    got = {r["node"]: r["component"] for r in components(frame).collect()}
    assert got == {k: v for k, v in brute([x for x in links if x[0] != x[1]]).items()}


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [s[0] for s in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "SimHash near-dedup", "benchmark decontamination", "byte-level BPE"]
    sizes, now = [docs.count()], docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, SF).cache()
        assert now.columns == docs.columns
        sizes.append(now.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[2] == sizes[1] and 0 < sizes[-1] < sizes[0]
    out = corpus_pipeline.run(spark, SF).collect()
    left = {r["doc_id"]: r["text"] for r in now.collect()}
    assert {r["doc_id"] for r in out} == set(left) and len(out) == len(left)
    import hashlib

    for r in out:
        assert r["decoded_sha256"] == hashlib.sha256(left[r["doc_id"]].encode()).hexdigest()
        assert len(r["ids"]) == 4 * r["n_tokens"]


def test_pipeline_on_edge_cases(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        now = docs
        for _, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, SF)
            assert now.columns == docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, now, SF).count() <= docs.count()


def test_nothing_else_imports_the_subpackage():
    for folder, _, names in os.walk(os.path.join(ROOT, "clusterfold")):
        for name in names:
            if name.endswith(".py") and not folder.endswith("llm"):
                assert not re.search(r"(from|import) +\S*\bllm\b", open(os.path.join(folder, name)).read()), name


def test_entry_without_the_subpackage():
    code = "import sys; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; assert not any(k.startswith('op') or k == 'pipeline' for k in e.queries()); assert len(e.queries()) > 40; print(len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
