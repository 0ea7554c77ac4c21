"""Job registry: every registered job takes ``(spark, sf_dir)`` and returns
a DataFrame; ``ORACLES`` holds the DuckDB SQL that recomputes the same
rows independently (absent for jobs whose output is not reproducible in
SQL, such as timings or random samples)."""

from __future__ import annotations

from clusterfold.plans import clustering, preparation, regression

QUERIES = {}
ORACLES = {}
for _mod in (preparation, clustering, regression):
    QUERIES.update(_mod.QUERIES)
    ORACLES.update(_mod.ORACLES)
