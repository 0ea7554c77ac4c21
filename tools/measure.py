"""
publishes none).  One warm-up, median of 3, printed as a markdown table.

    python tools/measure.py [--sf /root/testdata/sf0.1] [--cpus 4]
"""

from __future__ import annotations

import argparse
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def median_time(fn, reps: int = 3) -> float:
    fn()  # warm-up
    ts = []
    for _ in range(reps):
        t0 = time.perf_counter()
        fn()
        ts.append(time.perf_counter() - t0)
    return statistics.median(ts)


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("--cpus", type=int, default=4)
    ap.add_argument("--iters", type=int, default=10)
    args = ap.parse_args()

    from clusterfold.operators import joins as J
    from clusterfold.operators import kmeans as km
    from clusterfold.operators import linear as lin
    from clusterfold.plans.common import embedding_points, embedding_seeds
    from clusterfold.plans.training import train_lineitem, train_orders
    from clusterfold.session import build_session
    from clusterfold.sources.tables import table
    from pyspark.sql import functions as F

    spark = build_session(f"local[{args.cpus}]", shuffle_partitions=args.cpus)
    sf = args.sf
    rows = []

    pts = embedding_points(spark, sf)
    seeds = embedding_seeds(pts)
    for mode in ("cross", "auto"):
        for cache in (False, True):
            for co in (None, 8):
                def run(mode=mode, cache=cache, co=co):
                    km.kmeans(pts, init=seeds, max_iter=args.iters, eps=0.0,
                              assign_mode=mode, cache=cache, coalesce=co)
                t = median_time(run)
                name = (f"kmeans_fit {args.iters} iterations, assign={mode}, "
                        f"persist({'+' if cache else '-'}), coalesce({co or '-'})")
                rows.append((name, t, t / args.iters))

    tl = train_lineitem(spark, sf)
    for method, epochs in (("gram", 100), ("scan", 20)):
        t = median_time(lambda m=method, e=epochs: lin.batch_gd(tl, [0.0, 0.0], e, 0.1, m))
        rows.append((f"batch_gd {method}, {epochs} epochs", t, t / epochs))

    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    noop = lambda df: df.write.format("noop").mode("overwrite").save()
    rows.append(("join_shuffle (customer x nation, sort-merge)",
                 median_time(lambda: noop(J.shuffle_join(c, n, "c_nationkey"))), None))
    rows.append(("join_broadcast (strict lookup, size-checked)",
                 median_time(lambda: noop(J.lookup_join(c, n, "c_nationkey"))), None))

    to = train_orders(spark, sf)
    for p in (1, 2, 4, 8):
        t = median_time(lambda p=p: lin.sgd_averaged(to, [0.0, 0.0], 0.01, p, "ord").collect())
        rows.append((f"sgd_averaged, {p} shards", t, None))

    print(f"| measurement (sf {sf.rsplit('sf', 1)[-1]}, local[{args.cpus}]) | median s | s per iteration/epoch |")
    print("|---|---|---|")
    for name, t, per in rows:
        print(f"| {name} | {t:.3f} | {'' if per is None else f'{per:.3f}'} |")
    spark.stop()


if __name__ == "__main__":
    main()
