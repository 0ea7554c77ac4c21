"""Quality rules with adaptive thresholds.

Per document a numpy scan measures words, word characters, symbols,
duplicate lines and words inside repeated 8-word windows.  The derived
metrics are summarised per (language, source) by quantile sketches: counts of
documents in fixed buckets of thousandths, which keep ``BITS`` leading bits of
larger values, so a sketch has a bounded number of them.  Sketches merge by
adding counts of whole documents, so they are the same in any order and
partitioning; a group with fewer than ``MIN_GROUP`` documents takes its
language's merged sketch, and a small language the merged sketch of all
documents.  A document fails a rule when its metric lies beyond the fence
``q1 - FENCE * spread`` or ``q3 + FENCE * spread`` of its group, where the
spread is the distance of the quartiles and at least the metric's ``floor``.
Of a normal distribution less than 1e-12 lies beyond.  Documents and thresholds
are joined on (language, source).

Defined results: a null text has no words; documents that fail the base rule
(fewer than 20 words, or over 30 % repeated words) never enter the sketches
and are not kept; null languages and sources form groups of their own;
repeated rows are judged each on its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clusterfold.llm import words as W
from clusterfold.llm.frames import bounded_batches, saved

MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8
MIN_GROUP = 100
FENCE = 5.0
UNIT, BITS = 1000, 12  # buckets of 1 / UNIT, and leading bits of larger values

#: metric: (count, of which count, lowest spread of the fence, fence below?, fence above?)
METRICS: dict[str, tuple[str, str, float, bool, bool]] = {
    "word_length": ("word_chars", "n_words", 0.5, True, True),
    "symbol_ratio": ("n_symbols", "n_words", 0.05, False, True),
    "dup_line_ratio": ("n_dup_lines", "n_lines", 0.1, False, True),
    "repeat_ratio": ("n_repeat_words", "n_words", 0.05, False, True),
}

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def _repeat_words(words: W.Words, hashes: np.ndarray) -> np.ndarray:
    """Per text: words inside a window that stands twice or more in the text."""
    starts = W.window_starts(words, WINDOW)
    if not len(starts):
        return np.zeros(len(words.first) - 1, dtype=np.int64)
    text = words.text_of()
    keys = W.mix(W.window_hashes(hashes, starts, WINDOW) + W.mix(text[starts].astype(W.U64)))
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    again = np.zeros(len(keys), dtype=bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    return W.per_text(words, W.covered(again, starts, WINDOW, len(words.starts)))


def _dup_lines(data: np.ndarray, offsets: np.ndarray, words: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """Per text: lines with a word, and those equal to an earlier line."""
    raw = data.tobytes()
    n, dup = [], []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        lines = [x for x in raw[a:b].split(b"\n") if x.split(None, 1)]
        n.append(len(lines))
        dup.append(len(lines) - len(set(lines)))
    return np.array(n, np.int64), np.array(dup, np.int64)


def measure(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The counts of ``_COUNTS`` for each text of a block."""
    words = W.scan(data, offsets, W.SPACED)
    inside = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data & 0xC0 != 0x80) & W.SPACED[data], out=inside[1:])
    symbols = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(_SYMBOL[data], out=symbols[1:])
    n_lines, dup = _dup_lines(data, offsets, words)
    return [words.counts, inside[offsets[1:]] - inside[offsets[:-1]], symbols[offsets[1:]] - symbols[offsets[:-1]],
            n_lines, dup, _repeat_words(words, W.word_hashes(data, words))]


def _measure_batches(batches):
    for batch in batches:
        parts = [measure(data, offsets) for _, _, data, offsets in W.blocks(batch.column(1))]
        columns = [np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in range(len(_COUNTS))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), *[pa.array(c.astype(np.int64)) for c in columns]],
                                         names=["doc_id", "lang", "source", *_COUNTS])


def metrics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Counts, ``base_failed`` and the derived metrics of every document."""
    bounded_batches(docs.sparkSession)
    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"),
                      F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{source_col}`").cast("string").alias("source"))
    counted = own.mapInArrow(_measure_batches, "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in _COUNTS))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    ratios = {m: F.when(F.col("n_words") > 0, F.expr(f"{a} / {b}").cast("double")) for m, (a, b, *_) in METRICS.items()}
    return counted.withColumn("base_failed", failed).withColumns(ratios)


def bucket(count: str, of: str) -> Column:
    """Thousandths of ``count / of``, rounded down, in whole numbers; of larger
    ones only the ``BITS`` leading bits."""
    return F.expr(f"""transform(array({UNIT} * {count} div {of}), k -> transform(array(greatest(0, length(bin(k)) - {BITS})),
                      s -> shiftleft(shiftright(k, s), s))[0])[0]""")


def sketches(measured: DataFrame) -> DataFrame:
    """``lang, source, metric, bucket, n``: documents that pass the base rule."""
    good = measured.where(~F.col("base_failed"))
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), bucket(a, b).alias("bucket")) for m, (a, b, *_) in METRICS.items()]))
    return good.select("lang", "source", each.alias("e")).groupBy("lang", "source", "e.metric", "e.bucket").agg(F.count(F.lit(1)).alias("n"))


def _quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, metric, n, q1, q3`` of sketches (bucket counts) by ``keys``: the
    smallest buckets that a quarter and three quarters do not exceed."""
    merged = sketch.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))
    here = Window.partitionBy(*keys, "metric")
    run = merged.withColumn("upto", F.sum("n").over(here.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))).withColumn("all", F.sum("n").over(here))
    at = lambda q: F.min(F.when(4 * F.col("upto") >= q * F.col("all"), F.col("bucket"))) / float(UNIT)
    return run.groupBy(*keys, "metric").agg(F.max("all").alias("n"), at(1).alias("q1"), at(3).alias("q3"))


def thresholds(measured: DataFrame) -> DataFrame:
    """``lang, source`` and, for each metric, ``<m>_low`` and ``<m>_high``:
    the fences of the group, its language or the corpus, whichever is the
    smallest with ``MIN_GROUP`` documents (the corpus, if none has)."""
    sketch = saved(sketches(measured))
    # groups of documents that all failed the base rule need no fence
    groups, langs = _quartiles(sketch, ["lang", "source"]).alias("g"), _quartiles(sketch, ["lang"]).alias("l")
    corpus = {r["metric"]: r for r in _quartiles(sketch, []).collect()}  # a row a metric
    table = groups.join(langs, F.col("g.lang").eqNullSafe(F.col("l.lang")) & (F.col("g.metric") == F.col("l.metric")), "left")
    own, lang = F.col("g.n") >= MIN_GROUP, F.col("l.n") >= MIN_GROUP
    columns = []
    for m, (_, _, floor, below, above) in METRICS.items():
        here = F.col("g.metric") == m
        q1, q3 = (F.max(F.when(here, F.when(own, F.col(f"g.{q}")).when(lang, F.col(f"l.{q}")).otherwise(F.lit(corpus[m][q] if m in corpus else None)))) for q in ("q1", "q3"))
        spread = FENCE * F.greatest(q3 - q1, F.lit(floor))
        columns += [(q1 - spread if below else F.lit(None).cast("double")).alias(f"{m}_low"), (q3 + spread if above else F.lit(None).cast("double")).alias(f"{m}_high")]
    return table.groupBy(F.col("g.lang").alias("lang"), F.col("g.source").alias("source")).agg(*columns)


def _verdict() -> Column:
    ok = F.lit(True)
    for m in METRICS:
        ok = ok & F.coalesce(F.col(m) >= F.col(f"{m}_low"), F.lit(True)) & F.coalesce(F.col(m) <= F.col(f"{m}_high"), F.lit(True))
    return ok


def judge(docs: DataFrame, **columns) -> DataFrame:
    """Counts, metrics, fences, ``base_failed`` and ``kept`` per document."""
    measured = saved(metrics(docs, **columns))
    fences = thresholds(measured).select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), *[f"{m}_{s}" for m in METRICS for s in ("low", "high")])
    joined = measured.join(fences, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    return joined.drop("_lang", "_source").withColumn("kept", ~F.col("base_failed") & _verdict())
