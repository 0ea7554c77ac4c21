"""Bounded samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clusterfold.llm.frames import saved, texts

LINE_BYTES = 256  # what a line costs a model besides its bytes, about


def sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, per_class: int, most_bytes: int, *,
           id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id") -> DataFrame:
    """``doc_id, text, y`` of at most ``per_class`` labelled documents of each
    class among those that ``train`` (an expression of ``doc_id``) allows:
    those with the smallest hashes of their ids, as long as they take at most
    ``most_bytes`` a class together (a line counts ``LINE_BYTES`` besides; the
    first document stays in any case).  Long texts are not left out for their
    length.  The ids are at most ``2 * per_class`` rows, which bounds their
    broadcast; an id that ``documents`` repeats is one row, with the smallest
    of its texts.  Null labels and ids are left out; of several labels of an
    id the largest counts."""
    own = labels.select(F.col(f"`{label_id}`").cast("long").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("y")) \
        .where("doc_id is not null and y in (0, 1)").where(train).groupBy("doc_id").agg(F.max("y").alias("y"))
    ids = None
    for y in (0, 1):
        part = own.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        ids = part if ids is None else ids.unionByName(part)
    found = saved(texts(docs, id_col, text_col).join(F.broadcast(ids), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text")).select("doc_id", "text", "y"))
    size = F.coalesce(F.octet_length("text") + LINE_BYTES * (F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"))) + 1), F.lit(0)).cast("long")
    left = {0: most_bytes, 1: most_bytes}
    taken: list[int] = []
    for r in found.select("doc_id", "y", size.alias("size"), F.xxhash64("doc_id").alias("h")).orderBy("h", "doc_id").collect():
        if left[r["y"]] == most_bytes or r["size"] <= left[r["y"]]:
            taken.append(r["doc_id"])
            left[r["y"]] -= r["size"]
        else:
            left[r["y"]] = 0  # no later, shorter document instead: length must not choose
    chosen = docs.sparkSession.createDataFrame([(i,) for i in taken], "doc_id long")
    return found.join(F.broadcast(chosen), "doc_id", "left_semi")
