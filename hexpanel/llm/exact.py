"""Exact deduplication with DataFrame operations only.

Equal texts are grouped by digest and whole text: first within each task, then within salted digest groups, then
across salts, so that no stage gathers the rows of one text in a task. The text itself is a key at each stage; a digest
alone never decides. Only (digest, winner, size) goes back to the rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexpanel.llm._util import cut


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def find(df: DataFrame, text: str = "text", key: str = "doc_id", salts: int = 16, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per row of df: key, keep_id (largest key of the rows with that text), group_size, kept, text_sha256.

    Null texts count as empty. A null key never wins over another; if all keys of a group are null, keep_id is null and
    all are kept. Rows that repeat both key and text are one document twice: both have the same verdict. Other columns
    of df are not read. digest: any function of the text; where two texts share a digest, the rows are told apart by
    their texts.
    """
    body = F.coalesce(df[text].cast("string"), F.lit(""))
    rows = df.select(df[key].alias("k"), body.alias("t")).withColumn("d", digest(F.col("t")))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("k"), F.lit(salts))).groupBy("d", "salt", "t").agg(F.max("k").alias("w"), F.count("*").alias("n"))
    merged = salted.groupBy("d", "t").agg(F.max("w").alias("w"), F.sum("n").alias("n"))
    winners = cut(merged.select("d", "w", "n"), "winners")
    clashing = winners.groupBy("d").agg(F.count("*").alias("texts")).where("texts > 1").select("d")
    small = rows.select("k", "d", sha256(F.col("t")).alias("sha"))
    if clashing.isEmpty():
        found = small.join(winners, "d")
    else:
        clashing = cut(clashing, "clashing")
        own = rows.join(clashing, "d", "left_semi").join(merged.join(clashing, "d", "left_semi"), ["d", "t"])
        found = small.join(clashing, "d", "left_anti").join(winners, "d").select("k", "w", "n", "sha").unionByName(own.select("k", "w", "n", sha256(F.col("t")).alias("sha")))
    return found.select(F.col("k").alias(key), F.col("w").alias("keep_id"), F.col("n").alias("group_size"), F.col("k").eqNullSafe(F.col("w")).alias("kept"), F.col("sha").alias("text_sha256"))
