"""Exact dedup: group by a 128-bit content hash, keep one stable id, compare bytes inside groups.

A group is first all rows of one 128-bit hash; grouping by (hash, bytes) then compares the bytes, so
that two texts that share a hash are still two groups. Spark combines equal texts in each map task
before the shuffle, so a text that a third of all rows repeat is shuffled once for each task.
Rows find their group again by (hash, SHA-256), which carries no text; large groups are broadcast (a
bounded number) and their rows stay spread. Should two different texts
ever share both, the query stops with an error rather than merge them.

Defined results: a null text counts as empty; empty texts are equal to each other; no row is dropped
or doubled; of rows that repeat an id and a text exactly one is kept; null ids sort before all others
(they stay only where a group has no other id); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isoforge.llm.common import materialise, table
from isoforge.llm.skew import join_groups

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; where all characters are ASCII, lower() is the same and faster."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def content_hash(text: Column) -> Column:
    """128 bits."""
    return F.unhex(F.md5(text.cast("binary")))


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def judged(docs: DataFrame, id_col: str, text_col: str, keep: str, normalise, hash128) -> DataFrame:
    """A row for each id and text: __id, __h, __s (SHA-256), __copies (rows that repeat both), keep_id, group_size."""
    pick = {"smallest": F.min, "largest": F.max}[keep]
    text = normalise(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    rows = docs.select(F.col(id_col).alias("__id"), text.alias("__t")).withColumn("__h", hash128(F.col("__t")))
    sha = digest(F.col("__t"))

    groups = rows.groupBy("__h", "__t").agg(pick("__id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")).select("__h", sha.alias("__s"), "keep_id", "group_size")
    # One row for each (hash, SHA-256), unless both collide for different bytes.
    one = groups.groupBy("__h", "__s").agg(F.min("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"), F.count(F.lit(1)).alias("__n"))
    one = one.withColumn("group_size", F.when(F.col("__n") > 1, F.raise_error(F.lit("two texts share both hashes")).cast("long")).otherwise(F.col("group_size"))).drop("__n")

    light = rows.select("__id", "__h", sha.alias("__s")).groupBy("__id", "__h", "__s").agg(F.count(F.lit(1)).alias("__copies"))
    return join_groups(light, materialise(one, "groups"), ["__h", "__s"], "group_size")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", normalise=lower_ascii, hash128=content_hash) -> DataFrame:
    """A row for each row of docs: id_col, keep_id, group_size, kept, text_sha256.

    keep: "smallest" or "largest" id of the group stays. normalise, hash128: Column -> Column.
    """
    nth = F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))).alias("__nth")
    out = judged(docs, id_col, text_col, keep, normalise, hash128).select("*", nth)
    return out.select(F.col("__id").alias(id_col), "keep_id", "group_size", (F.col("__id").eqNullSafe(F.col("keep_id")) & (F.col("__nth") == 1)).alias("kept"), F.col("__s").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """The rows of docs that stay, all columns. Whole rows are shuffled once; only those that repeat id and text a second time."""
    stay = materialise(judged(docs, id_col, text_col, keep, lower_ascii, content_hash).where(F.col("__id").eqNullSafe(F.col("keep_id"))).select("__id", "__s", "__copies"), "stay")
    # all columns of docs travel as one, so that no name of theirs clashes
    whole = F.struct(*(F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns))).alias("row")
    rows = docs.select(F.col(id_col).alias("i"), digest(lower_ascii(F.coalesce(F.col(text_col).cast("string"), F.lit("")))).alias("s"), whole)
    kept = rows.join(stay, F.col("i").eqNullSafe(F.col("__id")) & (F.col("s") == F.col("__s")))
    repeated = F.col("__copies") > 1
    out = kept.where(~repeated).select("row")
    if not stay.where(repeated).isEmpty():
        out = out.unionByName(kept.where(repeated).dropDuplicates(["i", "s"]).select("row"))
    return out.select(*(F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), keep="largest")


ORACLE = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
"""
