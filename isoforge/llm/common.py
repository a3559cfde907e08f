"""Shared helpers: reading inputs, Arrow batches of whole texts, shared checkpoints, hashing."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Texts are handed to numpy code in chunks of about this many bytes; a longer text is a chunk of its own.
CHUNK_BYTES = 2_000_000
REPO = str(Path(__file__).resolve().parents[2])


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package when it isn't installed (a cluster gets it by --py-files)."""
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "")
    if REPO not in have.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (REPO, have) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only in local mode may it be unset: one machine is all there is."""
    if found := spark.conf.get("spark.checkpoint.dir", None):
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: operators need a folder that the driver and all executors share")
    return f"file://{tempfile.gettempdir()}/isoforge-{os.getuid()}"


#: Rows of a file, where a bound on a table's rows is known.
FILE_ROWS = 100_000


def materialise(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Cut the lineage: write df as Parquet to the shared folder and read it back. rows: a bound on its rows, so that few aren't many files.

    Lost executors cost nothing that was written; only the columns a later step names are read again. The folder is
    deleted by discard, or when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    (df if rows is None else df.coalesce(rows // FILE_ROWS + 1)).write.parquet(path)
    fs, place = folder(spark, path)
    fs.deleteOnExit(place)
    out = spark.read.schema(df.schema).parquet(path)
    out._written = path
    return out


def folder(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def discard(written: DataFrame) -> None:
    """Delete what materialise wrote; nothing that is still to be computed may need it."""
    fs, place = folder(written.sparkSession, written._written)
    fs.delete(place, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only what an operator needs, under names that nothing in the input can clash with."""
    return docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))


def chunks(batches: Iterator[pa.RecordBatch], size: int = CHUNK_BYTES, id_col: str = "__id", text_col: str = "__text") -> Iterator[tuple[pa.Array, list[bytes | None], pa.RecordBatch]]:
    """(ids, texts as UTF-8 or None, the rows) of about size bytes of text each."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        column = batch.column(batch.schema.get_field_index(text_col))
        texts = column.cast(pa.large_binary()).to_pylist()
        begin, held = 0, 0
        for i, t in enumerate(texts):
            held += len(t or b"") + 64
            if held >= size or i == n - 1:
                part = batch.slice(begin, i + 1 - begin)
                yield part.column(part.schema.get_field_index(id_col)), texts[begin : i + 1], part
                begin, held = i + 1, 0


def map_chunks(df: DataFrame, work: Callable[[list[bytes | None]], dict[str, object]], fields: list[T.StructField], id_col: str) -> DataFrame:
    """One row out for each row in: the id and what work returns for a chunk of texts."""
    schema = T.StructType([T.StructField(id_col, df.schema["__id"].dataType), *fields])
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, _ in chunks(batches):
            got = work(texts)
            yield pa.RecordBatch.from_arrays([ids, *(got[n] if isinstance(got[n], pa.Array) else pa.array(got[n]) for n in names)], names=[id_col, *names])

    return df.mapInArrow(run, schema)


class WordHashes(dict):
    """word -> 64-bit hash, remembered while the table is small; words over LONGEST bytes aren't remembered."""

    LIMIT, LONGEST = 400_000, 64

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= self.LONGEST:
            if len(self) >= self.LIMIT:
                self.clear()
            self[word] = h
        return h


def word_hashes(words: list[bytes], known: WordHashes) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters them (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bucket4(id_col: str = "doc_id"):
    """crc32 of the id as text, mod 4; 2 marks the rows held out from learning."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4


def longest_part(sizes: dict[int, int], total: int) -> int:
    """The largest bound on a text's length with which all texts fit into total. sizes: number of texts of a length."""
    left, n = total, sum(sizes.values())
    for b, k in sorted(sizes.items()):
        if b * n > left:
            return max(1, left // n)
        left, n = left - b * k, n - k
    return max([1, *sizes])


def spread_pieces(text: Column, size: Column, most: Column, pieces: int) -> Column:
    """The bytes of a text as one piece if it has most bytes at most, else as so many pieces of equal length spread evenly over it."""
    raw, length = text.cast("binary"), F.floor(most / pieces).cast("int")
    spread = F.transform(F.sequence(F.lit(0), F.lit(pieces - 1)), lambda k: F.substring(raw, F.floor(k * (size - length) / (pieces - 1)).cast("int") + 1, length))
    return F.when(size <= most, F.array(raw)).otherwise(spread)


def joined(pieces: list[bytes]) -> bytes:
    """A text of its pieces, without the words that a cut may have split."""
    if len(pieces) == 1:
        return bytes(pieces[0])
    last = len(pieces) - 1
    whole = [p if i == 0 else re.sub(rb"^\S*\s", b"", p) for i, p in enumerate(map(bytes, pieces))]
    return b" ".join(p if i == last else re.sub(rb"\s\S*$", b"", p) for i, p in enumerate(whole))
