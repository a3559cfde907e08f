"""Best-fit packing by hierarchical residuals.

Each map task cuts its documents into pieces and packs them best-fit, largest first, into bins of
CAPACITY tokens. Bins that are nearly full (SLACK tokens free or fewer) are done. The underfull ones
become items: FAN neighbouring tasks' bins are packed best-fit into each other, done bins leave, and the
next round merges FAN groups, as a tree, up to the root. Only (bin, fill) travels, never text or tokens.
All underfull bins take part in every round. A group of over MAX_GROUP of them is dealt out by a hash into as many
parts as it needs, which are packed side by side and meet others in later rounds; a part packs as well as a whole of its
size, so the loss is one bin or so for each part.

A document over CAPACITY tokens is cut so that its first piece is the remainder and all others are full;
full pieces are bins of their own. Within a task documents are held as numbers only, in runs of LOCAL.

Token ids are those of the tokenizers library, for every text. Texts over LONG_CHARS characters are encoded in chunks
that are spliced at stable boundaries (token_counts.encode_long), which gives the same ids in bounded memory.

Defined results: a null text is empty: one piece of the end token; every row is packed, repeated rows
each on their own; a null id stays null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isoforge.llm.common import chunks, id_text, materialise, table
from isoforge.llm.token_counts import encode_long, splits_at_space, tokenizer, tokenizer_path

CAPACITY = 1024
END = 2
SLACK = 8
FAN = 32
#: Documents that a task packs at once.
LOCAL = 200_000
#: Bins that a group packs at once.
MAX_GROUP = 200_000
LONG_CHARS = 1_000_000


def encode(texts: list[bytes | None], path: str, end: int = END) -> Iterator[np.ndarray]:
    """The ids of each text, and the end token."""
    t, may_cut = tokenizer(path), splits_at_space(path)
    strings = [(x or b"").decode("utf-8", "replace") for x in texts]
    long = {i for i, s in enumerate(strings) if may_cut and len(s) > LONG_CHARS}
    found = iter(t.encode_batch_fast([s for i, s in enumerate(strings) if i not in long], add_special_tokens=False))
    for i, s in enumerate(strings):
        ids = [np.array(x, "<u4") for x in encode_long(t, s)] if i in long else [np.array(next(found).ids, "<u4")]
        yield np.concatenate([*ids, np.array([end], "<u4")])


def best_fit(sizes: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: (bin of each item, its offset there, fill of each bin)."""
    n = len(sizes)
    bins, offsets, fills = np.zeros(n, np.int64), np.zeros(n, np.int64), []
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    some = 0  # bit f: a bin with f tokens free exists
    sized = sizes.tolist()
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = sized[i]
        fits = some >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            b = by_free[free].pop()
            if not by_free[free]:
                some &= ~(1 << free)
        else:
            free, b = capacity, len(fills)
            fills.append(0)
        bins[i], offsets[i] = b, fills[b]
        fills[b] += size
        left = free - size
        if left:
            by_free[left].append(b)
            some |= 1 << left
    return bins, offsets, np.array(fills, np.int64)


PIECES = [("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType()), ("bin", T.LongType()), ("at", T.LongType()), ("fill", T.LongType()), ("open", T.BooleanType())]


def pieces(docs: DataFrame, path: str, id_col: str, text_col: str, capacity: int, end: int, slack: int) -> DataFrame:
    """All pieces, packed within their task. bin: the task's number and the bin's number there; open: is it handed on?"""
    rows = id_text(docs, id_col, text_col)
    schema = T.StructType([T.StructField("__id", rows.schema["__id"].dataType), *(T.StructField(n, t) for n, t in PIECES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 40
        ids: list[pa.Array] = []
        found: list[tuple] = []
        made = 0

        def out() -> Iterator[pa.RecordBatch]:
            nonlocal made
            cols = [np.array(c, np.int64) for c in zip(*found, strict=True)]
            owner = pa.concat_arrays(ids).take(pa.array(cols[0]))
            bins, at, fills = best_fit(cols[3], capacity)
            on = fills < capacity - slack
            values = [owner, pa.array(cols[1], pa.int32()), *(pa.array(c) for c in cols[2:]), pa.array(bins + task + made), pa.array(at), pa.array(fills[bins]), pa.array(on[bins])]
            made += len(fills)
            yield from pa.Table.from_arrays(values, names=schema.names).to_batches(50_000)
            ids.clear(), found.clear()

        n = 0
        for own, texts, _ in chunks(batches):
            ids.append(own)
            for tokens in encode(texts, path, end):
                begin, k = 0, 0
                stop = len(tokens) % capacity or capacity
                while begin < len(tokens):
                    found.append((n, k, begin, stop - begin, zlib.crc32(tokens[begin:stop].tobytes())))
                    begin, stop, k = stop, stop + capacity, k + 1
                n += 1
            if n >= LOCAL:
                yield from out()
                n = 0
        if found:
            yield from out()

    return rows.mapInArrow(run, schema)


def merge_round(rooted: DataFrame, capacity: int, slack: int, fan: int, max_group: int = MAX_GROUP) -> DataFrame:
    """Packs the bins of fan groups into each other. rooted: first (the map task's bin), bin, base (offset there), fill, open, grp."""
    names = rooted.columns

    def merge(rows: pa.Table) -> pa.Table:
        c = {n: rows.column(n).to_numpy() for n in names}
        which, first, inverse = np.unique(c["bin"], return_index=True, return_inverse=True)
        fill = c["fill"][first]
        into, at, fills = best_fit(fill, capacity)
        # a bin is named after the first one packed into it
        name = np.empty(len(fills), np.int64)
        name[into[at == 0]] = which[at == 0]
        on = fills < capacity - slack
        return pa.table({"first": c["first"], "bin": name[into][inverse], "base": c["base"] + at[inverse], "fill": fills[into][inverse], "open": on[into][inverse], "grp": c["grp"]})

    grouped = rooted.withColumn("grp", F.expr(f"grp div {fan}"))
    # parts of a group: at most one row for each map task, whatever the data
    parts = grouped.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / max_group).alias("parts"))
    dealt = grouped.join(F.broadcast(parts), "grp").withColumn("part", F.pmod(F.xxhash64("bin"), "parts")).select(*names, "part")
    return dealt.groupBy("grp", "part").applyInArrow(merge, grouped.schema)


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int = END, slack: int = SLACK, fan: int = FAN, max_group: int = MAX_GROUP) -> DataFrame:
    """A row for each piece: id, piece, start, length, ids_crc32, sequence_id, offset."""
    packed = materialise(pieces(docs, path, id_col, text_col, capacity, end, slack), "pieces")
    rooted = packed.where((F.col("at") == 0) & F.col("open")).select(F.col("bin").alias("first"), "bin", F.lit(0).cast("long").alias("base"), "fill", "open", F.shiftright("bin", 40).alias("grp"))
    groups = (packed.agg(F.max(F.shiftright("bin", 40))).first()[0] or 0) + 1
    done: list[DataFrame] = []
    while True:
        rooted = materialise(merge_round(rooted, capacity, slack, fan, max_group), "bins")
        groups = -(-groups // fan)
        if groups <= 1:
            break
        done.append(rooted.where(~F.col("open")))
        rooted = rooted.where("open")
    for d in done:
        rooted = rooted.unionByName(d)
    moved = rooted.select(F.col("first").alias("bin"), F.col("bin").alias("to"), "base")
    out = packed.join(moved, "bin", "left")
    return out.select(F.col("__id").alias(id_col), "piece", "start", "length", "ids_crc32", F.coalesce("to", "bin").alias("sequence_id"), (F.col("at") + F.coalesce("base", F.lit(0))).alias("offset"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
