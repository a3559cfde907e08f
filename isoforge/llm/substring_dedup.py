"""Substring dedup by super-k-mer partitioning.

A window is WINDOW consecutive words of a text. Its minimiser is the least hash of the GRAM-word sequences
in it, so equal windows have equal minimisers; neighbouring windows that share one are a super-k-mer.

1. Each text yields its super-k-mers as numbers: (minimiser, document, first window, windows, hash of its words).
2. Minimisers that occur in a single document are dropped: no window there has another copy. Spark takes
   the least and largest document of each minimiser, combining within map tasks first, and counts its distinct strings.
3. The other super-k-mers travel as packed strings (their words, joined by a space) to the bucket of their
   minimiser. Of equal strings a map task sends one, with its smallest document, so that a passage that
   a third of all rows repeat is a string or a few for each task; the bucket combines what is left.
4. A bucket numbers the windows of its strings exactly, by sorting word sequences of doubling length, and
   gives each window the smallest document it starts in. Strings of one minimiser stay together; a bucket
   is worked through in runs of RUN_WORDS words, with memory linear in them. A minimiser of over MAX_GROUP
   distinct strings (edited copies of one passage) is split: its windows travel one by one, as 128-bit digests, and
   equal ones are combined in map tasks first.
5. A text loses each word that lies in a window which also starts in a document with a smaller id.

Words are compared as words, but for split minimisers, whose windows are held equal if their 128-bit BLAKE2b digests are;
strings find their rows again by such a digest, too. Minimisers, strings and windows that a large share of the rows hold
are joined without gathering their rows (skew.join_groups). Documents are read twice and shuffled once.

Defined results: null, empty and shorter texts keep all their words; windows repeated within a document,
or in rows that repeat its id, don't count; a null id sorts after all others; every row gives one
row; an empty table gives no rows; other columns are ignored. Ids are integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isoforge.llm.common import WordHashes, chunks, materialise, mix, table, word_hashes
from isoforge.llm.skew import join_groups

WINDOW = 50
GRAM = 8
RUN_WORDS = 1_000_000
MAX_GROUP = 20_000
#: Strings that a map task remembers to have sent (by digests of 16 bytes).
SENT = 500_000
LAST = 2**63 - 1
ODD = np.uint64(0x9E3779B97F4A7C15)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each width consecutive values."""
    done = 1
    while done * 2 <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return np.minimum(x[: len(x) - (width - done)], x[width - done :]) if done < width else x


def gram_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """A hash of each size consecutive words."""
    n = len(h) - size + 1
    g = np.zeros(max(n, 0), np.uint64)
    for j in range(size):
        g = (g + h[j : j + n]) * ODD
    return mix(g)


def super_kmers(docs: list[list[bytes]], known: WordHashes, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """(document's number, first window, windows, minimiser, hash of the words) of all super-k-mers."""
    sizes = np.array([len(w) for w in docs], np.int64)
    long = np.flatnonzero(sizes >= window)
    none = (np.zeros(0, np.int64),) * 5
    if not len(long):
        return none
    h = np.concatenate([word_hashes(docs[i], known) for i in long])
    own = sizes[long]
    start = np.cumsum(own) - own
    least = sliding_min(gram_hashes(h, gram), window - gram + 1).view(np.int64)
    doc = np.repeat(np.arange(len(long)), own)[: len(least)]
    place = np.arange(len(least)) - start[doc]
    at = np.flatnonzero(place + window <= own[doc])
    value, doc, place = least[at], doc[at], place[at]
    new = np.ones(len(at), bool)
    new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(at)))
    # of the words from a on up to b: hash(b) - hash(a) * POWER^(b - a), from the hashes of all beginnings
    begin = at[first]
    end = begin + n + window - 1
    return long[doc[first]], place[first], n, value[first], range_hashes(h, begin, end).view(np.int64)


def range_hashes(h: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of the words from begin up to end, equal for equal words wherever they are."""
    # sum of h[i] * ODD^i, divided by ODD^begin: powers of an odd number have inverses modulo 2^64
    power, inverse = powers(ODD, len(h) + 1), powers(np.uint64(pow(int(ODD), -1, 1 << 64)), len(h) + 1)
    before = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h) * power[:-1], dtype=np.uint64)])
    return mix((before[end] - before[begin]) * inverse[begin] + (end - begin).astype(np.uint64))


def powers(x: np.uint64, n: int) -> np.ndarray:
    """x^0 .. x^(n - 1) modulo 2^64."""
    out = np.ones(n, np.uint64)
    out[1:] = x
    return np.multiply.accumulate(out)


KMERS = T.StructType([T.StructField("__d", T.LongType()), T.StructField("__k", T.LongType()), T.StructField("mini", T.LongType()), T.StructField("start", T.IntegerType()), T.StructField("n", T.IntegerType()), T.StructField("h", T.LongType())])
PACKED = T.StructType([T.StructField("__d", T.LongType()), T.StructField("__k", T.LongType()), T.StructField("mini", T.LongType()), T.StructField("start", T.IntegerType()), T.StructField("key", T.BinaryType()), T.StructField("packed", T.BinaryType()), T.StructField("windows", T.ArrayType(T.BinaryType()))])
RUNS = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("runs", T.ArrayType(T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType()), T.StructField("doc", T.LongType())])))])


def find_kmers(rows: DataFrame, window: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for _, texts, part in chunks(batches):
            doc, start, n, mini, h = super_kmers([(t or b"").split() for t in texts], known, window, gram)
            d, k = (part.column(part.schema.get_field_index(c)).to_numpy() for c in ("__id", "__k"))
            yield pa.RecordBatch.from_arrays([pa.array(d[doc]), pa.array(k[doc]), pa.array(mini), pa.array(start, pa.int32()), pa.array(n, pa.int32()), pa.array(h)], names=KMERS.names)

    return rows.mapInArrow(run, KMERS)


def digest(text: bytes) -> bytes:
    return hashlib.blake2b(text, digest_size=16).digest()


def pack_kmers(rows: DataFrame, window: int) -> DataFrame:
    """rows: __id, __k, __text, found (mini, start, n, split). A super-k-mer that isn't split has key, else windows.

    packed is there unless the task has sent it already for a document with as small an id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: dict[bytes, int] = {}
        for ids, texts, part in chunks(batches):
            k = part.column(part.schema.get_field_index("__k")).to_pylist()
            found = part.column(part.schema.get_field_index("found")).to_pylist()
            out: list[tuple] = []
            for d, kk, t, own in zip(ids.to_pylist(), k, texts, found, strict=True):
                words = (t or b"").split()
                for mini, start, n, split in {(f["mini"], f["start"], f["n"], f["split"]) for f in own}:
                    if split:
                        out.append((d, kk, mini, start, None, None, [digest(b" ".join(words[i : i + window])) for i in range(start, start + n)]))
                    else:
                        s = b" ".join(words[start : start + n + window - 1])
                        key = digest(s)
                        if fresh := d < sent.get(key, LAST + 1):
                            if len(sent) >= SENT:
                                sent.clear()
                            sent[key] = d
                        out.append((d, kk, mini, start, key, s if fresh else None, None))
            if out:
                c = list(zip(*out, strict=True))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.binary()))
                yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(c, kinds, strict=True)], names=PACKED.names)

    return rows.mapInArrow(run, PACKED)


def window_ids(strings: list[list[bytes]], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, first word there, number) of every window; numbers are equal exactly if the windows are."""
    known: dict[bytes, int] = {}
    fresh = count()
    ids = np.fromiter((known[w] if w in known else known.setdefault(w, next(fresh)) for s in strings for w in s), np.int64, sum(map(len, strings)))
    own = np.array([len(s) for s in strings], np.int64)
    start = np.cumsum(own) - own
    rank, done = ids, 1
    while done * 2 <= window:  # rank: of the sequence of done words from a place on
        key = rank[:-done] * (int(rank.max()) + 1) + rank[done:]
        rank = np.unique(key, return_inverse=True)[1]
        done *= 2
    if done < window:
        shift = window - done
        rank = np.unique(rank[: len(rank) - shift] * (int(rank.max()) + 1) + rank[shift:], return_inverse=True)[1]
    owner = np.repeat(np.arange(len(strings)), own)[: len(rank)]
    place = np.arange(len(rank)) - start[owner]
    at = np.flatnonzero(place + window <= own[owner])
    return owner[at], place[at], rank[at]


def least_documents(strings: list[bytes], docs: np.ndarray, window: int) -> list[list[tuple[int, int, int]]]:
    """For each string runs (first window, end, smallest document) of its windows."""
    owner, place, number = window_ids([s.split(b" ") for s in strings], window)
    least = np.full(int(number.max()) + 1, LAST, np.int64)
    np.minimum.at(least, number, docs[owner])
    doc = least[number]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(owner)))
    out: list[list[tuple[int, int, int]]] = [[] for _ in strings]
    for o, a, m, d in zip(owner[first].tolist(), place[first].tolist(), n.tolist(), doc[first].tolist(), strict=True):
        out[o].append((a, a + m, d))
    return out


def judge_buckets(strings: DataFrame, window: int) -> DataFrame:
    """strings: mini, key, packed, doc, all of one minimiser together and sorted by it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[bytes, bytes, int]] = []
        size, last = 0, None

        def flush() -> pa.RecordBatch:
            runs = least_documents([s for _, s, _ in held], np.array([d for _, _, d in held], np.int64), window)
            kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("doc", pa.int64())]))
            rows = [[{"a": a, "b": b, "doc": d} for a, b, d in r] for r in runs]
            return pa.RecordBatch.from_arrays([pa.array([k for k, _, _ in held], pa.binary()), pa.array(rows, kind)], names=RUNS.names)

        for batch in batches:
            for mini, key, s, doc in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("mini", "key", "packed", "doc")), strict=True):
                if mini != last and size >= RUN_WORDS:
                    yield flush()
                    held, size = [], 0
                last = mini
                held.append((key, s, doc))
                size += s.count(b" ") + 1
        if held:
            yield flush()

    return strings.mapInArrow(run, RUNS)


def strip_texts(rows: DataFrame, id_col: str, with_text: bool) -> DataFrame:
    """rows: __id, __text, gone (lists of a, b: words to remove)."""
    fields = [T.StructField(id_col, T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())]
    if with_text:
        fields.append(T.StructField("kept_text", T.StringType()))
    schema = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, part in chunks(batches):
            out: list[tuple] = []
            for d, t, gone in zip(ids.to_pylist(), texts, part.column(part.schema.get_field_index("gone")).to_pylist(), strict=True):
                words = (t or b"").split()
                n = len(words)
                if gone:
                    drop = np.zeros(n + 1, np.int32)
                    for g in gone:
                        for r in g:
                            drop[r["a"]] += 1
                            drop[r["b"]] -= 1
                    stays = np.cumsum(drop[:-1]) == 0
                    words = [words[i] for i in np.flatnonzero(stays)]
                kept = b" ".join(words)
                out.append((None if d == LAST else d, n, n - len(words), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace")))
            c = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c[i], pa.string() if i > 2 else pa.int64()) for i in range(len(schema.names))], names=schema.names)

    return rows.mapInArrow(run, schema)


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, with_text: bool = True, max_group: int = MAX_GROUP) -> DataFrame:
    """A row for each row of docs: id, n_words, n_removed, kept_sha256 and kept_text (kept words joined by a space)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("__id"), F.xxhash64(text).alias("__k"), text.alias("__text"))
    kmers = materialise(find_kmers(rows, window, gram), "superkmers")
    alike = kmers.groupBy("mini", "h").agg(F.min("__d").alias("lo"), F.max("__d").alias("hi"), F.count(F.lit(1)).alias("of"))
    shared = alike.groupBy("mini").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("of").alias("of"), F.count(F.lit(1)).alias("strings")).where("lo <> hi")
    shared = materialise(shared.select("mini", "of", (F.col("strings") > max_group).alias("split")), "shared")
    found = join_groups(kmers.drop("h"), shared, ["mini"], "of").groupBy("__d", "__k").agg(F.collect_list(F.struct("mini", "start", "n", "split")).alias("found"))
    found = found.select(F.col("__d").alias("__id"), "__k", "found")

    packed = materialise(pack_kmers(rows.join(found, ["__id", "__k"]), window), "packed")
    # one shuffle, by minimiser, serves the grouping of equal strings, too
    strings = packed.where("packed is not null").select("mini", "key", "packed", "__d").repartition("mini").groupBy("mini", "key", "packed").agg(F.min("__d").alias("doc"))
    runs = judge_buckets(strings.sortWithinPartitions("mini"), window)
    placed = packed.where("key is not null").select("__d", "__k", "start", "key")
    runs = materialise(runs.join(placed.groupBy("key").agg(F.count(F.lit(1)).alias("of")), "key"), "runs")
    later = F.filter("runs", lambda r: r["doc"] < F.col("__d"))
    hits = join_groups(placed, runs, ["key"], "of").select("__d", "__k", "start", later.alias("later")).where(F.size("later") > 0)
    spans = F.transform("later", lambda r: F.struct((F.col("start") + r["a"]).alias("a"), (F.col("start") + r["b"] + F.lit(window - 1)).alias("b")))
    gone = hits.select("__d", "__k", spans.alias("spans"))
    if not shared.where("split").isEmpty():
        single = packed.where("windows is not null").select("__d", "__k", "start", F.posexplode("windows").alias("at", "window"))
        first = materialise(single.groupBy("window").agg(F.min("__d").alias("doc"), F.max("__d").alias("last"), F.count(F.lit(1)).alias("of")).where("doc < last").select("window", "doc", "of"), "windows")
        late = join_groups(single, first, ["window"], "of").where("doc < __d").withColumn("a", F.col("start") + F.col("at"))
        gone = gone.unionByName(late.select("__d", "__k", F.array(F.struct("a", (F.col("a") + F.lit(window)).alias("b"))).alias("spans")))
    gone = gone.groupBy("__d", "__k").agg(F.collect_list("spans").alias("gone"))
    gone = gone.select(F.col("__d").alias("__id"), "__k", "gone")
    return strip_texts(rows.join(gone, ["__id", "__k"], "left"), id_col, with_text)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"), with_text=False)


ORACLE = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
  starts AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 48, 1))) AS i FROM w),
  win AS (SELECT doc_id, i, array_to_string(ws[i : i + 49], ' ') AS k FROM starts),
  least AS (SELECT k, min(doc_id) AS m FROM win GROUP BY k),
  gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM win JOIN least USING (k) WHERE m < doc_id),
  each AS (SELECT doc_id, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS p FROM w),
  kept AS (SELECT e.doc_id, count(g.p) AS n_removed, string_agg(x, ' ' ORDER BY e.p) FILTER (WHERE g.p IS NULL) AS t FROM each e LEFT JOIN gone g USING (doc_id, p) GROUP BY e.doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)
"""
