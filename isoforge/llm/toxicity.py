"""Toxicity by compression distance.

PAIRS pairs of zstandard dictionaries are trained on windows of WINDOW words of labelled text: in each pair the
ordinary dictionary by ordinary documents only and the toxic one by toxic documents only. A window is compressed with
the ordinary dictionary alone, and with the toxic one laid behind it (at larger offsets, so that toxic content is used
only where ordinary content has no match as good); the bytes saved are the window's compression distance. A window
counts if it saves 1, 2, .. STEPS bytes; how far a text's counts exceed those of ordinary documents goes through a
calibrated curve for each pair, and the pairs' mean through one more.

Of the learned rows every CALIBRATE-th only calibrates the last curve. The others form PAIRS folds: a pair is trained
without one of them, on which its own counts and curve are calibrated, so no curve sees text that its dictionaries hold.

Learning takes at most TRAIN_DOCS rows of each label, those with the smallest hash of the id among rows that may be
learned from, and TRAIN_BYTES of their texts: whole texts where they fit, otherwise the longest ones are held at the
length with which all fit, in PIECES pieces spread evenly over the text, so no row is left out for its own or another
row's length. They are learned from in one task, whose input these bounds hold at any size of the tables; only the model
comes to the driver. An ordinary dictionary has 1 / ORDINARY_PART of the bytes it is trained on, MAX_DICT at most, and the
toxic one 1 / TOXIC_PART of the ordinary one's size. These are the bounds, and every text is scored whole. The model
(the dictionaries, 1.7 MB at most, and some fifty numbers) goes to the tasks with the function.

Defined results: null and empty texts have no window and get the curves' value at no evidence, as any
clean text; a label that is null isn't learned from, of repeated labels of an id the largest counts, of repeated
documents of an id the least text; without labels of both kinds in every part the score is 0, and where the last
curve would fall with the evidence (too few labels) it is the share of toxic rows for all; repeated rows get equal
results, however they are dealt; a null id stays null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isoforge.llm.common import bucket4, chunks, id_text, joined, longest_part, map_chunks, materialise, spread_pieces, table

TRAIN_DOCS = 6000
TRAIN_BYTES = 16_000_000
#: A text that is too long to be learned from whole is learned from in so many pieces.
PIECES = 16
#: Every so many-th learned row is kept for the last calibration.
CALIBRATE = 5
PAIRS = 3
WINDOW = 10
#: A window is held against thresholds of 1 to so many bytes saved.
STEPS = 5
ORDINARY_PART = 30
TOXIC_PART = 32
MAX_DICT = 524_288
#: Length of the segments that a dictionary is made of, and of the sequences whose frequency chooses them.
ORDINARY_COVER = (64, 8)
TOXIC_COVER = (16, 6)
THRESHOLD = 0.3
#: The short chains of this level reach toxic content only where nearer ordinary content has none like it.
SEARCH = {"min_match": 4, "strategy": zstd.STRATEGY_BTOPT, "write_content_size": False, "write_dict_id": False, "write_checksum": False}
#: A long text is cut into words piece by piece.
SLICE = 1 << 20
PUNCTUATION = re.compile(rb"[!-/:-@\[-`{-~]+")
SPACE = re.compile(rb"\s")


@dataclass(frozen=True)
class Pair:
    ordinary: bytes
    toxic: bytes
    rates: tuple[float, ...]  # for each threshold, the share of windows of ordinary documents that reach it
    weights: tuple[float, ...]  # the last is the constant


@dataclass(frozen=True)
class Model:
    pairs: tuple[Pair, ...]  # empty: nothing to learn from
    slope: float = 0.0
    constant: float = 0.0


def windows(text: bytes, size: int = WINDOW) -> Iterator[bytes]:
    """Each size words of a text, the rest last. Words are read from slices, so only one slice's are held at a time."""
    left: list[bytes] = []
    begin = 0
    while begin < len(text):
        end = begin + SLICE
        if end < len(text):
            cut = SPACE.search(text, end)
            end = cut.start() if cut else len(text)
        left += PUNCTUATION.sub(b" ", text[begin:end].lower()).split()
        whole = len(left) if end >= len(text) else len(left) - len(left) % size
        for i in range(0, whole, size):
            yield b" " + b" ".join(left[i : i + size]) + b" "
        del left[:whole]
        begin = end


def train(size: int, samples: list[bytes], cover: tuple[int, int]) -> bytes:
    """A zstandard dictionary trained on samples; if they are too little for that, the samples themselves.

    Training stops early at a long run of samples that it has seen, so samples are dealt out in a fixed order of chance.
    """
    samples = [samples[i] for i in np.random.default_rng(0).permutation(len(samples)).tolist()]
    try:
        return zstd.train_dictionary(size, samples, k=cover[0], d=cover[1]).as_bytes()
    except (zstd.ZstdError, ValueError):
        return b"".join(samples)[:size]


@lru_cache(2 * PAIRS)
def compressors(ordinary: bytes, toxic: bytes) -> tuple:
    """Compressors with the ordinary dictionary, and with the toxic one behind it (what comes last is nearest)."""
    size = len(ordinary) + len(toxic)
    p = zstd.ZstdCompressionParameters.from_level(3, source_size=200, dict_size=size, **SEARCH)
    out = []
    for content in (ordinary, toxic + ordinary):
        d = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(compression_params=p)
        out.append(zstd.ZstdCompressor(dict_data=d, compression_params=p))
    return tuple(out)


def distances(parts: list[bytes], ordinary: bytes, toxic: bytes) -> np.ndarray:
    """Bytes that the toxic dictionary saves in each window."""
    by_ordinary, by_toxic = (c.compress for c in compressors(ordinary, toxic))
    return np.fromiter((len(by_ordinary(x)) - len(by_toxic(x)) for x in parts), np.int64, len(parts))


def counts(texts: list[bytes], dictionaries: list[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """(pairs, texts, thresholds): windows that save as much; and the windows of each text."""
    hits, total = np.zeros((len(dictionaries), len(texts), STEPS)), np.zeros(len(texts))

    def count(parts: list[bytes], owner: list[int]) -> None:
        own = np.array(owner, np.int64)
        total[:] += np.bincount(own, minlength=len(texts))
        for k, pair in enumerate(dictionaries):
            saved = distances(parts, *pair)
            for step in range(STEPS):
                hits[k, :, step] += np.bincount(own[saved > step], minlength=len(texts))

    parts: list[bytes] = []
    owner: list[int] = []
    for i, t in enumerate(texts):
        for w in windows(t):
            parts.append(w)
            owner.append(i)
            if len(parts) >= 50_000:
                count(parts, owner)
                parts, owner = [], []
    count(parts, owner)
    return hits, total


def excess(hits: np.ndarray, total: np.ndarray, rates: np.ndarray) -> np.ndarray:
    """How far the counts of a text are above those expected of an ordinary one, in a scale that flattens out."""
    expected = total[:, None] * rates
    return np.arcsinh((hits - expected) / np.sqrt(expected + 0.3))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, rounds: int = 40) -> np.ndarray:
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(h, x.T @ (p - y) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def parts_of(rows: list[tuple[bytes, int]]) -> np.ndarray:
    """The part of each row: -1 is for the last calibration, 0 .. PAIRS - 1 are folds. Labels are dealt out evenly."""
    seen = [0, 0]
    out = np.zeros(len(rows), np.int64)
    for i, (_, y) in enumerate(rows):
        out[i] = -1 if seen[y] % CALIBRATE == 0 else seen[y] % PAIRS
        seen[y] += 1
    return out


def fit(rows: list[tuple[bytes, int]], toxic_share: float | None = None) -> Model:
    """rows: (text, label) in an order that doesn't depend on the label. toxic_share: of all labelled rows, if rows have another."""
    seen: dict[bytes, int] = {}
    for t, y in rows:
        seen.setdefault(t, int(y > 0))
    rows = list(seen.items())
    part = parts_of(rows)
    label = np.array([y for _, y in rows], np.int64)
    if any(not ((part == p) & (label == y)).any() for p in range(-1, PAIRS) for y in (0, 1)):
        return Model(())
    texts = [t for t, _ in rows]
    split = [list(windows(t)) for t in texts]
    pick = lambda on: [i for i in np.flatnonzero(on).tolist()]
    last = pick(part == -1)
    pairs: list[Pair] = []
    logits = np.zeros(len(last))
    for k in range(PAIRS):
        of = lambda y: [w for i in pick((part >= 0) & (part != k) & (label == y)) for w in split[i]]  # noqa: B023, E731
        ordinary_windows, toxic_windows = of(0), of(1)
        size = min(MAX_DICT, max(256, sum(map(len, ordinary_windows)) // ORDINARY_PART))
        ordinary, toxic = train(size, ordinary_windows, ORDINARY_COVER), train(max(256, size // TOXIC_PART), toxic_windows, TOXIC_COVER)
        own = pick(part == k)
        hits, total = counts([texts[i] for i in own + last], [(ordinary, toxic)])
        y = label[own]
        n = len(own)
        clean = np.flatnonzero(y == 0)
        rates = (hits[0, clean].sum(0) + 0.5) / (total[clean].sum() + 1)
        x = excess(hits[0], total, rates)
        weights = fit_logistic(x[:n], y.astype(float))
        logits += x[n:] @ weights[:-1] + weights[-1]
        pairs.append(Pair(ordinary, toxic, tuple(rates.tolist()), tuple(weights.tolist())))
    y = label[last].astype(float)
    slope, constant = fit_logistic((logits / PAIRS)[:, None], y).tolist()
    if slope < 0:  # too few rows: evidence can't speak for a document
        slope, constant = 0.0, float(np.log(y.mean() / (1 - y.mean())))
    if toxic_share and toxic_share < 1:
        constant += float(np.log(toxic_share / (1 - toxic_share)) - np.log(y.mean() / (1 - y.mean())))
    return Model(tuple(pairs), slope, constant)


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", may_learn=None, train_docs: int = TRAIN_DOCS, train_bytes: int = TRAIN_BYTES) -> Model:
    """Fits on at most train_docs rows and about train_bytes of text of each label. may_learn: a condition on id_col."""
    rows = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    if may_learn is not None:
        rows = rows.where(may_learn)
    rows = materialise(rows.groupBy(F.col(id_col).alias("__i")).agg((F.max(label_col) > 0).cast("int").alias("__y")), "labels")
    shares = {r["__y"]: r["count"] for r in rows.groupBy("__y").count().collect()}
    first = [rows.where(F.col("__y") == y).orderBy(F.xxhash64("__i"), "__i").limit(train_docs) for y in (0, 1)]
    # at most twice train_docs rows
    chosen = materialise(first[0].unionByName(first[1]), "chosen", 2 * train_docs)
    texts = docs.select(F.col(id_col).alias("__i"), F.col(text_col).cast("string").alias("__t")).where("__t is not null")
    texts = texts.join(F.broadcast(chosen), "__i").groupBy("__i", "__y").agg(F.min("__t").alias("__t"))
    sized = materialise(texts.withColumn("__b", F.octet_length("__t")), "learned")
    sizes: dict[int, dict[int, int]] = {0: {}, 1: {}}
    for r in sized.groupBy("__y", "__b").count().collect():
        sizes[r["__y"]][r["__b"]] = r["count"]
    part = {y: max(PIECES, longest_part(own, train_bytes)) for y, own in sizes.items()}
    most = F.when(F.col("__y") == 1, part[1]).otherwise(part[0])
    pieces = spread_pieces(F.col("__t"), F.col("__b"), most, PIECES)
    share = shares.get(1, 0) / max(1, sum(shares.values()))
    rows = sized.select(F.xxhash64(F.col("__i"), F.lit(7)).alias("k"), F.col("__i").cast("string").alias("i"), pieces.alias("t"), F.col("__y").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(r["k"], r["i"], joined(r["t"]), r["y"]) for batch in batches for r in batch.to_pylist()]
        model = fit([(t, y) for _, _, t, y in sorted(got, key=lambda r: r[:3])], share)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    found = rows.repartition(1).mapInArrow(run, "model binary").collect()  # one row, of the model's size
    return pickle.loads(found[0][0]) if found else Model(())


def score_texts(texts: list[bytes | None], model: Model) -> np.ndarray:
    if not model.pairs:
        return np.zeros(len(texts))
    hits, total = counts([t or b"" for t in texts], [(p.ordinary, p.toxic) for p in model.pairs])
    logits = np.zeros(len(texts))
    for k, p in enumerate(model.pairs):
        w = np.array(p.weights)
        logits += excess(hits[k], total, np.array(p.rates)) @ w[:-1] + w[-1]
    return sigmoid(logits / len(model.pairs) * model.slope + model.constant)


def toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """A row for each row of docs: id, score, predicted."""

    def work(texts: list[bytes | None]) -> dict[str, object]:
        s = score_texts(texts, model)
        return {"score": s, "predicted": (s >= threshold).astype(np.int32)}

    return map_chunks(id_text(docs, id_col, text_col), work, [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())], id_col)


def reject_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, all columns, whose score is below threshold; scored where they are read, without a join."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts, rows in chunks(batches, id_col=text_col, text_col=text_col):
            yield rows.filter(pa.array(score_texts(texts, model) < threshold))

    return docs.mapInArrow(run, docs.schema)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from labels of rows whose crc32(doc_id) mod 4 isn't 2."""
    docs = table(spark, sf_dir, "documents")
    model = learn(docs, table(spark, sf_dir, "labels"), may_learn=bucket4() != 2)
    return toxicity(docs, model).select("doc_id", (bucket4() == 2).alias("held_out"), "score", "predicted")
