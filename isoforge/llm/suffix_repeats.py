"""Quality rules: suffix-array repetition.

The words of a text (runs of anything but ASCII white space) become numbers, and the suffixes of all
texts of a chunk are sorted at once by prefix doubling: each round sorts only suffixes that still share
their rank with another, so ordinary prose is done after two or three rounds. The ranks of each round
give the longest common prefixes of neighbours by binary lifting. Runs of the LCP array are its
intervals; an interval whose occurrences differ in the word before them is a maximal repeated
substring. The union of the spans of all such substrings of MIN_WORDS words or more, and the longest
of them, are held against limits. Words of different texts have different numbers, so a text is never
compared with another, and cost and memory follow the text's own length: some 100 bytes a word, so a Python worker with
a GB holds texts of about 60 MB.

Defined results: a null or empty text, or one of white space, has 0 words and fails the base rule; a text
that is only repetition is one whole span; texts of any length are processed whole; repeated rows get
equal results; a null id stays null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isoforge.llm.common import id_text, map_chunks, table

#: Repeats count from so many words on.
MIN_WORDS = 3
#: The method's verdict: at most this part of the words lies in repeats, and no repeat is longer than this. Labelled
#: documents of good quality that pass the base rule reach 0.473 and 13 words.
MAX_COVERED = 0.48
MAX_LONGEST = 30
WHITE = b" \t\n\v\f\r"
CONTINUES = bytes(range(0x80, 0xC0))
SYMBOLS = b"#*$%&|<>"


def suffix_array(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of ids (0..max, the last of each text unique) and the LCP of each suffix with the one before it."""
    n = len(ids)
    counts = np.bincount(ids)
    rank = (np.cumsum(counts) - counts)[ids]  # where the group of equal suffixes starts in sorted order
    levels = [rank.astype(np.int32)]
    active = np.flatnonzero(counts[ids] > 1)
    width = 1
    while len(active):
        nxt = active + width
        second = np.where(nxt < n, rank[np.minimum(nxt, n - 1)], -1) + 1
        first = rank[active]
        key = first * (n + 1) + second
        order = np.argsort(key)
        key, active, first = key[order], active[order], first[order]
        place = np.arange(len(active))
        new = np.empty(len(active), bool)
        new[0] = True
        np.not_equal(key[1:], key[:-1], out=new[1:])
        old = np.empty(len(active), bool)
        old[0] = True
        np.not_equal(first[1:], first[:-1], out=old[1:])
        start = np.maximum.accumulate(np.where(new, place, 0))
        group = np.maximum.accumulate(np.where(old, place, 0))
        rank[active] = first + (start - group)
        last = np.empty(len(active), bool)
        last[-1] = True
        last[:-1] = new[1:]
        active = active[~(new & last)]
        width *= 2
        levels.append(rank.astype(np.int32))
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    lcp = np.zeros(n, np.int64)
    pair = np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]]) + 1
    a, b, length = order[pair - 1], order[pair], np.zeros(len(pair), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + length, b + length
        inside = (x < n) & (y < n)
        x, y = np.minimum(x, n - 1), np.minimum(y, n - 1)
        length += np.where(inside & (levels[k][x] == levels[k][y]), 1 << k, 0)
    lcp[pair] = length
    return order, lcp


def lcp_intervals(lcp: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, last, depth) of every LCP interval of depth least or more."""
    firsts, lasts, depths = [], [], []
    at = np.flatnonzero(lcp >= least)
    if not len(at):
        return (np.zeros(0, np.int64),) * 3
    stack: list[tuple[int, int]] = []
    before = -2
    for k, value in zip(at.tolist(), lcp[at].tolist(), strict=True):
        if k != before + 1:
            while stack:
                left, depth = stack.pop()
                firsts.append(left), lasts.append(before), depths.append(depth)
        left = k - 1
        while stack and stack[-1][1] > value:
            left, depth = stack.pop()
            firsts.append(left), lasts.append(k - 1), depths.append(depth)
        if not stack or stack[-1][1] < value:
            stack.append((left, value))
        before = k
    while stack:
        left, depth = stack.pop()
        firsts.append(left), lasts.append(before), depths.append(depth)
    return np.array(firsts), np.array(lasts), np.array(depths)


def number_words(docs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all words, each text closed by a number of its own; where each text starts (and the end)."""
    parts, starts, base = [], [0], 0
    for words in docs:
        known: defaultdict = defaultdict(count(base).__next__)
        ids = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        base += len(known)
        parts += [ids, np.array([base])]
        base += 1
        starts.append(starts[-1] + len(words) + 1)
    return np.concatenate(parts) if parts else np.zeros(0, np.int64), np.array(starts)


def repeats(docs: list[list[bytes]], least: int = MIN_WORDS) -> dict[str, object]:
    """Of each text: covered words, longest repeat, maximal repeats; and these repeats and merged spans with the text's number.

    repeated: columns doc, start (of the first occurrence), length, times; spans: columns doc, start, length.
    """
    ids, starts = number_words(docs)
    m, n = len(docs), len(ids)
    if not n:
        none = np.zeros(0, np.int64)
        return {"covered": none, "longest": none, "n_maximal": none, "repeated": (none,) * 4, "spans": (none,) * 3}
    order, lcp = suffix_array(ids)
    first, last, depth = lcp_intervals(lcp, least)
    # The word before each occurrence, and in how many places of the sorted order it changes.
    ahead = np.where(np.isin(np.arange(n), starts), -np.arange(n) - 1, np.roll(ids, 1))[order]
    changes = np.concatenate([[0], np.cumsum(ahead[1:] != ahead[:-1])])
    diverse = changes[last] > changes[first] if len(first) else np.zeros(0, bool)
    first, last, depth = first[diverse], last[diverse], depth[diverse]
    doc_of = np.searchsorted(starts, np.arange(n), side="right") - 1
    # A suffix's longest maximal repeat is its deepest interval; spans of all maximal repeats have the same union.
    reach = np.zeros(n, np.int64)
    reach[order] = np.maximum(lcp, np.append(lcp[1:], 0))
    begin = np.flatnonzero(reach >= least)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, begin, 1)
    np.add.at(edge, begin + reach[begin], -1)
    inside = np.cumsum(edge[:-1]) > 0
    covered = np.bincount(doc_of[inside], minlength=m)
    longest = np.zeros(m, np.int64)
    np.maximum.at(longest, doc_of[order[first]], depth)
    step = np.diff(np.concatenate([[0], inside.astype(np.int8), [0]]))
    on, off = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    low = np.minimum.reduceat(order, np.stack([first, last + 1], 1).ravel()[:-1] if len(first) and last[-1] + 1 >= n else np.stack([first, last + 1], 1).ravel())[::2] if len(first) else first
    d = doc_of[low] if len(first) else first
    return {"covered": covered, "longest": longest, "n_maximal": np.bincount(d, minlength=m), "repeated": (d, low - starts[d], depth, last - first + 1), "spans": (doc_of[on], on - starts[doc_of[on]], off - on)}


def measure(texts: list[bytes | None], with_spans: bool, max_covered: float, max_longest: int) -> dict[str, object]:
    texts = [t or b"" for t in texts]
    docs = [t.split() for t in texts]
    n = np.array([len(w) for w in docs], np.int64)
    got = repeats(docs)
    chars = np.array([len(t.translate(None, WHITE + CONTINUES)) for t in texts], np.int64)
    symbols = np.array([len(t) - len(t.translate(None, SYMBOLS)) for t in texts], np.int64)
    lines = [[x for x in t.split(b"\n") if x and not x.isspace()] for t in texts]
    twice = np.array([len(x) - len(set(x)) for x in lines], np.int64)
    failed = (n < 50) | (100 * got["covered"] > 50 * n)
    kept = ~failed & (got["covered"] <= max_covered * n) & (got["longest"] <= max_longest)
    out = {"n_words": n, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": twice, "n_repeat_words": got["covered"], "longest_repeat_words": got["longest"], "n_maximal_repeats": got["n_maximal"], "base_failed": failed, "kept": kept}
    if with_spans:
        doc, start, length = got["spans"]
        ends = np.searchsorted(doc, np.arange(len(docs) + 1))
        rows = pa.StructArray.from_arrays([pa.array(start), pa.array(length)], names=["start", "length"])
        out["spans"] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)
    return out


NUMBERS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "longest_repeat_words", "n_maximal_repeats"]


def suffix_repetition(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST, with_spans: bool = True) -> DataFrame:
    """A row for each row of docs: the id, counts, base_failed, kept, and spans (start, length in words) of the union of its maximal repeats."""
    fields = [T.StructField(x, T.LongType()) for x in NUMBERS] + [T.StructField(x, T.BooleanType()) for x in ("base_failed", "kept")]
    if with_spans:
        fields.append(T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType())]))))
    return map_chunks(id_text(docs, id_col, text_col), lambda texts: measure(texts, with_spans, max_covered, max_longest), fields, id_col)


def op1_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_repeat_words is the length of the operator's spans: the union of all windows of three words found twice."""
    found = suffix_repetition(table(spark, sf_dir, "documents"))
    covered = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["length"])
    return found.withColumn("n_repeat_words", covered).drop("spans")
