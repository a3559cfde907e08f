"""License scans: Dice coefficient over word bigrams against licence templates.

A text is normalised (A-Z lower-cased, words are runs of letters and digits, or of bytes beyond ASCII) and cut into
segments: lines, and within lines sentences. It is compared in units: every segment, every paragraph (lines between blank
ones), every run of neighbouring segments that are mostly template wording, the whole text, and of all windows of
neighbouring segments the best (segments without words neither end nor dilute one, so a licence of several paragraphs is
found inside other content, and a sentence inside a line). With a unit of
a bigrams and a template of b, Dice is 2 * common / (a + b), bigrams counted as often as they occur. Dice >= t
bounds b to a*t/(2-t) .. a*(2-t)/t, so only templates of such sizes are compared; and a unit needs t/(2-t) of its
bigrams in the wording of all templates at all, which prefix sums give for all units of a chunk at once. Windows are
compared from each first segment that may begin one. The best template of a unit names it. Of matches that overlap and
name the same licence the one of the highest Dice stays (then the longest), and a match inside a better one of
another licence is dropped, so that a licence isn't named after a shorter relative that it contains.

Defined results: null or empty texts and units of fewer than two words match nothing; of equal Dice the
template that comes first in order of names wins; texts of any length are scanned whole; repeated rows get equal results;
a null id stays null; an empty table gives no rows; other columns are ignored. Licences without a template are not
found, or are named after one whose wording they share to the threshold.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isoforge.llm.common import id_text, map_chunks, table
from isoforge.llm.license_templates import TEMPLATES

THRESHOLD = 0.8
#: Words, ends of lines, and ends of sentences inside a line.
TOKEN = re.compile(rb"[a-z0-9\x80-\xff]+|\n|[.!?](?=[ \t]+[^\s])")
CUTS = (b"\n", b".", b"!", b"?")
WORD = re.compile(rb"[a-z0-9\x80-\xff]+")


def words(text: bytes) -> list[bytes]:
    return WORD.findall(text.lower())


def bigrams(tokens: list[bytes]) -> Counter:
    return Counter(zip(tokens, tokens[1:], strict=False))


def dice(a: Counter, b: Counter) -> float:
    n = a.total() + b.total()
    return 2 * sum(min(v, b[k]) for k, v in a.items() if k in b) / n if n else 0.0


class Scanner:
    def __init__(self, templates: tuple[tuple[str, str], ...], threshold: float):
        self.threshold = threshold
        self.templates = sorted((name, bigrams(words(t.encode()))) for name, t in templates)
        self.templates.sort(key=lambda x: x[0])
        self.sizes = np.array([b.total() for _, b in self.templates])
        vocabulary = sorted({w for _, b in self.templates for pair in b for w in pair})
        self.known = {w: i + 1 for i, w in enumerate(vocabulary)}  # 0: any other word
        self.known |= dict.fromkeys(CUTS, -1)
        self.width = len(vocabulary) + 1
        pairs = sorted({pair for _, b in self.templates for pair in b})
        self.pair = np.full(self.width * self.width, -1, np.int32)  # number of a bigram of the templates
        self.pair[[self.known[x] * self.width + self.known[y] for x, y in pairs]] = np.arange(len(pairs))
        number = {pair: i for i, pair in enumerate(pairs)}
        self.times = np.zeros((len(self.templates), len(pairs)), np.int32)
        for k, (_, b) in enumerate(self.templates):
            for pair, n in b.items():
                self.times[k, number[pair]] = n

    def best(self, tokens: list[bytes]) -> tuple[float, str] | None:
        """The best template of sizes that can reach the threshold."""
        own = bigrams(tokens)
        a, t = own.total(), self.threshold
        found = None
        for k in np.flatnonzero((self.sizes * (2 - t) >= a * t - 1e-9) & (self.sizes * t <= a * (2 - t) + 1e-9)):
            name, template = self.templates[k]
            d = dice(own, template)
            if d >= t and (found is None or d > found[0]):
                found = (d, name)
        return found

    def windows(self, ids: np.ndarray, begin: np.ndarray, end: np.ndarray, doc: np.ndarray) -> list[tuple[int, int]]:
        """First and last of the lines (with words) of the best windows. ids: words; line j has those from begin[j] to end[j]."""
        t, least = self.threshold, self.threshold / (2 - self.threshold)
        if not len(begin):
            return []
        code = self.pair[ids[:-1] * self.width + ids[1:]]
        on = code >= 0
        hit = code[on]
        before = np.concatenate([[0], np.cumsum(on)])  # bigrams of any template's wording before a place
        # A window needs hits >= least * bigrams: of a first line, that some last line of its text reaches it.
        apart = 2.0 * len(ids) * doc
        reach = np.maximum.accumulate((before[end - 1] - least * (end - 1) - apart)[::-1])[::-1]
        starts = np.flatnonzero(reach >= before[begin] - least * begin - apart - 1e-3)
        final = np.searchsorted(doc, doc[starts], side="right") - 1
        top: dict[int, tuple[float, int, int, int]] = {}
        for k, b in enumerate(self.sizes):
            has = np.concatenate([[0], np.cumsum(self.times[k, hit] > 0)])
            place = begin[starts]
            lo = np.searchsorted(end, place + 1 + b * least - 1e-9)
            hi = np.minimum(np.searchsorted(end, place + 1 + b / least + 1e-9, side="right") - 1, final)
            able = np.flatnonzero((lo <= hi) & (b > 0))
            n = end[lo[able]] - 1 - place[able]
            able = able[2 * (has[before[end[hi[able]] - 1]] - has[before[place[able]]]) >= t * (n + b) - 1e-9]
            for i in able.tolist():
                first, last = before[place[i]], end[lo[i] : hi[i] + 1] - 1
                own = hit[first : before[last[-1]]]
                order = np.argsort(own, kind="stable")
                new = np.concatenate([[True], own[order][1:] != own[order][:-1]])
                rank = np.empty(len(own), np.int64)  # how often a bigram has occurred in the window before
                rank[order] = np.arange(len(own)) - np.maximum.accumulate(np.where(new, np.arange(len(own)), 0))
                common = np.concatenate([[0], np.cumsum(rank < self.times[k, own])])[before[last] - first]
                d = 2 * common / (last - place[i] + b)
                m = len(d) - 1 - int(np.argmax(d[::-1]))
                best = (float(d[m]), int(last[m]), -k, int(lo[i]) + m)
                if d[m] >= t and best > top.get(i, (0.0,)):
                    top[i] = best
        found = sorted((-d, int(begin[starts[i]]) - e, -k, int(starts[i]), m) for i, (d, e, k, m) in top.items())
        kept: list[tuple[int, int]] = []
        holds: dict[int, set[str]] = {}  # line: licences of the windows kept
        inside: dict[int, set[int]] = {}  # line: windows kept
        for _, _, k, j, m in found:
            name = self.templates[k][0]
            if any(name in holds.get(x, ()) for x in range(j, m + 1)) or inside.get(j, set()) & inside.get(m, set()):
                continue
            for x in range(j, m + 1):
                holds.setdefault(x, set()).add(name)
                inside.setdefault(x, set()).add(len(kept))
            kept.append((j, m))
        return kept

    def scan(self, texts: list[bytes | None]) -> list[list[tuple[str, float, int, int]]]:
        """For each text: (licence, Dice, first line, lines) of each match. Inside, a "line" is a segment."""
        tokens: list[bytes] = []
        ends = []
        for t in texts:
            tokens += TOKEN.findall(t.lower()) if t else []
            tokens.append(b"\n")
            ends.append(len(tokens))
        get = self.known.get
        ids = np.fromiter((get(w, 0) for w in tokens), np.int64, len(tokens))
        cut = ids < 0
        pair = np.zeros(len(ids) + 1, np.int64)  # prefix sums over bigrams that begin before a place; those over a line's end count, too
        solid = np.flatnonzero(~cut)
        hit = np.zeros(len(ids), np.int64)
        if len(solid) > 1:
            hit[solid[:-1]] = self.pair[ids[solid[:-1]] * self.width + ids[solid[1:]]] >= 0
        np.cumsum(hit, out=pair[1:])
        count = np.concatenate([[0], np.cumsum(~cut)])
        line_end = np.flatnonzero(cut)
        line_begin = np.concatenate([[0], line_end[:-1] + 1])
        least = self.threshold / (2 - self.threshold)
        line_doc = np.searchsorted(ends, line_begin, side="right")
        doc_line = np.searchsorted(line_doc, np.arange(len(texts)))
        size = count[line_end] - count[line_begin]
        # A line's last word and the next line's first are a bigram of paragraphs and runs only.
        inner = pair[np.maximum(line_end - 1, line_begin)] - pair[line_begin]
        likely = (size >= 2) & (inner >= least * (size - 1) - 1e-9)
        dense = (size > 0) & (pair[line_end] - pair[line_begin] >= 0.5 * np.maximum(size - 1, 1)) | (size == 1)
        units = {(int(b), int(b)) for b in np.flatnonzero(likely)}
        new_doc = np.concatenate([[True], line_doc[1:] != line_doc[:-1]]) if len(line_doc) else np.zeros(0, bool)
        spans = [(doc_line, np.concatenate([doc_line[1:], [len(line_doc)]]) - 1)]
        for on in (size > 0, dense):
            first = on & (new_doc | ~np.concatenate([[False], on[:-1]]))
            last = on & np.concatenate([new_doc[1:] | ~on[1:], [True]])
            spans.append((np.flatnonzero(first), np.flatnonzero(last)))
        for lo, hi in spans:
            n = count[line_end[hi]] - count[line_begin[lo]]
            hits = pair[line_end[hi]] - pair[line_begin[lo]]  # one too many at most
            ok = (n >= 2) & (hi > lo) & (hits >= least * (n - 1) - 1e-9)
            units |= set(zip(lo[ok].tolist(), hi[ok].tolist(), strict=True))
        filled = np.flatnonzero(size > 0)
        units |= {(int(filled[j]), int(filled[m])) for j, m in self.windows(ids[solid], count[line_begin[filled]], count[line_end[filled]], line_doc[filled])}
        matches = []
        for lo, hi in units:
            got = self.best([w for w in tokens[line_begin[lo] : line_end[hi]] if w not in CUTS])
            if got:
                matches.append((-got[0], lo - hi, lo, hi, got[1]))
        breaks = np.concatenate([[0], np.cumsum(np.fromiter((w == b"\n" for w in tokens), bool, len(tokens)))])
        kept: dict[int, list[tuple[int, int, str]]] = {}
        out: list[list[tuple[str, float, int, int]]] = [[] for _ in texts]
        for d, _, lo, hi, name in sorted(matches):
            doc = int(line_doc[lo])
            own = kept.setdefault(doc, [])
            if any((a <= hi and lo <= b) if name == other else (a <= lo and hi <= b) for a, b, other in own):
                continue
            own.append((lo, hi, name))
            first, last = (int(breaks[line_begin[x]] - breaks[line_begin[doc_line[doc]]]) for x in (lo, hi))
            out[doc].append((name, -d, first, last - first + 1))
        return [sorted(m, key=lambda x: (x[2], x[3], x[0])) for m in out]


@lru_cache(4)
def scanner(templates: tuple[tuple[str, str], ...], threshold: float) -> Scanner:
    return Scanner(templates, threshold)


MATCH = T.ArrayType(T.StructType([T.StructField("license", T.StringType()), T.StructField("dice", T.DoubleType()), T.StructField("first_line", T.LongType()), T.StructField("lines", T.LongType())]))


def license_scan(docs: DataFrame, templates: dict[str, list[str]] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """A row for each row of docs: id, matches (license, dice, first_line from 0, lines)."""
    flat = tuple((name, t) for name in sorted(templates) for t in templates[name])
    kind = pa.list_(pa.struct([("license", pa.string()), ("dice", pa.float64()), ("first_line", pa.int64()), ("lines", pa.int64())]))

    def work(texts: list[bytes | None]) -> dict[str, object]:
        found = scanner(flat, threshold).scan(texts)
        return {"matches": pa.array([[dict(zip(("license", "dice", "first_line", "lines"), m, strict=True)) for m in x] for x in found], kind)}

    return map_chunks(id_text(docs, id_col, text_col), work, [T.StructField("matches", MATCH)], id_col)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best licence of each document (highest Dice, then first in the text), and all it matches."""
    found = license_scan(table(spark, sf_dir, "documents"))
    best = F.element_at(F.array_sort(F.transform("matches", lambda m: F.struct((-m["dice"]).alias("d"), m["first_line"].alias("l"), m["license"].alias("license")))), 1)
    return found.select("doc_id", F.when(F.size("matches") > 0, best["license"]).alias("license"), F.when(F.size("matches") > 0, F.round(-best["d"], 6)).alias("dice"), F.size("matches").alias("n_matches"), F.array_join(F.array_sort(F.array_distinct(F.col("matches.license"))), ",").alias("licenses"))
