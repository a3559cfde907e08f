"""Language ID by cross-parsing entropy.

For each language a suffix automaton is built of labelled text. A text is parsed greedily into the
longest matches that the automaton knows; the number of these phrases times log2 of the reference's
length, over the characters of the text, is its cross-parsing entropy (bits a character), and the
language that needs fewest bits wins. The parse of a text is unbroken. To let no Python loop run over characters, all
texts of a chunk are parsed in pieces side by side, one numpy step for a character of each; pieces are then joined by
parsing on from the piece before until both parses are in one state (Parser.parse), which gives the unbroken parse.

Learning takes at most SAMPLE_DOCS rows a language, those with the smallest crc32 of id and seed among the rows that may
be learned from, and REFERENCE_CHARS characters of each language: whole texts where they fit, otherwise the longest are
held at the length with which all fit, in PARTS parts spread evenly over the text. These are the only bounds; every text
is scored whole. The automata are sent to the tasks as the reference texts and built once in each Python worker; their
transitions are one table of states and letters up to DENSE entries, and beyond that a sorted list of those that there
are, at most three for each reference character.

Defined results: null text or a text without any letter is "und" with score 0; letters that no language
has count as a phrase each for every language; ties go to the language that sorts first; rows with a
null language aren't learned from; without anything to learn from all is "und"; repeated rows get equal
results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isoforge.llm.common import bucket4, chunks, id_text, joined, longest_part, materialise, spread_pieces, table

SAMPLE_DOCS = 60
REFERENCE_CHARS = 24_000
PARTS = 4
#: Pieces of this many characters walk side by side, so many at once.
PIECE = 1024
BATCH = 2048
DENSE = 16_000_000


def suffix_automaton(text: np.ndarray) -> list[dict[int, int]]:
    """letter -> state for each state of the suffix automaton of text; state 0 is the root."""
    nxt: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in text.tolist():
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return nxt


class Parser:
    """The automata of all languages over one alphabet."""

    def __init__(self, references: tuple[tuple[str, str], ...], dense: int = DENSE):
        self.langs = [lang for lang, _ in references]
        normal = [" ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " " for _, text in references]
        letters = sorted(set().union(*normal))
        self.alphabet = len(letters) + 1  # the last is for letters of none
        self.code = np.full(0x110000, self.alphabet - 1, np.uint16)
        for i, c in enumerate(letters):
            self.code[ord(c)] = i
        self.space = letters.index(" ")
        tables = [suffix_automaton(self.code[[ord(c) for c in t]]) for t in normal]
        sizes = np.cumsum([0, *map(len, tables)])
        self.root = sizes[:-1].astype(np.int32)
        # the states of all automata are numbered on; a transition's key is its state and letter
        arcs = np.array([((s + k) * self.alphabet + c, to + s) for t, s in zip(tables, sizes, strict=False) for k, x in enumerate(t) for c, to in x.items()], np.int64).reshape(-1, 2)
        self.arcs = arcs[np.argsort(arcs[:, 0])]
        self.next = None
        if sizes[-1] * self.alphabet <= dense:
            self.next = np.full(sizes[-1] * self.alphabet, -1, np.int32)
            self.next[arcs[:, 0]] = arcs[:, 1]
        self.cost = np.array([np.log2(len(t)) for t in normal])

    def codes(self, text: str) -> np.ndarray:
        """Letters as numbers, all else as one space."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = self.code[points]
        odd = codes == self.alphabet - 1
        if odd.any():
            at = np.flatnonzero(odd)
            kinds, where = np.unique(points[at], return_inverse=True)
            codes[at[np.array([not chr(k).isalpha() for k in kinds.tolist()])[where]]] = self.space
        keep = np.ones(len(codes), bool)
        keep[1:] = (codes[1:] != self.space) | (codes[:-1] != self.space)
        return codes[keep]

    def go(self, state: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """The state behind a letter, -1 where there is none."""
        key = state.astype(np.int64) * self.alphabet + letter
        if self.next is not None:
            return self.next[key]
        at = np.minimum(np.searchsorted(self.arcs[:, 0], key), len(self.arcs) - 1)
        return np.where(self.arcs[at, 0] == key, self.arcs[at, 1], -1).astype(np.int32)

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(texts, languages) phrases, and the characters of each text; 0 characters if it has no letter."""
        coded = [self.codes(t) for t in texts]
        has = np.array([bool((c != self.space).any()) for c in coded], bool)
        out = np.zeros((len(texts), len(self.langs)), np.int64)
        pieces = [(i, b) for i, c in enumerate(coded) if has[i] for b in range(0, len(c), PIECE)]
        enter = self.root  # the last state of the piece before
        for k in range(0, len(pieces), BATCH):
            batch = pieces[k : k + BATCH]
            made, leave = self.parse([coded[i][b : b + PIECE] for i, b in batch], np.array([b > 0 for _, b in batch]), enter)
            ends = np.array([b + PIECE >= len(coded[i]) for i, b in batch])  # the open phrase ends with the text
            np.add.at(out, [i for i, _ in batch], (made + (ends & (leave != self.root[:, None]))).T)
            enter = leave[:, -1]
        return out, np.where(has, [len(c) for c in coded], 0)

    def step(self, state: np.ndarray, letter: np.ndarray, root: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states after a letter, and the phrases that end by it."""
        to = self.go(state, letter)
        miss = to < 0
        if not miss.any():
            return to, miss.astype(np.uint8)
        again = self.go(root, letter)
        ended = (miss & (state != root)).astype(np.uint8) + (miss & (again < 0))  # one before the letter; the letter, if the language has none
        return np.where(miss, np.where(again < 0, root, again), to), ended

    def parse(self, pieces: list[np.ndarray], goes_on: np.ndarray, enter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(languages, pieces) phrases that end in a piece, and the states behind it, of an unbroken parse.

        All pieces are parsed side by side as if a phrase began with each. Then a piece that goes on is parsed again from
        the state behind the piece before, up to the place where both parses are in one state: from there on they are
        the same. A piece in which that doesn't happen gets another last state, so the piece behind it is done again.
        """
        size = np.array([len(p) for p in pieces])
        order = np.argsort(-size, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        height, width, langs = int(size.max()), len(pieces), len(self.langs)
        grid = np.zeros((height, width), np.uint16)
        for k, i in enumerate(order):
            grid[: size[i], k] = pieces[i]
        live = np.searchsorted(-size[order], -np.arange(1, height + 1), side="right")
        root = np.repeat(self.root[:, None], width, 1)
        states, ends = np.zeros((height, langs, width), np.int32), np.zeros((height, langs, width), np.uint8)
        state = root.copy()
        for at in range(height):
            w = live[at]
            state[:, :w], ends[at, :, :w] = self.step(state[:, :w], grid[at, :w], root[:, :w])
            states[at, :, :w] = state[:, :w]
        made, leave = ends.sum(0, dtype=np.int64), state
        before = np.where(np.arange(width) > 0, place[np.arange(width) - 1], -1)  # by piece: the column of the one before
        todo = np.flatnonzero(goes_on)
        while len(todo):
            col, prior = place[todo], before[todo]
            came = np.where(prior < 0, enter[:, None], leave[:, prior])
            lang, k = np.nonzero(came != root[:, col])  # else the parse is right as it is
            new_made, new_leave = made.copy(), leave.copy()
            new_made[:, col], new_leave[:, col] = ends[:, :, col].sum(0, dtype=np.int64), self.last(states, size, order, col)
            c, now = col[k], came[lang, k]
            more = np.zeros(len(c), np.int64)  # phrases of this parse less those of the other
            for at in range(height):
                on = at < size[order[c]]
                if not on.all():  # parsed to the end without meeting
                    new_leave[lang[~on], c[~on]] = now[~on]
                    np.add.at(new_made, (lang[~on], c[~on]), more[~on])
                    lang, c, now, more = lang[on], c[on], now[on], more[on]
                if not len(c):
                    break
                now, ended = self.step(now, grid[at, c], self.root[lang])
                more += ended.astype(np.int64) - ends[at, lang, c]
                met = now == states[at, lang, c]
                np.add.at(new_made, (lang[met], c[met]), more[met])
                lang, c, now, more = lang[~met], c[~met], now[~met], more[~met]
            new_leave[lang, c] = now
            np.add.at(new_made, (lang, c), more)
            changed = (new_leave != leave).any(0)
            made, leave = new_made, new_leave
            behind = np.flatnonzero(goes_on & (before >= 0) & changed[before])
            todo = behind
        return made[:, place], leave[:, place]

    def last(self, states: np.ndarray, size: np.ndarray, order: np.ndarray, col: np.ndarray) -> np.ndarray:
        """The states behind pieces in the parse that began with each of them."""
        return states[size[order[col]] - 1, :, col].T

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Languages, scores, bits a character of the language chosen."""
        made, n = self.phrases(texts)
        bits = made * self.cost / np.maximum(n, 1)[:, None]
        best = bits.argmin(1)
        # How far the other languages are behind, as a share in [0, 1).
        weight = np.exp2(-(bits - bits.min(1, keepdims=True)) * 8)
        score = np.where(n > 0, 1 / weight.sum(1), 0.0)
        return [self.langs[b] if k else "und" for b, k in zip(best.tolist(), n.tolist(), strict=True)], score, bits[np.arange(len(n)), best]


@lru_cache(2)
def parser(references: tuple[tuple[str, str], ...]) -> Parser:
    return Parser(references)


def learn(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS, reference_chars: int = REFERENCE_CHARS, seed: int = 1) -> tuple[tuple[str, str], ...]:
    """((language, reference text), ...) from at most sample_docs rows a language.

    The rows are the smallest by a hash: Spark keeps the least for each language within each map task before it shuffles them.
    """
    rows = labelled.select(F.col(lang_col).cast("string").alias("__l"), F.crc32(F.concat_ws(":", F.lit(seed), F.col(id_col).cast("string")).cast("binary")).alias("__k"), F.col(id_col).cast("string").alias("__i"), F.col(text_col).cast("string").alias("__t"))
    rows = rows.where("__l is not null and trim(__t) <> ''")
    first = F.row_number().over(Window.partitionBy("__l").orderBy("__k", "__i", F.xxhash64("__t")))
    rows = materialise(rows.withColumn("__n", first).where(F.col("__n") <= sample_docs).select("__l", "__n", "__t", F.octet_length("__t").alias("__b")), "references")
    sizes: dict[str, dict[int, int]] = {}
    for r in rows.groupBy("__l", "__b").count().collect():  # at most sample_docs a language
        sizes.setdefault(r["__l"], {})[r["__b"]] = r["count"]
    most = {lang: max(PARTS, longest_part(own, reference_chars)) for lang, own in sizes.items()}
    bound = F.coalesce(*(F.when(F.col("__l") == lang, n) for lang, n in most.items()), F.lit(reference_chars)) if most else F.lit(reference_chars)
    got: dict[str, list[str]] = {}
    for lang, _, pieces in sorted((r["__l"], r["__n"], r["__t"]) for r in rows.select("__l", "__n", spread_pieces(F.col("__t"), F.col("__b"), bound, PARTS).alias("__t")).collect()):
        got.setdefault(lang, []).append(joined(pieces).decode("utf-8", "ignore"))
    return tuple((lang, "\n".join(texts)) for lang, texts in sorted(got.items()) if any(c.isalpha() for t in texts for c in t))


def identify(docs: DataFrame, references: tuple[tuple[str, str], ...], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of docs: id, lang_pred, score, bits_per_char."""
    rows = id_text(docs, id_col, text_col)
    schema = T.StructType([T.StructField(id_col, rows.schema["__id"].dataType), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("bits_per_char", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, _ in chunks(batches):
            if references:
                langs, score, bits = parser(references).predict([(t or b"").decode("utf-8", "replace") for t in texts])
            else:
                langs, score, bits = ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([ids, pa.array(langs), pa.array(score), pa.array(bits)], names=schema.names)

    return rows.mapInArrow(run, schema)


def op2_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from rows whose crc32(doc_id) mod 4 isn't 2."""
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, learn(docs.where(bucket4() != 2)))
    return found.select("doc_id", (bucket4() == 2).alias("held_out"), "lang_pred", "score", "bits_per_char")
