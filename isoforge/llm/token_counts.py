"""Token counts with overlap resynchronisation for huge documents.

Texts up to CHUNK_CHARS characters go to the library whole. A longer one is encoded in chunks that overlap by
OVERLAP_CHARS, with offsets. A chunk's end may cut a token, so two neighbouring chunks are spliced where they are known
to agree: at a stable boundary of the overlap, a place between a character that isn't white space and one that is, where
both chunks have a token that ends there and a next token that starts at the same place. Where an overlap has no such
boundary, it is widened (doubled, up to the whole text), so the count is always the library's count of the whole text.
Nothing is truncated, padded or added.

That such a boundary is stable must hold for the tokenizer, so its file is looked at when it is loaded (splits_at_space):
no step may look across from a character to the white space behind it or back. Known steps are normalisers that work
character by character or within runs of one kind, the byte-level pre-tokenizer with its own pattern, and patterns of
classes without look-around. Added tokens must hold no white space and strip none. With any other tokenizer, texts of all
lengths are encoded whole.

Defined results: null counts as empty: 0 bytes, 0 tokens; special strings in texts are handled as the
library does; repeated rows get equal results; a null id stays null; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isoforge.llm.common import id_text, map_chunks, table

CHUNK_CHARS = 8192
OVERLAP_CHARS = 256
LIMIT = 2048
#: Patterns (fixed values, of tokenizer files) none of whose matches begins at a character and goes on over white space.
SPACE_PATTERNS = {r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}
BLANKS = " \t\n\r"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(4)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def steps(part: dict | None, inner: str) -> list[dict]:
    """The steps of a tokenizer file's normalizer or pre_tokenizer."""
    if part is None:
        return []
    return part[inner] if part["type"] == "Sequence" else [part]


@lru_cache(4)
def splits_at_space(path: str) -> bool:
    """Is every place between a character and white space behind it a token's end, whatever surrounds it?"""
    with open(path, encoding="utf-8") as f:
        j = json.load(f)
    blank = {"Regex": r"\s+"}
    normal = all(n["type"] in ("NFC", "Lowercase") or (n["type"] == "Replace" and n["pattern"] == blank and n["content"] == " ") for n in steps(j["normalizer"], "normalizers"))
    cuts = bare = False
    for p in steps(j["pre_tokenizer"], "pretokenizers"):
        if p["type"] == "ByteLevel" and not p["add_prefix_space"]:
            cuts |= p.get("use_regex", True)
        elif p["type"] == "Split" and p["pattern"].get("Regex") in SPACE_PATTERNS and p["behavior"] == "Removed" and p["invert"]:
            cuts = True
        else:
            bare = True
    added = any(a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"] or any(c.isspace() for c in a["content"]) for a in j["added_tokens"])
    return normal and cuts and not bare and not added and j["model"]["type"] == "BPE" and not j["model"].get("dropout")


Offsets = list[tuple[int, int]]


def ends_at_blanks(text: str, offsets: Offsets, at: int, low: int, high: int) -> dict[int, tuple[int, int]]:
    """place -> (tokens up to it, where the next token starts), of boundaries in text[low:high]. offsets count from at."""
    out = {}
    for k in range(len(offsets) - 1):
        e, s = offsets[k][1] + at, offsets[k + 1][0] + at
        if low < e < high and e <= s and text[e] in BLANKS and not text[e - 1].isspace():
            out[e] = k + 1, s
    return out


def stable_boundary(text: str, low: int, high: int, left: Offsets, left_at: int, right: Offsets, right_at: int) -> tuple[int, int] | None:
    """(tokens kept of left, tokens dropped of right) at the last boundary in text[low:high] that both agree on."""
    mine, other = ends_at_blanks(text, left, left_at, low, high), ends_at_blanks(text, right, right_at, low, high)
    for e in sorted(mine.keys() & other.keys(), reverse=True):
        if mine[e][1] == other[e][1]:
            return mine[e][0], other[e][0]
    return None


def encode_long(t, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> Iterator[list[int]]:
    """The ids of a text longer than a chunk, piece by piece; t must split at white space (splits_at_space)."""
    end = min(len(text), chunk)
    begin, skip, given = 0, 0, 0  # skip: of the chunk's tokens, those that are given already
    left = t.encode(text[:end], add_special_tokens=False)
    while end < len(text):
        width = overlap
        while True:
            at, stop = max(0, end - width), min(len(text), end + max(chunk, width))
            right = t.encode(text[at:stop], add_special_tokens=False)
            if not at:  # widened to the text's beginning, so right begins with what is given
                found = skip, given
                break
            found = stable_boundary(text, max(at, begin), end, left.offsets, begin, right.offsets, at)
            if found and found[0] >= skip:
                break
            width *= 2
        yield left.ids[skip : found[0]]
        given += found[0] - skip
        left, begin, skip, end = right, at, found[1], stop
    yield left.ids[skip:]


def count_long(t, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> int:
    return sum(map(len, encode_long(t, text, chunk, overlap)))


def count_tokens(texts: list[bytes | None], path: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> np.ndarray:
    t, may_cut = tokenizer(path), splits_at_space(path)
    out = np.zeros(len(texts), np.int64)
    whole: list[tuple[int, str]] = []
    for i, x in enumerate(texts):
        s = (x or b"").decode("utf-8", "replace")
        if may_cut and len(s) > chunk:
            out[i] = count_long(t, s, chunk, overlap)
        elif s:
            whole.append((i, s))
    for (i, _), e in zip(whole, t.encode_batch_fast([s for _, s in whole], add_special_tokens=False), strict=True):
        out[i] = len(e)
    return out


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """A row for each row of docs: id, n_bytes, n_tokens, over_limit."""

    def work(texts: list[bytes | None]) -> dict[str, object]:
        n = count_tokens(texts, path, chunk, overlap)
        return {"n_bytes": np.array([len(t or b"") for t in texts], np.int64), "n_tokens": n, "over_limit": n > limit}

    fields = [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())]
    return map_chunks(id_text(docs, id_col, text_col), work, fields, id_col)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json")).select("doc_id", "n_bytes", "n_tokens", F.col("over_limit"))
