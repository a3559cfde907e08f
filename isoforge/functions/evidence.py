"""Evidence references: key lists, the entry's dictionary, code resolution and confidence."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Confidence by evidence code; any other code, or none, has LOWEST.
CONFIDENCE = {
    "ECO:0000269": 1.0,
    "ECO:0007744": 0.8,
    "ECO:0000250": 0.4,
    "ECO:0000255": 0.1,
}
LOWEST = 0.1
# Codes that count as experimental, in lower case.
EXPERIMENTAL = ("eco:0000269", "eco:0007744")


def no_strings() -> Column:
    return F.array().cast("array<string>")


def evidence_keys(refs: Column) -> Column:
    """Keys of a white-space separated attribute; none for null."""
    return F.coalesce(F.filter(F.split(refs, r"\s+"), lambda t: t != ""), no_strings())


def codes_of(keys: Column, dictionary: Column) -> Column:
    """Codes of keys in a dictionary array<struct<_key,_type>>: order and repeats stay, unknown keys go, the last of equal keys counts."""
    found = F.transform(keys, lambda k: F.try_element_at(F.filter(dictionary, lambda e: e["_key"] == k), F.lit(-1))["_type"])
    return F.coalesce(F.filter(found, lambda c: c.isNotNull()), no_strings())


def joined_codes(codes: Column) -> Column:
    """Codes joined by ';', or null if there is none (a code may be empty text)."""
    return F.when(F.size(codes) > 0, F.array_join(codes, ";"))


def code_confidence(code: Column) -> Column:
    out = F.lit(LOWEST)
    for known, value in CONFIDENCE.items():
        out = F.when(code == known, F.lit(value)).otherwise(out)
    return out


def confidence_of(codes: Column) -> Column:
    """Largest confidence of the codes, FLOAT."""
    best = F.array_max(F.transform(codes, code_confidence))
    return F.greatest(F.lit(LOWEST), F.coalesce(best, F.lit(LOWEST))).cast("float")


def is_experimental(code: Column) -> Column:
    low = F.lower(code)
    out = F.lit(False)
    for known in EXPERIMENTAL:
        out = out | low.contains(known)
    return out
