"""Residues and coordinate edits: how positions of the canonical sequence map to an isoform's."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from isoforge.functions.binding import bind

UNRESOLVABLE, DELETED, OUT_OF_BOUNDS = "VSP_UNRESOLVABLE", "VSP_DELETION_EVENT", "MAPPER_OOB"
#: Types of features that describe another sequence.
SPLICE_VARIANT, VARIANT_SEQUENCE = "splice variant", "variant sequence"

EDIT = "struct<b:int,e:int,ord:int,d:int,gone:boolean>"


def residue_at(sequence: Column, position: Column) -> Column:
    """The residue at a 1-based position; null outside the sequence."""
    return F.when((position >= 1) & (position <= F.length(sequence)), F.substr(sequence, position, F.lit(1)))


def residue_length(text: Column) -> Column:
    """Length of a text of residue letters only, else 0 (blank, spaces within, digits, anything else)."""
    t = F.regexp_replace(text, r"^\s+|\s+$", "")
    return F.when(t.rlike("^[A-Za-z]+$"), F.length(t)).otherwise(0)


def is_missing(variation: Column, description: Column) -> Column:
    """Does either text say that the segment is missing?"""
    says = lambda c: F.lower(F.coalesce(c, F.lit(""))).contains("missing")
    return says(variation) | says(description)


def edit_of(feature: Column) -> Column:
    """The edit that a feature (type, description, start, end, ord, variation) describes, or null if its length isn't known."""

    def of(new: Column) -> Column:
        gone = ((feature["type"] == SPLICE_VARIANT) & (new <= 0)) | is_missing(feature["variation"], feature["description"])
        return bind(gone, lambda g: edit(new, g))

    def edit(new: Column, gone: Column) -> Column:
        delta = F.when(gone, F.lit(0)).otherwise(new) - (feature["end"] - feature["start"] + 1)
        made = F.struct(feature["start"].alias("b"), feature["end"].alias("e"), feature["ord"].cast("int").alias("ord"), delta.cast("int").alias("d"), gone.alias("gone"))
        return F.when(gone | (new > 0), made)

    return bind(residue_length(F.coalesce(feature["variation"], F.lit(""))), of)


def edits_of(features: Column, variant_ids: Column) -> Column:
    """Edits of the features named in variant_ids, in order of their begin, equal ones as in the text."""

    def applies(f: Column) -> Column:
        placed = (f["start"] > 0) & (f["end"] > 0) & (f["end"] >= f["start"])
        return F.coalesce(f["type"].isin(SPLICE_VARIANT, VARIANT_SEQUENCE) & F.array_contains(variant_ids, f["id"]) & placed, F.lit(False))

    found = F.transform(F.filter(features, applies), edit_of)
    return F.coalesce(F.array_sort(F.filter(found, lambda e: e.isNotNull())), F.array().cast(f"array<{EDIT}>"))


def map_position(edits: Column, position: Column) -> Column:
    """struct(pos, code): the mapped 1-based position, or why there is none.

    The first edit that holds the position decides; edits before it shift it.
    """
    start = F.struct(F.lit(0).alias("shift"), F.lit(False).alias("stop"), F.lit(None).cast("string").alias("code"))

    def step(acc: Column, e: Column) -> Column:
        past, before = position > e["e"], position < e["b"]
        code = F.when(e["gone"], F.lit(DELETED)).when((e["d"] == 0) | (position == e["b"]), F.lit(None).cast("string")).otherwise(F.lit(UNRESOLVABLE))
        return (
            F.when(acc["stop"], acc)
            .when(past, F.struct((acc["shift"] + e["d"]).alias("shift"), F.lit(False).alias("stop"), F.lit(None).cast("string").alias("code")))
            .otherwise(F.struct(acc["shift"].alias("shift"), F.lit(True).alias("stop"), F.when(~before, code).alias("code")))
        )

    def finish(acc: Column) -> Column:
        to = position + acc["shift"]
        code = F.when((position <= 0) | position.isNull(), F.lit(UNRESOLVABLE)).when(acc["code"].isNotNull(), acc["code"]).when(to <= 0, F.lit(OUT_OF_BOUNDS))
        return F.struct(F.when(code.isNull(), to).cast("int").alias("pos"), code.alias("code"))

    return F.aggregate(edits, start, step, finish)


def map_range(edits: Column, canonical: Column, isoform: Column, start: Column, end: Column) -> Column:
    """struct(start, end) of a mapped range, or null if it isn't whole inside both sequences."""
    inside = (start > 0) & (end > 0) & (end >= start) & (F.length(canonical) > 0) & (end <= F.length(canonical)) & (F.length(isoform) > 0)
    n = F.length(isoform)

    def fit(a: Column, b: Column) -> Column:
        return F.when((a > 0) & (b >= a) & (b <= n), F.struct(a.alias("start"), b.alias("end")))

    mapped = bind(map_position(edits, start)["pos"], lambda a: bind(F.when(end == start, a).otherwise(map_position(edits, end)["pos"]), lambda b: fit(a, b)))
    return F.when(F.coalesce(inside, F.lit(False)), mapped)


def edit_count(edits: Column) -> Column:
    return F.size(edits)


def total_delta(edits: Column) -> Column:
    return F.aggregate(edits, F.lit(0), lambda s, e: s + e["d"])
