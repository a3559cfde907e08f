"""Post-translational modifications: which features count, their kinds, and validation of their sites."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from isoforge.functions.binding import bind
from isoforge.functions.residues import map_position, residue_at

# Feature types, failure codes, and the wording by which kinds are told apart, in order.
POINT_TYPES = ("glycosylation site", "modified residue", "cross-link")
MODIFICATION_TYPES = ("modified residue", "lipidation", "glycosylation site", "cross-link")
CANONICAL_OOB, ISOFORM_OOB, RESIDUE_MISMATCH = "CANONICAL_OOB", "ISOFORM_OOB", "RESIDUE_MISMATCH"
FAILURES = (CANONICAL_OOB, "VSP_DELETION_EVENT", "MAPPER_OOB", "VSP_UNRESOLVABLE", ISOFORM_OOB, RESIDUE_MISMATCH)
KINDS = (
    (("acetyl",), "Acetylation"),
    (("methyl",), "Methylation"),
    (("ubiquit",), "Ubiquitination"),
    (("sumoyl",), "Sumoylation"),
    (("glcnac", "n-acetylglucosamine"), "O-GlcNAc"),
    (("palmitoyl",), "Palmitoylation"),
    (("myristoyl",), "Myristoylation"),
    (("hydroxyl",), "Hydroxylation"),
    (("glycat", "glycosyl"), "Glycosylation"),
    (("nitro",), "Nitration"),
    (("carboxyl",), "Carboxylation"),
    (("oxidation",), "Oxidation"),
)
FIRST_WORD = 30


def is_point_modification(f: Column) -> Column:
    """A modification of one residue with a known place."""
    return F.coalesce(F.lower(f["type"]).isin(*POINT_TYPES) & (f["start"] > 0) & (f["end"] > 0) & (f["start"] == f["end"]), F.lit(False))


def modification_code(kind: Column, description: Column) -> Column:
    """1 phosphorylation of a residue, 2 N-acetylglucosamine glycosylation, else 0."""
    kind, text = F.lower(kind), F.lower(F.coalesce(description, F.lit("")))
    return F.when((kind == "modified residue") & text.contains("phospho"), 1).when((kind == "glycosylation site") & text.contains("n-acetylglucosamine"), 2).otherwise(0).cast("int")


def is_modification(kind: Column, description: Column) -> Column:
    return (kind.isin(*MODIFICATION_TYPES) | kind.contains("modification")) & description.isNotNull()


def is_oglcnac(kind: Column, description: Column) -> Column:
    text = F.lower(description)
    return (F.lower(kind).contains("glyc") | (kind == "modified residue")) & description.isNotNull() & (text.contains("o-glcnac") | text.contains("n-acetylglucosamine") | text.contains("glcnac"))


def is_phospho(kind: Column, description: Column) -> Column:
    return (kind == "modified residue") & F.lower(description).contains("phospho")


def modification_kind(description: Column) -> Column:
    """The kind by wording, else the description's first word, or its first 30 characters if that is longer."""
    text = F.lower(description)
    first = F.coalesce(F.try_element_at(F.filter(F.split(description, r"\s+"), lambda t: t != ""), F.lit(1)), description)
    out = F.when(F.length(first) <= FIRST_WORD, first).otherwise(F.substring(description, 1, FIRST_WORD))
    for wording, name in reversed(KINDS):
        says = F.lit(False)
        for w in wording:
            says = says | text.contains(w)
        out = F.when(says, F.lit(name)).otherwise(out)
    phospho = F.when(text.contains("serine"), "Phosphoserine").when(text.contains("threonine"), "Phosphothreonine").when(text.contains("tyrosine"), "Phosphotyrosine").otherwise("Phosphorylation")
    return F.when(text.contains("phospho"), phospho).otherwise(out)


def amino_acid(description: Column) -> Column:
    text = F.lower(description)
    return F.when(text.contains("ser"), "Ser").when(text.contains("thr"), "Thr").when(text.contains("tyr"), "Tyr").otherwise("Unknown")


def shortened(text: Column, width: int) -> Column:
    """For display: cut to width with '...'."""
    return F.when(F.length(text) <= width, text).otherwise(F.concat(F.substring(text, 1, max(0, width - 3)), F.lit("...")))


def judged_sites(features: Column, canonical: Column, isoform: Column, edits: Column, same: Column) -> Column:
    """Every point modification with its fate: array<struct<start, pos, aa, code, mod_type, confidence>>.

    same: is the row the canonical entry itself? Then positions aren't mapped. code: null if the site is mapped.
    """

    def judge(f: Column, known_edits: Column) -> Column:
        own = residue_at(canonical, f["start"])
        mapped = F.when(same, F.struct(f["start"].alias("pos"), F.lit(None).cast("string").alias("code"))).otherwise(map_position(known_edits, f["start"]))

        def fate(m: Column) -> Column:
            there = residue_at(isoform, m["pos"])
            code = F.when(own.isNull(), F.lit(CANONICAL_OOB)).when(m["code"].isNotNull(), m["code"]).when(there.isNull(), F.lit(ISOFORM_OOB)).when(there != own, F.lit(RESIDUE_MISMATCH))
            return F.struct(f["start"].alias("start"), m["pos"].alias("pos"), own.alias("aa"), code.alias("code"), modification_code(f["type"], f["description"]).alias("mod_type"), f["confidence"].alias("confidence"))

        return bind(mapped, fate)

    return bind(edits, lambda e: F.transform(F.filter(features, is_point_modification), lambda f: judge(f, e)))


def sites_of(judged: Column) -> Column:
    """Mapped modifications nested by site: array<struct<site_index, site_aa, modifications>>, sites ascending."""

    def nest(good: Column) -> Column:
        places = F.array_sort(F.array_distinct(F.transform(good, lambda j: j["pos"])))
        return F.transform(places, lambda p: bind(F.filter(good, lambda j: j["pos"] == p), lambda here: site(p, here)))

    def site(p: Column, here: Column) -> Column:
        mods = F.transform(here, lambda j: F.struct(j["mod_type"].alias("mod_type"), j["confidence"].alias("confidence_score")))
        return F.struct(p.alias("site_index"), F.get(here, F.lit(0))["aa"].alias("site_aa"), mods.alias("modifications"))

    return bind(F.filter(judged, lambda j: j["code"].isNull()), nest)
