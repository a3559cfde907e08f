"""Results as text, for console and log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isoforge.functions.modifications import shortened
from isoforge.plans import analytics

WIDTH = 40


def render(df: DataFrame, title: str, rows: int = 50) -> str:
    """The first rows of a small result, in columns."""
    cut = lambda v: (f"{v:.2f}" if isinstance(v, float) else "" if v is None else str(v))
    short = [shortened(F.col(f.name), WIDTH).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in df.schema.fields]
    table = [df.columns, *([cut(v) for v in r] for r in df.limit(rows).select(*short).collect())]
    widths = [max(len(r[i]) for r in table) for i in range(len(df.columns))]
    lines = ["  ".join(v.ljust(w) for v, w in zip(r, widths, strict=True)).rstrip() for r in table]
    return "\n".join([title, "=" * len(title), lines[0], "  ".join("-" * w for w in widths), *lines[1:]])


def oglcnac_report(table: DataFrame) -> str:
    groups = analytics.oglcnac_evidence(analytics.flat_features(table))
    return render(groups, "O-GlcNAc evidence") + "\n\n" + render(analytics.evidence_buckets(groups), "Experimental or not")


def spectrum_report(table: DataFrame, least: int = analytics.LEAST_SITES) -> str:
    stats = analytics.modification_spectrum(analytics.flat_features(table), least)
    return render(analytics.ranked(stats), "Modifications by experimental share") + "\n\n" + render(analytics.spectrum_totals(stats), "Totals")


def cooccurrence_report(table: DataFrame) -> str:
    found = analytics.sites(analytics.flat_features(table))
    parts = ((analytics.presence(found), "Rows by kind of site"), (analytics.cooccurrence(found), "Sites"), (analytics.overlap_examples(found), "Examples of overlap"), (analytics.site_evidence(found).orderBy("kind", "evidence"), "Evidence"))
    return "\n\n".join(render(df, title) for df, title in parts)


def inspection(table: DataFrame, ids: tuple[str, ...]) -> str:
    schema = "\n".join(f"{n}: {t}{'' if null else ' not null'}" for n, t, null in analytics.describe_schema(table))
    return schema + "\n\n" + render(analytics.point_lookup(table, ids).select("id", "parent_id", "gene_name", "organism_id"), "First match")
