"""Domain functions against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from isoforge.functions.evidence import codes_of, confidence_of, evidence_keys, joined_codes
from isoforge.functions.modifications import FAILURES, judged_sites, modification_kind, shortened, sites_of
from isoforge.functions.residues import EDIT, edits_of, map_position, map_range, residue_length
from isoforge.plans import analytics
from isoforge.sources.fasta import fasta_key


def reference_map(edits, pos):
    if pos <= 0:
        return None, "VSP_UNRESOLVABLE"
    shift = 0
    for b, e, _, d, gone in sorted(edits, key=lambda x: x[0]):
        if pos < b:
            break
        if pos > e:
            shift += d
            continue
        if gone:
            return None, "VSP_DELETION_EVENT"
        if d and pos != b:
            return None, "VSP_UNRESOLVABLE"
        break
    return (None, "MAPPER_OOB") if pos + shift <= 0 else (pos + shift, None)


def test_map_position_matches_loop(spark):
    rng = random.Random(7)
    cases = []
    for i in range(600):
        edits = []
        for k in range(rng.randrange(0, 5)):
            b = rng.randrange(1, 25)
            e = b + rng.randrange(0, 6)
            gone = rng.random() < 0.4
            edits.append((b, e, k, -(e - b + 1) if gone else rng.randrange(-4, 4), gone))
        cases.append((i, sorted(edits), rng.randrange(-1, 30)))
    cases.append((9999, [(1, 10, 0, -20, False)], 12))  # out of bounds by too large a shift
    df = spark.createDataFrame(cases, f"i int, edits array<{EDIT}>, pos int").select("i", map_position(F.col("edits"), F.col("pos")).alias("m"))
    got = {r.i: (r.m.pos, r.m.code) for r in df.collect()}
    assert got == {i: reference_map(e, p) for i, e, p in cases}
    assert got[9999] == (None, "MAPPER_OOB")


@pytest.mark.parametrize(("variation", "delta", "expected"), [("Missing", -3, {10: 7, 6: "VSP_DELETION_EVENT"}), ("A", -2, {5: 5, 6: "VSP_UNRESOLVABLE", 7: "VSP_UNRESOLVABLE", 10: 8}), ("AAA", 0, {5: 5, 6: 6, 7: 7, 10: 10})])
def test_edits(spark, variation, delta, expected):
    feature = [("variant sequence", "VSP_1", None, 5, 7, 0, variation)]
    df = spark.createDataFrame([(feature, list(expected))], "f array<struct<type:string,id:string,description:string,start:int,`end`:int,ord:int,variation:string>>, p array<int>")
    e = edits_of(F.col("f"), F.array(F.lit("VSP_1")))
    row = df.select(e.alias("e"), F.transform("p", lambda p: map_position(e, p)).alias("m")).first()
    assert row.e[0].d == delta
    assert {p: m.code or m.pos for p, m in zip(expected, row.m, strict=True)} == expected


def test_edit_rules(spark):
    kind = "f array<struct<type:string,id:string,description:string,start:int,`end`:int,ord:int,variation:string>>"
    rows = [
        ("splice variant", "V", None, 5, 7, 0, None),  # no variation: a deletion
        ("splice variant", "V", None, 5, 7, 1, "free text"),  # not residues: a deletion
        ("variant sequence", "V", None, 5, 7, 2, "free text"),  # unknown length: left out
        ("splice variant", "W", None, 5, 7, 3, "A"),  # another isoform's
        ("splice variant", "V", None, 7, 5, 4, "A"),  # reversed
        ("splice variant", "V", "is Missing here", 1, 1, 5, "A"),
        ("domain", "V", None, 5, 7, 6, "A"),
    ]
    got = spark.createDataFrame([(rows,)], kind).select(edits_of(F.col("f"), F.array(F.lit("V"))).alias("e")).first().e
    assert [(x.b, x.ord, x.gone) for x in got] == [(1, 5, True), (5, 0, True), (5, 1, True)]


def test_residue_length(spark):
    cases = {"AC GT": 0, "A1": 0, "ACGT": 4, "": 0, " X ": 1, "AcGt": 4, "A" * 51: 51, "Unknown": 7}
    df = spark.createDataFrame([(k,) for k in cases], "t string").select("t", residue_length(F.col("t")).alias("n"))
    assert {r.t: r.n for r in df.collect()} == cases


def test_evidence(spark):
    dictionary = "array(named_struct('_key','A','_type','x'),named_struct('_key','A','_type','ECO:0000269'),named_struct('_key','B','_type',''),named_struct('_key','C','_type','ECO:0000255'))"
    df = spark.createDataFrame([("A  B A",), (" ",), (None,), ("Z",), ("C",)], "r string")
    codes = codes_of(evidence_keys(F.col("r")), F.expr(dictionary))
    got = df.select(joined_codes(codes).alias("j"), confidence_of(codes).alias("c")).collect()
    assert [r.j for r in got] == ["ECO:0000269;;ECO:0000269", None, None, None, "ECO:0000255"]
    assert [round(r.c, 2) for r in got] == [1.0, 0.1, 0.1, 0.1, 0.1]


def test_fasta_keys(spark):
    cases = {"sp|P04637-2|X_HUMAN": "P04637-2", "tr|Q9-1|Y z": "Q9-1", "Q9-1 some text": "Q9-1", "a||b": "a||b", "": ""}
    df = spark.createDataFrame([(k,) for k in cases], "h string").select("h", fasta_key(F.col("h")).alias("k"))
    assert {r.h: r.k for r in df.collect()} == cases


def test_kinds_and_display(spark):
    cases = {"Phosphoserine; by X": "Phosphoserine", "phospho": "Phosphorylation", "O-linked (GlcNAc) serine": "O-GlcNAc", "N-acetylglucosamine": "Acetylation", "Nitrated tyrosine": "Nitrated", "Nitrotyrosine": "Nitration", "Q" * 40: "Q" * 30}
    df = spark.createDataFrame([(k,) for k in cases], "d string").select("d", modification_kind(F.col("d")).alias("k"), shortened(F.col("d"), 10).alias("s"))
    rows = df.collect()
    assert {r.d: r.k for r in rows} == cases
    assert all(len(r.s) <= 10 for r in rows)


def test_every_failure(spark):
    canonical, isoform = "ACDEFGHIKL", "ACDEFGHY"
    kind = "known array<struct<type:string,description:string,start:int,`end`:int,confidence:float>>"
    feature = lambda p, t="modified residue", d="phospho": (t, d, p, p, 0.4)
    edits = "array(named_struct('b',3,'e',4,'ord',0,'d',-2,'gone',true),named_struct('b',5,'e',6,'ord',1,'d',1,'gone',false),named_struct('b',8,'e',8,'ord',2,'d',-20,'gone',false))"
    fs = [feature(99), feature(3), feature(9), feature(6), feature(1), feature(1, "Cross-link", None), feature(2, "domain"), ("modified residue", "x", 2, 3, 0.1), feature(5), feature(0)]
    df = spark.createDataFrame([(fs,)], kind).select(judged_sites(F.col("known"), F.lit(canonical), F.lit(isoform), F.expr(edits), F.lit(False)).alias("j"))
    got = [j.code for j in df.first().j]
    assert got == ["CANONICAL_OOB", "VSP_DELETION_EVENT", "MAPPER_OOB", "VSP_UNRESOLVABLE", None, None, "RESIDUE_MISMATCH"]
    same = spark.createDataFrame([([feature(10)],)], kind).select(judged_sites(F.col("known"), F.lit(canonical), F.lit(isoform), F.expr(edits), F.lit(True)).alias("j")).first().j
    assert same[0].code == "ISOFORM_OOB"
    assert {*got, "ISOFORM_OOB"} - {None} == set(FAILURES)
    nest = df.select(sites_of(F.col("j")).alias("s")).first().s
    assert [(s.site_index, s.site_aa, [m.mod_type for m in s.modifications]) for s in nest] == [(1, "A", [1, 0])]


def test_map_range(spark):
    none = F.expr(f"cast(array() as array<{EDIT}>)")
    df = spark.createDataFrame([(1, 4), (2, 9), (3, 2), (0, 1), (4, 4)], "s int, e int")
    got = df.select(map_range(none, F.lit("ACDEFGHI"), F.lit("ACDE"), F.col("s"), F.col("e")).alias("r")).collect()
    assert [tuple(r.r) if r.r else None for r in got] == [(1, 4), None, None, None, (4, 4)]


def test_cooccurrence(spark):
    p, o = "modified residue", "glycosylation site"
    rows = [(1, 0, p, "Phosphoserine", 10, None), (1, 1, p, "Phosphothreonine", 10, "ECO:0000269"), (1, 2, o, "GlcNAc", 10, None), (1, 3, o, "GlcNAc", 15, None), (1, 4, p, "phospho", 21, None), (2, 0, p, "phospho", 5, None), (3, 0, o, "GlcNAc", 5, None), (3, 1, o, None, 5, None), (4, 0, o, "GlcNAc", None, None)]
    found = analytics.sites(spark.createDataFrame(rows, "row_key int, ord int, feature_type string, description string, start int, evidence_code string"))
    assert tuple(analytics.presence(found).first()) == (1, 1, 1)
    c = analytics.cooccurrence(found).first()
    assert (c.phospho_sites, c.oglcnac_sites, c.overlapping, c.near) == (3, 3, 1, 1)
    assert [tuple(r) for r in analytics.overlap_examples(found).collect()] == [(1, 10, "Thr")]
    assert {(r.kind, r.evidence): r.n for r in analytics.site_evidence(found).collect()}[("phospho", "ECO:0000269")] == 1
    empty = analytics.cooccurrence(found.limit(0)).first()
    assert empty.overlap_percent is None


def test_shortened_and_stems(spark):
    from isoforge.functions.modifications import shortened
    from isoforge.sources.entries import stem

    rows = spark.createDataFrame([("abcdef",), ("abc",), (None,)], "t string").select(shortened(F.col("t"), 5).alias("s")).collect()
    assert [r.s for r in rows] == ["ab...", "abc", None]
    assert [stem(x) for x in ("a/b.xml", "b.xml.gz", "b.gz", "b.c")] == ["b", "b", "b", "b.c"]


def test_nested_markup(spark):
    from isoforge.sources.entries import without_markup

    cases = {
        "<text>a <i>b</i> c</text>": "<text>a b c</text>",
        '<text evidence="1">a<sub x="2">3</sub><br/></text>': '<text evidence="1">a3</text>',
        "<location><position position='1'/></location>": "<location><position position='1'/></location>",
        "<text>a &lt;b&gt; c</text>": "<text>a &lt;b&gt; c</text>",
        "<note><![CDATA[x <i>y</i>]]> <i>z</i></note>": "<note><![CDATA[x <i>y</i>]]> z</note>",
        "<text/><entry><i>kept: no text of ours</i></entry>": "<text/><entry><i>kept: no text of ours</i></entry>",
        "<name>a<!-- <i> -->b</name>": "<name>ab</name>",
    }
    got = spark.createDataFrame([(k,) for k in cases], "x string").select("x", without_markup(F.col("x")).alias("y")).collect()
    assert {r.x: r.y for r in got} == cases
