"""The engine's operators as queries over the driver's tables, each with the SQL that gives the same rows.

The tables hold no protein data, so orders stand for entries and their line items for features, by a
fixed derivation: the same in Spark (feature_rows) and in SQL (FEATURES).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from isoforge.functions.binding import bind
from isoforge.functions.evidence import codes_of, confidence_of, joined_codes
from isoforge.functions.modifications import amino_acid, judged_sites, modification_code, modification_kind, sites_of
from isoforge.functions.residues import edit_count, edits_of, is_missing, map_position, map_range, residue_at, residue_length, total_delta
from isoforge.operators.counters import row_counters
from isoforge.operators.extract import EXISTENCE, existence_code, parse_entries
from isoforge.operators.isoforms import isoform_key, isoform_rows, missing_isoforms, output_rows
from isoforge.operators.sinks import species_of
from isoforge.plans import analytics
from isoforge.sources.entries import parse_xml
from isoforge.sources.fasta import fasta_key

CANONICAL = "ACDEFGHIKLMNPQRSTVWY" * 3
ISOFORM = "ACDEFGHIKLMNPQRSTVWYACDEFGHIKLMNPQRSTVWYKLMNPQ"
#: The variants that an order's isoform is made with.
VARIANTS = ["VSP_1", "VSP_3", "VSP_4"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(c: Column, values: dict, other: Column | None = None) -> Column:
    out = other if other is not None else F.lit(None)
    for k, v in values.items():
        out = F.when(c == k, F.lit(v)).otherwise(out)
    return out


KINDS = {"R": "modified residue", "A": "glycosylation site"}
WORDING = {"ring": "Phosphoserine", "bolt": "Phosphothreonine", "gear": "N6-acetyllysine", "plate": "O-linked (GlcNAc) serine", "rod": "N-acetylglucosamine", "widget": "Omega-N-methylarginine", "gizmo": "Nitrated tyrosine"}
CODES = {0: "ECO:0000269", 1: "ECO:0007744", 2: "ECO:0000250", 3: "ECO:0000255", 4: "ECO:0000305"}
VARIATION = {1: "Missing", 2: "ACDEF", 3: "in isoform 2"}


def feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """row_key, ord (from 1), feature_type, description, start, evidence_code, and what edits are made of."""
    rows = read(spark, sf_dir, "lineitem").join(read(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return rows.select(
        F.col("l_orderkey").alias("row_key"), F.row_number().over(order).alias("ord"),
        pick(F.col("l_returnflag"), KINDS, F.lit("domain")).alias("feature_type"),
        pick(F.split_part("p_name", F.lit(" "), F.lit(2)), WORDING, F.col("p_name")).alias("description"),
        F.col("l_quantity").cast("int").alias("start"), pick(F.col("l_suppkey") % 6, CODES).alias("evidence_code"),
        F.when(F.col("l_linestatus") == "O", "splice variant").otherwise("variant sequence").alias("edit_type"),
        (F.col("l_quantity").cast("int") + F.col("l_linenumber") - 1).alias("edit_end"), pick(F.col("l_partkey") % 4, VARIATION).alias("variation"),
        (F.col("l_partkey") % 64).cast("int").alias("place"), "l_suppkey",
    )


def cases(c: str, values: dict, other: str) -> str:
    quote = lambda v: f"'{v}'" if isinstance(v, str) else str(v)
    return f"CASE {c} " + " ".join(f"WHEN {quote(k)} THEN {quote(v)}" for k, v in values.items()) + f" ELSE {other} END"


FEATURES = f"""feat AS MATERIALIZED (SELECT l_orderkey AS row_key,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS ord,
  {cases("l_returnflag", KINDS, "'domain'")} AS feature_type,
  {cases("split_part(p_name, ' ', 2)", WORDING, "p_name")} AS description,
  l_quantity::INT AS start, {cases("l_suppkey % 6", CODES, "NULL")} AS evidence_code,
  CASE WHEN l_linestatus = 'O' THEN 'splice variant' ELSE 'variant sequence' END AS edit_type,
  l_quantity::INT + l_linenumber - 1 AS edit_end, {cases("l_partkey % 4", VARIATION, "NULL")} AS variation,
  (l_partkey % 64)::INT AS place, l_suppkey
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

# The edits of each order's isoform, with their residue lengths worked out; ord keeps equal begins apart.
EDITS = """edit AS MATERIALIZED (SELECT row_key, ord, start AS b, edit_end AS e, gone, CASE WHEN gone THEN 0 ELSE len END - (edit_end - start + 1) AS d FROM (
  SELECT *, (edit_type = 'splice variant' AND len <= 0) OR contains(lower(coalesce(variation, '')), 'missing') AS gone FROM (
    SELECT *, CASE WHEN regexp_full_match(trim(coalesce(variation, '')), '[A-Za-z]+') THEN length(trim(variation)) ELSE 0 END AS len FROM feat WHERE ord IN (1, 3, 4) AND start > 0 AND edit_end >= start))
  WHERE gone OR len > 0)"""


def mapped_sql(points: str) -> str:
    """points: a CTE (row_key, ord, pos) with one row for each point; gives mapped (row_key, ord, pos, mapped, code)."""
    return f"""near AS MATERIALIZED (SELECT p.row_key, p.ord, p.pos, e.b, e.e, e.d, e.ord AS edit FROM {points} p LEFT JOIN edit e ON e.row_key = p.row_key),
  hit AS MATERIALIZED (SELECT row_key, ord, pos, min({{'b': b, 'ord': edit}}) FILTER (WHERE pos BETWEEN b AND e) AS f FROM near GROUP BY ALL),
  moved AS MATERIALIZED (SELECT n.row_key, n.ord, n.pos, h.f, coalesce(sum(CASE WHEN n.e < n.pos AND (h.f IS NULL OR {{'b': n.b, 'ord': n.edit}} < h.f) THEN n.d END), 0) AS shift
    FROM near n JOIN hit h USING (row_key, ord, pos) GROUP BY ALL),
  judged AS (SELECT m.*, e.gone, e.d, e.b FROM moved m LEFT JOIN edit e ON e.row_key = m.row_key AND e.ord = m.f.ord AND e.b = m.f.b),
  coded AS (SELECT *, CASE WHEN pos <= 0 THEN 'VSP_UNRESOLVABLE' WHEN f IS NULL AND pos + shift <= 0 THEN 'MAPPER_OOB' WHEN f IS NULL THEN NULL WHEN gone THEN 'VSP_DELETION_EVENT'
    WHEN (d = 0 OR pos = b) AND pos + shift <= 0 THEN 'MAPPER_OOB' WHEN d = 0 OR pos = b THEN NULL ELSE 'VSP_UNRESOLVABLE' END AS code FROM judged),
  mapped AS (SELECT row_key, ord, pos, CASE WHEN code IS NULL THEN (pos + shift)::INT END AS mapped, code FROM coded)"""


def entry_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their features as a list, in order, and the edits of their isoform."""
    f = feature_rows(spark, sf_dir)
    one = F.struct(
        F.col("ord").cast("int").alias("ord"), F.concat(F.lit("VSP_"), F.col("ord")).alias("id"), "feature_type", "edit_type", "description", "start",
        "edit_end", "variation", "evidence_code", "place", "l_suppkey",
    )
    rows = f.groupBy("row_key").agg(F.sort_array(F.collect_list(one)).alias("items"))
    edits = F.transform("items", lambda i: F.struct(i["ord"].alias("ord"), i["id"].alias("id"), i["edit_type"].alias("type"), F.lit(None).cast("string").alias("description"), i["start"].alias("start"), i["edit_end"].alias("end"), i["variation"].alias("variation")))
    return rows.withColumn("edits", edits_of(edits, F.array(*map(F.lit, VARIANTS))))


def taxa_split(spark, sf_dir):
    c = read(spark, sf_dir, "customer").select("c_custkey", pick(F.col("c_nationkey") % 5, {0: 9606, 1: 10090, 2: 10116, 4: 9544}).cast("int").alias("organism_id"))
    return species_of(c).where("species is not null")


def evidence_breakdown(spark, sf_dir):
    return analytics.oglcnac_evidence(feature_rows(spark, sf_dir)).withColumn("percent", F.round("percent", 6))


def evidence_buckets(spark, sf_dir):
    return analytics.evidence_buckets(analytics.oglcnac_evidence(feature_rows(spark, sf_dir)))


def ptm_spectrum(spark, sf_dir):
    return analytics.ranked(analytics.modification_spectrum(feature_rows(spark, sf_dir), 20)).withColumn("ratio", F.round("ratio", 6))


def spectrum_totals(spark, sf_dir):
    return analytics.spectrum_totals(analytics.modification_spectrum(feature_rows(spark, sf_dir), 20)).withColumn("percent", F.round("percent", 6))


def found_sites(spark, sf_dir):
    return analytics.sites(feature_rows(spark, sf_dir).withColumn("start", (F.col("start") / 5).cast("int")))


def mod_sites(spark, sf_dir):
    return found_sites(spark, sf_dir)


def presence(spark, sf_dir):
    return analytics.presence(found_sites(spark, sf_dir))


def cooccurrence(spark, sf_dir):
    return analytics.cooccurrence(found_sites(spark, sf_dir)).withColumn("overlap_percent", F.round("overlap_percent", 6))


def exact_overlap(spark, sf_dir):
    return analytics.overlaps(found_sites(spark, sf_dir))


def overlap_examples(spark, sf_dir):
    return analytics.overlap_examples(found_sites(spark, sf_dir))


def proximity_semi(spark, sf_dir):
    return analytics.near_sites(found_sites(spark, sf_dir))


def site_evidence(spark, sf_dir):
    return analytics.site_evidence(found_sites(spark, sf_dir))


def coord_map_point(spark, sf_dir):
    rows = entry_rows(spark, sf_dir).select("row_key", F.explode(bind(F.col("edits"), lambda e: F.transform("items", lambda i: F.struct(i["ord"].alias("ord"), i["place"].alias("pos"), map_position(e, i["place"]).alias("m"))))).alias("x"))
    return rows.select("row_key", "x.ord", "x.pos", F.coalesce("x.m.pos", F.lit(-1)).alias("mapped"), "x.m.code")


def coord_map_range(spark, sf_dir):
    def one(i: Column, edits: Column) -> Column:
        return F.struct(i["ord"].alias("ord"), map_range(edits, F.lit(CANONICAL), F.lit(ISOFORM), i["place"], i["place"] + (i["ord"] % 5)).alias("r"))

    return entry_rows(spark, sf_dir).select("row_key", F.explode(bind(F.col("edits"), lambda e: F.transform("items", lambda i: one(i, e)))).alias("x")).select("row_key", "x.ord", F.coalesce("x.r.start", F.lit(-1)).alias("start"), F.coalesce("x.r.end", F.lit(-1)).alias("end"))


def edit_totals(spark, sf_dir):
    return entry_rows(spark, sf_dir).select("row_key", edit_count(F.col("edits")).alias("edits"), total_delta(F.col("edits")).alias("delta"))


def evidence_resolve(spark, sf_dir):
    """Keys E2, E0, E9, E0 in a dictionary that each order's items write in turn."""
    dictionary = F.filter(F.transform("items", lambda i: F.struct(F.concat(F.lit("E"), i["ord"] % 3).alias("_key"), i["evidence_code"].alias("_type"))), lambda e: e["_type"].isNotNull())
    codes = codes_of(F.array(*map(F.lit, ("E2", "E0", "E9", "E0"))), F.col("dictionary"))
    return entry_rows(spark, sf_dir).withColumn("dictionary", dictionary).select("row_key", joined_codes(codes).alias("codes"), confidence_of(codes).cast("double").alias("c")).select("row_key", "codes", F.round("c", 3).alias("confidence"))


def confidence_max(spark, sf_dir):
    codes = F.filter(F.transform("items", lambda i: i["evidence_code"]), lambda c: c.isNotNull())
    return entry_rows(spark, sf_dir).select("row_key", F.round(confidence_of(codes).cast("double"), 3).alias("confidence"))


def entries_with_isoforms(spark, sf_dir) -> DataFrame:
    """Orders as parsed entries; an order without items has no isoform."""
    items = entry_rows(spark, sf_dir).select("row_key", F.transform("items", lambda i: F.struct(F.concat(F.lit("S-"), i["l_suppkey"], F.lit(" x")).alias("isoform_id"), F.when(i["ord"] % 2 == 0, F.concat(F.lit("R-"), i["ord"])).alias("isoform_sequence"), F.array().cast("array<string>").alias("vsp_ids"))).alias("isoforms"))
    orders = read(spark, sf_dir, "orders")
    return orders.join(items, orders["o_orderkey"] == items["row_key"], "left").select(F.col("o_orderkey").cast("string").alias("accession"), F.lit("MTAK").alias("sequence"), F.coalesce("isoforms", F.array().cast("array<struct<isoform_id:string,isoform_sequence:string,vsp_ids:array<string>>>")).alias("isoforms"))


def sidecar(spark, sf_dir) -> DataFrame:
    s = read(spark, sf_dir, "supplier").where("s_suppkey % 3 <> 0").select(F.concat(F.lit("S-"), "s_suppkey").alias("fasta_id"), F.col("s_name").alias("fasta_sequence"))
    return s.unionByName(spark.range(1).select(F.lit("R-2").alias("fasta_id"), F.lit("MT").alias("fasta_sequence")))


def isoform_explode_join(spark, sf_dir):
    return isoform_rows(entries_with_isoforms(spark, sf_dir), sidecar(spark, sf_dir)).select("id", "parent_id", F.col("row_sequence").alias("seq"))


def isoform_missing(spark, sf_dir):
    return missing_isoforms(entries_with_isoforms(spark, sf_dir), sidecar(spark, sf_dir))


def judged_entries(spark, sf_dir) -> DataFrame:
    features = F.transform("items", lambda i: F.struct(i["feature_type"].alias("type"), i["description"].alias("description"), i["place"].alias("start"), i["place"].alias("end"), confidence_of(F.array_compact(F.array(i["evidence_code"]))).alias("confidence")))
    rows = entry_rows(spark, sf_dir).withColumn("known", features)
    return rows.select("row_key", judged_sites(F.col("known"), F.lit(CANONICAL), F.lit(ISOFORM), F.col("edits"), F.col("row_key") % 7 == 0).alias("judged"))


def ptm_validate(spark, sf_dir):
    rows = judged_entries(spark, sf_dir).select("row_key", F.explode("judged").alias("j"))
    return rows.groupBy(F.coalesce("j.code", F.lit("MAPPED")).alias("status"), F.col("j.mod_type").alias("mod_type")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("j.pos", F.lit(0))).alias("positions"))


def ptm_site_nest(spark, sf_dir):
    text = lambda s: F.concat(s["site_index"], F.lit(":"), s["site_aa"], F.lit(":"), F.array_join(F.transform(s["modifications"], lambda m: F.concat(m["mod_type"], F.lit("/"), F.round(m["confidence_score"] * 10).cast("int"))), ","))
    return judged_entries(spark, sf_dir).select("row_key", F.array_join(F.transform(sites_of(F.col("judged")), text), ";").alias("sites"))


def run_counters(spark, sf_dir):
    return judged_entries(spark, sf_dir).agg(*row_counters())


def aa_clean_len(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    second = F.split_part("p_name", F.lit(" "), F.lit(2))
    return p.select("p_partkey", residue_length(F.col("p_name")).alias("whole"), residue_length(F.concat(F.lit("  "), second, F.lit(" "))).alias("word"), residue_length(F.col("p_brand")).alias("brand"), is_missing(F.col("p_type"), F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("Missing "), "p_name"))).alias("missing"))


def residue_lookup(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", residue_at(F.col("p_name"), F.col("p_size") - 3).alias("residue"))


def description_kinds(spark, sf_dir):
    f = feature_rows(spark, sf_dir)
    return f.groupBy("feature_type", "description").agg(F.count(F.lit(1)).alias("n")).select("feature_type", "description", "n", modification_kind(F.col("description")).alias("kind"), amino_acid(F.col("description")).alias("amino_acid"), modification_code(F.col("feature_type"), F.col("description")).alias("code"))


def fasta_keys(spark, sf_dir):
    header = F.when(F.col("p_partkey") % 4 == 0, F.concat(F.lit("sp|P"), "p_partkey", F.lit("-2|X "), "p_name")).when(F.col("p_partkey") % 4 == 1, F.concat("p_name", F.lit("|a|b"))).when(F.col("p_partkey") % 4 == 2, F.concat(F.lit("tr||"), "p_brand")).otherwise(F.concat(F.lit("  "), "p_name"))
    return read(spark, sf_dir, "part").select("p_partkey", fasta_key(header).alias("key"))


def isoform_keys(spark, sf_dir):
    iso = F.struct(F.concat(F.lit("I"), "p_partkey", F.lit(" old")).alias("isoform_id"), pick(F.col("p_partkey") % 4, {0: "VSP_1-2", 1: "P1-2 x", 2: "noref"}).alias("isoform_sequence"))
    return read(spark, sf_dir, "part").select("p_partkey", isoform_key(iso).alias("key"))


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]


def existence_codes(spark, sf_dir):
    kind = pick(F.col("o_orderpriority"), dict(zip(PRIORITIES, EXISTENCE, strict=False)), F.lit("no such"))
    return read(spark, sf_dir, "orders").select("o_orderkey", F.coalesce(existence_code(kind).cast("int"), F.lit(0)).alias("existence"))


def xml_text(spark, sf_dir) -> DataFrame:
    """Each order as an XML entry."""
    item = lambda i: F.concat(F.lit('<feature type="'), i["feature_type"], F.lit('" description="'), i["description"], F.lit('" evidence="E1 E'), i["ord"], F.lit('"><location><position position="'), i["place"], F.lit('"/></location></feature>'))
    partner = lambda i: F.concat(F.lit('<dbReference type="UniProtKB" id="S'), i["l_suppkey"], F.lit('"/>'))
    xml = F.concat(
        F.lit("<entry><accession>P"), "row_key", F.lit("</accession><sequence> ACDEF GHIKL\nMNPQRSTVWY </sequence><organism><dbReference type=\"NCBI Taxonomy\" id=\"9606\"/></organism>"),
        F.array_join(F.transform("items", item), ""), F.lit('<comment type="interaction" evidence="E1">'), F.array_join(F.transform("items", partner), ""),
        F.lit('</comment><evidence key="E1" type="ECO:0000250"/><evidence key="E1" type="ECO:0000269"/><evidence key="E2" type="ECO:0007744"/></entry>'),
    )
    return entry_rows(spark, sf_dir).select(xml.alias("xml"))


def xml_rows(spark, sf_dir, columns: list[str] | None = None) -> DataFrame:
    raw = parse_xml(xml_text(spark, sf_dir), "xml", columns=columns)
    return output_rows(isoform_rows(parse_entries(raw), None))


def xml_roundtrip(spark, sf_dir):
    feature = lambda f: F.concat(f["feature_type"], F.lit("|"), f["description"], F.lit("|"), f["start"], F.lit("|"), f["evidence_code"])
    return xml_rows(spark, sf_dir).select("id", "sequence", "organism_id", F.array_join(F.transform("features", feature), ";").alias("features"), F.size("domains").alias("domains"), F.size("ptm_sites").alias("sites"))


def interaction_pairs(spark, sf_dir):
    text = lambda x: F.concat(x["interactant_id_1"], F.lit("-"), F.coalesce(x["interactant_id_2"], F.lit("")), F.lit(":"), x["evidence_code"])
    return xml_rows(spark, sf_dir, ["accession", "comment", "evidence"]).select("id", F.array_join(F.transform("interactions", text), ";").alias("pairs"))


def table_sites(spark, sf_dir):
    """Sites of the table that entries were parsed into, from its nested features."""
    return analytics.sites(analytics.flat_features(xml_rows(spark, sf_dir, ["accession", "sequence", "feature", "evidence"])))


def table_spectrum(spark, sf_dir):
    flat = analytics.flat_features(xml_rows(spark, sf_dir, ["accession", "sequence", "feature", "evidence"]))
    return analytics.modification_spectrum(flat, 20).withColumn("ratio", F.round("ratio", 6))


CHAIN = "ACDEFGHIKLMNPQRSTVWY"
#: CHAIN without the two residues that the splice variant of a customer's second isoform deletes.
SHORT = CHAIN[:2] + CHAIN[4:]


def customer_xml(spark, sf_dir) -> DataFrame:
    """Each customer as an entry that has every element which is read; what it has of them depends on its key."""
    k = F.col("c_custkey")
    text = lambda *parts: F.concat(*(F.lit(x) if isinstance(x, str) else x.cast("string") for x in parts))
    some = lambda when, *parts: F.when(when, text(*parts)).otherwise(F.lit(""))
    at = k % 10 + 6
    span = lambda a, b: text('<location><begin position="', a, '"/><end position="', b, '"/></location>')
    point = lambda a: text('<location><position position="', a, '"/></location>')
    feature = lambda kind, more, inner: text(f'<feature type="{kind}" id="', k, f'" description="{kind} of it"{more}>', inner, "</feature>")
    kinds = pick(k % 6, dict(enumerate(EXISTENCE)), F.lit("unheard of"))
    xml = text(
        "<entry><accession>C", k, "</accession>", some(k % 5 == 0, "<accession>X", k, "</accession>"), "<name>", F.col("c_name"), "</name>",
        '<protein><recommendedName><fullName evidence="E1">Beta<sub>', k % 7, "</sub> <i>sub</i>unit &amp; co</fullName></recommendedName>", some(k % 3 == 1, "<alternativeName><fullName>Other</fullName></alternativeName>"), "</protein>",
        some(k % 4 > 0, '<gene><name type="synonym">S', k, '</name><name type="primary">G', k % 11, "</name></gene>"),
        '<organism><name type="scientific">Genus <b>no</b> ', F.col("c_nationkey"), '</name><name type="common">N</name>', some(k % 6 > 0, '<dbReference type="NCBI Taxonomy" id="', F.col("c_nationkey") + 9600, '"/>'), "</organism>",
        some(k % 8 > 0, '<comment type="subcellular location"><subcellularLocation><location evidence="E1 E2">Outer <i>mem</i>brane ', k % 3, "</location><location>Cytosol</location></subcellularLocation></comment>"),
        '<comment type="subunit" evidence="E2">', pick(k % 4, {2: "<text> </text>"}, text("<text", some(k % 4 == 1, ' evidence="E1"'), "> Binds <i>abc</i> ", k % 9, "<!-- note --> tightly. </text>")), "</comment>",
        some(k % 3 == 0, '<comment type="alternative products"><isoform><id>C', k, '-1</id><sequence type="displayed"/><note>first <i>one</i></note></isoform><isoform><id>C', k, '-2</id><sequence type="described" ref="VSP_', k, '"/></isoform></comment>'),
        '<dbReference type="PDB" id="P', k % 13, '"/><dbReference type="EMBL" id="E"/>', some(k % 2 == 0, '<dbReference type="AlphaFoldDB" id="A', k, '"/>'),
        '<proteinExistence type="', kinds, '"/>',
        feature("domain", ' evidence="E1"', span(at, at + 2)), feature("domain", "", span(F.lit(19), F.lit(25))), feature("active site", ' evidence="E2"', point(at)), feature("binding site", "", span(at, at + 1)),
        feature("metal ion-binding site", ' evidence="E9"', point(F.lit(2))), feature("mutagenesis site", ' evidence="E1 E2"', text("<original>A</original><variation>G</variation>", span(at + 3, at + 3))),
        feature("sequence variant", "", text("<original>A<i>B</i></original><variation>C</variation><variation>D<sup>2</sup></variation>", span(F.lit(1), F.lit(1)))),
        some(k % 3 == 0, '<feature type="splice variant" id="VSP_', k, '">', span(F.lit(3), F.lit(4)), "</feature>"), '<feature type="modified residue" description="Phosphoserine">', point(at), "</feature>",
        f'<evidence key="E1" type="ECO:0000269"/><evidence key="E2" type="ECO:0000250"/><sequence length="20">{CHAIN[:9]}\n {CHAIN[9:]}</sequence></entry>',
    )
    return read(spark, sf_dir, "customer").select(xml.alias("xml"))


def customer_sidecar(spark, sf_dir) -> DataFrame:
    """Both isoforms of customers that have some, but of every third of them only the first."""
    own = read(spark, sf_dir, "customer").where("c_custkey % 3 = 0").select(F.concat(F.lit("C"), "c_custkey").alias("c"), (F.col("c_custkey") % 9 == 0).alias("few"))
    sequences = F.array(F.struct(F.concat("c", F.lit("-1")).alias("i"), F.lit(CHAIN).alias("s")), F.when(~F.col("few"), F.struct(F.concat("c", F.lit("-2")).alias("i"), F.lit(SHORT).alias("s"))))
    return own.select(F.explode(F.array_compact(sequences)).alias("x")).select(F.col("x.i").alias("fasta_id"), F.col("x.s").alias("fasta_sequence"))


def customer_rows(spark, sf_dir) -> DataFrame:
    """The table of customer_xml."""
    return output_rows(isoform_rows(parse_entries(parse_xml(customer_xml(spark, sf_dir), "xml")), customer_sidecar(spark, sf_dir)))


def listed(column: str, *names: str) -> Column:
    """The named fields of a list's elements as text."""
    part = lambda x, n: F.coalesce((F.round(x[n] * 10).cast("int") if n == "confidence_score" else x[n]).cast("string"), F.lit("-"))
    return F.array_join(F.transform(column, lambda x: F.concat_ws("|", *(part(x, n) for n in names))), ";").alias(column)


def xml_metadata(spark, sf_dir):
    return customer_rows(spark, sf_dir).select("id", "parent_id", "entry_name", "protein_name", "gene_name", "organism_name", "organism_id", F.col("existence").cast("int").alias("existence"), listed("structures", "db", "id"))


def xml_nested_text(spark, sf_dir):
    """Text with tags nested in it is read whole: protein names, locations, subunits, variants, notes of isoforms."""
    return customer_rows(spark, sf_dir).select("id", "protein_name", "organism_name", listed("location", "location", "evidence_code"), listed("subunits", "text", "evidence_code", "confidence_score"), listed("natural_variants", "original", "variation"))


def xml_isoforms(spark, sf_dir):
    return customer_rows(spark, sf_dir).select("id", "parent_id", "sequence", listed("isoforms", "isoform_id", "isoform_sequence", "isoform_note"), F.size("features").alias("features"))


def xml_routed_lists(spark, sf_dir):
    """The six lists that features are routed to, mapped onto each isoform."""
    place = ("id", "description", "start", "end", "evidence_code", "confidence_score")
    return customer_rows(spark, sf_dir).select(
        "id", listed("active_sites", *place), listed("binding_sites", *place), listed("metal_coordinations", "metal", *place), listed("mutagenesis_sites", *place),
        listed("domains", "domain_name", *place), listed("natural_variants", "original", "variation", *place),
    )


def point_lookup(spark, sf_dir):
    return analytics.point_lookup(read(spark, sf_dir, "customer"), (7, -1), "c_custkey").select("c_custkey", "c_name")


QUERIES = [
    taxa_split, evidence_breakdown, evidence_buckets, ptm_spectrum, spectrum_totals, mod_sites, presence, cooccurrence, exact_overlap, overlap_examples, proximity_semi, site_evidence,
    coord_map_point, coord_map_range, edit_totals, evidence_resolve, confidence_max, isoform_explode_join, isoform_missing, ptm_validate, ptm_site_nest, run_counters, aa_clean_len,
    residue_lookup, description_kinds, fasta_keys, isoform_keys, existence_codes, xml_roundtrip, interaction_pairs, table_sites, table_spectrum,
    xml_metadata, xml_nested_text, xml_isoforms, xml_routed_lists, point_lookup,
]


def queries() -> dict:
    from isoforge.plans import file_queries

    return {f.__name__: f for f in [*QUERIES, *file_queries.QUERIES]}


def oracle_sql() -> dict[str, str]:
    from isoforge.plans import oracles

    return oracles.oracle_sql()
