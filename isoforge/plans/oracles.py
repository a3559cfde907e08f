"""SQL of the catalog's queries, for DuckDB."""

from __future__ import annotations

from isoforge.operators.extract import EXISTENCE
from isoforge.plans.catalog import CANONICAL, CHAIN, EDITS, FEATURES, ISOFORM, PRIORITIES, SHORT, cases, mapped_sql

OGLCNAC = "(contains(lower(feature_type), 'glyc') OR feature_type = 'modified residue') AND description IS NOT NULL AND (contains(lower(description), 'glcnac') OR contains(lower(description), 'n-acetylglucosamine'))"
PHOSPHO = "feature_type = 'modified residue' AND contains(lower(description), 'phospho')"
EXPERIMENTAL = "(contains(lower({0}), 'eco:0000269') OR contains(lower({0}), 'eco:0007744'))"
KIND = """CASE WHEN contains(lower(description), 'phospho') THEN CASE WHEN contains(lower(description), 'serine') THEN 'Phosphoserine' WHEN contains(lower(description), 'threonine') THEN 'Phosphothreonine'
    WHEN contains(lower(description), 'tyrosine') THEN 'Phosphotyrosine' ELSE 'Phosphorylation' END
  WHEN contains(lower(description), 'acetyl') THEN 'Acetylation' WHEN contains(lower(description), 'methyl') THEN 'Methylation' WHEN contains(lower(description), 'ubiquit') THEN 'Ubiquitination'
  WHEN contains(lower(description), 'sumoyl') THEN 'Sumoylation' WHEN contains(lower(description), 'glcnac') OR contains(lower(description), 'n-acetylglucosamine') THEN 'O-GlcNAc'
  WHEN contains(lower(description), 'palmitoyl') THEN 'Palmitoylation' WHEN contains(lower(description), 'myristoyl') THEN 'Myristoylation' WHEN contains(lower(description), 'hydroxyl') THEN 'Hydroxylation'
  WHEN contains(lower(description), 'glycat') OR contains(lower(description), 'glycosyl') THEN 'Glycosylation' WHEN contains(lower(description), 'nitro') THEN 'Nitration'
  WHEN contains(lower(description), 'carboxyl') THEN 'Carboxylation' WHEN contains(lower(description), 'oxidation') THEN 'Oxidation'
  WHEN length(split_part(trim(description), ' ', 1)) <= 30 THEN split_part(trim(description), ' ', 1) ELSE substr(description, 1, 30) END"""
ACID = "CASE WHEN contains(lower(description), 'ser') THEN 'Ser' WHEN contains(lower(description), 'thr') THEN 'Thr' WHEN contains(lower(description), 'tyr') THEN 'Tyr' ELSE 'Unknown' END"
CODE = "CASE WHEN lower({0}feature_type) = 'modified residue' AND contains(lower({0}description), 'phospho') THEN 1 WHEN lower({0}feature_type) = 'glycosylation site' AND contains(lower({0}description), 'n-acetylglucosamine') THEN 2 ELSE 0 END"
CONFIDENCE = "CASE {0} WHEN 'ECO:0000269' THEN 1.0 WHEN 'ECO:0007744' THEN 0.8 WHEN 'ECO:0000250' THEN 0.4 ELSE 0.1 END"

OGROUPS = f"{FEATURES}, g AS (SELECT coalesce(evidence_code, 'Unknown') AS evidence, count(*) AS n FROM feat WHERE {OGLCNAC} GROUP BY 1)"
SPECTRUM = f"""{FEATURES}, stats AS (SELECT {KIND} AS mod_type, count(*) AS total, count(*) FILTER (WHERE {EXPERIMENTAL.format("evidence_code")}) AS experimental,
  count(*) FILTER (WHERE evidence_code IS NOT NULL AND NOT {EXPERIMENTAL.format("evidence_code")}) AS non_experimental, count(*) FILTER (WHERE evidence_code IS NULL) AS unknown
  FROM feat WHERE feature_type IN ('modified residue', 'lipidation', 'glycosylation site', 'cross-link') OR contains(feature_type, 'modification') GROUP BY 1 HAVING count(*) >= 20)"""
SITES = f"""{FEATURES}, known AS (SELECT row_key, ord, (start / 5)::DOUBLE AS s, floor(start / 5)::INT AS position, feature_type, description, evidence_code FROM feat WHERE start IS NOT NULL AND description IS NOT NULL),
  each AS (SELECT *, 'phospho' AS kind FROM known WHERE {PHOSPHO} UNION ALL SELECT *, 'oglcnac' AS kind FROM known WHERE {OGLCNAC}),
  site AS (SELECT row_key, position, kind, arg_max({ACID}, ord) AS amino_acid, arg_max(coalesce(evidence_code, 'Unknown'), ord) AS evidence FROM each GROUP BY 1, 2, 3)"""
OVERLAP = "SELECT p.row_key, p.position, p.amino_acid FROM site p JOIN site o USING (row_key, position) WHERE p.kind = 'phospho' AND o.kind = 'oglcnac'"
NEAR = "SELECT p.row_key, p.position FROM site p WHERE p.kind = 'phospho' AND EXISTS (SELECT 1 FROM site o WHERE o.kind = 'oglcnac' AND o.row_key = p.row_key AND o.position <> p.position AND abs(o.position - p.position) <= 5)"
ISOFORMS = f"""{FEATURES}, iso AS (SELECT row_key, CASE WHEN ord % 2 = 0 THEN 'R-' || ord ELSE 'S-' || l_suppkey END AS k FROM feat),
  side AS (SELECT 'S-' || s_suppkey AS k, s_name AS seq FROM supplier WHERE s_suppkey % 3 <> 0 UNION ALL SELECT 'R-2', 'MT')"""
JUDGED = f"""{FEATURES}, {EDITS}, points AS (SELECT row_key, ord, place AS pos FROM feat), {mapped_sql("points")},
  tried AS (SELECT f.*, substr('{CANONICAL}', place, 1) AS own, CASE WHEN f.row_key % 7 = 0 THEN place ELSE mapped END AS spot, CASE WHEN f.row_key % 7 = 0 THEN NULL ELSE m.code END AS why
    FROM feat f JOIN mapped m ON m.row_key = f.row_key AND m.ord = f.ord WHERE feature_type IN ('modified residue', 'glycosylation site', 'cross-link') AND place > 0),
  fate AS (SELECT *, CASE WHEN place > {len(CANONICAL)} THEN 'CANONICAL_OOB' WHEN why IS NOT NULL THEN why WHEN spot > {len(ISOFORM)} THEN 'ISOFORM_OOB' WHEN substr('{ISOFORM}', spot, 1) <> own THEN 'RESIDUE_MISMATCH' END AS code, {CODE.format("")} AS mod_type FROM tried)"""

# The table's features as xml_roundtrip has them: place as start, and the evidence that an item's two keys resolve to.
PARSED = f"""{FEATURES}, flat AS (SELECT 'P' || row_key AS row_key, ord, feature_type, description, place, 'ECO:0000269' || (CASE ord WHEN 1 THEN ';ECO:0000269' WHEN 2 THEN ';ECO:0007744' ELSE '' END) AS evidence_code FROM feat)"""
# The rows of customer_rows: the number of an isoform (0: the entry has none) and how far its residues behind the splice variant move.
ENTRIES = f"""entry AS (SELECT *, c_custkey AS k, c_custkey % 10 + 6 AS a FROM customer),
  made AS (SELECT *, 0 AS iso, 0 AS shift, 'C' || k AS id, '{CHAIN}' AS seq FROM entry WHERE k % 3 <> 0 UNION ALL SELECT *, 1, 0, 'C' || k || '-1', '{CHAIN}' FROM entry WHERE k % 3 = 0
    UNION ALL SELECT *, 2, -2, 'C' || k || '-2', '{SHORT}' FROM entry WHERE k % 3 = 0 AND k % 9 <> 0)"""


def oracle_sql() -> dict[str, str]:
    residue = "CASE WHEN regexp_full_match(trim({0}), '[A-Za-z]+') THEN length(trim({0})) ELSE 0 END"
    existence = cases("o_orderpriority", dict(zip(PRIORITIES, range(1, len(EXISTENCE) + 1), strict=False)), "NULL")
    return {
        "taxa_split": "SELECT * FROM (SELECT c_custkey, CASE c_nationkey % 5 WHEN 0 THEN 9606 WHEN 1 THEN 10090 WHEN 2 THEN 10116 WHEN 4 THEN 9544 END AS organism_id, CASE c_nationkey % 5 WHEN 0 THEN 'human' WHEN 1 THEN 'mouse' WHEN 2 THEN 'rat' END AS species FROM customer) WHERE species IS NOT NULL",
        "evidence_breakdown": f"WITH {OGROUPS} SELECT evidence, n, round(n * 100.0 / sum(n) OVER (), 6)::DOUBLE AS percent FROM g ORDER BY n DESC, evidence",
        "evidence_buckets": f"WITH {OGROUPS} SELECT coalesce(sum(n), 0)::BIGINT AS total, coalesce(sum(n) FILTER (WHERE {EXPERIMENTAL.format('evidence')}), 0)::BIGINT AS experimental, coalesce(sum(n) FILTER (WHERE evidence = 'Unknown'), 0)::BIGINT AS unknown, coalesce(sum(n) FILTER (WHERE evidence <> 'Unknown' AND NOT {EXPERIMENTAL.format('evidence')}), 0)::BIGINT AS non_experimental FROM g",
        "ptm_spectrum": f"WITH {SPECTRUM}, placed AS (SELECT *, experimental / total AS r, row_number() OVER (ORDER BY experimental / total DESC, mod_type)::INT AS place, count(*) OVER () AS groups FROM stats) SELECT mod_type, total, experimental, non_experimental, unknown, round(r, 6) AS ratio, place, part FROM (SELECT *, 'top' AS part FROM placed WHERE place <= 10 UNION ALL SELECT * REPLACE ((place - greatest(0, groups - 10))::INT AS place), 'bottom' AS part FROM placed WHERE place > groups - 10) ORDER BY part DESC, place",
        "spectrum_totals": f"WITH {SPECTRUM} SELECT count(*) AS kinds, coalesce(sum(total), 0)::BIGINT AS total, coalesce(sum(experimental), 0)::BIGINT AS experimental, round(sum(experimental) * 100.0 / sum(total), 6)::DOUBLE AS percent FROM stats",
        "mod_sites": f"WITH {SITES} SELECT * FROM site",
        "presence": f"WITH {SITES}, e AS (SELECT row_key, bool_or(kind = 'phospho') AS p, bool_or(kind = 'oglcnac') AS o FROM site GROUP BY 1) SELECT count(*) FILTER (WHERE p AND o) AS both, count(*) FILTER (WHERE p AND NOT o) AS phospho_only, count(*) FILTER (WHERE o AND NOT p) AS oglcnac_only FROM e",
        "cooccurrence": f"WITH {SITES}, n AS (SELECT count(*) FILTER (WHERE kind = 'phospho') AS p, count(*) FILTER (WHERE kind = 'oglcnac') AS o FROM site) SELECT p AS phospho_sites, o AS oglcnac_sites, (SELECT count(*) FROM ({OVERLAP})) AS overlapping, (SELECT count(*) FROM ({NEAR})) AS near, round((SELECT count(*) FROM ({OVERLAP})) * 100.0 / nullif(least(p, o), 0), 6)::DOUBLE AS overlap_percent FROM n",
        "exact_overlap": f"WITH {SITES} {OVERLAP}",
        "overlap_examples": f"WITH {SITES} {OVERLAP} ORDER BY row_key, position LIMIT 10",
        "proximity_semi": f"WITH {SITES} {NEAR}",
        "site_evidence": f"WITH {SITES} SELECT kind, evidence, count(*) AS n, {EXPERIMENTAL.format('evidence')} AS experimental FROM site GROUP BY kind, evidence",
        "coord_map_point": f"WITH {FEATURES}, {EDITS}, points AS (SELECT row_key, ord, place AS pos FROM feat), {mapped_sql('points')} SELECT row_key, ord::INT AS ord, pos, coalesce(mapped, -1) AS mapped, code FROM mapped",
        "coord_map_range": f"WITH {FEATURES}, {EDITS}, points AS (SELECT row_key, ord * 2 AS ord, place AS pos FROM feat UNION ALL SELECT row_key, ord * 2 + 1, place + ord % 5 FROM feat), {mapped_sql('points')}, r AS (SELECT f.row_key, f.ord, a.mapped AS a, b.mapped AS b, place > 0 AND place + f.ord % 5 <= {len(CANONICAL)} AND a.mapped BETWEEN 1 AND {len(ISOFORM)} AND b.mapped BETWEEN 1 AND {len(ISOFORM)} AND b.mapped >= a.mapped AS ok FROM feat f JOIN mapped a ON a.row_key = f.row_key AND a.ord = f.ord * 2 JOIN mapped b ON b.row_key = f.row_key AND b.ord = f.ord * 2 + 1) SELECT row_key, ord::INT AS ord, CASE WHEN ok THEN a ELSE -1 END AS start, CASE WHEN ok THEN b ELSE -1 END AS \"end\" FROM r",
        "edit_totals": f"WITH {FEATURES}, {EDITS} SELECT f.row_key, count(e.b)::INT AS edits, coalesce(sum(e.d), 0)::INT AS delta FROM feat f LEFT JOIN edit e USING (row_key, ord) GROUP BY 1",
        "evidence_resolve": f"WITH {FEATURES}, dict AS (SELECT row_key, 'E' || (ord % 3) AS k, arg_max(evidence_code, ord) AS code FROM feat WHERE evidence_code IS NOT NULL GROUP BY 1, 2), keys AS (SELECT * FROM (VALUES (1, 'E2'), (2, 'E0'), (3, 'E9'), (4, 'E0')) t(i, k)), got AS (SELECT row_key, string_agg(code, ';' ORDER BY i) AS codes, max({CONFIDENCE.format('code')}) AS c FROM dict JOIN keys USING (k) GROUP BY 1) SELECT row_key, codes, coalesce(c, 0.1)::DOUBLE AS confidence FROM (SELECT DISTINCT row_key FROM feat) LEFT JOIN got USING (row_key)",
        "confidence_max": f"WITH {FEATURES} SELECT row_key, max({CONFIDENCE.format('evidence_code')})::DOUBLE AS confidence FROM feat GROUP BY 1",
        "isoform_explode_join": f"WITH {ISOFORMS} SELECT k AS id, row_key::VARCHAR AS parent_id, seq FROM iso JOIN side USING (k) JOIN orders ON o_orderkey = row_key UNION ALL SELECT o_orderkey::VARCHAR, o_orderkey::VARCHAR, 'MTAK' FROM orders WHERE o_orderkey NOT IN (SELECT row_key FROM feat)",
        "isoform_missing": f"WITH {ISOFORMS} SELECT row_key::VARCHAR AS parent_id, k AS isoform_id FROM iso JOIN orders ON o_orderkey = row_key WHERE NOT EXISTS (SELECT 1 FROM side WHERE side.k = iso.k)",
        "ptm_validate": f"WITH {JUDGED} SELECT coalesce(code, 'MAPPED') AS status, mod_type, count(*) AS n, coalesce(sum(coalesce(spot, 0)), 0)::BIGINT AS positions FROM fate GROUP BY 1, 2",
        "ptm_site_nest": f"WITH {JUDGED}, s AS (SELECT row_key, spot, any_value(own) AS own, string_agg(mod_type || '/' || (CASE evidence_code WHEN 'ECO:0000269' THEN 10 WHEN 'ECO:0007744' THEN 8 WHEN 'ECO:0000250' THEN 4 ELSE 1 END), ',' ORDER BY ord) AS mods FROM fate WHERE code IS NULL GROUP BY 1, 2), t AS (SELECT row_key, string_agg(spot || ':' || own || ':' || mods, ';' ORDER BY spot) AS sites FROM s GROUP BY 1) SELECT row_key, coalesce(sites, '') AS sites FROM (SELECT DISTINCT row_key FROM feat) LEFT JOIN t USING (row_key)",
        "run_counters": f"WITH {JUDGED} SELECT (SELECT count(DISTINCT row_key) FROM feat) AS entries, count(*) AS ptm_attempted, count(*) FILTER (WHERE code IS NULL) AS ptm_mapped, count(code) AS ptm_failed, "
        + ", ".join(f"count(*) FILTER (WHERE code = '{c}') AS ptm_failed_{c.lower()}" for c in ("CANONICAL_OOB", "VSP_DELETION_EVENT", "MAPPER_OOB", "VSP_UNRESOLVABLE", "ISOFORM_OOB", "RESIDUE_MISMATCH"))
        + " FROM fate",
        "aa_clean_len": f"SELECT p_partkey, {residue.format('p_name')}::INT AS whole, {residue.format(chr(39) + '  ' + chr(39) + ' || split_part(p_name, ' + chr(39) + ' ' + chr(39) + ', 2)')}::INT AS word, {residue.format('p_brand')}::INT AS brand, contains(lower(p_type), 'missing') OR p_size % 2 = 0 AS missing FROM part",
        "residue_lookup": "SELECT p_partkey, CASE WHEN p_size - 3 BETWEEN 1 AND length(p_name) THEN substr(p_name, p_size - 3, 1) END AS residue FROM part",
        "description_kinds": f"WITH {FEATURES} SELECT feature_type, description, count(*) AS n, {KIND} AS kind, {ACID} AS amino_acid, {CODE.format('')} AS code FROM feat GROUP BY feature_type, description",
        "fasta_keys": "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'P' || p_partkey || '-2' WHEN 1 THEN CASE WHEN contains(p_name, ' ') THEN split_part(p_name, ' ', 1) ELSE 'a' END WHEN 2 THEN split_part('tr||' || p_brand, ' ', 1) ELSE split_part(p_name, ' ', 1) END AS key FROM part",
        "isoform_keys": "SELECT p_partkey, CASE WHEN p_partkey % 4 = 1 THEN 'P1-2' ELSE 'I' || p_partkey END AS key FROM part",
        "existence_codes": f"SELECT o_orderkey, coalesce({existence}, 0)::INT AS existence FROM orders",
        "xml_roundtrip": f"WITH {FEATURES} SELECT 'P' || row_key AS id, 'ACDEFGHIKLMNPQRSTVWY' AS sequence, 9606 AS organism_id, string_agg(feature_type || '|' || description || '|' || place || '|' || 'ECO:0000269' || (CASE ord WHEN 1 THEN ';ECO:0000269' WHEN 2 THEN ';ECO:0007744' ELSE '' END), ';' ORDER BY ord) AS features, count(*) FILTER (WHERE feature_type = 'domain' AND place BETWEEN 1 AND 20)::INT AS domains, count(DISTINCT CASE WHEN feature_type <> 'domain' AND place BETWEEN 1 AND 20 THEN place END)::INT AS sites FROM feat GROUP BY row_key",
        "interaction_pairs": f"WITH {FEATURES}, p AS (SELECT row_key, (ord - 1) // 2 AS g, max(CASE WHEN ord % 2 = 1 THEN 'S' || l_suppkey END) AS a, max(CASE WHEN ord % 2 = 0 THEN 'S' || l_suppkey END) AS b FROM feat GROUP BY 1, 2) SELECT 'P' || row_key AS id, string_agg(a || '-' || coalesce(b, '') || ':ECO:0000269', ';' ORDER BY g) AS pairs FROM p GROUP BY row_key",
        "table_sites": f"WITH {PARSED}, each AS (SELECT *, 'phospho' AS kind FROM flat WHERE {PHOSPHO} UNION ALL SELECT *, 'oglcnac' AS kind FROM flat WHERE {OGLCNAC}) SELECT row_key, place AS position, kind, arg_max({ACID}, ord) AS amino_acid, arg_max(evidence_code, ord) AS evidence FROM each GROUP BY 1, 2, 3",
        "table_spectrum": f"WITH {PARSED} SELECT {KIND} AS mod_type, count(*) AS total, count(*) AS experimental, 0::BIGINT AS non_experimental, 0::BIGINT AS unknown, 1.0::DOUBLE AS ratio FROM flat WHERE feature_type IN ('modified residue', 'glycosylation site') GROUP BY 1 HAVING count(*) >= 20",
        "xml_metadata": f"WITH {ENTRIES} SELECT id, 'C' || k AS parent_id, c_name AS entry_name, 'Beta' || (k % 7) || ' subunit & co' AS protein_name, CASE WHEN k % 4 > 0 THEN 'G' || (k % 11) END AS gene_name, 'Genus no ' || c_nationkey AS organism_name, CASE WHEN k % 6 > 0 THEN (c_nationkey + 9600)::INT END AS organism_id, CASE WHEN k % 6 < 5 THEN (k % 6 + 1)::INT END AS existence, 'PDB|P' || (k % 13) || (CASE WHEN k % 2 = 0 THEN ';AlphaFoldDB|A' || k ELSE '' END) AS structures FROM made",
        "xml_nested_text": f"WITH {ENTRIES} SELECT id, 'Beta' || (k % 7) || ' subunit & co' AS protein_name, 'Genus no ' || c_nationkey AS organism_name, CASE WHEN k % 8 > 0 THEN 'Outer membrane ' || (k % 3) || '|ECO:0000269;ECO:0000250;Cytosol|-' ELSE '' END AS location, CASE k % 4 WHEN 2 THEN '' ELSE 'Binds abc ' || (k % 9) || ' tightly.|' || (CASE k % 4 WHEN 1 THEN 'ECO:0000269|10' ELSE 'ECO:0000250|4' END) END AS subunits, 'AB|D2' AS natural_variants FROM made",
        "xml_isoforms": f"WITH {ENTRIES} SELECT id, 'C' || k AS parent_id, seq AS sequence, CASE WHEN k % 3 = 0 THEN 'C' || k || '-1|-|first one;C' || k || '-2|-|-' ELSE '' END AS isoforms, (8 + (k % 3 = 0)::INT)::INT AS features FROM made",
        "xml_routed_lists": f"WITH {ENTRIES}, p AS (SELECT id, k::VARCHAR AS k, (a + shift)::INT AS s FROM made) SELECT id, k || '|active site of it|' || s || '|' || s || '|ECO:0000250|4' AS active_sites, k || '|binding site of it|' || s || '|' || (s + 1) || '|-|1' AS binding_sites, '-|' || k || '|metal ion-binding site of it|2|2|-|1' AS metal_coordinations, k || '|mutagenesis site of it|' || (s + 3) || '|' || (s + 3) || '|ECO:0000269;ECO:0000250|10' AS mutagenesis_sites, 'domain of it|' || k || '|domain of it|' || s || '|' || (s + 2) || '|ECO:0000269|10' AS domains, 'AB|D2|' || k || '|sequence variant of it|1|1|-|1' AS natural_variants FROM p",
        "etl_table": f"WITH {ENTRIES} SELECT id, 'C' || k AS parent_id, seq AS sequence, CASE WHEN k % 6 > 0 THEN (c_nationkey + 9600)::INT END AS organism_id, (8 + (k % 3 = 0)::INT)::INT AS features, (a + shift)::INT || '|' || (a + shift + 2)::INT AS domains, (a + shift)::INT AS site FROM made",
        "etl_counters": f"WITH {ENTRIES}, n AS (SELECT count(*) AS made FROM made) SELECT made AS entries, (SELECT sum(8 + (k % 3 = 0)::INT) FROM entry)::BIGINT AS features, (SELECT count(*) * 2 FROM entry WHERE k % 3 = 0)::BIGINT AS isoforms, ceil(made / 1000.0)::BIGINT AS batches, made AS ptm_attempted, made AS ptm_mapped, 0::BIGINT AS ptm_failed FROM n",
        "etl_directory": f"WITH {ENTRIES} SELECT id, CASE WHEN k % 4 > 0 THEN 'G' || (k % 11) END AS gene_name, CASE WHEN k % 2 = 0 THEN 'even' ELSE 'odd' END AS file FROM made",
        "species_files": "SELECT * FROM (SELECT c_custkey, CASE c_nationkey % 5 WHEN 0 THEN 9606 WHEN 1 THEN 10090 WHEN 2 THEN 10116 END AS organism_id, CASE c_nationkey % 5 WHEN 0 THEN 'human' WHEN 1 THEN 'mouse' WHEN 2 THEN 'rat' END AS species FROM customer) WHERE species IS NOT NULL",
        "point_lookup": "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (7, -1) LIMIT 1",
    }
