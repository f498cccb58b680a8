"""Queries over scans and sinks: variant lines, layouts, completeness, fingerprints, incremental planning."""
from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from assocspark.operators import matrices, provenance
from assocspark.operators import pairs as pair_ops
from assocspark.sources import sinks, tables, text

from . import pairs as pq
from . import views as v
from .variants import _v
from .views import q6

# One text line per lineitem row; trailing fields are dropped on some, keys reordered on others.
LINE = ("concat_ws('\t', CASE WHEN l_linenumber = 1 THEN concat('chr', CAST(l_partkey % 22 + 1 AS STRING)) ELSE CAST(l_partkey % 22 + 1 AS STRING) END, CAST(l_partkey + 1 AS STRING), "
        "CASE WHEN l_quantity = 7 THEN '.' ELSE concat('rs', CAST(l_partkey AS STRING)) END, 'A', 'G', '.', 'PASS', "
        "CASE WHEN l_linenumber = 2 THEN '.' ELSE concat('EAF=9;AF=', CAST(l_suppkey AS STRING), ';EUR=0.5') END, "
        "CASE WHEN l_linenumber = 3 THEN 'NEF:LP' ELSE 'LP:ES:NEF' END, "
        "CASE WHEN l_linenumber = 3 THEN concat(CAST(l_orderkey AS STRING), ':.') WHEN l_linenumber = 4 THEN CAST(l_partkey AS STRING) "
        "ELSE concat(CAST(l_partkey AS STRING), ':', CAST(l_suppkey AS STRING), ':', CAST(l_orderkey AS STRING)) END)")
ROW = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


def vcf_scan(spark, sf):
    lines = v.lineitem(spark, sf).selectExpr(*ROW, f"{LINE} AS value")
    return text.parse_vcf_lines(lines, {"LP": "LP", "ES": "beta", "NEF": "N", "SI": "INFO"}, info=("AF", "EUR", "DP"))


def vcf_samples(spark, sf):
    lines = v.table(spark, sf, "supplier").selectExpr(
        "s_nationkey AS trait", "concat_ws('\t', '#CHROM', 'POS', 'ID', 'REF', 'ALT', 'QUAL', 'FILTER', 'INFO', 'FORMAT', 'a', CASE WHEN s_nationkey % 5 = 0 THEN 'b' END) AS value")
    return text.vcf_sample_counts(lines)


def assoc_table(spark, sf):
    good = v.variants(spark, sf, id_source="chr_pos_ref_alt").good
    return sinks.assoc_table(good).withColumns({"Z": F.round("Z", 6), "P": F.round("P", 6)})


def missing_chromosomes(spark, sf):
    rows = v.assoc(spark, sf).filter("NOT (trait = 'T3' AND CHR IN (4, 9)) AND NOT (trait = 'T5' AND CHR = 22)")
    return sinks.missing_chromosomes(rows).select("trait", F.concat_ws(",", F.transform("missing", lambda x: x.cast("string"))).alias("missing"))


def munge_input_folded(spark, sf):
    good = v.variants(spark, sf, require_info=True).good
    return sinks.munge_input(good, "folded_maf").select("trait", "SNP", "CHR", "POS", "A1", "A2", F.round("MAF", 6).alias("MAF"), "beta", "se", "N", "INFO")


def munge_input_legacy(spark, sf):
    good = v.variants(spark, sf, id_source="chr_pos_ref_alt").good
    return sinks.munge_input(good, "legacy", "chr_pos_ref_alt").select("trait", "SNP", "CHR", "POS", "A1", "A2", "eaf_A1", "beta", "se", "N", F.round("p", 6).alias("p"))


def table_fingerprint(spark, sf):
    return provenance.table_fingerprint(v.raw(spark, sf), ["SNP", "CHR", "POS", "A1", "A2"])


def incremental_pairs(spark, sf):
    plan = pair_ops.plan_pairs(pq.manifest(spark, sf).withColumn("ref", F.lit("yes"))).select(
        "p1", "p2", F.concat("p1", F.lit("+"), "p2").alias("input_fingerprint"), F.lit("blocks=200").alias("parameters"))
    done = pq.dirty(spark, sf).filter("row_id % 10 = 0").select(
        "p1", "p2", F.when(F.col("p1") == "T1", "running").otherwise("completed").alias("status"),
        F.when(F.col("p2") == "T3", F.lit("old")).otherwise(F.concat("p1", F.lit("+"), "p2")).alias("input_fingerprint"), F.lit("blocks=200").alias("parameters"),
        F.lit("r").alias("result_fingerprint"), F.when(F.col("p1") == "T5", "changed").when(F.col("p2") != "T6", "r").alias("current_fingerprint"))
    return provenance.pairs_to_compute(plan, done).select("p1", "p2", "reason")


def settings_differences(spark, sf):
    m = pq.manifest(spark, sf)
    current = m.select("trait", F.lit("info_min").alias("name"), F.lit("0.7").alias("value"))
    saved = m.filter("trait_order > 1").select("trait", F.lit("info_min").alias("name"), F.when(F.col("trait_order") == 4, "0.9").otherwise("0.7").alias("value"))
    return provenance.settings_differences(saved, current)


def bundle_sizes(spark, sf):
    from .panels import cells, members
    parts = [matrices.subset_panels(cells(spark, sf, m).withColumn("matrix", F.lit(n)), members(spark, sf)) for m, n in (("S_Stand", "S"), ("I", "I"))]
    rows = parts[0].unionByName(parts[1]).filter("NOT (matrix = 'I' AND i = 3 AND j = 4)").select("panel_id", "matrix", "i", "j", "value")
    # Positions within the panel, as a stored bundle has them.
    place = members(spark, sf).withColumn("k", F.row_number().over(Window.partitionBy("panel_id").orderBy("trait_order")) - 1)
    for c in ("i", "j"):
        rows = rows.join(place.select("panel_id", F.col("trait_order").alias(c), F.col("k").alias(f"n_{c}")), ["panel_id", c])
    rows = rows.select("panel_id", "matrix", F.col("n_i").alias("i"), F.col("n_j").alias("j"), "value")
    return tables.bundle_sizes(rows).select("panel_id", "matrix", "entries", "dimension", "asymmetric", "valid")


LEAF = "CHR * 4096 + POS div 64"


def _versions(spark, sf):
    """The variant records, and a version of them with one trait's records of a range edited, some of another trait's dropped, and a new range added."""
    old = v.raw(spark, sf).select("trait", "SNP", "CHR", "POS", "A1", "A2", "beta", "N")
    new = old.filter("NOT (trait = 'T2' AND CHR = 5 AND POS < 1000)").withColumn("beta", F.when(F.expr("trait = 'T4' AND CHR = 7 AND POS % 200 < 3"), F.col("beta") + 1).otherwise(F.col("beta")))
    return old, new.unionByName(old.filter("trait = 'T6' AND CHR = 3").withColumn("POS", F.col("POS") + 100_000))


def _changes(spark, sf):
    trees = [provenance.digest_tree(t, ["SNP", "POS", "A1", "A2", "beta", "N"], group="trait", key=F.expr(LEAF)) for t in _versions(spark, sf)]
    return provenance.changed_ranges(*trees)


def changed_ranges(spark, sf):
    return _changes(spark, sf).withColumnRenamed("group", "trait")


def pairs_of_changes(spark, sf):
    return provenance.pairs_of_changes(_changes(spark, sf), pair_ops.plan_pairs(pq.manifest(spark, sf).withColumn("ref", F.lit("yes"))))


_SHA = "sha256(concat_ws('|', " + ", ".join(f"'=' || CAST({c} AS STRING)" for c in ("SNP", "CHR", "POS", "A1", "A2")) + "))"
_WORDS = "concat_ws('-', " + ", ".join(f"CAST(sum(CAST(CAST('0x' || substr({_SHA}, {16 * k + 1}, 16) AS UBIGINT) AS HUGEINT)) AS STRING)" for k in range(4)) + ")"

_CHANGES = f"""va AS (SELECT trait, {LEAF.replace('div', '//')} AS node, SNP, POS, A1, A2, beta, N, CHR FROM raw0),
vb0 AS (SELECT trait, CHR, SNP, POS, A1, A2, CASE WHEN trait = 'T4' AND CHR = 7 AND POS % 200 < 3 THEN beta + 1 ELSE beta END AS beta, N FROM raw0 WHERE NOT (trait = 'T2' AND CHR = 5 AND POS < 1000)
  UNION ALL SELECT trait, CHR, SNP, POS + 100000, A1, A2, beta, N FROM raw0 WHERE trait = 'T6' AND CHR = 3),
vb AS (SELECT trait, {LEAF.replace('div', '//')} AS node, SNP, POS, A1, A2, beta, N FROM vb0),
sa AS (SELECT trait, node, list_sort(list({{'s': SNP, 'p': POS, 'a': A1, 'b': A2, 'e': beta, 'n': N}})) AS rows FROM va GROUP BY 1, 2), sb AS (SELECT trait, node, list_sort(list({{'s': SNP, 'p': POS, 'a': A1, 'b': A2, 'e': beta, 'n': N}})) AS rows FROM vb GROUP BY 1, 2),
changes AS (SELECT coalesce(sa.trait, sb.trait) AS trait, CAST(coalesce(sa.node, sb.node) AS BIGINT) AS node, CASE WHEN sa.trait IS NULL THEN 'added' WHEN sb.trait IS NULL THEN 'removed' ELSE 'changed' END AS change
  FROM sa FULL JOIN sb ON sa.trait = sb.trait AND sa.node = sb.node WHERE sa.rows IS DISTINCT FROM sb.rows)"""

QUERIES = {
    "changed_ranges": (changed_ranges, _v("SELECT trait, node, change FROM changes").replace(" SELECT trait, node, change FROM changes", f", {_CHANGES} SELECT trait, node, change FROM changes")),
    "pairs_of_changes": (pairs_of_changes, _v("SELECT p1, p2 FROM x9").replace(" SELECT p1, p2 FROM x9", f""", {_CHANGES}, {pq.MANIFEST}, t AS (SELECT trait, count(*) AS k FROM changes GROUP BY trait)
  SELECT a.trait AS p1, b.trait AS p2, coalesce(x.k, 0) + CASE WHEN a.trait <> b.trait THEN coalesce(y.k, 0) ELSE 0 END AS ranges FROM manifest a CROSS JOIN manifest b LEFT JOIN t x ON x.trait = a.trait LEFT JOIN t y ON y.trait = b.trait
  WHERE x.k IS NOT NULL OR y.k IS NOT NULL""")),
    "vcf_scan": (vcf_scan, f"""SELECT {', '.join(ROW)}, CASE WHEN l_quantity <> 7 THEN 'rs' || l_partkey END AS SNP, CASE WHEN l_linenumber = 1 THEN 'chr' ELSE '' END || (l_partkey % 22 + 1) AS CHR,
  CAST(l_partkey + 1 AS STRING) AS POS, 'G' AS A1, 'A' AS A2, CASE WHEN l_linenumber <> 3 THEN CAST(l_partkey AS STRING) END AS LP, CASE WHEN l_linenumber NOT IN (3, 4) THEN CAST(l_suppkey AS STRING) END AS beta,
  CASE WHEN l_linenumber <> 4 THEN CAST(l_orderkey AS STRING) END AS N, CAST(NULL AS STRING) AS INFO, CASE WHEN l_linenumber <> 2 THEN CAST(l_suppkey AS STRING) END AS INFO_AF,
  CASE WHEN l_linenumber <> 2 THEN '0.5' END AS INFO_EUR, CAST(NULL AS STRING) AS INFO_DP FROM lineitem"""),
    "vcf_samples": (vcf_samples, "SELECT s_nationkey AS trait, max(CASE WHEN s_nationkey % 5 = 0 THEN 2 ELSE 1 END) AS samples FROM supplier GROUP BY 1"),
    "assoc_table": (assoc_table, _v(f"SELECT trait, trait_order, coordinate_id AS SNPID, CHR, POS AS BP, A1 AS EA, A2 AS OA, eaf_A1 AS EAF, N, {q6('Z')} AS Z, {q6('p')} AS P FROM good", vcf_id=False)),
    "missing_chromosomes": (missing_chromosomes, f"WITH {v.variant_ctes()}, {v.ASSOC_CTE}, a AS (SELECT * FROM assoc WHERE NOT (trait = 'T3' AND CHR IN (4, 9)) AND NOT (trait = 'T5' AND CHR = 22)), "
                            "c AS (SELECT t.trait, r.c FROM (SELECT DISTINCT trait FROM a) t, (SELECT unnest(range(1, 23)) AS c) r) "
                            "SELECT c.trait, string_agg(CAST(c.c AS STRING), ',' ORDER BY c.c) AS missing FROM c WHERE (c.trait, c.c) NOT IN (SELECT trait, CHR FROM a) GROUP BY c.trait"),
    "munge_input_folded": (munge_input_folded, _v(f"SELECT trait, SNP, CHR, POS, A1, A2, {q6('least(eaf_A1, 1 - eaf_A1)')} AS MAF, beta, se, N, INFO FROM good", require_info=True)),
    "munge_input_legacy": (munge_input_legacy, _v(f"SELECT trait, coordinate_id AS SNP, CHR, POS, A1, A2, eaf_A1, beta, se, N, {q6('p')} AS p FROM good", vcf_id=False)),
    "table_fingerprint": (table_fingerprint, _v(f"SELECT trait, count(*) AS rows, {_WORDS} AS fingerprint FROM raw0 GROUP BY trait")),
    "incremental_pairs": (incremental_pairs, f"WITH {pq.DIRTY}, {pq.MANIFEST}, plan AS (SELECT a.trait AS p1, b.trait AS p2 FROM manifest a, manifest b), done AS (SELECT p1, p2 FROM dirty WHERE row_id % 10 = 0) "
                          "SELECT p.p1, p.p2, CASE WHEN d.p1 IS NULL THEN 'result_or_checkpoint_missing' WHEN p.p1 = 'T1' THEN 'completion_not_verified' WHEN p.p2 = 'T3' THEN 'inputs_or_parameters_changed' "
                          "WHEN p.p1 = 'T5' THEN 'result_changed' WHEN p.p2 = 'T6' THEN 'result_or_checkpoint_missing' END AS reason FROM plan p LEFT JOIN done d ON d.p1 = p.p1 AND d.p2 = p.p2"),
    "settings_differences": (settings_differences, f"WITH {pq.MANIFEST} SELECT trait, 'info_min' AS name, '0.7' AS \"current\", CASE WHEN trait_order = 4 THEN '0.9' END AS saved FROM manifest WHERE trait_order IN (0, 1, 4)"),
    "bundle_sizes": (bundle_sizes, f"WITH {pq.MANIFEST}, p AS (SELECT 'all' AS panel_id, 8 AS k, true AS gap UNION ALL SELECT concat('without_', trait), 7, trait_order NOT IN (3, 4) FROM manifest) "
                     "SELECT panel_id, unnest(['S', 'I']) AS matrix, unnest([k * k, k * k - gap::INT]) AS entries, k AS dimension, 0 AS asymmetric, unnest([true, NOT gap]) AS valid FROM p"),
}
