"""Queries over the variant tables: QC, deduplication, filters, munging, allele checks."""
from __future__ import annotations

from pyspark.sql import functions as F

from assocspark.functions.tails import normal_quantile_sql
from assocspark.operators import alleles, filters, ordering
from assocspark.operators import variant_qc as vq
from assocspark.plans import jobs

from . import views as v
from .views import ORDER, q6, r6

KEYS = ["trait", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
_K = ", ".join(KEYS)


def row_qc_reasons(spark, sf):
    checks = vq.variant_checks("vcf_id", require_info=True)
    return vq.row_qc(vq.typed_variants(v.raw(spark, sf), require_info=True), checks).select(*KEYS, "QC_reason")


def validated_variants(spark, sf):
    return v.variants(spark, sf).good.select("trait", "SNP", "CHR", "POS", "A1", "A2", "eaf_A1", "beta", "se", "N", "coordinate_id",
                                             F.round("Z", 6).alias("Z"), F.round("p", 6).alias("p"))


def variant_issues(spark, sf):
    return v.variants(spark, sf).issues.select(*KEYS, "QC_action", "QC_reason")


def variant_summary(spark, sf):
    return v.variants(spark, sf).summary


def issue_report(spark, sf):
    found = v.variants(spark, sf, id_source="chr_pos_ref_alt", require_info=True)
    return vq.issue_report(v.raw(spark, sf), found.issues, ["trait", *ORDER]).select(
        *KEYS, "SNP", "CHR", "POS", "A1", "A2", "QC_action", "QC_reason")


def p_from_lp(spark, sf):
    return v.raw(spark, sf).select(*KEYS, F.round(F.log10(vq.lp_to_p("LP")), 6).alias("log_p"),
                                   F.round(vq.lp_to_p("LP", None), 6).alias("p_unfloored"))


def coordinate_ids(spark, sf):
    return v.raw(spark, sf).select("trait", vq.coordinate_id().alias("coordinate_id")).groupBy("trait", "coordinate_id").agg(
        F.count("*").alias("records"))


def id_failures(spark, sf):
    return vq.id_failures(v.raw(spark, sf), "SNP")


def sorted_variants(spark, sf):
    rows = v.variants(spark, sf, id_source="chr_pos_ref_alt").good
    ranked = ordering.global_rank(rows.select("CHR", "POS", "trait", *ORDER), ["CHR", "POS", "trait", *ORDER])
    return ranked.select("CHR", "POS", *KEYS, "rank")


def region_excluded(spark, sf):
    return filters.exclude_region(v.raw(spark, sf), 6, 100, 1000).groupBy("CHR").agg(
        F.count("*").alias("rows"), F.min("POS").alias("first_pos"), F.max("POS").alias("last_pos"))


def extraction(spark, sf):
    """Frequencies as INFO text, some missing, some vectors with a missing element."""
    return v.lineitem(spark, sf).selectExpr(*v.exprs({**v.RAW, **AF}), *ORDER)


AF = {
    "INFO_AF": "CASE WHEN l_linenumber = 6 THEN NULL WHEN l_quantity = 47 THEN '.' WHEN l_quantity = 46 THEN '0.125,.' "
               "WHEN l_quantity = 45 THEN '0.125,0.875' ELSE CAST(CAST(l_quantity AS DOUBLE) / 64 AS VARCHAR(20)) END",
    "INFO_EUR": "CASE WHEN l_quantity = 1 THEN '.' WHEN l_quantity = 45 THEN '0.125,0.125' WHEN l_quantity = 46 THEN '0.125,0.125' "
                "ELSE '0.25' END",
    "SI": "CASE WHEN l_linenumber = 4 THEN NULL ELSE CAST(l_quantity AS DOUBLE) / 50 END",
    "AF": "CAST(l_partkey % 100 AS DOUBLE) / 100",
    "REF": "CASE WHEN l_linenumber = 2 THEN 'A' ELSE 'C' END",
    "ALT": "CASE WHEN l_linenumber = 2 THEN 'T' WHEN l_linenumber = 3 THEN 'G' ELSE 'A' END",
    "NC": "CAST(100 + l_linenumber * 10 AS DOUBLE)",
    "NCO": "1000 * l_quantity",
}
_X = f"x AS ({v.select({**v.RAW, **AF}, 'lineitem', extra=ORDER)})"


def af_difference(spark, sf):
    return filters.af_difference_filter(extraction(spark, sf), 0.2).select(*KEYS, "INFO_AF", "INFO_EUR")


def af_audit(spark, sf):
    return filters.af_audit(extraction(spark, sf))


def info_maf(spark, sf):
    return filters.info_maf_filter(extraction(spark, sf), 0.7, 0.01).select(*KEYS, "SI", "AF")


def palindromes_removed(spark, sf):
    return filters.palindrome_filter(extraction(spark, sf), 0.45, 0.55).groupBy("trait", "REF", "ALT").agg(
        F.count("*").alias("rows"), F.sum("l_partkey").alias("part_sum"))


def case_medians(spark, sf):
    return filters.infer_prevalence(extraction(spark, sf)).withColumns(r6("case_fraction"))


def maf_folded(spark, sf):
    return v.variants(spark, sf).good.select("trait", "SNP", F.round(filters.fold_maf("eaf_A1"), 6).alias("MAF"))


def munged(spark, sf):
    """Text table with the missing spellings a munged file may hold, and some very large Z."""
    return v.lineitem(spark, sf).selectExpr(*v.exprs(MUNGED), *ORDER)


MUNGED = {
    "trait": v.RAW["trait"], "SNP": v.RAW["SNP"], "A1": v.RAW["A1"], "A2": v.RAW["A2"],
    "N": "CASE WHEN l_quantity = 44 THEN 'NA' ELSE CAST(CAST(1000 * l_quantity * CASE WHEN l_suppkey % 8 = 2 THEN 4 ELSE 1 END AS BIGINT) AS VARCHAR(20)) END",
    "Z": "CASE WHEN l_quantity = 43 THEN 'NA' WHEN l_quantity = 42 THEN '' WHEN l_quantity = 41 THEN '.' "
         "WHEN l_quantity = 40 THEN '-9' WHEN l_quantity = 39 THEN CAST(8 + l_linenumber AS VARCHAR(20)) "
         "ELSE CAST(l_linenumber - 3 AS VARCHAR(20)) END"}
_MUNGED = f"m0 AS ({v.select(MUNGED, 'lineitem', extra=ORDER)}), m AS (SELECT *, TRY_CAST(CASE WHEN Z IN ('', 'NA', '.') THEN NULL ELSE Z END AS DOUBLE) AS zn FROM m0)"
_AUTO = f"""{_MUNGED}, {v.LD_CTE},
cut AS (SELECT trait, greatest(CAST(80 AS DOUBLE), CAST('0.001' AS DOUBLE) * max(CAST(N AS DOUBLE))) AS chisq_max, max(CAST(N AS DOUBLE)) AS maximum_matched_n,
  count(*) AS complete_ld_matched_rows, CAST(0 AS BIGINT) AS invalid_n FROM m
  WHERE N <> 'NA' AND Z NOT IN ('', 'NA', '.') AND SNP IN (SELECT SNP FROM ldscore INTERSECT SELECT SNP FROM ldweights) GROUP BY trait)"""
_CHISQ = """SELECT m.trait, max({cut}) AS chisq_max, count(*) AS variants_before,
  count(*) FILTER (WHERE zn * zn > {cut}) AS variants_removed, count(*) FILTER (WHERE zn IS NULL OR zn * zn <= {cut}) AS variants_after,
  count(*) FILTER (WHERE zn IS NULL) AS variants_missing_z, max(zn * zn) AS maximum_chisq, CAST(0 AS BIGINT) AS fatal_rows FROM m {join} GROUP BY m.trait"""


def matched_snps(spark, sf):
    return filters.matched_snps(v.ldscore(spark, sf), v.ldweights(spark, sf))


def auto_cutoff(spark, sf):
    columns = ["SNP", "A1", "A2", "N", "Z"]
    return filters.auto_chisq_cutoff(munged(spark, sf), filters.matched_snps(v.ldscore(spark, sf), v.ldweights(spark, sf)), columns)


def chisq_fixed(spark, sf):
    return filters.chisq_filter(munged(spark, sf), 64.0)[2]


def chisq_fixed_excluded(spark, sf):
    return filters.chisq_filter(munged(spark, sf), 64.0)[1].groupBy("trait", "SNP").agg(
        F.count("*").alias("rows"), F.max("CHISQ").alias("max_chisq"), F.sum("Z").alias("z_sum"))


def chisq_fixed_kept(spark, sf):
    return filters.chisq_filter(munged(spark, sf), 64.0)[0].select(*KEYS, "SNP", "N", "Z")


def chisq_auto(spark, sf):
    return filters.chisq_filter(munged(spark, sf), auto_cutoff(spark, sf))[2]


def job_chisq_auto(spark, sf):
    """The checked job: its summary with mode, matched N and matched rows."""
    return jobs.chisq_filtered(munged(spark, sf), "auto", reference=v.ldscore(spark, sf), weights=v.ldweights(spark, sf), keys=("trait", *ORDER))[2]


def hm3_selected(spark, sf):
    kept, _ = filters.hm3_select(v.variants(spark, sf, require_info=True).good, v.hm3(spark, sf), keys=ORDER)
    return kept.select("trait", "SNP", "CHR", "POS", "A1", "A2", "N", "INFO")


def hm3_issues(spark, sf):
    """Regression-side issues: a reference-list removal replaces an earlier P adjustment of the same record."""
    found = v.variants(spark, sf, require_info=True)
    _, removed = filters.hm3_select(found.good, v.hm3(spark, sf), keys=ORDER)
    return vq.replace_issues(found.issues, removed, ["trait", *ORDER]).select(*KEYS, "QC_action", "QC_reason")


def n_overridden(spark, sf):
    wanted = v.manifest(spark, sf).selectExpr("trait", "try_cast(nullif(N, '') AS double) AS N")
    return filters.override_n(v.raw(spark, sf), wanted).groupBy("trait", "N_source").agg(
        F.count("*").alias("rows"), F.max("N").alias("max_n"), F.min("N").alias("min_n"))


def sample_metadata(spark, sf):
    return filters.resolve_sample_metadata(v.manifest(spark, sf))


def raw_regression_table(good):
    return good.select("trait", "SNP", "CHR", F.col("POS").alias("BP"), "A1", "A2", F.col("eaf_A1").alias("EAF"), F.col("beta").alias("BETA"),
                       F.col("se").alias("SE"), F.col("p").alias("P"), "N", "INFO")


def munge(spark, sf):
    good = v.variants(spark, sf, require_info=True).good
    return filters.munge(raw_regression_table(good), v.hm3(spark, sf), info_min=0.7).withColumns(r6("Z"))


def allele_classes(spark, sf):
    rows = alleles.classify_alleles(vq.typed_variants(v.raw(spark, sf)), v.hm3(spark, sf), ORDER)
    return rows.select(*KEYS, "SNP", "A1", "A2", "reference_A1", "reference_A2", "reason")


def allele_audit(spark, sf):
    return alleles.allele_audit(alleles.classify_alleles(vq.typed_variants(v.raw(spark, sf)), v.hm3(spark, sf), ORDER), ORDER)


_MUNGE_Z = normal_quantile_sql("(P / 2)")
_FIRST = f"row_number() OVER (PARTITION BY trait, SNP ORDER BY {', '.join(ORDER)})"
_CLASSES = f"""{v.HM3_CTE}, cls AS (SELECT r.*, h.A1 AS reference_A1, h.A2 AS reference_A2, translate(r.A1, 'ACGT', 'TGCA') AS f1, translate(r.A2, 'ACGT', 'TGCA') AS f2,
  {_FIRST.replace('trait, SNP', 'r.trait, r.SNP')} AS k FROM raw1 r LEFT JOIN hm3 h ON h.SNP = r.SNP),
classed AS (SELECT *, CASE WHEN k > 1 THEN 'duplicate SNP ID' WHEN reference_A1 IS NULL THEN 'SNP absent from allele reference'
  WHEN A1 = reference_A1 AND A2 = reference_A2 THEN CASE WHEN Z IS NULL THEN 'nonnumeric N/Z' END
  WHEN A1 = reference_A2 AND A2 = reference_A1 THEN 'swapped allele order'
  WHEN f1 = reference_A1 AND f2 = reference_A2 THEN 'strand-complemented allele pair'
  WHEN f2 = reference_A1 AND f1 = reference_A2 THEN 'swapped strand-complemented allele pair' ELSE 'incompatible allele pair' END AS reason FROM cls)"""


def _v(body: str, **kw) -> str:
    return f"WITH {v.variant_ctes(**kw)} {body}"


def _issues_sql(dup_keys: list[tuple[str, str]], columns: str) -> str:
    parts = [f"SELECT {columns}, 'removed' AS QC_action, QC_reason FROM qc WHERE QC_reason <> ''"]
    parts += [f"SELECT {columns}, 'duplicate_removed' AS QC_action, 'Duplicate {key}; retained largest valid LP, first original row on ties' AS QC_reason "
              f"FROM {source} WHERE {rank} > 1" for key, source, rank in dup_keys]
    parts.append(f"SELECT {columns}, 'p_adjusted' AS QC_action, 'P below 1e-300; floored to 1e-300' AS QC_reason FROM good WHERE LP > 300")
    return " UNION ALL ".join(parts)


_DUPS = [("coordinate_id", "r1", "k1"), ("SNP", "r2", "k2")]
_HM3_ISSUES = f"""SELECT {_K}, QC_action, QC_reason FROM ({_issues_sql(_DUPS, _K + ', SNP')}) i
  WHERE NOT (QC_action = 'p_adjusted' AND SNP NOT IN (SELECT SNP FROM hm3))
  UNION ALL SELECT {_K}, 'removed' AS QC_action, 'SNP not in HapMap reference' AS QC_reason FROM good WHERE SNP NOT IN (SELECT SNP FROM hm3)"""

QUERIES = {
    "row_qc_reasons": (row_qc_reasons, _v(f"SELECT {_K}, QC_reason FROM qc", require_info=True)),
    "validated_variants": (validated_variants, _v(
        f"SELECT trait, SNP, CHR, POS, A1, A2, eaf_A1, beta, se, N, coordinate_id, {q6('Z')} AS Z, {q6('p')} AS p FROM good")),
    "variant_issues": (variant_issues, _v(_issues_sql(_DUPS, _K))),
    "variant_summary": (variant_summary, _v(
        "SELECT q.trait, count(*) AS input_rows, max(g.kept) AS retained_rows, count(*) - max(g.kept) AS removed_rows, max(g.adj) AS p_adjusted_rows, "
        "count(*) FILTER (WHERE NOT CHR BETWEEN 1 AND 22) AS excluded_non_autosomal_rows FROM qc q JOIN "
        "(SELECT trait, count(*) AS kept, count(*) FILTER (WHERE LP > 300) AS adj FROM good GROUP BY trait) g ON g.trait = q.trait GROUP BY q.trait")),
    "issue_report": (issue_report, _v(_issues_sql(_DUPS[:1], _K + ", SNP, CHR, POS, A1, A2"), require_info=True, vcf_id=False)),
    "p_from_lp": (p_from_lp, _v(
        f"SELECT {_K}, {q6('log10(greatest(1e-300, pow(CAST(10 AS DOUBLE), -least(LP, 300))))')} AS log_p, "
        f"{q6('pow(CAST(10 AS DOUBLE), -LP)')} AS p_unfloored FROM raw0")),
    "coordinate_ids": (coordinate_ids, _v("SELECT trait, concat_ws('_', CHR, POS, A2, A1) AS coordinate_id, count(*) AS records FROM raw0 GROUP BY 1, 2")),
    "id_failures": (id_failures, _v(
        "SELECT trait, count(*) AS rows, count(DISTINCT SNP) AS distinct_ids, CAST(0 AS BIGINT) AS missing_ids, "
        "CAST(0 AS BIGINT) AS whitespace_ids, count(*) - count(DISTINCT SNP) AS repeated_rows FROM raw0 GROUP BY trait")),
    "sorted_variants": (sorted_variants, _v(
        f"SELECT CHR, POS, {_K}, row_number() OVER (ORDER BY CHR, POS, trait, {', '.join(ORDER)}) - 1 AS rank FROM good", vcf_id=False)),
    "region_excluded": (region_excluded, _v(
        "SELECT CHR, count(*) AS rows, min(POS) AS first_pos, max(POS) AS last_pos FROM raw0 WHERE NOT (CHR = 6 AND POS BETWEEN 100 AND 1000) GROUP BY CHR")),
    "af_difference": (af_difference, f"WITH {_X} SELECT {_K}, INFO_AF, INFO_EUR FROM x WHERE INFO_AF IS NOT NULL AND INFO_AF NOT LIKE '%.' "
                      "AND INFO_EUR <> '.' AND INFO_AF NOT LIKE '%,%' AND abs(TRY_CAST(INFO_AF AS DOUBLE) - TRY_CAST(INFO_EUR AS DOUBLE)) <= CAST('0.2' AS DOUBLE)"),
    "af_audit": (af_audit, f"WITH {_X}, f AS (SELECT *, (INFO_AF IS NULL OR INFO_AF IN ('.', '0.125,.')) AS a, INFO_EUR = '.' AS e FROM x) "
                 "SELECT trait, count(*) AS records_after_mhc, count(*) FILTER (WHERE a) AS missing_info_af, count(*) FILTER (WHERE e) AS missing_info_eur, "
                 "count(*) FILTER (WHERE a OR e) AS excluded_missing_either FROM f GROUP BY trait"),
    "info_maf": (info_maf, f"WITH {_X} SELECT {_K}, SI, AF FROM x WHERE SI >= CAST('0.7' AS DOUBLE) AND AF BETWEEN CAST('0.01' AS DOUBLE) AND 1 - CAST('0.01' AS DOUBLE)"),
    "palindromes_removed": (palindromes_removed, f"WITH {_X} SELECT trait, REF, ALT, count(*) AS rows, CAST(sum(l_partkey) AS BIGINT) AS part_sum FROM x "
                            "WHERE NOT (REF || ALT IN ('AT', 'TA', 'CG', 'GC') AND AF BETWEEN CAST('0.45' AS DOUBLE) AND CAST('0.55' AS DOUBLE)) GROUP BY 1, 2, 3"),
    "case_medians": (case_medians, f"WITH {_X} SELECT trait, count(*) AS variants, CAST(0 AS BIGINT) AS invalid_counts, median(NC) AS median_cases, "
                     f"median(NCO) AS median_controls, {q6('median(NC / (NC + NCO))')} AS case_fraction FROM x GROUP BY trait"),
    "maf_folded": (maf_folded, _v(f"SELECT trait, SNP, {q6('least(eaf_A1, 1 - eaf_A1)')} AS MAF FROM good")),
    "matched_snps": (matched_snps, f"WITH {v.LD_CTE} SELECT SNP FROM ldscore INTERSECT SELECT SNP FROM ldweights"),
    "auto_cutoff": (auto_cutoff, f"WITH {_AUTO} SELECT * FROM cut"),
    "chisq_fixed": (chisq_fixed, f"WITH {_MUNGED} " + _CHISQ.format(cut="CAST(64 AS DOUBLE)", join="")),
    "chisq_fixed_excluded": (chisq_fixed_excluded, f"WITH {_MUNGED} SELECT trait, SNP, count(*) AS rows, max(zn * zn) AS max_chisq, sum(zn) AS z_sum "
                             "FROM m WHERE zn * zn > 64 GROUP BY 1, 2"),
    "chisq_fixed_kept": (chisq_fixed_kept, f"WITH {_MUNGED} SELECT {_K}, SNP, N, zn AS Z FROM m WHERE zn IS NULL OR zn * zn <= 64"),
    "chisq_auto": (chisq_auto, f"WITH {_AUTO} " + _CHISQ.format(cut="cut.chisq_max", join="JOIN cut ON cut.trait = m.trait")),
    "job_chisq_auto": (job_chisq_auto, f"WITH {_AUTO}, s AS (" + _CHISQ.format(cut="cut.chisq_max", join="JOIN cut ON cut.trait = m.trait")
                       + ") SELECT s.*, 'auto' AS threshold_mode, maximum_matched_n, complete_ld_matched_rows FROM s JOIN cut ON cut.trait = s.trait"),
    "hm3_selected": (hm3_selected, f"WITH {v.variant_ctes(require_info=True)}, {v.HM3_CTE} "
                     "SELECT trait, SNP, CHR, POS, A1, A2, N, INFO FROM good WHERE SNP IN (SELECT SNP FROM hm3)"),
    "hm3_issues": (hm3_issues, f"WITH {v.variant_ctes(require_info=True)}, {v.HM3_CTE} {_HM3_ISSUES}"),
    "n_overridden": (n_overridden, _v(
        "SELECT trait, CASE WHEN trait_order IN (3, 5, 6) THEN 'manifest_N' ELSE 'FORMAT/NEF' END AS N_source, count(*) AS rows, "
        "max(CASE trait_order WHEN 3 THEN 40000 WHEN 5 THEN -1 WHEN 6 THEN 30000 ELSE N END) AS max_n, "
        "min(CASE trait_order WHEN 3 THEN 40000 WHEN 5 THEN -1 WHEN 6 THEN 30000 ELSE N END) AS min_n FROM raw0 GROUP BY trait, trait_order")),
    "sample_metadata": (sample_metadata, f"WITH {v.MANIFEST_CTE} SELECT trait, trait_order, "
                        "CASE trait_order WHEN 3 THEN CAST(40000 AS DOUBLE) WHEN 5 THEN -1 WHEN 6 THEN 30000 END AS N, "
                        "CASE trait_order WHEN 3 THEN CAST('0.3' AS DOUBLE) WHEN 6 THEN CAST('0.5' AS DOUBLE) WHEN 7 THEN CAST('1.5' AS DOUBLE) END AS sample_prevalence, "
                        "CASE trait_order WHEN 3 THEN CAST('0.01' AS DOUBLE) WHEN 4 THEN CAST('0.1' AS DOUBLE) END AS population_prevalence, "
                        "CASE trait_order WHEN 4 THEN 'supply both prevalences or neither; binary trait requires explicit total N' "
                        "WHEN 5 THEN 'manifest N must be finite and positive' WHEN 6 THEN 'supply both prevalences or neither' "
                        "WHEN 7 THEN 'sample_prevalence must be finite and strictly between 0 and 1; supply both prevalences or neither' ELSE '' END AS reason FROM manifest"),
    "munge": (munge, f"WITH {v.variant_ctes(require_info=True)}, {v.HM3_CTE}, u AS (SELECT *, p AS P0 FROM good WHERE INFO >= CAST('0.7' AS DOUBLE) "
              "AND least(eaf_A1, 1 - eaf_A1) > CAST('0.01' AS DOUBLE) AND A1 || A2 NOT IN ('AT', 'TA', 'CG', 'GC')) "
              f"SELECT u.trait, u.SNP, u.A1, u.A2, u.N, {q6(f'CASE WHEN beta < 0 THEN -1 ELSE 1 END * abs({_MUNGE_Z})')} AS Z FROM u JOIN hm3 h ON h.SNP = u.SNP "
              "WHERE (u.A1, u.A2) IN ((h.A1, h.A2), (h.A2, h.A1), (translate(h.A1, 'ACGT', 'TGCA'), translate(h.A2, 'ACGT', 'TGCA')), "
              "(translate(h.A2, 'ACGT', 'TGCA'), translate(h.A1, 'ACGT', 'TGCA')))"),
    "allele_classes": (allele_classes, f"WITH {v.variant_ctes()}, {_CLASSES} SELECT {_K}, SNP, A1, A2, reference_A1, reference_A2, reason FROM classed"),
    "allele_audit": (allele_audit, f"WITH {v.variant_ctes()}, {_CLASSES}, bad AS (SELECT *, row_number() OVER (PARTITION BY trait ORDER BY {', '.join(ORDER)}) AS b "
                     "FROM classed WHERE reason IS NOT NULL) SELECT c.trait, CASE WHEN max(b.reason) IS NULL THEN 'accepted' ELSE 'error' END AS status, "
                     "coalesce(max(b.reason), 'exact reference allele order; no edits') AS reason, max(b.SNP) AS SNP, max(b.A1) AS A1, max(b.A2) AS A2, "
                     "max(b.reference_A1) AS reference_A1, max(b.reference_A2) AS reference_A2, count(*) FILTER (WHERE c.reason IS NULL) AS n_snps "
                     "FROM classed c LEFT JOIN bad b ON b.trait = c.trait AND b.b = 1 GROUP BY c.trait"),
}
