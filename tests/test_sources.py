import gzip
import itertools

import pytest
from pyspark.sql import functions as F

from assocspark.operators import filters
from assocspark.plans import jobs
from assocspark.sources import sinks, tables, text

HEADER = "##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ttrait\n"


def vcf(path, records, header=HEADER):
    path.write_text(header + "".join("\t".join(map(str, r)) + "\n" for r in records))
    return str(path)


def test_vcf_scan_reads_keys_by_name(spark, tmp_path, rows):
    records = [(1, 10, "rs1", "A", "G", ".", "PASS", "AF=.1", "AF:ES:SE:LP:NEF", "0.1:0.2:0.1:3:100"),
               ("chr2", 20, ".", "C", "T", ".", "PASS", ".", "LP:SE:ES:AF", "4:.:0.5:0.3"),
               (3, 30, "rs3", "C", "T", ".", "PASS", ".", "AF:ES:SE:LP:NEF", "0.1:0.2")]
    path = vcf(tmp_path / "one file.vcf", records)
    out = text.read_gwas_vcf(spark, {"T 1": path})
    assert rows(out, "trait", "SNP", "CHR", "POS", "A1", "A2", "eaf_A1", "beta", "se", "LP", "N") == [
        ("T 1", None, "chr2", "20", "T", "C", "0.3", "0.5", None, "4", None),
        ("T 1", "rs1", "1", "10", "G", "A", "0.1", "0.2", "0.1", "3", "100"),
        ("T 1", "rs3", "3", "30", "T", "C", "0.1", "0.2", None, None, None)]
    ordered = [r.POS for r in out.orderBy(*text.ROW_ORDER).collect()]
    assert ordered == ["10", "20", "30"]


def test_vcf_needs_one_sample(spark, tmp_path):
    two = vcf(tmp_path / "two.vcf", [], HEADER.replace("trait", "a\tb"))
    record = (1, 10, "rs1", "A", "G", ".", "PASS", ".", "AF", "0.1")
    wide = vcf(tmp_path / "wide.vcf", [record, (*record, "0.2")])
    none = vcf(tmp_path / "none.vcf", [record[:9]])
    for path, found in ((two, 2), (wide, 2), (none, 0)):  # the scan that reads the records raises
        with pytest.raises(Exception, match=f"exactly one sample per file; found {found} in T"):
            text.read_gwas_vcf(spark, {"T": path}).collect()


def test_many_files_are_one_scan(spark, tmp_path):
    paths = {}
    for k in range(300):
        path = tmp_path / f"trait {k}.tsv"
        path.write_text("SNPID\tCHR\tBP\tA1\tA2\tEAF\tN\tZ\tp\tP\n" if k % 2 else "SNPID\tCHR\tBP\tEA\tOA\tEAF\tN\tZ\tP\n")
        with path.open("a") as f:
            f.write(f"rs{k}\t1\t{k}\tA\tG\t.5\t10\t1.5\t" + ("9\t.25\n" if k % 2 else ".25\n"))
        paths[f"t{k}"] = str(path)
    rows = tables.read_assoc(spark, paths)
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("Relation [") <= 2
    got = rows.collect()
    assert {(r.trait, r.trait_order, r.SNPID, r.EA, r.P) for r in got} == {(f"t{k}", k, f"rs{k}", "A", .25) for k in range(300)} and len(got) == 300
    with pytest.raises(ValueError, match="empty"):
        (tmp_path / "void.tsv").write_text("")
        tables.read_assoc(spark, {"v": str(tmp_path / "void.tsv")})


FREQUENCIES = {None: None, ".": None, "0.2": .2, "0.2,.": None, "0.9": .9}


def test_extraction_audit_and_filters(spark, tmp_path, rows):
    """Every combination of the two frequency tags, against rules applied by hand, plus one record per other filter."""
    made, kept, missing = [], set(), [0, 0, 0]
    for number, (af, eur) in enumerate(itertools.product(FREQUENCIES, repeat=2)):
        name = f"m{number}"
        info = ";".join(f"{tag}={value}" for tag, value in (("AF", af), ("XAF", "0.2"), ("EUR", eur)) if value is not None)
        made.append((2, 700 + number, name, "C", "T", ".", "PASS", info, "NC:LP:EZ:AF:NEF:SI:NCO", "50:3:-1.5:0.3:800:0.95:150"))
        a, e = FREQUENCIES[af], FREQUENCIES[eur]
        missing = [missing[0] + (a is None), missing[1] + (e is None), missing[2] + (a is None or e is None)]
        if a is not None and e is not None and abs(a - e) <= .1:
            kept.add(name)
    extra = [("rare", 2, 5, "50:3:1:0.0004:800:0.95:150"), ("unsure", 2, 6, "50:3:1:0.3:800:0.2:150"), ("hla", 6, 31_500_000, "50:3:1:0.3:800:0.95:150")]
    made += [(chrom, pos, name, "C", "T", ".", "PASS", "EUR=0.2;AF=0.2", "NC:LP:EZ:AF:NEF:SI:NCO", values) for name, chrom, pos, values in extra]
    table = text.read_gwas_vcf(spark, {"cohort": vcf(tmp_path / "cohort.vcf", made)}, text.EXTRACT_FIELDS, info=("AF", "EUR"))
    table = table.unionByName(table.withColumn("trait", F.lit("cases")))
    manifest = spark.createDataFrame([("cohort", 0, None, None), ("cases", 1, None, "0.05")], "trait string, trait_order int, sample_prevalence string, population_prevalence string")
    out, audit, prevalence = jobs.extract(table, manifest, settings=filters.VariantFilters(exclude_mhc=True, max_af_difference=.1))
    for trait, size in (("cohort", 800.0), ("cases", 200.0)):
        found = out.filter(F.col("trait") == trait).collect()
        assert {r.SNP for r in found} == kept and {r.N for r in found} == {size}
    assert rows(audit, "records_after_mhc", "missing_info_af", "missing_info_eur", "excluded_missing_either") == [(27, *missing)] * 2
    assert rows(prevalence, "trait", "sample_prevalence", "sample_prevalence_source") == [("cases", .25, "median_case_fraction"), ("cohort", None, None)]
    for value in ("1.5", "0", "x"):
        with pytest.raises(ValueError, match="cases: population_prevalence"):
            jobs.extract(table, manifest.withColumn("population_prevalence", F.when(F.col("trait") == "cases", value)))


def test_manifest_keeps_names_and_order(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text("traitname,N,note\n001,,x\nNA,5,\nz,,\"a,b\"\n")
    out = text.read_manifest(spark, str(path)).orderBy("trait_order").collect()
    assert [(r.trait, r.trait_order, r.N, r.note) for r in out] == [("001", 0, "", "x"), ("NA", 1, "5", ""), ("z", 2, "", "a,b")]
    path.write_text("traitname\na\na\n")
    with pytest.raises(ValueError, match="unique"):
        text.read_manifest(spark, str(path))


def test_sumstats_layouts_and_bad_lines(spark, tmp_path, rows):
    a, b = tmp_path / "a.sumstats.gz", tmp_path / "b.txt"
    a.write_bytes(gzip.compress(b"SNP\tA1\tA2\tN\tZ\nrs1\tA\tG\t100\t1\nrs2\tA\t\t\t\nrs3\tA\n"))
    b.write_text("SNP  Z N\nrs1   2  7\n")
    good, bad = text.read_sumstats(spark, {"A": str(a), "B": str(b)})
    assert rows(good, "trait", "SNP", "N", "Z", "A2") == [("A", "rs1", "100", "1", "G"), ("A", "rs2", "", "", ""), ("B", "rs1", "7", "2", None)]
    assert rows(bad, "trait", "value") == [("A", "rs3\tA")]


def test_ldscores_read_all_chromosomes(spark, tmp_path):
    for c in range(1, 23):
        (tmp_path / f"{c}.l2.ldscore.gz").write_bytes(gzip.compress(f"CHR\tSNP\tBP\tL2\n{c}\trs{c}\t{c}\t1.5\n{c}\tNA\t9\t1\n".encode()))
        (tmp_path / f"{c}.l2.M_5_50").write_text("10\n")
    out = text.read_ldscores(spark, str(tmp_path))
    assert out.count() == 22 and dict(out.dtypes)["L2"] == "double"
    assert text.read_reference_snp_count(spark, str(tmp_path)) == 220


def test_pair_table_guard(spark, tmp_path):
    names = "p1,p2,rg,se,z,p,h2_int,h2_int_se,gcov_int,gcov_int_se,h2_obs,h2_obs_se"
    path = tmp_path / "p.csv"
    path.write_text(names + "\nNA,001,.5,.1,5,1e-310,1,.1,0,.1,.2,NaN\nNA,zz,.5,.1,5,1,1,.1,0,.1,.2,.1\n")
    traits = spark.createDataFrame([("NA",), ("001",)], "trait string")
    out = tables.read_pairs(spark, [str(path)], traits).collect()
    assert len(out) == 1 and out[0].p1 == "NA" and out[0].p == 1e-310 and out[0].h2_obs_se is None
    assert tables.export_retained(spark, str(path), traits).collect()[0].p == "1e-310"
    path.write_text(names + "\nNA,001,.5x,.1,5,1,1,.1,0,.1,.2,.1\n")
    with pytest.raises(ValueError, match="non-numeric value"):
        tables.read_pairs(spark, [str(path)])
    path.write_text("p1,p2,rg\nA,B,1\n")
    with pytest.raises(ValueError, match="missing columns"):
        tables.read_pairs(spark, [str(path)])


def test_assoc_aliases(spark, tmp_path):
    path = tmp_path / "a.tsv"
    path.write_text("A1\tA2\tp\tSNPID\tCHR\tBP\tEAF\tN\tZ\textra\nA\tG\t.5\trs1\t1\t7\t.2\t100\t1.5\tq\n")
    out = tables.read_assoc(spark, {"T": str(path)}).collect()[0]
    assert (out.EA, out.OA, out.P, out.BP, out.trait_order) == ("A", "G", .5, 7, 0)
    assert tables.canonical_assoc_columns(["A1", "EA", "OA", "P", "SNPID", "CHR", "BP", "EAF", "N", "Z"])["EA"] == "EA"
    with pytest.raises(ValueError, match="missing required"):
        tables.canonical_assoc_columns(["SNPID"])


def test_matrix_bundle_checks(spark, tmp_path):
    def bundle(skew=0.0, drop=None):
        cells = []
        for m, k in (("S", 2), ("I", 2), ("S_Stand", 2), ("V", 3), ("V_Stand", 3)):
            cells += [("p", m, i, j, 1.0 + (skew if (i, j) == (0, 1) else 0)) for i in range(k) for j in range(k) if m != drop]
        return spark.createDataFrame(cells, "panel_id string, matrix string, i int, j int, value double")
    tables.check_bundle(bundle())
    with pytest.raises(ValueError, match="asymmetric"):
        tables.check_bundle(bundle(skew=1e-3))
    with pytest.raises(ValueError, match="must contain"):
        tables.check_bundle(bundle(drop="V"))


def test_split_sink_needs_every_chromosome(spark, tmp_path):
    data = spark.range(22).select(F.lit("T").alias("trait"), (F.col("id") + 1).alias("CHR"), F.concat(F.lit("rs"), "id").alias("SNPID"), F.lit(0.1).alias("Z"))
    sinks.write_assoc(data, str(tmp_path / "ok"))
    assert spark.read.parquet(str(tmp_path / "ok")).count() == 22
    with pytest.raises(ValueError, match="chromosomes 1-22"):
        sinks.write_assoc(data.filter("CHR <> 4"), str(tmp_path / "bad"))
    sinks.write_table(spark.sql("select 0.1D + 0.2D AS a, cast(null as string) AS b, 1.0E-310D AS c"), str(tmp_path / "t"), separator="\t", compression="none")
    assert [r.value for r in spark.read.text(str(tmp_path / "t")).collect()] == ["a\tb\tc", "0.30000000000000004\t\t1.0E-310"]


def test_association_columns_go_by_case_and_position(spark, tmp_path):
    path = tmp_path / "a.tsv"
    path.write_text("SNPID\tCHR\tBP\tEA\tOA\tEAF\tN\tZ\tp\tP\nv\t1\t2\tA\tC\t.5\t10\t1\t0.9\t0.3\n")
    assert tables.read_assoc(spark, {"T": str(path)}).first().P == 0.3
    for extra in ("w\t1\t2\tA\tC\t.5\t10\t1\t0.9\n", "w\t1\t2\tA\tC\t.5\t10\t1\t0.9\t0.3\t7\n"):
        path.write_text("SNPID\tCHR\tBP\tEA\tOA\tEAF\tN\tZ\tp\tP\n" + extra)
        with pytest.raises(Exception, match="MALFORMED|Malformed"):
            tables.read_assoc(spark, {"T": str(path)}).select("SNPID").collect()


def test_ragged_manifest_is_an_error(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text("traitname,N\na,1\nb,2,3\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        text.read_manifest(spark, str(path)).collect()
