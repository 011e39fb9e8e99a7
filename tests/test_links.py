"""Link jobs, labels and checks on small hand-worked inputs."""

import pytest
from conftest import rows

from regulink import operators as O
from regulink import plans as P
from regulink import sources as S
from regulink.schemas import BIOFEATURES, CHAIN_BLOCKS, GENES

GENE_COLUMNS = GENES.fieldNames()


def genes(spark, *records):
    return spark.createDataFrame([tuple(r.get(c) for c in GENE_COLUMNS) for r in records], GENES)


def labels(spark, **codes):
    return spark.createDataFrame(list(codes.items()), "biofeature_string string, biofeature_code string")


def identity(spark, shift=0):
    return spark.createDataFrame(
        [(i, 1, c, 0, 10**8, f"chr{c}", 10**8, "+", shift) for i, c in enumerate(["1", "2"])], CHAIN_BLOCKS
    )


def plan_run(df):
    """The plan that a query had in the end."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_gene_list_links(spark, tmp_path):
    path = tmp_path / "lists.csv"
    path.write_text(
        "gene_names,interval,biofeature_string\n"
        "AAA;bbb;nope,chr1.100.200,Fat\n"  # official, synonym, unknown
        "AAA;AAA,chr1.300.400,Lung\n"  # repeated names stay repeated
        "AAA,chr2.100.200,Fat\n"  # not on the gene's chromosome
        "syn,chr1.500.600,Fat\n"  # a synonym of two genes
        "AAA,chr1.90000.91000,Fat\n"  # beyond two standard deviations
    )
    table = genes(
        spark,
        dict(gene_id="G1", gene_name="AAA", gene_synonyms=["bbb"], gene_chrom="1", gene_start=0, gene_end=100),
        dict(gene_id="G2", gene_name="BBB", gene_synonyms=["AAA", "syn"], gene_chrom="1", gene_start=0, gene_end=100),
        dict(gene_id="G3", gene_name="CCC", gene_synonyms=["syn"], gene_chrom="1", gene_start=0, gene_end=100),
    )
    codes = labels(spark, Fat="F1", Lung="L1")
    built = P.build_gene_list_links(S.read_links_csv(spark, str(path)), table, codes, identity(spark))
    assert rows(built) == sorted(
        [
            ("1", 100, 200, "G1", 1.0, "F1"),
            ("1", 100, 200, "G1", 1.0, "F1"),
            ("1", 300, 400, "G1", 1.0, "L1"),
            ("1", 300, 400, "G1", 1.0, "L1"),
            ("1", 500, 600, "G2", 1.0, "F1"),
            ("1", 500, 600, "G3", 1.0, "F1"),
        ],
        key=repr,
    )


def test_capture_links(spark, tmp_path):
    for cell, lines in {
        "Tcell": [
            "chr1\t100\t200\tchr1:1000-2000,5.5\t1\t2",
            "chr1\t150\t300\tchr1:1000-2000,7.5\t1\t2",  # the same link again, better
            "chr1\t100\t200\tchr2:1000-2000,9\t1\t2",  # to another chromosome
            "chr1\t100\t200\tchr1:9000000-9000100,9\t1\t2",  # too far
            "chr1\t199\t300\tchr1:5000-5001,6\t1\t2",  # bait starts after the site
        ],
        "Bcell": ["chr1\t100\t200\tchr1:1000-2000,6\t1\t2"],
    }.items():
        (tmp_path / cell).mkdir()
        (tmp_path / cell / "raw.txt").write_text("\n".join(lines) + "\n")
    baits = S.read_bed(
        spark,
        f"{tmp_path}/*/raw.txt",
        {"chrom": (0, "string"), "start": (1, "long"), "end": (2, "long"), "target": (3, "string")},
        tag={"bio_feature": "/([^/]+)/raw.txt"},
    )
    tss = spark.createDataFrame(
        [("1", 170, 171, "G1", "."), ("1", 400, 401, "G2", ".")],
        "chrom string, start long, end long, name string, score string",
    )
    built = P.build_capture_links(baits, tss, labels(spark, Tcell="T", Bcell="B"), identity(spark, 10))
    assert rows(built) == [("1", 1011, 2010, "G1", 6.0, "B"), ("1", 1011, 2010, "G1", 7.5, "T")]


def test_large_capture_links_are_merged(spark, nothing_small):
    """Start sites and labels beyond the bound stay out of the driver, however small their files are."""
    baits = spark.createDataFrame(
        [("chr1", 100, 200, f"chr1:{1000 + i}-2000,5.5", "Tcell") for i in range(20)],
        "chrom string, start long, end long, target string, bio_feature string",
    )
    tss = spark.createDataFrame(
        [("1", 170, 171, "G1", "."), ("1", 400, 401, "G2", ".")],
        "chrom string, start long, end long, name string, score string",
    )
    built = P.build_capture_links(baits, tss, labels(spark, Tcell="T", Bcell="B"))
    assert plan_run(built).count("SortMergeJoin") == 2
    assert rows(built) == sorted([("1", 1001 + i, 2000, "G1", 5.5, "T") for i in range(20)], key=repr)


def test_enhancer_links(spark, tmp_path):
    path = tmp_path / "assoc.bed"
    names = [
        "chr1:100-200;NM_1;abc;R:0.5;0.01",
        "chr1:100-200;NM_2;abc;R:-0.8;0.01",  # same link, better when squared
        "chr1:100-200;NM_3;lower;R:0.5;0.01",  # dictionary names are compared as stored
        "chr2:100-200;NM_4;abc;R:0.9;0.01",
        "chr1:5000000-5000100;NM_5;abc;R:0.9;0.01",
    ]
    path.write_text("track name=x\n#chrom\ts\te\tname\n" + "".join(f"chr1\t1\t2\t{n}\n" for n in names))
    table = genes(
        spark,
        dict(gene_id="G1", gene_name="ABC", chr="1", tss=1000),
        dict(gene_id="G2", gene_name="lower", chr="1", tss=1000),
    )
    built = P.build_enhancer_links(S.read_bed(spark, str(path), {"name": (3, "string")}), table, identity(spark))
    assert rows(built) == [("1", 101, 200, "G1", pytest.approx(0.64), "unspecified")]


def test_large_enhancer_links_are_merged(spark, nothing_small):
    """A gene dictionary beyond the bound stays out of the driver, however small its files are."""
    packed = [(f"chr1:{100 + i}-200;NM_1;abc;R:0.5;0.01",) for i in range(20)]
    table = genes(
        spark,
        dict(gene_id="G1", gene_name="ABC", chr="1", tss=1000),
        dict(gene_id="G2", gene_name="ABC", chr="1", tss=2000),
    )
    built = P.build_enhancer_links(spark.createDataFrame(packed, "name string"), table)
    assert plan_run(built).count("SortMergeJoin") == 1
    found = [("1", 101 + i, 200, gene, 0.25, "unspecified") for i in range(20) for gene in ("G1", "G2")]
    assert rows(built) == sorted(found, key=repr)


def test_case_insensitive_symbols(spark):
    table = genes(spark, dict(gene_id="G2", gene_name="lower", chr="1", tss=1000))
    df = spark.createDataFrame([("Lower",)], "gene_symbol string")
    assert O.map_symbols(df, table).count() == 0
    assert rows(O.map_symbols(df, table, case_insensitive=True), "gene_symbol", "gene_id") == [("LOWER", "G2")]


def test_correlation_links(spark, tmp_path):
    path = tmp_path / "x.bed8"
    path.write_text(
        "chr1\t1\t2\tabc\tchr1\t100\t200\t0.7\n"
        "chr1\t1\t2\tABC\tchr1\t100\t200\t0.9\n"
        "chr1\t1\t2\tzzz\tchr1\t100\t200\t0.9\n"
        "chr1\t1\t2\tabc\tchrUn\t100\t200\t0.9\n"
    )
    rows_in = S.read_bed(
        spark,
        str(path),
        {
            "gene_symbol": (3, "string"), "chrom": (4, "string"), "start": (5, "long"),
            "end": (6, "long"), "score": (7, "double"),
        },
    )
    gtf_path = tmp_path / "x.gtf"
    gtf_path.write_text('1\ts\tgene\t1\t2\t.\t+\t.\tgene_id "G1"; gene_name "Abc";\n')
    built = P.build_correlation_links(rows_in, S.read_gtf(spark, str(gtf_path)), identity(spark))
    assert rows(built) == [("1", 101, 200, "G1", 0.9, "unspecified")]


def test_one_row_has_no_deviation(spark):
    df = spark.createDataFrame([(5.0,)], "distance double")
    assert O.within_sd(df).count() == 0


def test_keep_best_ignores_missing_scores(spark):
    df = spark.createDataFrame(
        [("1", 1, 2, "G", 0.2), ("1", 1, 2, "G", None), ("1", 1, 2, "G", float("nan")), ("1", 3, 4, "G", None)],
        "chrom string, start long, end long, gene_id string, score double",
    )
    assert rows(O.keep_best(df)) == [("1", 1, 2, "G", 0.2), ("1", 3, 4, "G", None)]


def test_thresholds_at_the_edge(spark):
    df = spark.createDataFrame([(9.0,), (10.0,)], "distance double")
    assert rows(O.within(df, 10)) == [(9.0,)]
    qtl = spark.createDataFrame([(0.05, 1), (0.025, 2), (0.03, 2), (0.0, 0)], "pval double, num_tests long")
    assert rows(O.bonferroni(qtl)) == [(0.025, 2), (0.05, 1)]


def test_strict_labels_name_the_missing_one(spark):
    df = spark.createDataFrame([("Fat",), ("Liver",)], "bio_feature string")
    codes = labels(spark, Fat="F1")
    with pytest.raises(Exception, match="no biofeature code for: Liver"):
        O.map_biofeature(df, codes).collect()
    assert rows(O.map_biofeature(df, codes, strict=False)) == [("F1",), (None,)]
    assert rows(O.missing_labels(df, codes)) == [("Liver", 1)]


def test_label_tables(spark):
    schema = (
        "study string, dataset string, qtl_group string, tissue_ontology_id string, tissue_label string, "
        "condition_label string, quant_method string"
    )
    metadata = spark.createDataFrame(
        [
            ("GTEx", "d", "blood_x", "U1", "blood", "naive", "ge"),
            ("Alasoo", "d", "mac", "U2", "macro_phage", "IFNg_18h", "microarray"),
            ("Other", "d", "z", "U3", "z", "naive", "exon"),
        ],
        schema,
    )
    other = spark.createDataFrame([("jung", None, "Fat", "F1", None, "Fat", None, None)], BIOFEATURES)
    built = P.build_biofeature_map(metadata, other)
    assert rows(built, "study", "biofeature_string", "biofeature_code", "label") == sorted(
        [
            (None, "Fat", "F1", "Fat"),
            ("GTEx-eQTL", "blood_x", "BLOOD_X", "blood"),
            ("Alasoo", "mac", "MAC", "macro phage IFNg 18h"),
            ("GTEx-eQTL", "GTEx-eQTL-blood_x", "GTEx-eQTL-BLOOD_X", "blood"),
            ("Alasoo", "Alasoo-mac", "Alasoo-MAC", "macro phage IFNg 18h"),
        ],
        key=repr,
    )


def test_cis_and_trans(spark):
    table = genes(spark, dict(gene_id="G1", chr="1", tss=2_000_000))
    df = spark.createDataFrame(
        [
            ("G1", "1", 1_000_000, 1e-5),
            ("G1", "1", 999_999, 1e-5),
            ("G1", "1", 999_999, 1e-9),
            ("G1", "2", 2_000_000, 1e-9),
            ("G1", "1", 2_000_000, 2.5e-5),
            ("G9", "1", 2_000_000, 1e-9),
        ],
        "gene_id string, chrom string, pos long, pval double",
    )
    assert rows(O.classify_cis_trans(df, table), "chrom", "pos", "regulation") == [
        ("1", 1_000_000, "cis_reg"), ("1", 999_999, "trans_reg"), ("2", 2_000_000, "trans_reg"),
    ]


def test_nearest_check(spark):
    ours = spark.createDataFrame(
        [("1_10_A_C", "G1"), ("1_10_A_T", "G2"), ("1_99_A_C", "G1")],
        "varid string, ensemblid_protein_coding string",
    )
    theirs = spark.createDataFrame(
        [("1:10", "a;NEAREST=x;NEAREST=G1"), ("2:10", "NEAREST=G1")], "loc string, info string"
    )
    assert rows(P.nearest_check(ours, theirs)) == [(2, 1)]


def test_coverage_check(spark):
    table = genes(
        spark,
        dict(gene_id="G1", gene_name="A", biotype="protein_coding"),
        dict(gene_id="G2", gene_name="B", biotype="protein_coding"),
        dict(gene_id="G3", gene_name="C", biotype="lincRNA"),
    )
    listed = spark.createDataFrame([("G1",), ("G1",), ("G3",)], "gene_id string")
    covered, summary = P.coverage_check(table, link_gene=listed, other_gene=listed.limit(0))
    assert covered.columns == ["biotype", "gene_id", "gene_name", "description", "link_gene", "other_gene"]
    assert rows(covered, "gene_id", "link_gene") == [("G1", True), ("G2", False)]
    assert rows(summary) == [(2, 1, 0)]


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(4.0,), (4.0,)], "delta double")
    assert rows(O.distance_histogram(df, 2)) == [(0, 3.5, 4.0, 0), (1, 4.0, 4.5, 2)]


def test_missing_value_stops_the_job(spark):
    df = spark.createDataFrame([("a",), (None,)], "x string")
    with pytest.raises(Exception, match="missing value in x"):
        O.assert_no_nulls(df, "x").collect()


def test_first_per_key(spark):
    df = spark.createDataFrame([("k", 2, "b"), ("k", 1, "c"), ("j", 5, None)], "k string, n long, v string")
    assert rows(O.first_per_key(df, ["k"], ["n"])) == [("j", 5, None), ("k", 1, "c")]


def test_distance_check_reads_the_links_once(spark, nothing_small):
    links = spark.createDataFrame(
        [("1", 0, 10 * i, f"G{i % 2}") for i in range(1, 9)] + [("2", 0, 10, "G1"), ("1", 0, 10, None)],
        "chrom string, start long, end long, gene_id string",
    )
    table = spark.createDataFrame([("G0", "1", 0), ("G1", "1", 5)], "gene_id string, chr string, tss long")
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    summary, histogram = P.distance_check(links.mapInArrow(counted, links.schema), table, bins=2)
    assert rows(summary, "count", "min", "p50", "max") == [(8, 0.0, 20.0, 40.0)]
    assert rows(histogram, "bin", "count") == [(0, 3), (1, 5)]
    assert read.value == 10


def test_gene_list_links_are_shuffled_for_their_names_only(spark, nothing_small, monkeypatch):
    from regulink.operators import joins

    shuffled, skew_join = [], joins.skew_join

    def noted(df, other, on, *args, **options):
        if "bio_feature" in df.columns:
            shuffled.append((list(on), sorted(other.columns)))
        return skew_join(df, other, on, *args, **options)

    monkeypatch.setattr(joins, "skew_join", noted)
    lists = spark.createDataFrame(
        [("AAA;bbb", "chr1.100.200", "Fat"), ("AAA;none", "chr2.100.200", "Fat"), ("BBB", "chr1.300.400", "Fat")],
        "gene_names string, interval string, biofeature_string string",
    )
    table = genes(
        spark,
        dict(gene_id="G1", gene_name="AAA", gene_synonyms=["bbb"], gene_chrom="1", gene_start=0, gene_end=100),
        dict(gene_id="G2", gene_name="BBB", gene_synonyms=[], gene_chrom="1", gene_start=0, gene_end=100),
        dict(gene_id=None, gene_name="BBB", gene_synonyms=[], gene_chrom="1", gene_start=0, gene_end=100),
    )
    built = P.build_gene_list_links(lists, table, labels(spark, Fat="F1"), identity(spark), sd_multiple=1000.0)
    expected = [("1", 100, 200, "G1")] * 2 + [("1", 300, 400, "G2")]
    assert rows(built, "chrom", "start", "end", "gene_id") == expected
    # the labels (before the text of an interval is taken apart no more than a code is added), and the names
    assert shuffled == [(["_label"], ["_code", "_label"]), (["gene_name"], ["gene_chrom", "gene_id", "gene_mid", "gene_name"])]
