"""Readers and writers on files as they come."""

import gzip
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from regulink import operators as O
from regulink import plans as P
from regulink import sources as S
from regulink.session import freeze


def write(path, text, compress=False):
    if compress:
        with gzip.open(path, "wt") as out:
            out.write(text)
    else:
        path.write_text(text)
    return str(path)


def test_read_intervals_by_position_from_many_files(spark, tmp_path):
    first = write(
        tmp_path / "a.tsv.gz",
        "chrom\tstart\tend\tensembl_id\tscore\tcell_type\n1\t10\t20\tG1\t0.5\tA\nX\t1\t2\tG2\t\tA\n",
        compress=True,
    )
    second = write(tmp_path / "b.tsv", "c\ts\te\tg\ts\tf\n2\t5\t6\tG3\tNaN\tB\n")
    df = S.read_intervals(spark, [first, second])
    assert df.columns == ["chrom", "start", "end", "gene_id", "score", "bio_feature"]
    assert rows(df) == sorted(
        [("1", 10, 20, "G1", 0.5, "A"), ("X", 1, 2, "G2", None, "A"), ("2", 5, 6, "G3", None, "B")],
        key=repr,
    )


def test_read_genes_of_both_shapes(spark, tmp_path):
    path = write(
        tmp_path / "genes.json",
        '{"gene_name":"A","gene_id":"G1","chr":"1","tss":5,"biotype":"protein_coding"}\n'
        '{"gene_name":"B","gene_id":"G2","gene_synonyms":["b1","b2"],"gene_chrom":"2","gene_start":1,"gene_end":9}\n',
    )
    found = rows(S.read_genes(spark, path), "gene_name", "gene_synonyms", "gene_chrom", "chr", "tss")
    assert found == [("A", None, None, "1", 5), ("B", ["b1", "b2"], "2", None, None)]


def test_read_biofeatures_with_differing_fields(spark, tmp_path):
    a = write(tmp_path / "a.json", '{"original_source":"x","biofeature_string":"s","biofeature_code":"c","label":"l"}\n')
    b = write(tmp_path / "b.json", '{"original_source":"y","study":"T","biofeature_string":"t","biofeature_code":"d"}\n')
    df = S.read_biofeatures(spark, [a, b])
    assert rows(df, "study", "biofeature_code", "label") == [("T", "d", None), (None, "c", "l")]


def test_read_bed_skips_track_and_header_lines(spark, tmp_path):
    path = write(tmp_path / "x.bed", "track name=t\n#chrom\tstart\tend\tname\nchr1\t1\t2\tn\nchr2\tx\t4\tm\n")
    df = S.read_bed(spark, path, {"name": (3, "string"), "start": (1, "long"), "absent": (9, "long")})
    assert rows(df) == [("m", None, None), ("n", 1, None)]


def test_many_files_are_one_scan_with_a_tag(spark, tmp_path):
    for cell in ("Tcell", "Bcell"):
        folder = tmp_path / cell
        folder.mkdir()
        write(folder / "raw.gz", "1\t5\n", compress=True)
    df = S.read_bed(spark, f"{tmp_path}/*/raw.gz", {"pos": (1, "long")}, tag={"cell": "/([^/]+)/raw.gz"})
    assert rows(df) == [(5, "Bcell"), (5, "Tcell")]


def test_gene_list_keeps_its_first_line(spark, tmp_path):
    path = write(tmp_path / "genes.tsv", "G1\nG2\n")
    assert rows(S.read_gene_list(spark, path)) == [("G1",), ("G2",)]


def test_gtf_quotes_comments_and_last_symbol(spark, tmp_path):
    def line(kind, start, end, strand, gene, name, extra=""):
        attributes = f'gene_id "{gene}"; gene_name "{name}";{extra}'
        return "\t".join(["1", "src", kind, str(start), str(end), ".", strand, ".", attributes])

    coding = ' transcript_biotype "protein_coding";'
    path = write(
        tmp_path / "x.gtf.gz",
        "\n".join(
            [
                "#!comment",
                line("gene", 1, 9, "+", "G1", "abc"),
                line("transcript", 1, 9, "+", "G1", "abc", coding),
                line("transcript", 1, 8, "+", "G1", "abc", coding),
                line("transcript", 3, 9, "-", "G2", "def"),
                line("transcript", 3, 9, ".", "G3", "ghi", coding),
                line("gene", 20, 30, "-", "G4", "ABC"),
            ]
        )
        + "\n",
        compress=True,
    )

    gtf = S.read_gtf(spark, path)
    assert rows(O.transcript_tss(gtf)) == [("1", 0, 1, "G1", "."), ("1", 8, 9, "G2", ".")]
    assert rows(P.gene_tss(gtf)) == [("1", 0, 1, "G1", ".")]
    assert rows(O.strand_report(gtf)) == [(3, 1)]
    assert rows(O.symbol_map_from_gtf(gtf)) == [("ABC", "G4")]


def test_vcf_to_bed(spark, tmp_path):
    path = write(tmp_path / "x.vcf", "##head\n#CHROM\tPOS\n1\t10\trs\tA\tC,GT\t.\nX\t7\trs\tT\tG\t.\n")
    assert rows(S.vcf_to_bed(S.read_vcf_sites(spark, path))) == [
        ("1", 9, 10, "1_10_A_C", "."),
        ("1", 9, 10, "1_10_A_GT", "."),
        ("X", 6, 7, "X_7_T_G", "."),
    ]


def test_read_consequences(spark, tmp_path):
    path = write(tmp_path / "c.tsv", "Accession\tTerm\tv2g_score\teco\nx\tmissense\t0.66\t1\ny\tother\t\t0.5\n")
    assert rows(S.read_consequences(spark, path)) == [("missense", 0.66), ("other", None)]


def test_read_evidence(spark, tmp_path):
    line = "\t".join(["1", "5", "A", "C", "1_5_A_C", "rs", "1", "G", "1", "9", "N", "f", "eqtl", "s", "", "0.1", "", "0.2", ""])
    path = write(tmp_path / "e.tsv", (line + "\n") * 5)
    assert S.read_evidence(spark, path).count() == 5
    df = S.read_evidence(spark, path).distinct()
    assert rows(df, "position", "qtl_pval", "qtl_se", "interval_score") == [(5, 0.2, None, None)]


def test_sorted_table_is_in_order_and_splits_copies(spark, tmp_path):
    df = spark.range(4000).selectExpr("'1' AS chrom", "0L AS start", "9L AS end", "id").unionByName(
        spark.range(4000).selectExpr("'2' AS chrom", "id * 7 % 4001 AS start", "id + 9 AS end", "id")
    )
    path = str(tmp_path / "out.parquet")
    S.write_sorted(df.repartition(8), path, partitions=8)
    written = spark.read.parquet(path).withColumn("file", F.input_file_name()).collect()
    by_file = {}
    for r in written:
        by_file.setdefault(r["file"], []).append((r["chrom"], r["start"], r["end"]))
    spans = sorted((keys[0], keys[-1]) for keys in by_file.values())
    assert all(keys == sorted(keys) for keys in by_file.values())
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert len(written) == 8000
    assert sum(1 for keys in by_file.values() if keys[0][0] == "1") > 1


def test_write_qtl_layout_and_feature_list(spark, tmp_path):
    data = [
        ("eqtl", "S1", "A", "G1", "1", 10, "A", "C", 0.1, 0.2, 0.001, 10),
        ("eqtl", "S1", "A", "G1", "1", 5, "A", "C", 0.1, 0.2, 0.005, 10),
        ("pqtl", "S2", None, "G2", "2", 5, "A", "C", 0.1, 0.2, 0.0001, 10),
        ("pqtl", "S2", "B", "G2", "2", 5, "A", "C", 0.1, 0.2, 0.006, 10),
        ("pqtl", "S2", "B", None, "2", 5, "A", "C", 0.1, 0.2, 0.0001, 10),
        ("pqtl", "S2", "B", "G2", "2", 5, "A", "C", 0.1, 0.2, 0.0, 0),
    ]
    from regulink.schemas import QTL_COMPOSITE_COLUMNS, QTL_INPUT

    df = spark.createDataFrame(data, QTL_INPUT)
    path = str(tmp_path / "qtl")
    P.write_qtl(df, path)
    assert (tmp_path / "qtl/type=eqtl/study_id=S1/bio_feature=A").is_dir()
    assert spark.read.parquet(path).count() == 3
    composite = str(tmp_path / "composite")
    P.write_qtl(df, composite, composite=True)
    table = spark.read.parquet(composite)
    assert table.columns == QTL_COMPOSITE_COLUMNS
    assert rows(table.select("feature").distinct()) == [("S1-A",), ("S2",)]
    lines = spark.read.text(composite + ".feature_list.json").collect()
    assert sorted(json.loads(r[0])["feature"] for r in lines) == ["S1-A", "S2"]


def test_jsonl_writes_nulls(spark, tmp_path):
    path = str(tmp_path / "x.json")
    S.write_jsonl(spark.createDataFrame([("a", None)], "x string, y string"), path)
    assert [r[0] for r in spark.read.text(path).collect()] == ['{"x":"a","y":null}']


def test_dataset_path():
    assert S.dataset_path("out/", "interval", "pchic", "jung2019", "1") == "out/interval/pchic/jung2019/1/data.parquet"


def test_scratch_needs_a_shared_folder_on_a_cluster(monkeypatch):
    from regulink import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_root(Session())


def test_chain_files_with_either_line_end_and_prefixed_names(spark, tmp_path):
    text = "#note\nchain 9 chr1 100 + 0 100 chr2 200 + 10 110 1\n40 5 5\n55\n\nchain 8 chr3 50 + 0 50 chr4 50 + 0 50 2\n50\n\n"
    unix = write(tmp_path / "a.chain", text)
    other = tmp_path / "b.chain"
    other.write_bytes(text.replace("\n", "\r\n").encode())
    wanted = [("chr1", 0, 40), ("chr1", 45, 100), ("chr3", 0, 50)]
    for path in (unix, str(other)):
        blocks = S.read_chain(spark, path)
        assert rows(blocks, "src_chrom", "src_start", "src_end") == wanted
        links = spark.createDataFrame([("1", 5, 9), ("chr3", 5, 9), ("7", 1, 2)], "chrom string, start long, end long")
        assert rows(O.liftover(links, blocks)) == [("2", 15, 19), ("4", 5, 9)]
        assert rows(O.unmatched_chromosomes(links, blocks)) == [("7", 1)]


def test_label_tables_from_tsv(spark, tmp_path):
    head = "study\tqtl_group\ttissue_ontology_id\ttissue_label\tcondition_label\tx\tquant_method\n"
    path = write(tmp_path / "m.tsv", head + "GTEx\tliver_a\tT1\tliver\tnaive\t1\tge\nGTEx\tb\tT1\tliver\tnaive\t1\ttx\n")
    labels = O.make_biofeature_labels(O.filter_quant(S.read_study_metadata(spark, path), ["ge"]))
    assert rows(labels, "biofeature_code", "label") == [("LIVER_A", "liver")]
    path = write(tmp_path / "r.tsv", "study_id\tq\tbiofeature_code\told_study_id\told_bio_feature_code\nA\tx\tB\tC\tD\n")
    df = spark.createDataFrame([("C", "D"), ("E", "F")], "study_id string, bio_feature string")
    assert rows(O.remap_biofeatures(df, S.read_feature_remap_tsv(spark, path))) == [("A", "B"), ("E", "F")]


def test_arrays_are_written_as_json(spark, tmp_path):
    P.write_scores({"t": spark.sql("SELECT 1 AS a, array(1, 2) AS b")}, str(tmp_path))
    assert rows(spark.read.csv(str(tmp_path / "t"), sep="\t", header=True)) == [("1", "[1,2]")]


def test_scratch_tables_are_deleted_when_done(spark):
    from regulink.session import freeze, scratch

    kept = freeze(spark.range(3))
    with scratch(spark):
        table = freeze(spark.range(5))
        files = table.inputFiles()
        assert table.count() == 5
    assert kept.count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(files[0]).count()


def _qtl(spark, studies, rows_each=50):
    data = [("eqtl", s, f, "1", k * 10, f"{s}-{k}") for s in studies for f in ("A", "B") for k in range(rows_each)]
    return spark.createDataFrame(data, "type string, study_id string, bio_feature string, chrom string, pos long, gene_id string")


def _files(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


def test_adding_a_study_leaves_the_others_alone(spark, tmp_path):
    path = tmp_path / "qtl"
    S.add_partitioned(_qtl(spark, ["one", "two"]), str(path))
    before = _files(path)
    S.add_partitioned(_qtl(spark, ["three"]), str(path))
    after = _files(path)
    assert {k: after[k] for k in before} == before and any("study_id=three" in k for k in after)
    whole = rows(spark.read.parquet(str(path)))
    S.add_partitioned(_qtl(spark, ["three"]), str(path))  # run again
    assert rows(spark.read.parquet(str(path))) == whole and len(whole) == 300
    assert {k: v for k, v in _files(path).items() if k in before} == before
    S.add_partitioned(_qtl(spark, ["two"], 7), str(path))  # a new release of one study
    counts = rows(spark.read.parquet(str(path)).groupBy("study_id").count())
    assert counts == sorted([("one", 100), ("three", 100), ("two", 14)], key=repr)
    S.add_partitioned(_qtl(spark, ["two"]).limit(0), str(path))
    assert rows(spark.read.parquet(str(path)).groupBy("study_id").count()) == counts
    # the same job for the plan that writes QTL tables
    S.write_partitioned(_qtl(spark, ["one"]), str(path))
    assert rows(spark.read.parquet(str(path)).groupBy("study_id").count()) == [("one", 100)]


def test_a_failed_addition_changes_nothing(spark, tmp_path):
    path = tmp_path / "qtl"
    S.add_partitioned(_qtl(spark, ["one"]), str(path))
    before = _files(path)
    broken = _qtl(spark, ["one", "two"]).withColumn("pos", F.when(F.col("pos") < 400, F.col("pos")).otherwise(F.raise_error(F.lit("broken")).cast("long")))
    with pytest.raises(Exception, match="broken"):
        S.add_partitioned(broken, str(path), partitions=3)
    assert {k: v for k, v in _files(path).items() if "_temporary" not in k and ".spark-staging" not in k} == before


def _intervals(spark, n):
    return spark.range(n).selectExpr("cast(id % 3 + 1 as string) AS chrom", "id * 7 % 100000 AS start", "id * 7 % 100000 + id % 50 AS end", "id AS gene")


def test_a_region_opens_only_matching_files(spark, tmp_path):
    path = str(tmp_path / "links")
    df = _intervals(spark, 20_000)
    S.write_sorted(df, path, partitions=24)
    files = spark.read.parquet(path).inputFiles()
    assert len(files) > 15
    for chrom, start, end in (("2", 5000, 6000), ("1", None, 300), ("3", 99_990, None), ("2", 50, 50), ("1", None, None), ("9", 1, 2)):
        region = S.read_region(spark, path, chrom, start, end)
        kept = df.where(F.col("chrom") == chrom)
        kept = kept if start is None else kept.where(F.col("end") >= start)
        kept = kept if end is None else kept.where(F.col("start") <= end)
        assert rows(region, *df.columns) == rows(kept)
        opened = set(region.inputFiles()) if kept.count() else set()
        holding = {r[0] for r in spark.read.parquet(path).join(kept, df.columns, "left_semi").select(F.input_file_name()).distinct().collect()}
        assert holding <= opened and len(opened) <= len(holding) + 2


def test_region_of_an_empty_table_and_by_position(spark, tmp_path):
    path = str(tmp_path / "empty")
    S.write_sorted(_intervals(spark, 0), path)
    assert S.read_region(spark, path, "1", 1, 5).count() == 0
    path = str(tmp_path / "sites")
    sites = spark.range(500).selectExpr("'1' AS chrom", "id * 3 AS pos")
    S.write_sorted(sites, path, ["chrom", "pos"], 5)
    assert rows(S.read_region(spark, path, "1", 10, 20, ["chrom", "pos"]), "pos") == [(12,), (15,), (18,)]


def test_number_of_files_follows_the_size(spark, tmp_path):
    from regulink.sources.writers import _sized

    df = _intervals(spark, 10_000)
    assert _sized(df, None)[1] == 1 and _sized(df, 7) == (df, 7)
    assert [_sized(part, None, 10_000)[1] for part in (df, df.where("gene % 2 = 0"))] == [11, 6]
    frozen = freeze(df, measured=True)
    assert _sized(frozen, None, 10_000) == (frozen, 11)


def test_grids_are_kept_by_version(spark, tmp_path):
    root = str(tmp_path / "grids")
    df = spark.range(300).selectExpr("'s' AS source_id", "concat('f', id % 3) AS feature", "cast(id as double) AS score")
    first, second = O.fit_quantile_grids(df, 10), O.fit_quantile_grids(df.withColumn("score", F.col("score") * 2), 5)
    S.write_grids(first, root, "v1")
    S.write_grids(second, root, "v2")
    S.write_grids(second, root, "v2")
    assert rows(S.read_grids(spark, root, "v1")) == rows(first)
    assert rows(S.read_grids(spark, root)) == rows(second)
    for version in ("none", None):
        with pytest.raises(ValueError):
            S.read_grids(spark, root, version) if version else S.write_grids(first, root, "a/b")
