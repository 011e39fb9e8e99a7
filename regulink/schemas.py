"""Schemas of the files read and written."""

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _schema(**columns) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


_text, _long, _double = StringType(), LongType(), DoubleType()

INTERVAL_LINKS = _schema(
    chrom=_text, start=_long, end=_long, gene_id=_text, score=_double, bio_feature=_text
)

GENE_LIST_LINKS = _schema(gene_names=_text, interval=_text, biofeature_string=_text)

# Both dictionary shapes in one: absent fields read as null.
GENES = _schema(
    gene_id=_text,
    gene_name=_text,
    gene_synonyms=ArrayType(_text),
    gene_chrom=_text,
    gene_start=_long,
    gene_end=_long,
    chr=_text,
    start=_long,
    tss=_long,
    biotype=_text,
    description=_text,
)

BIOFEATURES = _schema(
    original_source=_text,
    study=_text,
    biofeature_string=_text,
    biofeature_code=_text,
    biofeature_ontology_term=_text,
    label=_text,
    tissue_label=_text,
    condition_label=_text,
)

FEATURE_REMAP = _schema(
    study_id=_text, biofeature_code=_text, old_study_id=_text, old_bio_feature_code=_text
)

QTL_INPUT = _schema(
    type_id=_text,
    study_id=_text,
    bio_feature=_text,
    gene_id=_text,
    chrom=_text,
    pos=_long,
    ref=_text,
    alt=_text,
    beta=_double,
    se=_double,
    pval=_double,
    num_tests=_long,
)

QTL_COLUMNS = [
    "type", "source", "study_id", "bio_feature", "chrom", "pos",
    "other_allele", "effect_allele", "ensembl_id", "beta", "se", "pval",
]

QTL_COMPOSITE_COLUMNS = [
    "feature" if name == "bio_feature" else name for name in QTL_COLUMNS
]

EVIDENCE = _schema(
    chr_id=_text,
    position=_long,
    ref_allele=_text,
    alt_allele=_text,
    variant_id=_text,
    rs_id=_text,
    gene_chr=_text,
    gene_id=_text,
    gene_start=_long,
    gene_end=_long,
    gene_name=_text,
    feature=_text,
    type_id=_text,
    source_id=_text,
    csq_counts=_text,
    qtl_beta=_double,
    qtl_se=_double,
    qtl_pval=_double,
    interval_score=_double,
)

LABEL_COLUMNS = [
    "original_source", "study", "biofeature_string", "biofeature_code",
    "biofeature_ontology_term", "label", "tissue_label", "condition_label",
]

CHAIN_BLOCKS = _schema(
    chain_id=_long,
    score=_long,
    src_chrom=_text,
    src_start=_long,
    src_end=_long,
    tgt_chrom=_text,
    tgt_size=_long,
    tgt_strand=_text,
    tgt_start=_long,
)

GTF_COLUMNS = [
    "seqname", "source", "feature", "start", "end", "score", "strand", "frame", "attributes",
]

