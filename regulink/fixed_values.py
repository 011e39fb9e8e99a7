"""Constants the computed results depend on."""

# Chromosomes kept by coordinate conversion.
ALLOWED_CHROMOSOMES = [
    "1", "2", "3", "4", "5", "6", "7", "8", "9", "10", "11", "12",
    "13", "14", "15", "16", "17", "18", "19", "20", "21", "22",
    "X", "Y", "MT",
]

# Thresholds.
FAMILY_WISE_ALPHA = 0.05
MAX_LENGTH_DRIFT = 100
ENHANCER_MAX_DISTANCE = 2 * 5.341328e5
CAPTURE_MAX_DISTANCE = 2.45e6
GENE_LIST_SD_MULTIPLE = 2
CIS_WINDOW = 1_000_000
CIS_PVAL = 2.5e-5
TRANS_PVAL = 5e-8

# Evidence types scored from the interval score, and from the QTL p-value.
INTERVAL_TYPES = ["pchic", "fantom5", "dhscor"]
QTL_TYPES = ["eqtl"]
CONSEQUENCE_TYPE = "vep"
CONSEQUENCE_FEATURE = "not_a_feature"

# Weight of each source in the mean over sources.
SOURCE_WEIGHTS = {
    "vep": 1.0,
    "javierre2016": 1.0,
    "andersson2014": 1.0,
    "thurman2012": 1.0,
    "gtex_v7": 1.0,
    "sun2018": 1.0,
}

# Weight of (best score, scaled feature count) in the mean within a source.
FEATURE_WEIGHTS = {
    "vep": {"ft_max": 1.0, "ft_count_scaled": 0.0},
    "javierre2016": {"ft_max": 0.8, "ft_count_scaled": 0.2},
    "andersson2014": {"ft_max": 0.8, "ft_count_scaled": 0.2},
    "thurman2012": {"ft_max": 0.8, "ft_count_scaled": 0.2},
    "gtex_v7": {"ft_max": 0.8, "ft_count_scaled": 0.2},
    "sun2018": {"ft_max": 0.8, "ft_count_scaled": 0.2},
}

# Consequence term weights of the first scoring version.
CONSEQUENCE_WEIGHTS_V1 = {
    "cttv_mapping_pipeline": 1.0,
    "curator_inference": 1.0,
    "trinucleotide_repeat_expansion": 1.0,
    "sequence_variant": 0.5,
    "regulatory_region_variant": 0.6,
    "stop_retained_variant": 0.65,
    "splice_acceptor_variant": 0.95,
    "splice_donor_variant": 0.95,
    "stop_lost": 0.9,
    "coding_sequence_variant": 0.95,
    "initiator_codon_variant": 0.7,
    "missense_variant": 0.7,
    "stop_gained": 0.95,
    "frameshift_variant": 0.95,
    "non_coding_transcript_variant": 0.65,
    "mature_miRNA_variant": 0.65,
    "NMD_transcript_variant": 0.65,
    "5_prime_UTR_variant": 0.65,
    "3_prime_UTR_variant": 0.65,
    "incomplete_terminal_codon_variant": 0.9,
    "intron_variant": 0.65,
    "intergenic_variant": 0.5,
    "splice_region_variant": 0.95,
    "upstream_gene_variant": 0.6,
    "downstream_gene_variant": 0.6,
    "TF_binding_site_variant": 0.6,
    "non_coding_transcript_exon_variant": 0.65,
    "protein_altering_variant": 0.7,
    "synonymous_variant": 0.65,
    "inframe_insertion": 0.7,
    "inframe_deletion": 0.7,
    "conservative_inframe_deletion": 0.5,
    "transcript_amplification": 0.6,
    "regulatory_region_amplification": 0.6,
    "TFBS_amplification": 0.6,
    "transcript_ablation": 1.0,
    "regulatory_region_ablation": 0.6,
    "TFBS_ablation": 0.6,
    "feature_truncation": 0.6,
    "feature_elongation": 0.6,
    "start_lost": 0.95,
    "Nearest gene counting from 5' end": 0.5,
    "Regulatory nearest gene 5' end": 0.6,
}

# Label texts.
EQTL_LABEL_SOURCE = "eqtl_catalogue_v2"
COMPOSITE_LABEL_SOURCE = "composite_source_feature_hack"
EQTL_QUANT_METHODS = ["ge", "microarray"]
EQTL_STUDY_RENAMES = {"GTEx": "GTEx-eQTL"}
PLAIN_CONDITION = " naive"
UNSPECIFIED_FEATURE = "unspecified"
