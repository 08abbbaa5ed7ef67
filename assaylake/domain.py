"""The closed class list and the values every reader and filter agrees on."""

from __future__ import annotations

# Class codes with their display names, in the published order.
CLASS_NAMES = {
    "BRCA": "Breast invasive carcinoma",
    "KIRC": "Kidney renal clear cell carcinoma",
    "LUAD": "Lung adenocarcinoma",
    "UCEC": "Uterine corpus endometrial carcinoma",
    "THCA": "Thyroid carcinoma",
    "HNSC": "Head and neck squamous cell carcinoma",
    "LUSC": "Lung squamous cell carcinoma",
    "PRAD": "Prostate adenocarcinoma",
    "LGG": "Brain lower grade glioma",
    "COAD": "Colon adenocarcinoma",
    "SKCM": "Skin cutaneous melanoma",
    "STAD": "Stomach adenocarcinoma",
    "OV": "Ovarian serous cystadenocarcinoma",
    "BLCA": "Bladder urothelial carcinoma",
    "LIHC": "Liver hepatocellular carcinoma",
    "GBM": "Glioblastoma multiforme",
    "KIRP": "Kidney renal papillary cell carcinoma",
    "CESC": "Cervical squamous cell carcinoma and endocervical adenocarcinoma",
}

# Literals of the cleaning and labelling rules.
UNKNOWN = "DESCONOCIDO"
TECHNICAL_PREFIX = "N_"
FEATURE_TYPE = "protein_coding"
SAMPLE_TYPE_NEEDLE = "primary tumor"
SUBJECT_PREFIX = 12
FILE_ID_PATTERN = r"([0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12})"
RAW_FILE_NEEDLE = "rna_seq.augmented_star_gene_counts"

# Which files of the listing are wanted.
DATA_CATEGORY = "Transcriptome Profiling"
DATA_TYPE = "Gene Expression Quantification"
WORKFLOW = "STAR - Counts"
ACCESS = "open"


def study_projects(prefix: str) -> dict[str, tuple[str, str]]:
    """project id -> (class code, class name) for a programme whose ids are prefix + code."""
    return {prefix + code: (code, name) for code, name in CLASS_NAMES.items()}
