"""Column expressions shared by the operators; all but ``character_counts`` stay inside code generation."""

from .characters import character_counts
from .scalars import (
    base_id,
    class_lookup,
    contains_ci,
    decode_label,
    element,
    error_flag,
    file_id_of,
    log2p1,
    null_to_zero,
    rounded,
    share_pct,
    split_label,
    subject_id,
    to_number,
    vector_values,
)

__all__ = [
    "base_id", "character_counts", "class_lookup", "contains_ci", "decode_label", "element", "error_flag", "file_id_of", "log2p1",
    "null_to_zero", "rounded", "share_pct", "split_label", "subject_id", "to_number", "vector_values",
]
