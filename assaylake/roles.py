"""Which column plays which part in a frame."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Roles:
    """Column names by role; the defaults are the names of the trusted long table."""

    file: str = "file_id"
    file_name: str = "file_name"
    file_size: str = "file_size"
    case: str = "case_id"
    case_submitter: str = "case_submitter_id"
    sample: str = "sample_id"
    sample_submitter: str = "sample_submitter_id"
    subject: str = "patient_id"
    sample_type: str = "sample_type"
    project: str = "project_id"
    cls: str = "cancer_type"
    cls_name: str = "cancer_name"
    feature: str = "gene_id_base"
    feature_name: str = "gene_name"
    feature_type: str = "gene_type"
    measure: str = "tpm_unstranded"
    value: str = "log2_tpm"
    source: str = "source_file"

    @property
    def sample_columns(self) -> list[str]:
        """The twelve columns that describe one sample, in stored order."""
        return [
            self.file, self.file_name, self.file_size, self.case, self.case_submitter,
            self.sample, self.sample_submitter, self.subject, self.sample_type,
            self.project, self.cls, self.cls_name,
        ]

    @property
    def metadata_columns(self) -> list[str]:
        """Columns of the flat metadata table: the sample columns before the subject is known."""
        return [c for c in self.sample_columns if c != self.subject]

    @property
    def feature_columns(self) -> list[str]:
        return [self.feature, self.feature_name, self.feature_type]

    @property
    def long_columns(self) -> list[str]:
        return [*self.sample_columns, *self.feature_columns, self.measure, self.value, self.source]


DEFAULT = Roles()
