from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, functions as F, types as T

from .. import domain

# The text forms that count as a number.
_NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"


def base_id(feature: Column | str) -> Column:
    """Feature id without its version suffix."""
    return F.substring_index(_col(feature), ".", 1)


def null_to_zero(measure: Column | str) -> Column:
    return F.coalesce(_col(measure), F.lit(0.0))


def log2p1(measure: Column | str) -> Column:
    return F.log2(_col(measure) + F.lit(1.0))


def file_id_of(path: Column | str) -> Column:
    """First UUID in a path; the empty string when there is none."""
    return F.regexp_extract(_col(path), domain.FILE_ID_PATTERN, 1)


def subject_id(case_submitter, sample_submitter, sample, prefix: int = domain.SUBJECT_PREFIX) -> Column:
    return F.coalesce(_col(case_submitter), F.substring(_col(sample_submitter), 1, prefix), _col(sample))


def contains_ci(text: Column | str, needle: str) -> Column:
    return F.lower(_col(text)).contains(needle.lower())


def class_lookup(
    project: Column | str, projects: Mapping[str, tuple[str, str]], default: str = domain.UNKNOWN
) -> tuple[Column, Column]:
    """(class code, class name) of a project, ``default`` for one outside the list."""
    if not projects:
        return F.lit(default), F.lit(default)
    entries = list(projects.items())
    codes = F.create_map(*[F.lit(x) for key, (code, _) in entries for x in (key, code)])
    names = F.create_map(*[F.lit(x) for key, (_, name) in entries for x in (key, name)])
    key = _col(project)
    return F.coalesce(F.try_element_at(codes, key), F.lit(default)), F.coalesce(
        F.try_element_at(names, key), F.lit(default)
    )


def to_number(text: Column | str, kind: T.DataType | None = None) -> Column:
    """Number in a column, null where there is none (NaN counts as none).

    ``kind`` is the column's type where it is known: a number is then taken as it is, without a look at its text.
    """
    if isinstance(kind, T.NumericType):
        number = _col(text).cast("double")
        return F.when(~F.isnan(number), number) if isinstance(kind, T.FractionalType) else number
    as_text = _col(text).cast("string")
    return F.when(as_text.rlike(_NUMBER), F.trim(as_text).try_cast("double"))


def element(values: Column | str, index: Column | str) -> Column:
    """Zero-based array element, null outside the array."""
    return F.get(_col(values), _col(index).cast("int"))


def decode_label(index: Column | str, labels: Sequence[str], default: str = domain.UNKNOWN) -> Column:
    return F.coalesce(element(F.array(*[F.lit(x) for x in labels]), index), F.lit(default))


def vector_values(vector: Column | str) -> Column:
    return vector_to_array(_col(vector))


def error_flag(truth: Column | str, predicted: Column | str) -> Column:
    return F.when(_col(truth) != _col(predicted), F.lit(1)).otherwise(F.lit(0))


def rounded(value: Column | str, digits: int) -> Column:
    """A double at so many decimals, as SQL engines round doubles: the scaled value to a whole number, halves away from zero.

    Spark's own ``round`` takes the shortest decimal that stands for the double, which makes other halves: 0.10225 times
    10,000 lies below 1022.5, so it is 0.1022 here and 0.1023 there.
    """
    scale = F.lit(float(10**digits))
    return F.round(_col(value) * scale) / scale


def share_pct(part: Column, whole: Column, digits: int = 2) -> Column:
    return rounded(F.lit(100) * part / whole, digits)


def split_label(proportion: Column, cuts: Sequence[float] = (0.70, 0.85)) -> Column:
    train, validation = cuts
    return (
        F.when(proportion <= F.lit(float(train)), F.lit("train"))
        .when(proportion <= F.lit(float(validation)), F.lit("validation"))
        .otherwise(F.lit("test"))
    )


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
