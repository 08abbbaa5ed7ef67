"""Characters of a text, counted in one pass by NumPy inside the tasks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F, types as T

_COUNTS = T.ArrayType(T.StructType([T.StructField("letter", T.StringType()), T.StructField("n", T.LongType())]))


def character_counts(text: Column | str) -> Column:
    """Each character of a text and how often it occurs; null for a null text."""

    # Both are local, so that they travel to the workers whole, which need not find this package.
    def of_text(one: str) -> list[dict]:
        times = np.bincount(np.frombuffer(one.encode("utf-32-le"), np.uint32))
        return [{"letter": chr(code), "n": int(times[code])} for code in np.flatnonzero(times)]

    def of_all(texts):
        return texts.map(of_text, na_action="ignore")

    of_all.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return F.pandas_udf(of_all, _COUNTS)(text)
