"""Text functions that Spark has no expression for, batched through Arrow."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def fold_id(value: str | None) -> str | None:
    """NFKC, trimmed, lower case."""
    return None if value is None else unicodedata.normalize("NFKC", value).strip().lower()


def letters_only(value: str | None) -> str | None:
    """NFKC, lower case, letters only: digits, blanks, punctuation, symbols and combining marks don't count."""
    if value is None:
        return None
    folded = unicodedata.normalize("NFKC", value).lower()
    return "".join(ch for ch in folded if unicodedata.category(ch)[0] == "L")


def map_distinct(fn, series: pd.Series) -> pd.Series:
    """fn once for each distinct value of the batch."""
    codes, values = pd.factorize(series)
    done = [fn(v) for v in values] + [None]
    return pd.Series([done[c] for c in codes], index=series.index, dtype=object)


@F.pandas_udf(T.StringType())
def fold_id_udf(values: pd.Series) -> pd.Series:
    return map_distinct(fold_id, values)


@F.pandas_udf(T.StringType())
def nfkc_udf(values: pd.Series) -> pd.Series:
    return map_distinct(lambda v: unicodedata.normalize("NFKC", v), values)


def clean_lines(body: Column) -> Column:
    """Lines of a text; a line is what lies between line feeds."""
    return F.split(body, "\n", -1)
