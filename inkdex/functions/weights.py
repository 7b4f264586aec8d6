"""Term weights."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def term_frequency(n: Column, doc_len: Column) -> Column:
    return n.cast("double") / doc_len.cast("double")


def inverse_document_frequency(n_docs: Column, df: Column) -> Column:
    """Natural logarithm of N / df, never below zero (df may exceed a given N)."""
    return F.greatest(F.lit(0.0), F.ln(n_docs.cast("double") / df.cast("double")))
