"""Pandas UDFs for what built-in expressions can't say; use them on distinct sequences.

Each hands a whole batch to ``functions.batch``; nothing loops over rows here.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomsite.functions import batch


def _where_known(work: Callable[[list, list], list], a: pd.Series, b: pd.Series) -> list:
    """``work`` on the pairs without nulls, null for the others."""
    known = np.flatnonzero((a.notna() & b.notna()).to_numpy())
    out: list = [None] * len(a)
    for i, x in zip(known, work(a.iloc[known].tolist(), b.iloc[known].tolist()), strict=True):
        out[i] = x
    return out


@F.pandas_udf(T.IntegerType())
def osa_distance(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(_where_known(batch.osa, a, b), dtype="Int32")


def trim_adapter(error: float = 0.15, min_overlap: int = 3):
    """A pandas UDF ``(seq, adapter) -> trimmed seq``; without an adapter the whole one."""

    @F.pandas_udf(T.StringType())
    def trim(seq: pd.Series, adapter: pd.Series) -> pd.Series:
        some = adapter.where(adapter.notna() & (adapter != ""))
        cut = _where_known(lambda x, y: batch.trim_at(x, y, error, min_overlap), seq, some)
        return pd.Series([s if n is None else s[:n] for s, n in zip(seq, cut, strict=True)], dtype=object)

    return trim


def merge_pairs(min_overlap: int = 10, max_mismatch: float = 0.1):
    """A pandas UDF ``(seq, reverse complement of the mate) -> merged seq`` or null."""

    @F.pandas_udf(T.StringType())
    def merge(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(_where_known(lambda x, y: batch.joined(x, y, min_overlap, max_mismatch, scored=True), a, b), dtype=object)

    return merge


@F.pandas_udf(T.StringType())
def match_marks(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(_where_known(batch.marks, a, b), dtype=object)


def _struct(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.IntegerType()) for n in names])


@F.pandas_udf(_struct("edits", "start", "end"))
def laid_inside(longer: pd.Series, shorter: pd.Series) -> pd.DataFrame:
    """The least edits of the whole shorter sequence inside the longer one, and where."""
    return pd.DataFrame(batch.edits_inside(longer.tolist(), shorter.tolist()), columns=["edits", "start", "end"])


def best_segments(gap: int):
    """A pandas UDF ``(query, target, offset) -> start, end, matches, insert, tStart, tEnd``."""

    @F.pandas_udf(_struct("start", "end", "matches", "insert", "tStart", "tEnd"))
    def segments(q: pd.Series, t: pd.Series, offset: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(batch.segments(q.tolist(), t.tolist(), offset.tolist(), gap=gap), columns=["start", "end", "matches", "insert", "tStart", "tEnd"])

    # A filter on its result would otherwise run it twice.
    return segments.asNondeterministic()
