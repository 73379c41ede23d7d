"""Shape of the physical plan."""

from __future__ import annotations

import functools

from pyspark import SparkContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def built_once(function):
    """Keep the columns a function without arguments builds.

    Each part of a column is a call from Python into the JVM, and the message columns have thousands
    of parts. Columns are not bound to a frame, so one set serves every job of the same JVM.
    """
    kept: dict = {}

    @functools.wraps(function)
    def build():
        jvm = id(SparkContext._gateway)
        if jvm not in kept:
            kept.clear()
            kept[jvm] = function()
        return kept[jvm]

    return build


def computed_once(df: DataFrame) -> DataFrame:
    """The same rows with every column evaluated exactly once per row.

    A filter on a computed column is normally pushed below the projection that computes it, which
    copies the whole expression into the filter; for long chains (parse, check, tokenise) that means
    parsing each message many times. A generator of one row per input row is a point that filters
    and projections above it do not cross.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))
