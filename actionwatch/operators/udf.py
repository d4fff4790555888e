"""Where users bring their own functions: scorers, page parsers, cluster functions."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def score_rows(df: DataFrame, scorer: Callable[[dict], dict], *, key: str, result: str) -> DataFrame:
    """Apply a scorer to each row in Arrow batches (UDF-01). A row that fails has a null verdict and its error."""
    names = [c.strip().split(" ")[0] for c in result.split(",")]

    def run(frames):
        for frame in frames:
            out = []
            for row in frame.to_dict("records"):
                try:
                    answer, error = scorer(row), None
                except Exception as e:  # noqa: BLE001  a failure stays with its row
                    answer, error = {}, f"{type(e).__name__}: {e}"
                out.append([row[key], *(answer.get(n) for n in names), error])
            yield pd.DataFrame(out, columns=[key, *names, "error"])

    return df.mapInPandas(run, f"{key} {df.schema[key].dataType.simpleString()}, {result}, error string")


def parse_pages(pages: DataFrame, parsers: dict[str, Callable[[Column], Column]], *, parser: str = "parser", html: str = "html", out: str = "parsed") -> DataFrame:
    """The named parser of each page, as one expression (UDF-02). An unknown name gives null."""
    value = F.lit(None)
    for name, parse in parsers.items():
        value = F.when(F.col(parser) == name, parse(F.col(html))).otherwise(value)
    return pages.withColumn(out, value)


def cluster_groups(df: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame], *, group: str, schema: str) -> DataFrame:
    """A user's cluster function on each group (UDF-03).

    A group must fit into a task; for large groups use ``clustering.cluster``, which never gathers one.
    """
    return df.groupBy(group).applyInPandas(function, schema)
