"""All queries of the library proper, by name, with the DuckDB SQL of their results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillstone.plans import aggregates, gate, guidelines, joins, matching, predicates, quotes, ranking, scalars, selection, sets, sources, stores, templates, validation, windows, wordchecks  # noqa: F401  they register their queries
from quillstone.plans.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "flagship"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["j07_nearest_within"](spark, sf_dir)
