"""Validators in layers: a question goes on to the next layer only if it passed those before.

A layer is a list of reasons, each with a condition that is true where a question fails; the first that is true counts. Some layers need evidence,
which a join brings; only what passed so far is joined, so the dear layers see few rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.operators.skew import kept


@dataclass(frozen=True)
class Layer:
    name: str
    #: (reason, SQL condition that is true, and not null, where it fails)
    reasons: list[tuple[str, str]] = field(default_factory=list)
    #: Adds the columns that the conditions need to the questions that got here, one row each.
    evidence: Callable[[DataFrame], DataFrame] | None = None


def validated(questions: DataFrame, layers: list[Layer], columns: list[str]) -> DataFrame:
    """columns, valid, passed_layers, failed_layer, error of every question."""
    done: list[DataFrame] = []
    left = questions.withColumns({"__failed": F.lit(None).cast("int"), "__error": F.lit(None).cast("string")})

    def split() -> None:
        nonlocal left
        left = kept(left)
        done.append(left.filter("__failed IS NOT NULL").select(*columns, "__failed", "__error"))
        left = left.filter("__failed IS NULL")

    for i, layer in enumerate(layers):
        if layer.evidence is not None:
            split()
            left = layer.evidence(left)
        error = F.coalesce(*[F.when(F.expr(fails), reason) for reason, fails in layer.reasons], F.lit(None).cast("string"))
        left = left.withColumn("__error", F.when(F.col("__failed").isNull(), error).otherwise(F.col("__error")))
        left = left.withColumn("__failed", F.when(F.col("__failed").isNull() & F.col("__error").isNotNull(), i).otherwise(F.col("__failed")))
    out = left.select(*columns, "__failed", "__error")
    for part in done:
        out = out.unionByName(part)
    names = F.array(*[F.lit(layer.name) for layer in layers])
    return out.select(
        *columns, F.col("__failed").isNull().alias("valid"), F.coalesce("__failed", F.lit(len(layers))).alias("passed_layers"),
        F.when(F.col("__failed").isNotNull(), F.get(names, F.col("__failed"))).alias("failed_layer"), F.col("__error").alias("error"),
    )


def validated_sql(source: str, layers: list[Layer], columns: list[str]) -> str:
    """DuckDB SQL of the same, over a source that has all columns of evidence."""
    step = lambda i, layer, what: " ".join(f"WHEN {fails} THEN {what(i, layer, reason)}" for reason, fails in layer.reasons)
    cases = lambda what: "CASE " + " ".join(step(i, layer, what) for i, layer in enumerate(layers)) + " END"
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    failed, error = cases(lambda i, layer, reason: str(i)), cases(lambda i, layer, reason: quoted(reason))
    names = "[" + ", ".join(quoted(layer.name) for layer in layers) + "]"
    return f"SELECT {', '.join(columns)}, failed IS NULL AS valid, coalesce(failed, {len(layers)}) AS passed_layers, {names}[failed + 1] AS failed_layer, error FROM (SELECT *, {failed} AS failed, {error} AS error FROM {source})"
