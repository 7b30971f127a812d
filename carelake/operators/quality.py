"""Data-quality rules (expectations).

A rule is a SQL predicate. A row passes only when the predicate is TRUE; NULL
counts as a violation. ``warn`` rules keep every row and count violations;
``fail`` rules stop the job on the first violating row, from inside the plan, so
no separate validation pass over the data is needed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    name: str
    expr: str
    on_fail: str = "warn"  # "warn" | "fail"

    def ok(self) -> Column:
        return F.coalesce(F.expr(self.expr), F.lit(False))


def enforce(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Pass rows through; raise inside the plan when a ``fail`` rule is violated."""
    for r in rules:
        if r.on_fail == "fail":
            msg = f"expectation {r.name} failed: {r.expr}"
            df = df.where(F.when(r.ok(), F.lit(True)).otherwise(F.raise_error(F.lit(msg))))
    return df


def counters(rules: list[Rule]) -> list[Column]:
    """Rows (``__rows``) and the violations of each rule, as aggregates."""
    return [F.count(F.lit(1)).alias("__rows")] + [F.count_if(~r.ok()).alias(r.name) for r in rules]


def report_of(spark: SparkSession, counts: dict[str, int], rules: list[Rule]) -> DataFrame:
    """``counters`` as a table ``(rule, passed, failed)``."""
    rows = [(r.name, int(counts["__rows"]) - int(counts[r.name]), int(counts[r.name])) for r in rules]
    return spark.createDataFrame(rows, "rule string, passed bigint, failed bigint")


def observe_rules(df: DataFrame, rules: list[Rule], name: str = "rules") -> tuple[DataFrame, Observation]:
    """Attach violation counters that are filled by whatever action runs next
    (typically the table write), without a second pass over the data."""
    obs = Observation(name)
    return df.observe(obs, *counters(rules)), obs


def report_from_observation(spark: SparkSession, obs: Observation, rules: list[Rule]) -> DataFrame:
    """The counters of ``observe_rules`` as a table ``(rule, passed, failed)``."""
    return report_of(spark, obs.get, rules)


def expect_report(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """``(rule, passed, failed)`` per rule in one aggregation pass."""
    aggs = []
    for i, r in enumerate(rules):
        aggs += [F.count_if(r.ok()).alias(f"p{i}"), F.count_if(~r.ok()).alias(f"f{i}")]
    wide = df.agg(*aggs)
    entries = F.array(*[F.struct(F.lit(r.name).alias("rule"),
                                 F.col(f"p{i}").cast("bigint").alias("passed"),
                                 F.col(f"f{i}").cast("bigint").alias("failed"))
                        for i, r in enumerate(rules)])
    return wide.select(F.inline(entries))
