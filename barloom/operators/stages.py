"""What became of each asked feature: through how many stages it came, and why it went."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STAGES = ("requested", "allowed", "present", "kept", "used")


def stage_facts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """tables: a stage's name to its rows (view, feature), a row each in the order of the mapping; one table: stage, nth, view, feature. Repeated rows are one."""
    out = None
    for nth, (stage, df) in enumerate(tables.items(), 1):
        rows = df.select(F.lit(stage).alias("stage"), F.lit(nth).alias("nth"), "view", "feature").filter("feature IS NOT NULL").distinct()
        out = rows if out is None else out.union(rows)
    return out


def audit(facts: DataFrame, stages: tuple[str, ...] = STAGES, reasons: Mapping[str, str] | None = None, given: DataFrame | None = None) -> DataFrame:
    """view, feature, requested.. used (is it there?), last_stage, lost_at, reason: a row for each view and feature of any stage.

    lost_at is the first stage that lacks a feature of the stage before it; reason is what given(view, feature, stage, reason) says of it there,
    else the stage's own of `reasons`. A feature that turns up in a later stage without an earlier one is `unexpected_<stage>`. One shuffle by
    view and feature; the stages' rows combine into flags before it.
    """
    why = {"allowed": "not_in_registry", "present": "not_in_data", "kept": "dropped_by_quality", "used": "not_selected"} | dict(reasons or {})
    flags = facts.groupBy("view", "feature").agg(*(F.max((F.col("stage") == s).cast("int")).alias(s) for s in stages))
    lost, strange, last = F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(None).cast("string")
    for before, stage in zip(reversed(stages[:-1]), reversed(stages[1:]), strict=True):
        lost = F.when((F.col(before) == 1) & (F.col(stage) == 0), F.lit(stage)).otherwise(lost)
        strange = F.when((F.col(before) == 0) & (F.col(stage) == 1), F.concat(F.lit("unexpected_"), F.lit(stage))).otherwise(strange)
    for stage in stages:
        last = F.when(F.col(stage) == 1, F.lit(stage)).otherwise(last)
    seen = flags.withColumn("lost_at", lost).withColumn("last_stage", last).withColumn("strange", strange)
    own = F.try_element_at(F.create_map(*(F.lit(x) for kv in why.items() for x in kv)), F.col("lost_at"))
    if given is None:
        told = seen.withColumn("told", F.lit(None).cast("string"))
    else:
        notes = given.groupBy(F.col("view").alias("v"), F.col("feature").alias("f"), F.col("stage").alias("s")).agg(F.min("reason").alias("told"))
        told = seen.join(notes, F.col("view").eqNullSafe(F.col("v")) & (F.col("feature") == F.col("f")) & (F.col("lost_at") == F.col("s")), "left")
    reason = F.coalesce("strange", "told", F.when(F.col("lost_at").isNotNull(), own), F.lit("ok"))
    return told.select("view", "feature", *stages, "last_stage", "lost_at", reason.alias("reason"))


def stage_counts(audited: DataFrame, stages: tuple[str, ...] = STAGES) -> DataFrame:
    """view, reason, n and how many of the features are in each stage."""
    return audited.groupBy("view", "reason").agg(F.count("*").alias("n"), *(F.sum(s).alias(s) for s in stages))
