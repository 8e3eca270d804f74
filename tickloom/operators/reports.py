"""Summaries of labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def label_summary(labels: DataFrame, bars: DataFrame | None = None) -> DataFrame:
    """Counts, hit rate and net R as one row; with ``bars`` also candidates per bar."""
    count = F.count(F.lit(1))
    wins = F.count_if(F.col("success"))
    if bars is None:
        density = F.lit(None).cast("double")
    else:
        total = bars.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
        density = F.when(total > 0, F.round(F.col("candidate_count") / total, 4))
    return labels.agg(
        count.alias("candidate_count"),
        wins.alias("success_count"),
        F.when(count > 0, F.round(wins / count, 4)).alias("hit_rate"),
        F.round(F.coalesce(F.sum("net_r"), F.lit(0.0)), 4).alias("sum_net_r"),
        F.round(F.avg("net_r"), 4).alias("avg_net_r"),
        F.count_if(F.col("exit_reason") == "MAX_HOLD").alias("max_hold_count"),
        F.count_if(F.col("exit_reason") == "STOP").alias("stop_count"),
    ).withColumn("candidate_density", density)


def label_counts(labels: DataFrame) -> DataFrame:
    """Labels per exit reason, per side and per reason code, in one pass.

    Each label is turned into its (kind, value) facts; partial aggregation keeps the shuffle at
    one row per fact and task.
    """
    fact = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.alias("value"))
    codes = F.transform(F.coalesce("reason_codes", F.array()), lambda c: fact("reason_code", c))
    facts = F.concat(
        F.array(fact("exit_reason", F.col("exit_reason")), fact("entry_side", F.col("entry_side"))),
        codes,
    )
    return (
        labels.select(F.inline(facts))
        .groupBy("kind", "value")
        .agg(F.count(F.lit(1)).alias("labels"))
    )


def net_r_buckets(labels: DataFrame) -> DataFrame:
    """Count, sum and mean of net R by exit reason and by side."""
    return (
        labels.filter(F.col("net_r").isNotNull())
        .groupingSets([["exit_reason"], ["entry_side"]], "exit_reason", "entry_side")
        .agg(
            F.count(F.lit(1)).alias("labels"),
            F.round(F.sum("net_r"), 4).alias("sum_net_r"),
            F.round(F.avg("net_r"), 4).alias("avg_net_r"),
        )
        .select(
            F.when(F.col("exit_reason").isNotNull(), "exit_reason").otherwise("entry_side").alias("kind"),
            F.coalesce("exit_reason", "entry_side").alias("value"),
            "labels",
            "sum_net_r",
            "avg_net_r",
        )
    )


def diagnose(summary: DataFrame) -> DataFrame:
    """Failure modes that a one-row label summary shows, as an array of messages."""
    n = F.col("candidate_count")
    share = lambda c: F.when(n > 0, F.col(c) / n)
    # Thresholds and messages.
    rules: list[tuple[Column, str]] = [
        (F.col("avg_net_r") < 0, "negative expectancy after costs: average net R is below zero"),
        (
            (n > 0) & (F.coalesce("hit_rate", F.lit(0.0)) <= 0.2),
            "target conversion is weak: few candidates reach TARGET_1",
        ),
        (
            share("max_hold_count") >= 0.5,
            "MAX_HOLD dominates exits: signals often fail to resolve before timeout",
        ),
        (
            share("stop_count") >= 0.3,
            "STOP exits are frequent: adverse movement is common after entry",
        ),
        (
            F.col("candidate_density") >= 0.25,
            "candidate density is high: raw QEP is overtrading the M30 stream",
        ),
    ]
    found = F.array_compact(F.array(*(F.when(rule, F.lit(text)) for rule, text in rules)))
    none = F.array(
        F.lit("no single dominant failure mode detected; inspect trade-level rows")
    )
    return summary.withColumn("diagnosis", F.when(F.size(found) > 0, found).otherwise(none))


def label_gate_report(labels: DataFrame) -> DataFrame:
    """Labels per exit reason with the share of the gate: successes and the fixed verdict."""
    return labels.groupBy("exit_reason").agg(
        F.count(F.lit(1)).alias("labels"),
        F.count_if(F.col("success")).alias("successes"),
        F.lit("NO-GO").alias("gate_recommendation"),
    )
