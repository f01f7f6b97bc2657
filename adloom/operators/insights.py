"""Raw insight rows to typed facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from adloom.functions.actions import (
    MESSAGING,
    PURCHASE,
    goal_action,
    last_action_text,
    list_text,
    parse_actions,
    parse_list,
    result_label,
    result_position,
    result_text,
)
from adloom.functions.dates import to_day
from adloom.functions.numbers import count_or_zero, number_or_zero
from adloom.schemas import require_columns

# The label of a reach goal per level, columns needed and columns dropped.
REACH_LABEL = {"ad": "reach", "campaign": "impressions"}
REQUIRED = ("date_start", "date_stop", "actions")
RAW_ONLY = ("actions", "optimization_goal", "date_start", "date_stop")


def _column_or_null(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def with_actions(df: DataFrame) -> DataFrame:
    """Replace ``actions`` by its parsed array, parsed once for all later uses. Text is made
    ready for the parser as a column of its own, once for all of its readings."""
    kind = df.schema["actions"].dataType
    if isinstance(kind, StringType):
        return df.withColumn("actions", list_text(F.col("actions"))).withColumn(
            "actions", parse_list(F.col("actions"))
        )
    return df.withColumn("actions", parse_actions(F.col("actions"), kind))


def with_result(df: DataFrame, level: str) -> DataFrame:
    """Add ``result`` and ``result_type`` to rows with parsed actions."""
    actions, target, position = F.col("actions"), F.col("_target"), F.col("_position")
    return (
        df.withColumn("_target", goal_action(_column_or_null(df, "optimization_goal")))
        .withColumn("_position", result_position(actions, target))
        .withColumns(
            {
                "result": result_text(
                    actions, target, position, _column_or_null(df, "impressions")
                ),
                "result_type": result_label(actions, target, position, REACH_LABEL[level]),
            }
        )
        .withColumn("result", number_or_zero(F.col("result")))
        .drop("_target", "_position")
    )


def with_action_metrics(df: DataFrame) -> DataFrame:
    metrics = {"messaging_conversations_started": MESSAGING, "purchase": PURCHASE}
    return df.withColumns(
        {name: last_action_text(F.col("actions"), action) for name, action in metrics.items()}
    ).withColumns({name: count_or_zero(F.col(name)) for name in metrics})


def with_numbers(df: DataFrame) -> DataFrame:
    """Type the metrics that are present; unreadable ones become 0."""
    typed = {"impressions": count_or_zero, "clicks": count_or_zero, "spend": number_or_zero}
    return df.withColumns(
        {name: convert(F.col(name)) for name, convert in typed.items() if name in df.columns}
    )


def with_date_parts(df: DataFrame) -> DataFrame:
    """Add ``date``, ``year`` and ``month`` (YYYY-MM); all null for an unreadable start."""
    day = to_day(F.col("date_start"))
    return df.withColumn("date", day).withColumns(
        {
            "year": F.year("date"),
            "month": F.when(
                F.col("date").isNotNull(), F.substring(F.col("date_start").cast("string"), 1, 7)
            ),
        }
    )


def transform_insights(df: DataFrame, level: str) -> DataFrame:
    """Facts of one level ('ad' or 'campaign'): one narrow pass, no shuffle."""
    if level not in REACH_LABEL:
        raise ValueError(f"unknown level {level!r}")
    require_columns(df, *REQUIRED)
    facts = with_action_metrics(with_result(with_actions(df), level))
    return with_date_parts(with_numbers(facts)).drop(*RAW_ONLY)
