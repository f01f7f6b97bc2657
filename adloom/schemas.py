"""Column types of every table. Nothing is inferred from data."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T


TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "creative": T.StructType([T.StructField("id", T.StringType())]),
}


def schema(columns: str) -> T.StructType:
    """Schema of 'name type, ...'. Unlike Spark's own reader it needs no session."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


SHARD = ("department", "account")
SHARD_DDL = "department string, account string"

# The fields asked of the ads service, per level.
INSIGHT_FIELDS = {
    "ad": (
        "account_id", "campaign_id", "ad_id", "adset_id", "optimization_goal", "actions",
        "spend", "impressions", "clicks", "date_start", "date_stop",
    ),
    "campaign": (
        "account_id", "campaign_id", "optimization_goal", "actions",
        "spend", "impressions", "clicks", "date_start", "date_stop",
    ),
}

# Landed insights: JSON text fields, foldered by shard and by the day asked for.
LANDED_INSIGHTS = {
    level: schema(
        ", ".join(f"{name} string" for name in names) + f", {SHARD_DDL}, day date"
    )
    for level, names in INSIGHT_FIELDS.items()
}

# Landed entities, foldered by shard, by run and by attempt.
LANDED_ENTITIES = {
    "ads": schema(
        "id string, name string, adset_id string, campaign_id string, status string, "
        f"{SHARD_DDL}, run string, attempt int"
    ),
    "adsets": schema(f"id string, name string, campaign_id string, {SHARD_DDL}, run string, attempt int"),
    "campaigns": schema(f"id string, name string, status string, {SHARD_DDL}, run string, attempt int"),
    "ad_creatives": schema(f"id string, creative creative, {SHARD_DDL}, run string, attempt int"),
    "creatives": schema(f"id string, thumbnail_url string, {SHARD_DDL}, run string"),
    "accounts": schema(f"id string, name string, {SHARD_DDL}, run string"),
    "responses": schema(f"entity string, http_status int, error_code int, {SHARD_DDL}, day date"),
}

_FACT_DDL = (
    "impressions bigint, clicks bigint, spend double, result double, result_type string, "
    "messaging_conversations_started bigint, purchase bigint, year int, month string, "
    f"{SHARD_DDL}, date date"
)
_CAMPAIGN_PARTS_DDL = (
    "platform string, objective string, region string, budget_group_1 string, "
    "budget_group_2 string, category_level_1 string, personnel string, track_group string, "
    "pillar_group string, content_group string"
)
_ADSET_PARTS_DDL = (
    "location string, gender string, age string, audience string, format string, "
    "strategy string, type string, pillar string, content string"
)


@dataclass(frozen=True)
class Table:
    """How a table is keyed and laid out. Rows are keyed inside one shard."""

    schema: T.StructType
    keys: tuple[str, ...]
    partition: tuple[str, ...] = SHARD
    cluster: tuple[str, ...] = ()
    shard: tuple[str, ...] = field(default=SHARD)


TABLES = {
    "ad_insights": Table(
        schema("account_id string, campaign_id string, adset_id string, ad_id string, " + _FACT_DDL),
        keys=("date",),
        partition=(*SHARD, "date"),
        cluster=("ad_id",),
    ),
    "campaign_insights": Table(
        schema("account_id string, campaign_id string, " + _FACT_DDL),
        keys=("date",),
        partition=(*SHARD, "date"),
        cluster=("campaign_id",),
    ),
    "ad_metadata": Table(
        schema(
            "ad_id string, ad_name string, adset_id string, campaign_id string, status string, "
            f"account_id string, account_name string, {SHARD_DDL}"
        ),
        keys=("account_id", "ad_id"),
        cluster=("ad_id",),
    ),
    "adset_metadata": Table(
        schema(
            "adset_id string, adset_name string, campaign_id string, account_id string, "
            f"account_name string, {_ADSET_PARTS_DDL}, {SHARD_DDL}"
        ),
        keys=("account_id", "adset_id"),
        cluster=("adset_id",),
    ),
    "campaign_metadata": Table(
        schema(
            "campaign_id string, campaign_name string, status string, account_id string, "
            f"account_name string, {_CAMPAIGN_PARTS_DDL}, {SHARD_DDL}"
        ),
        keys=("account_id", "campaign_id"),
        cluster=("campaign_id",),
    ),
    "ad_creative": Table(
        schema(
            "account_id string, ad_id string, creative_id string, thumbnail_url string, "
            + SHARD_DDL
        ),
        keys=("account_id", "ad_id"),
        cluster=("ad_id",),
    ),
}

# Column order of the staged facts and of the two marts.
STAGED_COLUMNS = {
    "ad": (
        "department", "account", "date", "month", "year",
        "account_id", "campaign_id", "adset_id", "ad_id",
        "impressions", "clicks", "spend", "result", "result_type",
        "messaging_conversations_started", "purchase",
    ),
    "campaign": (
        "department", "account", "date", "month", "year",
        "account_id", "campaign_id",
        "impressions", "clicks", "spend", "result", "result_type",
        "messaging_conversations_started", "purchase",
    ),
}
CAMPAIGN_PARTS = (
    "platform", "objective", "region", "budget_group_1", "budget_group_2",
    "category_level_1", "personnel", "track_group", "pillar_group", "content_group",
)
ADSET_PARTS = (
    "location", "gender", "age", "audience", "format", "strategy", "type", "pillar", "content",
)
MART_COLUMNS = {
    "ad": (
        "date", "month", "year", "department", "account",
        "account_id", "campaign_id", "adset_id", "ad_id",
        "ad_name", "ad_status", "thumbnail_url",
        "impressions", "clicks", "spend", "result", "result_type",
        "messaging_conversations_started", "purchase",
        *CAMPAIGN_PARTS, *ADSET_PARTS,
    ),
    "campaign": (
        "date", "month", "year", "department", "account",
        "account_id", "account_name", "campaign_id", "campaign_name", "campaign_status",
        "impressions", "clicks", "spend", "result", "result_type",
        "messaging_conversations_started", "purchase",
        *CAMPAIGN_PARTS,
    ),
}
MART_TABLES = {"ad": "creative_performance", "campaign": "campaign_performance"}
MART_CLUSTER = {"ad": ("account_id", "ad_id"), "campaign": ("account_id", "campaign_id")}


def require_columns(df: DataFrame, *names: str) -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
