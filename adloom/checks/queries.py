"""Registered queries. Each runs over whole tables shaped from the test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.checks.fixtures import fixture
from adloom.functions.dates import MODES, date_range, days_between, to_day
from adloom.functions.names import bare_account_id, error_class, status_icon
from adloom.operators.insights import (
    transform_insights,
    with_action_metrics,
    with_actions,
    with_date_parts,
    with_numbers,
    with_result,
)
from adloom.operators.metadata import transform_adset_metadata, transform_campaign_metadata
from adloom.operators.retries import due, queue_after
from adloom.operators.sizes import BROADCAST_LIMIT
from adloom.operators.upsert import key_set, matching_count, matching_keys, upsert
from adloom.operators.worklists import (
    coverage,
    distinct_ids,
    failed_ids,
    fetched,
    fetched_in_attempts,
    missing_days,
    union_attempts,
)
from adloom.plans.marts import ad_dimensions, campaign_dimensions, mart, staged, write_mart
from adloom.plans.pipelines import (
    AUDIT,
    COVERAGE,
    Job,
    backfill,
    run_ad,
    run_campaign,
    run_scheduled,
)
from adloom.schemas import MART_CLUSTER, MART_TABLES, TABLES
from adloom.session import work_folder
from adloom.sinks.load import load, load_table, stage, staged_for
from adloom.sources.landing import in_range
from adloom.sources.shards import (
    account_of,
    department_of,
    read_shard_files,
    shard_of,
    union_shards,
)
from adloom.sources.tables import folders, put_in_place, read_path, read_table

Query = Callable[[SparkSession, str], DataFrame]

FIRST_DAY, LAST_DAY = date(1990, 1, 1), date(2010, 12, 31)
AS_OF = date(1998, 3, 15)
RERUN_FROM = date(1997, 1, 1)
SHARD_PREFIX = "co_table_platform_"
NO_BROADCAST = -1
LANDED_CODEC = "lz4"


# Inputs ---------------------------------------------------------------------------


def in_one_shard(df: DataFrame, department: str = "mkt", account: str = "main") -> DataFrame:
    return df.withColumns({"department": F.lit(department), "account": F.lit(account)})


def ad_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Ad facts of two shards: accounts 0 and 1, and the others."""
    first = F.col("account_id").isin("0", "1")
    return transform_insights(fixture(spark, sf, "fx_ad_insights"), "ad").withColumns(
        {
            "department": F.when(first, "mkt").otherwise("sales"),
            "account": F.when(first, "main").otherwise("alt"),
        }
    )


def raw_campaign_facts(spark: SparkSession, sf: str) -> DataFrame:
    return transform_insights(fixture(spark, sf, "fx_campaign_insights"), "campaign")


def campaign_facts(spark: SparkSession, sf: str) -> DataFrame:
    return in_one_shard(raw_campaign_facts(spark, sf)).withColumn(
        "account_id", bare_account_id(F.col("account_id"))
    )


def campaign_dim(spark: SparkSession, sf: str) -> DataFrame:
    return transform_campaign_metadata(fixture(spark, sf, "fx_campaign_metadata"))


def ad_mart_dims(spark: SparkSession, sf: str):
    return ad_dimensions(
        fixture(spark, sf, "fx_ad_metadata"),
        campaign_dim(spark, sf),
        transform_adset_metadata(fixture(spark, sf, "fx_adset_metadata")),
        fixture(spark, sf, "fx_ad_creative"),
    )


def good_ads(spark: SparkSession, sf: str) -> DataFrame:
    return fixture(spark, sf, "fx_ad_metadata").where("ad_name is not null")


def new_ads(spark: SparkSession, sf: str) -> DataFrame:
    """Placeholders, and one row without a key for every part."""
    fixture(spark, sf, "fx_ad_metadata")
    loose = spark.table("part").select(F.col("p_name").alias("ad_name"))
    placeholders = fixture(spark, sf, "fx_ad_metadata").where("ad_name is null")
    return placeholders.unionByName(loose, allowMissingColumns=True)


def answered_ads(spark: SparkSession, sf: str) -> DataFrame:
    """Good ads with the attempt that got them; one in ten only in a fourth one."""
    last_digit = F.col("ad_id").cast("bigint") % 10
    attempt = F.when(last_digit == 0, 2).when(last_digit == 5, 4).otherwise(1)
    return good_ads(spark, sf).withColumn("attempt", attempt)


def requested_ads(spark: SparkSession, sf: str) -> DataFrame:
    return distinct_ids(fixture(spark, sf, "fx_ad_insights"), "ad_id")


def past_and_fresh(facts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A loaded table and its next load, one year overlapping, bad dates in the load."""
    past = facts.where(F.col("date") < date(1998, 1, 1))
    fresh = facts.where((F.col("date") >= date(1997, 1, 1)) | F.col("date").isNull())
    return past, fresh


# Expressions ----------------------------------------------------------------------


def source(level: str) -> Query:
    def run(spark, sf):
        raw = fixture(spark, sf, f"fx_{level}_insights").withColumn("day", to_day(F.col("date_start")))
        return in_range(raw, "day", date(1995, 1, 1), date(1997, 12, 31)).drop("day")

    return run


def parse_actions_query(spark, sf):
    def shown(action: Column) -> Column:
        return F.concat(
            F.coalesce(action["action_type"], F.lit("-")),
            F.lit("="),
            F.coalesce(action["value"], F.lit("-")),
        )

    objects = F.filter(
        "actions", lambda a: a["action_type"].isNotNull() | a["value"].isNotNull()
    )
    return (
        with_actions(fixture(spark, sf, "fx_ad_insights"))
        .withColumn("actions", objects)
        .select(
            "account_id", "campaign_id", "ad_id", "date_start",
            F.size("actions").cast("bigint").alias("n_actions"),
            F.array_join(F.transform("actions", shown), ";").alias("actions"),
        )
    )


def resolve_result(level: str) -> Query:
    def run(spark, sf):
        rows = with_result(with_actions(fixture(spark, sf, f"fx_{level}_insights")), level)
        return rows.select(
            "account_id", f"{level}_id", "date_start", "optimization_goal", "impressions",
            "result", "result_type",
        )

    return run


def action_metrics(level: str) -> Query:
    def run(spark, sf):
        rows = with_action_metrics(with_actions(fixture(spark, sf, f"fx_{level}_insights")))
        return rows.select(
            "account_id", f"{level}_id", "date_start", "messaging_conversations_started", "purchase"
        )

    return run


def numeric_coercion(spark, sf):
    return with_numbers(
        fixture(spark, sf, "fx_campaign_insights").select(
            "account_id", "campaign_id", "impressions", "clicks", "spend"
        )
    )


def date_dims(spark, sf):
    return with_date_parts(
        fixture(spark, sf, "fx_campaign_insights").select("campaign_id", "date_start")
    )


def account_id_norm(spark, sf):
    return fixture(spark, sf, "fx_campaign_insights").select(
        bare_account_id(F.col("account_id")).alias("account_id"), "campaign_id"
    )


def transform_ad(spark, sf):
    return transform_insights(fixture(spark, sf, "fx_ad_insights"), "ad")


def adset_name_parts(spark, sf):
    return transform_adset_metadata(fixture(spark, sf, "fx_adset_metadata"))


def status_icons(spark, sf):
    return fixture(spark, sf, "fx_campaign_metadata").select(
        "campaign_id", "status", status_icon(F.col("status")).alias("icon")
    )


def error_classes(spark, sf):
    return fixture(spark, sf, "fx_responses").withColumn(
        "class", error_class(F.col("http_status"), F.col("error_code"))
    )


# Shards and marts -----------------------------------------------------------------


def shard_name_parts(spark, sf):
    facts = ad_facts(spark, sf).where("date is not null")
    shard = shard_of(SHARD_PREFIX, F.col("department"), F.col("account"), "ad", F.col("date"))
    return (
        facts.select(shard.alias("shard"))
        .distinct()
        .withColumns({"department": department_of(F.col("shard")), "account": account_of(F.col("shard"))})
    )


SHARD_TABLES = {
    f"{SHARD_PREFIX}mkt_main_ad_m011995": "department = 'mkt'",
    f"{SHARD_PREFIX}sales_alt_ad_m011995": "department = 'sales'",
}


def stg_union(spark, sf):
    facts = ad_facts(spark, sf)
    for name, rows in SHARD_TABLES.items():
        facts.where(rows).drop("department", "account").createOrReplaceTempView(name)
    return union_shards(spark, SHARD_PREFIX, "ad")


def stg_shard_files(spark, sf):
    root = work_folder(spark, "shards")
    facts = ad_facts(spark, sf).withColumn("date", F.col("date").cast("timestamp"))
    for name, rows in SHARD_TABLES.items():
        load(facts.where(rows).drop("department", "account"), f"{root}/{name}", "insert")
    return read_shard_files(spark, root, SHARD_PREFIX, "ad")


def stg_shard_mixed(spark, sf):
    """Month shards as writers that guess types leave them: results of odd days are whole
    numbers, those of even days are not."""
    root, prefix = work_folder(spark, "months"), SHARD_PREFIX
    shard = shard_of(prefix, F.col("department"), F.col("account"), "ad", F.col("date"))
    facts = ad_facts(spark, sf).where("date is not null").withColumns(
        {"shard": shard, "odd": F.dayofmonth("date") % 2, "date": F.col("date").cast("timestamp")}
    )
    # gathered by shard in one shuffle; fractions stay as they are, whole numbers join them
    facts = stage(facts.drop("department", "account"), "months", ("odd", "shard"), root)
    whole = facts.where("odd = 1").drop("odd").withColumn("result", F.col("result").cast("bigint"))
    whole.write.mode("append").partitionBy("shard").parquet(f"{root}/odd=0")
    for path in folders(spark, f"{root}/odd=0/shard=*"):
        put_in_place(spark, path, path.replace("/odd=0/shard=", "/"))
    return read_shard_files(spark, root, prefix, "ad")


def stg_empty(spark, sf):
    """Staged facts and the typed empty relation of a prefix without shards."""
    return staged(campaign_facts(spark, sf), "campaign").unionByName(
        union_shards(spark, "none_table_platform_", "campaign")
    )


def mart_ad_query(limit: int) -> Query:
    def run(spark, sf):
        return mart(ad_facts(spark, sf), "ad", ad_mart_dims(spark, sf), limit)

    return run


def mart_campaign_query(limit: int) -> Query:
    def run(spark, sf):
        dims = campaign_dimensions(campaign_dim(spark, sf))
        return mart(campaign_facts(spark, sf), "campaign", dims, limit)

    return run


def mart_table(level: str) -> Query:
    """The mart, written as a version of a table in the catalog and read by name."""
    query = {"ad": mart_ad_query, "campaign": mart_campaign_query}[level](BROADCAST_LIMIT)

    def run(spark, sf):
        warehouse = work_folder(spark, "mart")
        database = f"checks_{uuid.uuid4().hex}"
        with staged_for(query(spark, sf), "mart-rows") as rows:
            write_mart(rows, warehouse, level, database=database)
        return spark.table(f"{database}.{MART_TABLES[level]}")

    return run


# Upserts and loads ----------------------------------------------------------------


def upsert_by_date(spark, sf):
    past, fresh = past_and_fresh(raw_campaign_facts(spark, sf))
    return upsert(past, fresh, ["date"])


def upsert_by_entity(spark, sf):
    return upsert(good_ads(spark, sf), new_ads(spark, sf), ["account_id", "ad_id"])


def upsert_key_set(spark, sf):
    return key_set(new_ads(spark, sf), ["account_id", "ad_id"])


def upsert_matching_keys(spark, sf):
    return matching_keys(*past_and_fresh(raw_campaign_facts(spark, sf)), ["date"])


def upsert_matches(spark, sf):
    return matching_count(good_ads(spark, sf), new_ads(spark, sf), ["account_id", "ad_id"])


def load_insert(spark, sf):
    """Twice the same rows: an insert deletes nothing."""
    warehouse = work_folder(spark, "insert")
    facts = stage(campaign_facts(spark, sf))
    for _ in range(2):
        load_table(facts, warehouse, "campaign_insights", "insert")
    return read_table(spark, warehouse, "campaign_insights")


def _load_past_and_fresh(spark, sf):
    warehouse = work_folder(spark, "facts")
    past, fresh = past_and_fresh(stage(campaign_facts(spark, sf)))
    load_table(past, warehouse, "campaign_insights")
    return warehouse, load_table(fresh, warehouse, "campaign_insights")


def load_upsert_facts(spark, sf):
    warehouse, _ = _load_past_and_fresh(spark, sf)
    return read_table(spark, warehouse, "campaign_insights")


def load_audit(spark, sf):
    _, audit = _load_past_and_fresh(spark, sf)
    counts = (audit.rows_in, audit.rows_deleted, audit.rows_written)
    return spark.createDataFrame(
        [counts], "rows_in bigint, rows_deleted bigint, rows_written bigint"
    )


def load_upsert_entities(spark, sf):
    warehouse = work_folder(spark, "entities")
    for rows in (good_ads(spark, sf), new_ads(spark, sf)):
        load_table(in_one_shard(rows), warehouse, "ad_metadata")
    return read_table(spark, warehouse, "ad_metadata")


def load_audit_paths(spark, sf):
    """Counts of an upsert into touched partitions, and of one that rewrites a whole table."""
    warehouse, path = work_folder(spark, "audit"), work_folder(spark, "audit-plain")
    for rows in (good_ads(spark, sf), new_ads(spark, sf)):
        audits = {
            "partitions": load_table(in_one_shard(rows), warehouse, "ad_metadata"),
            "table": load(rows, path, "upsert", keys=["account_id", "ad_id"]),
        }
    counts = [(k, a.rows_in, a.rows_deleted, a.rows_written) for k, a in audits.items()]
    return spark.createDataFrame(
        counts, "path string, rows_in bigint, rows_deleted bigint, rows_written bigint"
    )


def load_upsert_unpartitioned(spark, sf):
    path = work_folder(spark, "plain")
    rows = good_ads(spark, sf)
    for new in (rows, new_ads(spark, sf)):
        load(new, path, "upsert", keys=["account_id", "ad_id"], cluster=["ad_id"])
    return read_path(spark, path, rows.schema)


# Work lists and calendars ---------------------------------------------------------


def worklist(name: str, column: str, keep_null: bool = False) -> Query:
    def run(spark, sf):
        return distinct_ids(fixture(spark, sf, name), column, keep_null=keep_null)

    return run


def entity_fetch(insights: str, entity: str, column: str, *fields: str) -> Query:
    def run(spark, sf):
        requested = distinct_ids(fixture(spark, sf, insights), column)
        received = fixture(spark, sf, entity)
        if entity == "fx_ad_metadata":
            received = received.where("ad_name is not null")
        return fetched(requested, received.select(column, *fields), [column])

    return run


def fetch_in_attempts(spark, sf):
    received = answered_ads(spark, sf).drop("account_id", "account_name")
    return fetched_in_attempts(requested_ads(spark, sf), received, ["ad_id"])


def attempts_union(spark, sf):
    """Four attempts one after the other, each asking only for what is still missing."""
    asked, received = requested_ads(spark, sf), answered_ads(spark, sf)
    frames = []
    for n in (1, 2, 3, 4):
        got = received.where(F.col("attempt") == n).select("ad_id", "ad_name", "status")
        frames.append(fetched(asked, got, ["ad_id"]))
        asked = failed_ids(asked, got, ["ad_id"])
    return union_attempts(*frames)


def failed_ids_query(spark, sf):
    received = answered_ads(spark, sf)
    return failed_ids(requested_ads(spark, sf), received, ["ad_id"])


def retry_queue(spark, sf):
    """Two runs of a fetch: what the second asks for again, and the queue after it. The service
    answers or fails as the log of responses says; in the second run two of three that
    failed before come through."""
    on, first, second = ["ad_id"], datetime(1998, 3, 1, 6), datetime(1998, 3, 1, 6, 10)
    log = fixture(spark, sf, "fx_responses").select(
        F.col("request_id").alias("ad_id"), "http_status", "error_code",
        error_class(F.col("http_status"), F.col("error_code")).alias("class"),
    )
    failures = log.where("error_code is not null or http_status >= 400")
    wanted = requested_ads(spark, sf)
    empty_queue = wanted.limit(0).selectExpr(
        "ad_id", "0 as attempts", "'' as class", "cast(null as timestamp) as next_try"
    )
    asked = due(empty_queue, wanted, first, on)
    received = failed_ids(asked, failures, on)
    queue = stage(queue_after(empty_queue, asked, received, failures, first, on))
    again = stage(due(queue, wanted.where("false"), second, on))  # nothing but the queue
    passed = again.where(F.col("ad_id").cast("bigint") % 3 != 0)
    left = queue_after(queue, again, passed, failures, second, on)
    state = ("attempts", "class", F.unix_timestamp("next_try").alias("next_try"))
    return again.join(queue, on).select("ad_id", F.lit("asked").alias("kind"), *state).unionAll(
        left.select("ad_id", F.lit("left").alias("kind"), *state)
    )


def coverage_query(spark, sf):
    received = answered_ads(spark, sf)
    return coverage(requested_ads(spark, sf), received, ["ad_id"])


def calendar(spark, sf):
    """Every day from an account's first to its last."""
    bounds = (
        campaign_facts(spark, sf)
        .groupBy("account_id")
        .agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    )
    return bounds.select("account_id", days_between(F.col("lo"), F.col("hi")).alias("date"))


def missing_days_query(spark, sf):
    return missing_days(calendar(spark, sf), campaign_facts(spark, sf), ["account_id", "date"])


def range_modes(spark, sf):
    """Facts of each scheduled range: one scan, each row under every range it is in."""
    ranges = {mode: date_range(mode, AS_OF) for mode in MODES}
    lo, hi = min(r[0] for r in ranges.values()), max(r[1] for r in ranges.values())
    modes = F.array_compact(
        F.array(*(F.when(F.col("date").between(*r), F.lit(m)) for m, r in ranges.items()))
    )
    return in_range(campaign_facts(spark, sf), "date", lo, hi).select(
        F.explode(modes).alias("mode"), "campaign_id", "date"
    )


# Pipelines ------------------------------------------------------------------------


def land(df: DataFrame, root: str, name: str, *below: str, codec: str = "none") -> None:
    """Landed JSON of one shard, foldered by day, or by run and attempt."""
    by = ["department", "account", *below]
    rows = in_one_shard(df).hint("rebalance", *by)
    writer = rows.write.partitionBy(*by).option("ignoreNullFields", "false").option("compression", codec)
    writer.mode("append").json(f"{root}/{name}")


def land_insights(df: DataFrame, root: str, level: str) -> None:
    """Rows whose start is unreadable were asked for by their stop day. They are landed
    compressed: as plain JSON they take far more room than all tables made of them."""
    day = F.coalesce(to_day(F.col("date_start")), to_day(F.col("date_stop")))
    rows = df.withColumns({"account_id": F.lit("act_7"), "day": day})
    land(rows, root, f"{level}_insights", "day", codec=LANDED_CODEC)


def land_answers(spark, sf: str, root: str, level: str, run: str | None, ads: DataFrame, change) -> None:
    """Answers to one run's questions; ``change`` gives a later run other names and states."""
    one = F.lit(1).alias("attempt")

    def put(df: DataFrame, name: str, *below: str) -> None:
        df = change(name, df)
        if run is not None:
            df, below = df.withColumn("run", F.lit(run)), ("run", *below)
        land(df, root, name, *below)

    account = fixture(spark, sf, "fx_campaign_metadata").select(
        F.lit("act_7").alias("id"), F.lit("Account 7").alias("name")
    )
    put(account.distinct(), "accounts")
    put(
        fixture(spark, sf, "fx_campaign_metadata").select(
            F.col("campaign_id").alias("id"), F.col("campaign_name").alias("name"), "status", one
        ),
        "campaigns", "attempt",
    )
    if level == "campaign":
        return
    put(
        ads.select(
            F.col("ad_id").alias("id"), F.col("ad_name").alias("name"),
            "adset_id", "campaign_id", "status", "attempt",
        ),
        "ads", "attempt",
    )
    put(
        fixture(spark, sf, "fx_adset_metadata").select(
            F.col("adset_id").alias("id"), F.col("adset_name").alias("name"), "campaign_id", one
        ),
        "adsets", "attempt",
    )
    creative = fixture(spark, sf, "fx_ad_creative")
    link = F.when(F.col("creative_id").isNotNull(), F.struct(F.col("creative_id").alias("id")))
    put(
        creative.select(F.col("ad_id").alias("id"), link.alias("creative"), one),
        "ad_creatives", "attempt",
    )
    put(
        creative.where("creative_id is not null").select(
            F.col("creative_id").alias("id"), "thumbnail_url"
        ),
        "creatives",
    )


def landed_job(spark: SparkSession, sf: str, level: str, run: str | None = None) -> Job:
    """All landed files of one shard, and a fresh warehouse."""
    root = work_folder(spark, f"landing-{level}")
    land_answers(spark, sf, root, level, run, answered_ads(spark, sf), lambda _, df: df)
    land_insights(fixture(spark, sf, f"fx_{level}_insights"), root, level)
    return Job(root, work_folder(spark, "warehouse"), "mkt", "main", run)


RUN_PIPELINE = {"ad": run_ad, "campaign": run_campaign}


def built_mart(spark: SparkSession, job: Job, level: str) -> DataFrame:
    """The mart a pipeline has written, read back."""
    names = ("ad_metadata", "campaign_metadata", "adset_metadata", "ad_creative")
    tables = names if level == "ad" else ("campaign_metadata",)
    dims = {"ad": ad_dimensions, "campaign": campaign_dimensions}[level]
    shape = mart(
        read_table(spark, job.warehouse, f"{level}_insights"),
        level,
        dims(*(read_table(spark, job.warehouse, t) for t in tables)),
    ).schema
    return read_path(spark, f"{job.warehouse}/{MART_TABLES[level]}", shape)


def pipeline(level: str) -> Query:
    """Landed JSON through loads and fetches to the mart table, read back."""

    def run(spark, sf):
        job = landed_job(spark, sf, level)
        RUN_PIPELINE[level](spark, job, FIRST_DAY, LAST_DAY)
        return built_mart(spark, job, level)

    return run


def changed_answers(name: str, df: DataFrame) -> DataFrame:
    """What a later run is told: entities renamed, paused and pictured anew."""
    if name in ("ads", "campaigns", "accounts"):
        df = df.withColumn("name", F.concat("name", F.lit(" v2")))
    if name in ("ads", "campaigns"):
        df = df.withColumn("status", F.lit("PAUSED"))
    if name == "creatives":
        df = df.withColumn("thumbnail_url", F.concat("thumbnail_url", F.lit("?v=2")))
    return df


def pipeline_rerun(level: str) -> Query:
    """A second run over the later days only. Its answers differ, and one ad in four it
    never gets; entities it does not ask for keep what the first run was told."""

    def run(spark, sf):
        job = landed_job(spark, sf, level, "run1")
        RUN_PIPELINE[level](spark, job, FIRST_DAY, LAST_DAY)
        ads = good_ads(spark, sf).where(F.col("ad_id").cast("bigint") % 4 != 1)
        ads = ads.withColumn("attempt", F.lit(2))
        land_answers(spark, sf, job.landing, level, "run2", ads, changed_answers)
        RUN_PIPELINE[level](spark, replace(job, run="run2"), RERUN_FROM, LAST_DAY)
        return built_mart(spark, job, level)

    return run


def run_both_query(spark, sf):
    """Both pipelines at once over the month before ``AS_OF``: their audit rows, and how
    many ids of each entity were asked for and answered."""
    job = landed_job(spark, sf, "ad")
    land_insights(fixture(spark, sf, "fx_campaign_insights"), job.landing, "campaign")
    outcome = run_scheduled(spark, job, "lastmonth", AS_OF)
    for result in outcome.values():
        if isinstance(result, Exception):
            raise result
    kept = spark.read.schema(AUDIT).parquet(f"{job.warehouse}/load_audit")
    counts = spark.read.schema(COVERAGE).parquet(f"{job.warehouse}/fetch_coverage")
    return kept.select(
        "pipeline", F.col("table").alias("item"), F.col("rows_in").alias("a"), F.col("rows_written").alias("b")
    ).unionAll(counts.select("pipeline", "entity", "requested", "received"))


def backfill_ad(spark, sf):
    """The ad pipeline over an explicit quarter."""
    job = landed_job(spark, sf, "ad")
    backfill(spark, job, "ad_insights", "1996-01-01", "1996-03-31")
    return built_mart(spark, job, "ad")


QUERIES: dict[str, Query] = {
    "src_ad_insights": source("ad"),
    "src_campaign_insights": source("campaign"),
    "parse_actions": parse_actions_query,
    "resolve_result_ad": resolve_result("ad"),
    "resolve_result_campaign": resolve_result("campaign"),
    "action_metrics_ad": action_metrics("ad"),
    "action_metrics_campaign": action_metrics("campaign"),
    "numeric_coercion": numeric_coercion,
    "date_dims": date_dims,
    "account_id_norm": account_id_norm,
    "transform_ad": transform_ad,
    "transform_campaign": raw_campaign_facts,
    "campaign_name_parts": campaign_dim,
    "adset_name_parts": adset_name_parts,
    "status_icons": status_icons,
    "shard_name_parts": shard_name_parts,
    "stg_union": stg_union,
    "stg_shard_files": stg_shard_files,
    "stg_shard_mixed": stg_shard_mixed,
    "stg_empty": stg_empty,
    "mart_ad": mart_ad_query(BROADCAST_LIMIT),
    "mart_ad_large_dimensions": mart_ad_query(NO_BROADCAST),
    "mart_ad_table": mart_table("ad"),
    "mart_campaign": mart_campaign_query(BROADCAST_LIMIT),
    "mart_campaign_large_dimensions": mart_campaign_query(NO_BROADCAST),
    "mart_campaign_table": mart_table("campaign"),
    "upsert_by_date": upsert_by_date,
    "upsert_by_entity": upsert_by_entity,
    "upsert_key_set": upsert_key_set,
    "upsert_matching_keys": upsert_matching_keys,
    "upsert_matches": upsert_matches,
    "worklist_ads": worklist("fx_ad_insights", "ad_id"),
    "worklist_campaigns": worklist("fx_campaign_insights", "campaign_id", keep_null=True),
    "worklist_adsets": worklist("fx_ad_metadata", "adset_id"),
    "worklist_campaigns_from_ads": worklist("fx_ad_metadata", "campaign_id"),
    "entity_fetch_ads": entity_fetch(
        "fx_ad_insights", "fx_ad_metadata", "ad_id", "ad_name", "adset_id", "campaign_id", "status"
    ),
    "entity_fetch_adsets": entity_fetch(
        "fx_ad_insights", "fx_adset_metadata", "adset_id",
        "adset_name", "campaign_id", "account_id", "account_name",
    ),
    "entity_fetch_campaigns": entity_fetch(
        "fx_campaign_insights", "fx_campaign_metadata", "campaign_id",
        "campaign_name", "status", "account_id", "account_name",
    ),
    "creative_fetch": entity_fetch(
        "fx_ad_insights", "fx_ad_creative", "ad_id", "creative_id", "thumbnail_url"
    ),
    "fetch_in_attempts": fetch_in_attempts,
    "attempts_union": attempts_union,
    "failed_ids": failed_ids_query,
    "coverage": coverage_query,
    "calendar": calendar,
    "missing_days": missing_days_query,
    "range_modes": range_modes,
    "error_class": error_classes,
    "load_insert": load_insert,
    "load_upsert_facts": load_upsert_facts,
    "load_upsert_entities": load_upsert_entities,
    "load_upsert_unpartitioned": load_upsert_unpartitioned,
    "load_audit": load_audit,
    "load_audit_paths": load_audit_paths,
    "retry_queue": retry_queue,
    "pipeline_campaign": pipeline("campaign"),
    "pipeline_ad": pipeline("ad"),
    "pipeline_campaign_rerun": pipeline_rerun("campaign"),
    "pipeline_ad_rerun": pipeline_rerun("ad"),
    "run_both": run_both_query,
    "backfill_ad": backfill_ad,
}
