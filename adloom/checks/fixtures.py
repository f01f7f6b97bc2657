"""SQL that shapes the test tables into ads tables. It runs unchanged in Spark and DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from adloom.session import configure

SOURCES = ("lineitem", "orders", "customer", "supplier", "part", "events")

FX_AD_INSIGHTS = r"""
select cast(l.l_partkey % 4 as string) as account_id,
  cast(o.o_custkey as string) as campaign_id,
  cast(l.l_partkey as string) as ad_id,
  cast(l.l_suppkey as string) as adset_id,
  case l.l_linenumber when 1 then 'REACH' when 2 then 'IMPRESSIONS' when 3 then 'PAGE_LIKES'
    when 4 then 'MESSAGES' when 5 then 'OFFSITE_CONVERSIONS' when 6 then 'NOT_A_GOAL' end as optimization_goal,
  case cast(l.l_orderkey % 8 as int)
    when 0 then null when 1 then '' when 2 then 'None'
    when 3 then '{"action_type": "lead", "value": "1"}'
    when 4 then replace(concat('[{~action_type~: ~like~, ~value~: ~', cast(l.l_partkey as string), '~}, {~action_type~: ~purchase~, ~value~: ~2~}, {~action_type~: ~purchase~, ~value~: ~3.9~}]'), '~', chr(39))
    when 5 then concat('[{"action_type": "onsite_conversion.messaging_conversation_started_7d", "value": "', cast(l.l_suppkey as string), '"}, {"action_type": "lead", "value": "x"}]')
    when 6 then '[{"action_type": "lead", "value": "4"}, 7, {"action_type": "onsite_conversion.lead_grouped", "value": 5}]'
    else '[{"action_type": "purchase"}, {"action_type": "like", "value": null}]' end as actions,
  cast(l.l_extendedprice as string) as spend,
  cast(cast(l.l_quantity * 100 as bigint) as string) as impressions,
  cast(cast(l.l_quantity as bigint) as string) as clicks,
  cast(cast(l.l_shipdate as date) as string) as date_start,
  cast(cast(l.l_shipdate as date) as string) as date_stop
from lineitem l join orders o on l.l_orderkey = o.o_orderkey
"""

FX_CAMPAIGN_INSIGHTS = r"""
select case when o_orderkey % 2 = 0 then concat('act_', cast(o_custkey % 4 as string)) else cast(o_custkey % 4 as string) end as account_id,
  cast(o_custkey as string) as campaign_id,
  case cast(o_orderkey % 5 as int) when 0 then 'REACH' when 1 then 'LEAD_GENERATION' when 2 then 'CONVERSIONS' when 3 then 'PAGE_LIKES' end as optimization_goal,
  case cast(o_orderkey % 3 as int) when 0 then null
    when 1 then '[{"action_type": "lead", "value": "abc"}, {"action_type": "lead", "value": "9"}]'
    else '[{"action_type": "purchase", "value": "1.5"}, {"action_type": "purchase", "value": "bad"}, {"action_type": "like", "value": "2"}]' end as actions,
  cast(o_totalprice as string) as spend,
  case cast(o_orderkey % 10 as int) when 0 then null when 1 then 'abc' when 2 then ' 7 ' when 3 then '1e3' when 4 then '5d' when 5 then ''
    else cast(o_orderkey % 1000 as string) end as impressions,
  cast(o_orderkey % 50 as string) as clicks,
  case when o_orderkey % 97 = 0 then null when o_orderkey % 89 = 0 then 'bad'
    else cast(cast(o_orderdate as date) as string) end as date_start,
  cast(cast(o_orderdate as date) as string) as date_stop
from orders
"""

FX_CAMPAIGN_METADATA = r"""
select cast(c_custkey as string) as campaign_id,
  case cast(c_custkey % 5 as int) when 0 then null when 1 then ''
    when 2 then concat(c_mktsegment, '_R', cast(c_nationkey as string), '_')
    else concat(c_mktsegment, '_R', cast(c_nationkey as string), '_B1_B2_CAT_PERS_SKIP_TRK_PIL_CON') end as campaign_name,
  case cast(c_custkey % 6 as int) when 0 then 'ACTIVE' when 1 then 'PAUSED' when 2 then 'ARCHIVED' when 3 then 'DELETED' when 4 then 'IN_REVIEW' end as status,
  cast(c_custkey % 4 as string) as account_id,
  concat('Account ', cast(c_custkey % 4 as string)) as account_name
from customer
"""

FX_ADSET_METADATA = r"""
select cast(s_suppkey as string) as adset_id,
  case cast(s_suppkey % 4 as int) when 0 then null
    when 1 then concat('LOC', cast(s_nationkey as string), '||18-24')
    else concat('LOC', cast(s_nationkey as string), '|F|18-24|AUD|FMT|STR|TYP|PIL|CON') end as adset_name,
  cast(s_suppkey % 7 as string) as campaign_id,
  cast(s_suppkey % 4 as string) as account_id,
  concat('Account ', cast(s_suppkey % 4 as string)) as account_name
from supplier
"""

FX_AD_METADATA = r"""
select cast(p_partkey as string) as ad_id, p_name as ad_name, cast(p_partkey % 10 as string) as adset_id,
  cast(p_partkey % 15 as string) as campaign_id,
  case cast(p_partkey % 6 as int) when 0 then 'ACTIVE' when 1 then 'PAUSED' when 2 then 'ARCHIVED' when 3 then 'DELETED' when 4 then 'IN_REVIEW' end as status,
  cast(p_partkey % 4 as string) as account_id, concat('Account ', cast(p_partkey % 4 as string)) as account_name
from part
union all
select cast(p_partkey as string), null, null, null, null, cast(p_partkey % 4 as string), concat('Account ', cast(p_partkey % 4 as string))
from part where p_partkey % 10 = 0
"""

FX_AD_CREATIVE = r"""
select cast(p_partkey % 4 as string) as account_id, cast(p_partkey as string) as ad_id,
  case when p_partkey % 5 = 0 then null else concat('cr', cast(p_partkey as string)) end as creative_id,
  case when p_partkey % 5 = 0 then null else concat('https://cdn.example/', cast(p_partkey as string), '.jpg') end as thumbnail_url
from part where p_partkey % 3 <> 0
"""

# Answers of the ads service, one per event: status and error code from the event.
FX_RESPONSES = """
select cast(event_id as string) as request_id,
  case event_type when 'error' then 500 + cast(event_id % 4 as int) when 'click' then 400
    when 'view' then 200 end as http_status,
  case cast(event_id % 7 as int) when 0 then 190 when 1 then 1 when 2 then 80000 when 3 then 17
    when 4 then 100 end as error_code
from events
"""

FIXTURES = {
    "fx_ad_insights": FX_AD_INSIGHTS,
    "fx_campaign_insights": FX_CAMPAIGN_INSIGHTS,
    "fx_campaign_metadata": FX_CAMPAIGN_METADATA,
    "fx_adset_metadata": FX_ADSET_METADATA,
    "fx_ad_metadata": FX_AD_METADATA,
    "fx_ad_creative": FX_AD_CREATIVE,
    "fx_responses": FX_RESPONSES,
}


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One ads table shaped from the test tables in a folder."""
    configure(spark)
    sql = FIXTURES[name]
    for source in SOURCES:
        if re.search(rf"\b{source}\b", sql):
            spark.read.parquet(f"{sf_dir}/{source}.parquet").createOrReplaceTempView(source)
    return spark.sql(sql)
