"""DuckDB SQL for every registered query, over the same test tables."""

from __future__ import annotations

from adloom.checks.fixtures import FIXTURES
from adloom.functions.actions import GOAL_ACTIONS
from adloom.functions.names import ADSET_PART_INDEX, CAMPAIGN_PART_INDEX
from adloom.schemas import ADSET_PARTS, CAMPAIGN_PARTS, MART_COLUMNS, STAGED_COLUMNS

NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
MESSAGING = "onsite_conversion.messaging_conversation_started_7d"


def num(text: str) -> str:
    return (
        f"coalesce(case when regexp_matches({text}, '{NUMBER}') "
        f"then try_cast(trim({text}) as double) end, 0)"
    )


def whole(text: str) -> str:
    return f"cast(trunc({num(text)}) as bigint)"


def with_ctes(select: str, **ctes: str) -> str:
    """``select`` after the fixtures it or its CTEs name, and its CTEs in order."""
    text = select + " ".join(ctes.values())
    used = {name: sql for name, sql in FIXTURES.items() if name in text}
    parts = [f"{name} as ({sql})" for name, sql in {**used, **ctes}.items()]
    return f"with {', '.join(parts)} {select}" if parts else select


def acts(source: str) -> str:
    return f"""
      select *, case when json_valid(t) then case when json_type(t) = 'ARRAY'
          then list_filter(json_extract(t, '$[*]'), lambda x: json_type(x) = 'OBJECT') end end as acts
      from (select *, replace(actions, chr(39), '"') as t from {source})"""


def typed(name: str) -> str:
    return f"list_filter(acts, lambda x: json_extract_string(x, '$.action_type') = {name})"


def value(hit: str) -> str:
    return f"json_extract_string({hit}, '$.value')"


TARGET = "case optimization_goal " + " ".join(
    f"when '{goal}' then '{action}'" for goal, action in GOAL_ACTIONS.items()
) + " end"


def resolved(source: str, level: str) -> str:
    """Rows of a raw source with result, result_type and the two action metrics."""
    reach = "'reach'" if level == "ad" else "'impressions'"
    grouped = "'onsite_conversion.lead_grouped'"
    return f"""
      select *,
        case when target in ('reach', 'impressions') then {num('impressions')}
          else {num(value('hit'))} end as result,
        case when target = 'reach' then {reach} when target = 'impressions' then target
          when json_extract_string(hit, '$.action_type') = 'like' then 'follows_or_likes'
          else coalesce(json_extract_string(hit, '$.action_type'), 'unknown') end as result_type,
        {whole(value(typed(f"'{MESSAGING}'") + '[-1]'))} as messaging_conversations_started,
        {whole(value(typed("'purchase'") + '[-1]'))} as purchase
      from (select *, coalesce({typed('target')}[1], {typed(grouped)}[1], {typed("'lead'")}[1]) as hit
        from (select *, {TARGET} as target from ({acts(source)})))"""


def facts(source: str, level: str) -> str:
    ids = "account_id, campaign_id" + (", adset_id, ad_id" if level == "ad" else "")
    return f"""
      select {ids}, {whole('impressions')} as impressions, {whole('clicks')} as clicks,
        {num('spend')} as spend, result, result_type, messaging_conversations_started, purchase,
        day as date, cast(year(day) as int) as year, strftime(day, '%Y-%m') as month
      from (select *, try_cast(date_start as date) as day from ({resolved(source, level)}))"""


def bare(column: str) -> str:
    return f"regexp_replace({column}, '^act_', '')"


def parts(name: str, delimiter: str, index: dict[str, int]) -> str:
    return ", ".join(
        f"coalesce(str_split(coalesce({name}, ''), '{delimiter}')[{at + 1}], 'unknown') as {part}"
        for part, at in index.items()
    )


CAMPAIGN_SPLIT = "'Facebook' as platform, " + parts("campaign_name", "_", CAMPAIGN_PART_INDEX)
ADSET_SPLIT = parts("adset_name", "|", ADSET_PART_INDEX)


def icon(status: str) -> str:
    return (
        f"case when {status} = 'ACTIVE' then '🟢' when {status} = 'PAUSED' then '⚪' "
        f"when {status} in ('ARCHIVED', 'DELETED') then '🔴' else '❓' end"
    )


def columns(names, table: str = "") -> str:
    return ", ".join(f"{table}{n}" for n in names)


def mart(level: str, facts_cte: str = "facts", **dims: str) -> str:
    """Mart over a facts CTE with department and account, and dimension CTEs."""
    if level == "campaign":
        return f"""
          select {columns(STAGED_COLUMNS['campaign'], 'f.')}, c.account_name, c.campaign_name,
            {icon('c.status')} as campaign_status, {columns(CAMPAIGN_PARTS, 'c.')}
          from {facts_cte} f left join {dims['campaign']} c
            on f.account_id = c.account_id and f.campaign_id = c.campaign_id"""
    return f"""
      select {columns(STAGED_COLUMNS['ad'], 'f.')}, a.ad_name, {icon('a.status')} as ad_status,
        r.thumbnail_url, {columns(CAMPAIGN_PARTS, 'c.')}, {columns(ADSET_PARTS, 's.')}
      from {facts_cte} f
      left join {dims['ad']} a on f.account_id = a.account_id and f.ad_id = a.ad_id
      left join {dims['campaign']} c on f.account_id = c.account_id and f.campaign_id = c.campaign_id
      left join {dims['adset']} s on f.account_id = s.account_id and f.adset_id = s.adset_id
      left join {dims['creative']} r on f.account_id = r.account_id and f.ad_id = r.ad_id"""


def in_mart_order(level: str, select: str) -> str:
    return f"select {columns(MART_COLUMNS[level])} from ({select})"


AD_DEPARTMENT = "case when account_id in ('0', '1') then 'mkt' else 'sales' end"
AD_ACCOUNT = "case when account_id in ('0', '1') then 'main' else 'alt' end"
SHARDED_AD = f"""
  select {AD_DEPARTMENT} as department, {AD_ACCOUNT} as account, * from ({facts('fx_ad_insights', 'ad')})"""
SHARDED_CAMPAIGN = f"""
  select 'mkt' as department, 'main' as account, {bare('account_id')} as account_id,
    * exclude (account_id) from ({facts('fx_campaign_insights', 'campaign')})"""
CAMPAIGN_DIM = f"select *, {CAMPAIGN_SPLIT} from fx_campaign_metadata"
ADSET_DIM = f"select *, {ADSET_SPLIT} from fx_adset_metadata"
DIMS = {
    "ad": "fx_ad_metadata", "campaign": "campaigns", "adset": "adsets", "creative": "fx_ad_creative",
}

MART_AD = with_ctes(
    in_mart_order("ad", mart("ad", **DIMS)),
    facts=SHARDED_AD, campaigns=CAMPAIGN_DIM, adsets=ADSET_DIM,
)
MART_CAMPAIGN = with_ctes(
    in_mart_order("campaign", mart("campaign", campaign="campaigns")),
    facts=SHARDED_CAMPAIGN, campaigns=CAMPAIGN_DIM,
)


def upserted(target: str, new: str, *keys: str) -> str:
    same = " and ".join(f"t.{k} = n.{k}" for k in keys)
    return (
        f"select * from {target} t where not exists (select 1 from {new} n where {same}) "
        f"union all by name select * from {new}"
    )


GOOD_ADS = "select * from fx_ad_metadata where ad_name is not null"
NEW_ADS = """
  select * from fx_ad_metadata where ad_name is null
  union all select null, p_name, null, null, null, null, null from part"""
UPSERT_DATE = {
    "facts": facts("fx_campaign_insights", "campaign"),
    "target": "select * from facts where date < date '1998-01-01'",
    "fresh": "select * from facts where date >= date '1997-01-01' or date is null",
}
UPSERT_ENTITY = {"target": GOOD_ADS, "fresh": NEW_ADS}
PAST_FACTS = {
    "facts": SHARDED_CAMPAIGN,
    "target": UPSERT_DATE["target"],
    "fresh": UPSERT_DATE["fresh"],
}

AD_ATTEMPT = "case cast(ad_id as bigint) % 10 when 0 then 2 when 5 then 4 else 1 end"
REQUESTED_ADS = "select distinct ad_id from fx_ad_insights where ad_id is not null"
ANSWERED_ADS = f"select *, {AD_ATTEMPT} as attempt from ({GOOD_ADS})"
ADS_IN_ATTEMPTS = """
  select q.ad_id, cast(q.attempt as int) as attempt,
    case when a.attempt = q.attempt then ad_name end as ad_name,
    case when a.attempt = q.attempt then adset_id end as adset_id,
    case when a.attempt = q.attempt then campaign_id end as campaign_id,
    case when a.attempt = q.attempt then status end as status
  from (select r.ad_id, unnest(generate_series(1, coalesce(a.attempt, 3))) as attempt
      from requested r left join (select * from answered) a using (ad_id)) q
    left join (select * from answered) a using (ad_id)"""

# The shard of the pipeline queries: one configured account.
PIPELINE_ACCOUNT = {"account_id": "'7'", "account_name": "'Account 7'"}


def in_pipeline(select: str) -> str:
    return (
        f"select 'mkt' as department, 'main' as account, '7' as account_id, "
        f"* exclude (account_id) from ({select})"
    )


PIPELINE_CAMPAIGN_DIM = f"""
  select q.campaign_id, c.campaign_name, c.status, '7' as account_id, 'Account 7' as account_name,
    {CAMPAIGN_SPLIT.replace('campaign_name', 'c.campaign_name')}
  from campaign_ids q left join fx_campaign_metadata c using (campaign_id)"""
PIPELINE_AD = {
    "facts": in_pipeline(facts("fx_ad_insights", "ad")),
    "requested": REQUESTED_ADS,
    "answered": ANSWERED_ADS,
    "ad_rows": f"select *, '7' as account_id from ({ADS_IN_ATTEMPTS})",
    "adset_ids": "select distinct adset_id from ad_rows where adset_id is not null",
    "campaign_ids": "select distinct campaign_id from ad_rows where campaign_id is not null",
    "adsets": f"""select q.adset_id, '7' as account_id, {ADSET_SPLIT.replace('adset_name', 's.adset_name')}
      from adset_ids q left join fx_adset_metadata s using (adset_id)""",
    "campaigns": PIPELINE_CAMPAIGN_DIM,
    "creatives": """
      select '7' as account_id, q.ad_id, c.thumbnail_url
      from (select r.ad_id, unnest(generate_series(1, case when c.ad_id is null then 3 else 1 end))
          from requested r left join fx_ad_creative c using (ad_id)) q
        left join fx_ad_creative c using (ad_id)""",
}
PIPELINE_CAMPAIGN = {
    "facts": in_pipeline(facts("fx_campaign_insights", "campaign")),
    "campaign_ids": "select distinct campaign_id from facts where campaign_id is not null",
    "campaigns": PIPELINE_CAMPAIGN_DIM,
}

# A second run over days from 1997 on: its answers replace those of the ids it asks for.
PIPELINE_CAMPAIGN_RERUN = {
    "again": """select * from fx_campaign_insights
      where coalesce(try_cast(date_start as date), try_cast(date_stop as date)) >= date '1997-01-01'""",
    # rows without a date replace nothing, so the second load adds them again
    "again_undated": "select * from again where try_cast(date_start as date) is null",
    "facts": in_pipeline(facts("fx_campaign_insights", "campaign"))
    + " union all by name " + in_pipeline(facts("again_undated", "campaign")),
    "campaign_ids": "select distinct campaign_id from facts where campaign_id is not null",
    "first_campaigns": PIPELINE_CAMPAIGN_DIM,
    "asked": "select distinct campaign_id from again where campaign_id is not null",
    "told": "select * replace (campaign_name || ' v2' as campaign_name, 'PAUSED' as status) from fx_campaign_metadata",
    "second_campaigns": PIPELINE_CAMPAIGN_DIM.replace("fx_campaign_metadata", "told")
    .replace("campaign_ids", "asked").replace("'Account 7'", "'Account 7 v2'"),
    "campaigns": """select * from first_campaigns where campaign_id not in (select campaign_id from asked)
      union all by name select * from second_campaigns""",
}
PIPELINE_AD_RERUN = {
    **{name: PIPELINE_AD[name] for name in ("facts", "requested", "answered")},
    "first_ads": PIPELINE_AD["ad_rows"],
    "asked": "select distinct ad_id from facts where ad_id is not null and date >= date '1997-01-01'",
    "told_ads": f"""select * replace (ad_name || ' v2' as ad_name, 'PAUSED' as status), 2 as attempt
      from ({GOOD_ADS}) where cast(ad_id as bigint) % 4 <> 1""",
    "second_ads": "select *, '7' as account_id from ("
    + ADS_IN_ATTEMPTS.replace("from answered", "from told_ads").replace("from requested", "from asked") + ")",
    "ad_rows": """select * from first_ads where ad_id not in (select ad_id from asked)
      union all by name select * from second_ads""",
    "first_campaign_ids": "select distinct campaign_id from first_ads where campaign_id is not null",
    "second_campaign_ids": "select distinct campaign_id from second_ads where campaign_id is not null",
    "told": PIPELINE_CAMPAIGN_RERUN["told"],
    "first_campaigns": PIPELINE_CAMPAIGN_DIM.replace("campaign_ids", "first_campaign_ids"),
    "second_campaigns": PIPELINE_CAMPAIGN_DIM.replace("campaign_ids", "second_campaign_ids")
    .replace("fx_campaign_metadata", "told"),
    "campaigns": """select * from first_campaigns
        where campaign_id not in (select campaign_id from second_campaign_ids)
      union all by name select * from second_campaigns""",
    "adset_ids": "select distinct adset_id from first_ads where adset_id is not null",
    "adsets": PIPELINE_AD["adsets"],
    "creatives": """
      select '7' as account_id, q.ad_id,
        c.thumbnail_url || case when q.ad_id in (select ad_id from asked) then '?v=2' else '' end as thumbnail_url
      from (select r.ad_id, unnest(generate_series(1, case when c.ad_id is null then 3 else 1 end))
          from requested r left join fx_ad_creative c using (ad_id)) q
        left join fx_ad_creative c using (ad_id)""",
}

BACKFILL_AD = {
    **PIPELINE_AD,
    "facts": PIPELINE_AD["facts"] + " where date between date '1996-01-01' and date '1996-03-31'",
    "requested": "select distinct ad_id from facts where ad_id is not null",
}
# Both pipelines over February 1998: rows of every load, and ids asked for and answered.
RUN_BOTH = {
    "campaign_rows": """select * from fx_campaign_insights
      where coalesce(try_cast(date_start as date), try_cast(date_stop as date))
        between date '1998-02-01' and date '1998-02-28'""",
    **BACKFILL_AD,
    "facts": PIPELINE_AD["facts"] + " where date between date '1998-02-01' and date '1998-02-28'",
    "campaign_ids": """select campaign_id from ad_rows where campaign_id is not null
      union select campaign_id from campaign_rows where campaign_id is not null""",
    "counted": """
      select 'ad_insights' as item, count(*) as a, count(*) as b from facts
      union all select 'ad_metadata', count(*), count(*) from ad_rows
      union all select 'ad_creative', count(*), count(*) from creatives
      union all select 'adset_metadata', count(*), count(*) from adsets
      union all select 'campaign_metadata', count(*), count(*) from campaigns
      union all select 'ads', (select count(*) from requested),
        (select count(*) from requested where ad_id in (select ad_id from answered))
      union all select 'ad_creatives', (select count(*) from requested),
        (select count(*) from requested where ad_id in (select ad_id from fx_ad_creative))
      union all select 'adsets', (select count(*) from adset_ids),
        (select count(*) from adset_ids where adset_id in (select adset_id from fx_adset_metadata))
      union all select 'campaigns', (select count(*) from campaign_ids),
        (select count(*) from campaign_ids where campaign_id in (select campaign_id from fx_campaign_metadata))""",
}

AS_OF = "1998-03-15"
RANGE_MODES = {
    "today": ("1998-03-15", "1998-03-15"),
    "last3days": ("1998-03-12", "1998-03-14"),
    "last7days": ("1998-03-08", "1998-03-14"),
    "thismonth": ("1998-03-01", "1998-03-15"),
    "lastmonth": ("1998-02-01", "1998-02-28"),
}

ORACLES: dict[str, str] = {
    "src_ad_insights": with_ctes(
        "select * from fx_ad_insights where try_cast(date_start as date) "
        "between date '1995-01-01' and date '1997-12-31'"
    ),
    "src_campaign_insights": with_ctes(
        "select * from fx_campaign_insights where try_cast(date_start as date) "
        "between date '1995-01-01' and date '1997-12-31'"
    ),
    "parse_actions": with_ctes(
        f"""select account_id, campaign_id, ad_id, date_start,
          cast(coalesce(len(acts), 0) as bigint) as n_actions,
          coalesce(list_aggregate(list_transform(acts, lambda x: concat(
            coalesce(json_extract_string(x, '$.action_type'), '-'), '=',
            coalesce(json_extract_string(x, '$.value'), '-'))), 'string_agg', ';'), '') as actions
          from ({acts('fx_ad_insights')})"""
    ),
    "resolve_result_ad": with_ctes(
        "select account_id, ad_id, date_start, optimization_goal, impressions, result, result_type "
        f"from ({resolved('fx_ad_insights', 'ad')})"
    ),
    "resolve_result_campaign": with_ctes(
        "select account_id, campaign_id, date_start, optimization_goal, impressions, result, "
        f"result_type from ({resolved('fx_campaign_insights', 'campaign')})"
    ),
    "action_metrics_ad": with_ctes(
        "select account_id, ad_id, date_start, messaging_conversations_started, purchase "
        f"from ({resolved('fx_ad_insights', 'ad')})"
    ),
    "action_metrics_campaign": with_ctes(
        "select account_id, campaign_id, date_start, messaging_conversations_started, purchase "
        f"from ({resolved('fx_campaign_insights', 'campaign')})"
    ),
    "numeric_coercion": with_ctes(
        f"select account_id, campaign_id, {whole('impressions')} as impressions, "
        f"{whole('clicks')} as clicks, {num('spend')} as spend from fx_campaign_insights"
    ),
    "date_dims": with_ctes(
        "select campaign_id, date_start, day as date, cast(year(day) as int) as year, "
        "strftime(day, '%Y-%m') as month "
        "from (select *, try_cast(date_start as date) as day from fx_campaign_insights)"
    ),
    "account_id_norm": with_ctes(
        f"select {bare('account_id')} as account_id, campaign_id from fx_campaign_insights"
    ),
    "transform_ad": with_ctes(f"select * from ({facts('fx_ad_insights', 'ad')})"),
    "transform_campaign": with_ctes(f"select * from ({facts('fx_campaign_insights', 'campaign')})"),
    "campaign_name_parts": with_ctes(f"select * from ({CAMPAIGN_DIM})"),
    "adset_name_parts": with_ctes(f"select * from ({ADSET_DIM})"),
    "status_icons": with_ctes(
        f"select campaign_id, status, {icon('status')} as icon from fx_campaign_metadata"
    ),
    "shard_name_parts": with_ctes(
        """select distinct concat('co_table_platform_', department, '_', account, '_ad_m',
            strftime(date, '%m%Y')) as shard, department, account
          from facts where date is not null""",
        facts=SHARDED_AD,
    ),
    "stg_union": with_ctes(
        f"select {columns(STAGED_COLUMNS['ad'])} from facts", facts=SHARDED_AD
    ),
    "stg_shard_files": with_ctes(
        f"select {columns(STAGED_COLUMNS['ad'])} from facts", facts=SHARDED_AD
    ),
    "stg_shard_mixed": with_ctes(
        f"select {columns(STAGED_COLUMNS['ad'])} from facts where date is not null", facts=SHARDED_AD
    ),
    "stg_empty": with_ctes(
        f"select {columns(STAGED_COLUMNS['campaign'])} from facts", facts=SHARDED_CAMPAIGN
    ),
    "mart_ad": MART_AD,
    "mart_ad_large_dimensions": MART_AD,
    "mart_ad_table": MART_AD,
    "mart_campaign": MART_CAMPAIGN,
    "mart_campaign_large_dimensions": MART_CAMPAIGN,
    "mart_campaign_table": MART_CAMPAIGN,
    "upsert_by_date": with_ctes(upserted("target", "fresh", "date"), **UPSERT_DATE),
    "upsert_by_entity": with_ctes(upserted("target", "fresh", "account_id", "ad_id"), **UPSERT_ENTITY),
    "upsert_key_set": with_ctes(
        "select distinct account_id, ad_id from fresh where account_id is not null and ad_id is not null",
        **UPSERT_ENTITY,
    ),
    "upsert_matching_keys": with_ctes(
        "select distinct date from target where date in (select date from fresh)", **UPSERT_DATE
    ),
    "upsert_matches": with_ctes(
        "select count(*) as matched from target t where exists (select 1 from fresh n "
        "where t.account_id = n.account_id and t.ad_id = n.ad_id)",
        **UPSERT_ENTITY,
    ),
    "worklist_ads": with_ctes(REQUESTED_ADS),
    "worklist_campaigns": with_ctes("select distinct campaign_id from fx_campaign_insights"),
    "worklist_adsets": with_ctes(
        "select distinct adset_id from fx_ad_metadata where adset_id is not null"
    ),
    "worklist_campaigns_from_ads": with_ctes(
        "select distinct campaign_id from fx_ad_metadata where campaign_id is not null"
    ),
    "entity_fetch_ads": with_ctes(
        """select ad_id, a.ad_name, a.adset_id, a.campaign_id, a.status from requested
          left join answered a using (ad_id)""",
        requested=REQUESTED_ADS, answered=GOOD_ADS,
    ),
    "entity_fetch_adsets": with_ctes(
        """select q.adset_id, s.adset_name, s.campaign_id, s.account_id, s.account_name
          from (select distinct adset_id from fx_ad_insights where adset_id is not null) q
          left join fx_adset_metadata s using (adset_id)"""
    ),
    "entity_fetch_campaigns": with_ctes(
        """select q.campaign_id, c.campaign_name, c.status, c.account_id, c.account_name
          from (select distinct campaign_id from fx_campaign_insights where campaign_id is not null) q
          left join fx_campaign_metadata c using (campaign_id)"""
    ),
    "creative_fetch": with_ctes(
        """select q.ad_id, c.creative_id, c.thumbnail_url from requested q
          left join fx_ad_creative c using (ad_id)""",
        requested=REQUESTED_ADS,
    ),
    "fetch_in_attempts": with_ctes(
        ADS_IN_ATTEMPTS, requested=REQUESTED_ADS, answered=ANSWERED_ADS
    ),
    "attempts_union": with_ctes(
        """select r.ad_id, case when a.attempt = r.n then a.ad_name end as ad_name,
            case when a.attempt = r.n then a.status end as status
          from (select ad_id, unnest(generate_series(1, 4)) as n from requested) r
            left join answered a using (ad_id)
          where a.attempt is null or a.attempt >= r.n""",
        requested=REQUESTED_ADS, answered=ANSWERED_ADS,
    ),
    "failed_ids": with_ctes(
        "select ad_id from requested where ad_id not in (select ad_id from answered)",
        requested=REQUESTED_ADS, answered=ANSWERED_ADS,
    ),
    "coverage": with_ctes(
        """select count(*) as requested, count(a.ad_id) as received from requested
          left join (select distinct ad_id from answered) a using (ad_id)""",
        requested=REQUESTED_ADS, answered=ANSWERED_ADS,
    ),
    "calendar": with_ctes(
        """select account_id, cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as date
          from (select account_id, min(date) as lo, max(date) as hi from facts
            where date is not null group by account_id)""",
        facts=SHARDED_CAMPAIGN,
    ),
    "missing_days": with_ctes(
        """select account_id, date from (
            select account_id, cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as date
            from (select account_id, min(date) as lo, max(date) as hi from facts
              where date is not null group by account_id)) c
          where not exists (select 1 from facts f
            where f.account_id = c.account_id and f.date = c.date)""",
        facts=SHARDED_CAMPAIGN,
    ),
    "range_modes": with_ctes(
        " union all ".join(
            f"select '{mode}' as mode, campaign_id, date from facts "
            f"where date between date '{lo}' and date '{hi}'"
            for mode, (lo, hi) in RANGE_MODES.items()
        ),
        facts=SHARDED_CAMPAIGN,
    ),
    "error_class": with_ctes(
        """select request_id, http_status, error_code,
          case when error_code = 190 then 'token'
            when http_status >= 500 or error_code in (1, 2, 4, 17, 80000) then 'retryable'
            else 'fatal' end as class
          from fx_responses"""
    ),
    "load_insert": with_ctes("select * from facts union all select * from facts", facts=SHARDED_CAMPAIGN),
    "load_upsert_facts": with_ctes(upserted("target", "fresh", "date"), **PAST_FACTS),
    "load_upsert_entities": with_ctes(
        "select 'mkt' as department, 'main' as account, * from ("
        + upserted("target", "fresh", "account_id", "ad_id") + ")",
        **UPSERT_ENTITY,
    ),
    "load_upsert_unpartitioned": with_ctes(
        upserted("target", "fresh", "account_id", "ad_id"), **UPSERT_ENTITY
    ),
    "load_audit": with_ctes(
        """select (select count(*) from fresh) as rows_in,
          (select count(*) from target where date in (select date from fresh)) as rows_deleted,
          (select count(*) from fresh) as rows_written""",
        **PAST_FACTS,
    ),
    "pipeline_campaign": with_ctes(
        in_mart_order("campaign", mart("campaign", campaign="campaigns")), **PIPELINE_CAMPAIGN
    ),
    "pipeline_ad": with_ctes(
        in_mart_order(
            "ad", mart("ad", ad="ad_rows", campaign="campaigns", adset="adsets", creative="creatives")
        ),
        **PIPELINE_AD,
    ),
    "pipeline_campaign_rerun": with_ctes(
        in_mart_order("campaign", mart("campaign", campaign="campaigns")), **PIPELINE_CAMPAIGN_RERUN
    ),
    "pipeline_ad_rerun": with_ctes(
        in_mart_order(
            "ad", mart("ad", ad="ad_rows", campaign="campaigns", adset="adsets", creative="creatives")
        ),
        **PIPELINE_AD_RERUN,
    ),
    "backfill_ad": with_ctes(
        in_mart_order(
            "ad", mart("ad", ad="ad_rows", campaign="campaigns", adset="adsets", creative="creatives")
        ),
        **BACKFILL_AD,
    ),
    "run_both": with_ctes(
        """select 'ad_insights' as pipeline, * from counted
          union all select 'campaign_insights', item, a, b from counted
            where item in ('campaign_metadata', 'campaigns')
          union all select 'campaign_insights', 'campaign_insights', count(*), count(*) from campaign_rows""",
        **RUN_BOTH,
    ),
    "load_audit_paths": with_ctes(
        """select path, (select count(*) from fresh) as rows_in,
            (select count(*) from target t where exists (select 1 from fresh n
              where t.account_id = n.account_id and t.ad_id = n.ad_id)) as rows_deleted,
            (select count(*) from fresh) as rows_written
          from (values ('partitions'), ('table')) p(path)""",
        **UPSERT_ENTITY,
    ),
    "retry_queue": with_ctes(
        """select ad_id, 'asked' as kind, 1 as attempts, class, first_try as next_try from failed
            where class = 'retryable'
          union all select ad_id, 'left', 2, class, second_try from failed
            where class = 'retryable' and cast(ad_id as bigint) % 3 = 0
          union all select ad_id, 'left', 1, class, null from failed where class <> 'retryable'""",
        requested=REQUESTED_ADS,
        failed="""select ad_id, any_value(class) as class,
            epoch(timestamp '1998-03-01 06:01:00')::bigint as first_try,
            epoch(timestamp '1998-03-01 06:11:30')::bigint as second_try
          from (select request_id as ad_id, case when error_code = 190 then 'token'
              when http_status >= 500 or error_code in (1, 2, 4, 17, 80000) then 'retryable'
              else 'fatal' end as class
            from fx_responses where error_code is not null or http_status >= 400)
          where ad_id in (select ad_id from requested) group by ad_id""",
    ),
}
