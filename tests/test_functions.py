"""Column expressions on small literal cases."""

import json
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from adloom.functions.dates import MODES, date_range, days_between, explicit_range, to_day
from adloom.functions.names import bare_account_id, error_class, status_icon
from adloom.functions.numbers import count_or_zero, number_or_zero
from adloom.operators.insights import transform_insights, with_actions
from adloom.operators.metadata import transform_adset_metadata, transform_campaign_metadata
from adloom.schemas import INSIGHT_FIELDS


def one_column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def insights(spark, level, *rows):
    """Raw rows given as dicts over fixed defaults."""
    base = dict.fromkeys(INSIGHT_FIELDS[level], None) | {
        "account_id": "1", "campaign_id": "c", "spend": "1.5", "impressions": "200", "clicks": "3",
        "date_start": "2024-02-29", "date_stop": "2024-02-29",
    }
    data = [tuple((base | row)[name] for name in base) for row in rows]
    return spark.createDataFrame(data, ", ".join(f"{name} string" for name in base))


def results(spark, level, *rows):
    facts = transform_insights(insights(spark, level, *rows), level)
    return [(r.result, r.result_type) for r in facts.select("result", "result_type").collect()]


NUMBERS = {
    "7": 7.0, " 7 ": 7.0, "1e3": 1000.0, "5.7": 5.7, "-2.5": -2.5, "+3": 3.0, "1.": 1.0, ".5": 0.5,
    "": 0.0, "abc": 0.0, "5d": 0.0, "5f": 0.0, "0x10": 0.0, "0x1p3": 0.0, "1_000": 0.0, "1e": 0.0,
    "NaN": 0.0, "Infinity": 0.0, "1 2": 0.0, None: 0.0,
}


def test_numbers(spark):
    assert one_column(spark, list(NUMBERS), number_or_zero) == list(NUMBERS.values())


def test_counts_truncate_toward_zero(spark):
    texts = ["3.9", "-3.9", "1e3", " 12 ", "9223372036854775807", "1e30", "bad", None]
    assert one_column(spark, texts, count_or_zero) == [3, -3, 1000, 12, 2**63 - 1, 0, 0, 0]


def test_numbers_accept_numeric_columns(spark):
    assert one_column(spark, [1.5, 2e9, None], number_or_zero, "double") == [1.5, 2e9, 0.0]


ACTION_TEXTS = {
    None: [],
    "": [],
    "None": [],
    "null": [],
    "NULL": [],
    "[]": [],
    " [ ] ": [],
    '{"action_type": "like", "value": "1"}': [],
    "not json": [],
    "[{'action_type': 'like', 'value': '3'}]": [("like", "3")],
    '[{"action_type": "like", "value": 3}]': [("like", "3")],
    '[{"action_type": "like"}, 7, null, "x", [1], {"action_type": "lead", "value": 4}]': [
        ("like", None), ("lead", "4"),
    ],
    '["{\\"action_type\\": \\"like\\", \\"value\\": 1}", {"action_type": "lead", "value": 2}]': [
        ("lead", "2"),
    ],
    '[{"action_type": "a", "action_type": "b", "value": 1}]': [("b", "1")],
    '[{"action_type": "a", "action_type": "b", "value": 1}, 7]': [("b", "1")],
    '[{"action_type": "it\'s", "value": 1}]': [],
    '[{"action_type": "a", "value": 1}, {bad}]': [],
    '[{"action_type": "a", "value": 1}': [],
    "[] x": [],
    "[{'action_type': 'a', 'value': None}]": [],
    "[[{\"action_type\": \"a\"}]]": [],
}


def test_parse_actions(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ACTION_TEXTS)], "i int, actions string")
    parsed = with_actions(df).orderBy("i").collect()
    found = [[tuple(a) for a in r.actions if a and a.action_type is not None] for r in parsed]
    assert found == list(ACTION_TEXTS.values())


def test_parse_actions_takes_arrays(spark):
    df = spark.createDataFrame(
        [([{"value": 2.0, "action_type": "like"}],), (None,)],
        "actions array<struct<value: double, action_type: string>>",
    )
    assert [[tuple(a) for a in r.actions] for r in with_actions(df).collect()] == [
        [("like", "2.0")], [],
    ]


def test_parse_actions_like_a_json_reader(spark):
    """Random lists, some with damage, against Python's own JSON reader."""
    rng = random.Random(7)
    values = ["1", "2.5", "x", None, 3, 4.5, True, {"n": 1}, [1]]

    def element():
        if rng.random() < 0.2:
            return rng.choice([1, "s", None, [], {"other": 1}])
        return {"action_type": rng.choice("abc"), "value": rng.choice(values)}

    texts = []
    for _ in range(400):
        text = json.dumps([element() for _ in range(rng.randrange(5))])
        if rng.random() < 0.2:
            cut = rng.randrange(len(text))
            text = text[:cut] + rng.choice(["", "}", "'", ","]) + text[cut + 1 :]
        texts.append(text)

    def expected(text):
        try:
            return [e["action_type"] for e in json.loads(text.replace("'", '"'))
                    if isinstance(e, dict) and e.get("action_type") is not None]
        except ValueError:
            return []

    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, actions string")
    parsed = with_actions(df).orderBy("i").collect()
    found = [[a.action_type for a in r.actions if a and a.action_type is not None] for r in parsed]
    assert found == [expected(t) for t in texts]


@pytest.mark.parametrize(
    ("goal", "actions", "result"),
    [
        ("PAGE_LIKES", "[{'action_type': 'like', 'value': '3'}]", (3.0, "follows_or_likes")),
        ("PAGE_LIKES", '[{"action_type": "like", "value": "it\'s"}]', (0.0, "unknown")),
        ("PAGE_LIKES", '{"action_type":"like"}', (0.0, "unknown")),
        (
            "LINK_CLICKS",
            '[{"action_type": "link_click", "value": "abc"}, {"action_type": "lead", "value": 2}]',
            (0.0, "link_click"),
        ),
        ("LINK_CLICKS", '[{"action_type": "link_click"}]', (0.0, "link_click")),
        (
            "VIDEO_VIEWS",
            '[{"action_type": "lead", "value": 4}, '
            '{"action_type": "onsite_conversion.lead_grouped", "value": 5}]',
            (5.0, "onsite_conversion.lead_grouped"),
        ),
        (None, '[{"action_type": "lead", "value": 4}]', (4.0, "lead")),
        ("NOT_A_GOAL", '[{"action_type": "lead", "value": 4}]', (4.0, "lead")),
        ("NOT_A_GOAL", '[{"action_type": "like", "value": 4}]', (0.0, "unknown")),
        (
            "CONVERSIONS",
            '[{"action_type": "purchase", "value": 2}, {"action_type": "purchase", "value": 3.9}]',
            (2.0, "purchase"),
        ),
        ("IMPRESSIONS", '[{"action_type": "impressions", "value": 9}]', (200.0, "impressions")),
    ],
)
@pytest.mark.parametrize("level", ["ad", "campaign"])
def test_result(spark, level, goal, actions, result):
    assert results(spark, level, {"optimization_goal": goal, "actions": actions}) == [result]


def test_reach_label_differs_by_level(spark):
    row = {"optimization_goal": "REACH", "actions": '[{"action_type": "reach", "value": 9}]'}
    assert results(spark, "ad", row) == [(200.0, "reach")]
    assert results(spark, "campaign", row) == [(200.0, "impressions")]
    assert results(spark, "ad", row | {"impressions": "bad"}) == [(0.0, "reach")]


def test_metrics_take_the_last_match(spark):
    purchases = ['[{"action_type": "purchase", "value": 2}, {"action_type": "purchase", "value": %s}]' % v
                 for v in ("3.9", '"bad"', "-1.9")]
    message = (
        '[{"action_type": "onsite_conversion.messaging_conversation_started_7d", "value": "8"}]'
    )
    df = insights(spark, "ad", *({"actions": a} for a in [*purchases, message, None]))
    facts = transform_insights(df, "ad").select("purchase", "messaging_conversations_started")
    assert [tuple(r) for r in facts.collect()] == [(3, 0), (0, 0), (-1, 0), (0, 8), (0, 0)]


def test_transform_shape_and_dates(spark):
    df = insights(
        spark, "ad", {"ad_id": "a"}, {"date_start": "2024-02-30"}, {"date_start": None},
        {"date_start": "2024-2-1"}, {"date_start": "2024-02-01T00"},
    )
    facts = transform_insights(df, "ad")
    assert dict(facts.dtypes) == {
        "account_id": "string", "campaign_id": "string", "ad_id": "string", "adset_id": "string",
        "spend": "double", "impressions": "bigint", "clicks": "bigint", "result": "double",
        "result_type": "string", "messaging_conversations_started": "bigint", "purchase": "bigint",
        "date": "date", "year": "int", "month": "string",
    }
    dates = [tuple(r) for r in facts.select("date", "year", "month").collect()]
    assert dates == [(date(2024, 2, 29), 2024, "2024-02")] + [(None, None, None)] * 4


def test_transform_needs_its_columns(spark):
    df = insights(spark, "ad", {})
    for name in ("date_start", "date_stop", "actions"):
        with pytest.raises(ValueError, match=name):
            transform_insights(df.drop(name), "ad")
    assert transform_insights(df.drop("clicks"), "ad").count() == 1
    assert transform_insights(df.where("false"), "ad").count() == 0


def test_campaign_parts(spark):
    names = [None, "", "a_b_", "O_R_B1_B2_C_P_skip_T_PI_CO_extra"]
    df = spark.createDataFrame(
        [("1", str(i), n) for i, n in enumerate(names)],
        "account_id string, campaign_id string, campaign_name string",
    )
    out = transform_campaign_metadata(df).orderBy("campaign_id").drop("account_id", "campaign_id", "campaign_name")
    unknown = ("unknown",) * 6
    assert [tuple(r) for r in out.collect()] == [
        ("Facebook", "", "unknown", "unknown", *unknown),
        ("Facebook", "", "unknown", "unknown", *unknown),
        ("Facebook", "a", "b", "", *unknown),
        ("Facebook", "O", "R", "B1", "B2", "C", "P", "T", "PI", "CO"),
    ]
    with pytest.raises(ValueError, match="campaign_name"):
        transform_campaign_metadata(df.drop("campaign_name"))


def test_adset_parts(spark):
    df = spark.createDataFrame(
        [("1", "x", "L|F||AUD")], "account_id string, adset_id string, adset_name string"
    )
    row = transform_adset_metadata(df).first()
    assert (row.location, row.gender, row.age, row.audience, row.content) == (
        "L", "F", "", "AUD", "unknown",
    )
    with pytest.raises(ValueError, match="adset_id"):
        transform_adset_metadata(df.drop("adset_id"))


def test_small_text_rules(spark):
    statuses = ["ACTIVE", "PAUSED", "ARCHIVED", "DELETED", "IN_REVIEW", None]
    assert one_column(spark, statuses, status_icon) == ["🟢", "⚪", "🔴", "🔴", "❓", "❓"]
    ids = ["act_12", "12", "act_act_1", "xact_1", "", None]
    assert one_column(spark, ids, bare_account_id) == ["12", "12", "act_1", "xact_1", "", None]


def test_error_class(spark):
    cases = [(400, 190), (500, None), (None, 17), (400, 100), (None, None), (503, 190), (400, 80000)]
    df = spark.createDataFrame(cases, "status int, code int")
    found = [r[0] for r in df.select(error_class(F.col("status"), F.col("code"))).collect()]
    assert found == ["token", "retryable", "retryable", "fatal", "fatal", "token", "retryable"]


def test_date_ranges():
    day = date(2024, 3, 1)
    assert {m: date_range(m, day) for m in MODES} == {
        "today": (day, day),
        "last3days": (date(2024, 2, 27), date(2024, 2, 29)),
        "last7days": (date(2024, 2, 23), date(2024, 2, 29)),
        "thismonth": (day, day),
        "lastmonth": (date(2024, 2, 1), date(2024, 2, 29)),
    }
    assert date_range("lastmonth", date(2024, 1, 15)) == (date(2023, 12, 1), date(2023, 12, 31))
    with pytest.raises(ValueError):
        date_range("last5days", day)
    assert explicit_range("2024-01-05", "2024-01-05") == (date(2024, 1, 5), date(2024, 1, 5))
    for pair in (("2024-01-06", "2024-01-05"), ("2024-13-01", "2024-12-01"), ("x", "2024-01-01")):
        with pytest.raises(ValueError):
            explicit_range(*pair)


def test_days_between(spark):
    df = spark.sql("select date '2024-02-28' as lo, date '2024-03-01' as hi")
    days = [r[0].day for r in df.select(days_between(F.col("lo"), F.col("hi"))).collect()]
    assert days == [28, 29, 1]
    assert one_column(spark, ["2024-01-01\n"], to_day) == [None]


def test_list_text_is_made_once_for_all_readings(spark):
    df = spark.createDataFrame([("[{'action_type': 'lead', 'value': '1'}, 7]",)], "actions string")
    parsed = with_actions(df)
    assert [tuple(a) for a in parsed.first().actions] == [("lead", "1"), (None, None)]
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("replace(") == 1 and plan.count("try_variant_get(") == 1


def test_odd_members_and_ends_of_lists(spark):
    cases = {
        ' \t[{"action_type": "a", "value": 1.50}]\n\r': [("a", "1.5")],
        '[7, {"value": {"x": [1, null]}, "action_type": true}]': [(None, None), ("true", '{"x":[1,null]}')],
        '[null, [{"value": 1}], {"Value": 2}, {"value": "q"}]': [(None, None)] * 3 + [(None, "q")],
        '[7, {"value": 1, "value": 2}]': [(None, None), (None, "2")],
        '[{"value": 1}]\u0085': [],
        "[": [],
        "]": [],
    }
    df = spark.createDataFrame(list(enumerate(cases)), "i int, actions string")
    parsed = with_actions(df).orderBy("i").collect()
    assert [[tuple(a) for a in r.actions] for r in parsed] == list(cases.values())
