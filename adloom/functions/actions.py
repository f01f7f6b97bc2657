"""The nested action list: parsing it, and reading one result or metric out of it.

Lookups are array positions over ``actions.action_type`` rather than lambdas, so
everything after the JSON parse stays inside whole-stage code generation.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Optimisation goal -> action type that counts as its result.
GOAL_ACTIONS = {
    "REACH": "reach",
    "IMPRESSIONS": "impressions",
    "AD_RECALL_LIFT": "estimated_ad_recall_lift",
    "LANDING_PAGE_VIEWS": "landing_page_view",
    "LINK_CLICKS": "link_click",
    "PAGE_LIKES": "like",
    "VIDEO_VIEWS": "video_view",
    "POST_ENGAGEMENT": "post_engagement",
    "ENGAGED_USERS": "post_engagement",
    "MESSAGES": "onsite_conversion.messaging_conversation_started_7d",
    "REPLIES": "onsite_conversion.messaging_conversation_started_7d",
    "MESSAGING_CONVERSATIONS_REPLIES": "onsite_conversion.messaging_conversation_started_7d",
    "LEAD_GENERATION": "lead",
    "THRUPLAY": "video_view",
    "APP_INSTALLS": "mobile_app_install",
    "OFFSITE_CONVERSIONS": "purchase",
    "CONVERSIONS": "purchase",
    "VALUE": "value",
    "QUALITY_LEAD": "lead",
}
# Action types and labels with a meaning of their own.
MESSAGING = "onsite_conversion.messaging_conversation_started_7d"
PURCHASE = "purchase"
FALLBACKS = ("onsite_conversion.lead_grouped", "lead")
LIKE, LIKE_LABEL = "like", "follows_or_likes"
DELIVERY = ("reach", "impressions")
UNKNOWN = "unknown"

ACTION_STRUCT = "struct<action_type:string,value:string>"
JSON_BLANKS = " \t\n\r"


def list_text(actions: Column) -> Column:
    """Text of a JSON list with single quotes made double ones, null for any other text."""
    bare = F.when(_in_brackets(actions), actions).otherwise(F.btrim(actions, F.lit(JSON_BLANKS)))
    return F.when(_in_brackets(bare), F.replace(bare, F.lit("'"), F.lit('"')))


def _in_brackets(text: Column) -> Column:
    return text.startswith("[") & text.endswith("]")


def parse_list(text: Column) -> Column:
    """Array of (action_type, value) of a ``list_text``; empty where there is none.

    Three readings, each tried only where the one before gave nothing: a list of objects;
    a list with other things among the objects, which become nulls; the same with a key
    repeated inside an object, where the last one counts. ``text`` should be a plain
    column: each reading would work it out again.
    """
    empty = F.array().cast(f"array<{ACTION_STRUCT}>")
    # one variant for the whole list, taken apart in one pass
    mixed = F.transform(
        F.try_variant_get(F.from_json(text, "variant"), "$", f"array<{ACTION_STRUCT}>"),
        lambda item: F.struct(
            item["action_type"].alias("action_type"), item["value"].alias("value")
        ),
    )
    repeated = F.transform(
        F.from_json(text, "array<string>"),
        lambda item: F.from_json(item, ACTION_STRUCT),
    )
    return F.coalesce(
        F.when(
            text.isNotNull(),
            F.coalesce(F.from_json(text, f"array<{ACTION_STRUCT}>"), mixed, repeated),
        ),
        empty,
    )


def parse_actions(actions: Column, dtype: T.DataType) -> Column:
    """Array of (action_type, value); empty where the input is no list.

    An array column is only cast; text is read as JSON.
    """
    if isinstance(dtype, T.ArrayType):
        return F.coalesce(
            F.arrays_zip(
                actions["action_type"].alias("action_type"),
                actions["value"].cast("array<string>").alias("value"),
            ).cast(f"array<{ACTION_STRUCT}>"),
            F.array().cast(f"array<{ACTION_STRUCT}>"),
        )
    if not isinstance(dtype, T.StringType):
        return F.array().cast(f"array<{ACTION_STRUCT}>")
    return parse_list(list_text(actions))


def goal_action(goal: Column) -> Column:
    """Action type mapped to a goal, null where the goal is unknown."""
    mapping = F.create_map(*(F.lit(part) for part in chain.from_iterable(GOAL_ACTIONS.items())))
    return F.try_element_at(mapping, goal)


def _first(actions: Column, wanted: Column) -> Column:
    """1-based position of the first action of a type, null where there is none."""
    return F.nullif(F.array_position(actions["action_type"], wanted), F.lit(0)).cast("int")


def result_position(actions: Column, target: Column) -> Column:
    """Where the action that decides the result stands in the list.

    The goal's own action comes first, then the lead fallbacks. It is the action
    that is matched, not its value: a match with an unreadable value ends the search.
    """
    return F.coalesce(
        _first(actions, target),
        *(_first(actions, F.lit(name)) for name in FALLBACKS),
    )


def result_text(actions: Column, target: Column, position: Column, impressions: Column) -> Column:
    """Text of the result: impressions for a delivery goal, else the matched action's value."""
    return F.when(target.isin(*DELIVERY), impressions).otherwise(
        F.get(actions["value"], position - 1)
    )


def result_label(
    actions: Column, target: Column, position: Column, reach_label: str
) -> Column:
    """Label of the result; ``reach_label`` is what a reach goal is called at this level."""
    matched = F.get(actions["action_type"], position - 1)
    return (
        F.when(target == "reach", F.lit(reach_label))
        .when(target == "impressions", target)
        .when(matched == LIKE, F.lit(LIKE_LABEL))
        .otherwise(F.coalesce(matched, F.lit(UNKNOWN)))
    )


def last_action_text(actions: Column, name: str) -> Column:
    """Value of the last action of a type, null where there is none."""
    from_end = F.nullif(
        F.array_position(F.reverse(actions["action_type"]), F.lit(name)), F.lit(0)
    ).cast("int")
    return F.get(actions["value"], F.size(actions) - from_end)
