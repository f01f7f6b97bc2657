"""Small text rules: coded names, status icons, account ids, response classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Delimiter of coded names and the 0-based part each column takes.
CAMPAIGN_DELIMITER = "_"
CAMPAIGN_PART_INDEX = {
    "objective": 0,
    "region": 1,
    "budget_group_1": 2,
    "budget_group_2": 3,
    "category_level_1": 4,
    "personnel": 5,
    "track_group": 7,
    "pillar_group": 8,
    "content_group": 9,
}
ADSET_DELIMITER = r"\|"
ADSET_PART_INDEX = {
    "location": 0,
    "gender": 1,
    "age": 2,
    "audience": 3,
    "format": 4,
    "strategy": 5,
    "type": 6,
    "pillar": 7,
    "content": 8,
}
MISSING_PART = "unknown"
PLATFORM = "Facebook"

# Status icons.
STATUS_ICONS = {"ACTIVE": "🟢", "PAUSED": "⚪", "ARCHIVED": "🔴", "DELETED": "🔴"}
OTHER_STATUS_ICON = "❓"

# Prefix of account ids, and how the service's errors are classed.
ACCOUNT_PREFIX = "act_"
TOKEN_ERROR_CODE = 190
RETRYABLE_ERROR_CODES = (1, 2, 4, 17, 80000)
SERVER_ERROR_FROM = 500


def name_parts(name: Column, delimiter: str) -> Column:
    """Parts of a coded name. A null name has one empty part; empty parts are kept."""
    return F.split(F.coalesce(name, F.lit("")), delimiter, -1)


def part_or_unknown(parts: Column, index: int) -> Column:
    return F.coalesce(F.get(parts, F.lit(index)), F.lit(MISSING_PART))


def status_icon(status: Column) -> Column:
    icon = F
    for name, symbol in STATUS_ICONS.items():
        icon = icon.when(status == name, F.lit(symbol))
    return icon.otherwise(F.lit(OTHER_STATUS_ICON))


def bare_account_id(account_id: Column) -> Column:
    """The id without its prefix: sources disagree on it, and joins need one form."""
    prefixed = account_id.startswith(ACCOUNT_PREFIX)
    return F.when(prefixed, F.substring(account_id, len(ACCOUNT_PREFIX) + 1, F.length(account_id))).otherwise(account_id)


def error_class(http_status: Column, error_code: Column) -> Column:
    """``token``, ``retryable`` or ``fatal`` for a failed response."""
    return (
        F.when(error_code == TOKEN_ERROR_CODE, "token")
        .when((http_status >= SERVER_ERROR_FROM) | error_code.isin(*RETRYABLE_ERROR_CODES), "retryable")
        .otherwise("fatal")
    )
