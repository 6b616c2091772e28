"""Results of ads by action type: the nested lists of the insights as a long table.

`conversions` and `conversion_value` of the daily reports add up all action types. Here every (row, action type) is a row of its
own, with the number of actions and their value; an insight without any action keeps one row without a type, so that a day on
which the last action was retracted is replaced like any other. The sum per ad and day equals that of `meta_ads_performance`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendmill import functions as fn
from spendmill.plans.meta_reports import CURRENCY, WHO
from spendmill.plans.spec import Field, ReportSpec, Rule, strict_day

_LIST = "array<struct<action_type: string, value: string>>"
LISTS = (("actions", _LIST), ("action_values", _LIST))
_TYPE, _OWN = "_action_type", "_own_{}"


def _entries(name: str) -> Column:
    return F.coalesce(F.col(name), F.array().cast(_LIST))


def by_action_type(insights: DataFrame) -> DataFrame:
    """One row per insight and action type of either list, with that type's entries of both.

    A row is taken apart where it stands: no shuffle, whatever the number of its types.
    """
    types = F.array_distinct(F.transform(F.concat(*[_entries(name) for name, _ in LISTS]), lambda e: e["action_type"]))
    long = insights.withColumn(_TYPE, F.explode_outer(types))
    return long.withColumns(
        {
            _OWN.format(name): F.filter(_entries(name), lambda e: e["action_type"].eqNullSafe(F.col(_TYPE)))
            for name, _ in LISTS
        }
    )


def _total(name: str, source: str) -> Field:
    bad = Rule(lambda: fn.bad_list_values(source), f"{source} holds a value that is no number")
    return Field(name, "double", lambda: fn.list_total(_OWN.format(source)), (), (bad,))


ACTIONS = ReportSpec(
    "meta_ads_actions",
    "meta",
    (
        strict_day("date", "date_start"),
        *WHO,
        Field("action_type", "string", lambda: F.col(_TYPE), ()),
        _total("conversions", "actions"),
        _total("conversion_value", "action_values"),
        *CURRENCY,
    ),
    cluster_by=("account_id", "campaign_id", "action_type"),
    chunked=True,
    unnest=by_action_type,
    unnest_reads=LISTS,
)
