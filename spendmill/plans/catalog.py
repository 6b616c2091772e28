"""All report specifications by table name."""

from __future__ import annotations

from spendmill.plans import google_reports, meta_reports
from spendmill.plans.action_breakdown import ACTIONS
from spendmill.plans.spec import ReportSpec

FACTS: dict[str, ReportSpec] = {s.table: s for s in (*google_reports.FACTS, *meta_reports.FACTS)}
DIMENSIONS: dict[str, ReportSpec] = {s.table: s for s in (*google_reports.DIMENSIONS, *meta_reports.DIMENSIONS)}
REPORTS: dict[str, ReportSpec] = {**FACTS, **DIMENSIONS}
# Reports beside the usual ones, loaded when they are named, and the report whose landed rows they read.
OPTIONAL = {ACTIONS.table: ACTIONS}
LANDED_AS = {ACTIONS.table: "meta_ads_performance"}
