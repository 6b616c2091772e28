"""Small landed fixtures."""

from __future__ import annotations

import json
from datetime import date

from spendmill.plans.spec import INGESTED_AT
from spendmill.sources import GOOGLE_ACCOUNT_DDL, META_ACCOUNT_DDL, google_accounts, meta_accounts, read_landed


def land(spark, spec, rows, folder):
    """Write rows as JSON lines and scan them the way a load does."""
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / "part.json"
    path.write_text("".join(json.dumps(row) + "\n" for row in rows))
    return read_landed(spark, spec, str(folder))


def geo_row(account, day, n=1, campaign=7, **metrics):
    values = {
        "impressions": 10,
        "clicks": 2,
        "ctr": 0.2,
        "average_cpc": {"micros": 1_500_000},
        "cost_micros": 3_000_000,
        "conversions": 1.0,
        "conversions_value": 9.5,
        "all_conversions": 1.0,
        "view_through_conversions": 0,
    }
    values.update(metrics)
    return {
        "segments": {"date": day},
        "customer": {"id": int(account), "descriptive_name": f"Account {account}", "currency_code": "EUR"},
        "campaign": {"id": campaign, "name": "C", "status": "ENABLED", "bidding_strategy_type": "TARGET_CPA"},
        "ad_group": {"id": 70, "name": "G"},
        "geographic_view": {"country_criterion_id": 2000 + n, "location_type": "AREA_OF_INTEREST"},
        "metrics": {name: value for name, value in values.items() if value is not None},
        "requested_account": str(account),
        "account_ord": int(account),
        "row_ord": n,
    }


def insight(account, day, n=1, **values):
    row = {
        "date_start": day,
        "account_id": str(account),
        "account_name": f"Account {account}",
        "campaign_id": "c",
        "campaign_name": "C",
        "adset_id": "s",
        "adset_name": "S",
        "ad_id": f"a{n}",
        "ad_name": "A",
        "impressions": "10",
        "clicks": "2",
        "spend": "1.5",
        "ctr": "20.0",
        "cpc": "0.75",
        "cpm": "150",
        "reach": "9",
        "frequency": "1.1",
        "actions": [{"action_type": "purchase", "value": "2"}, {"action_type": "lead", "value": "0.5"}],
        "action_values": [{"action_type": "purchase", "value": "40.25"}],
        "requested_account": f"act_{account}",
        "account_ord": int(account),
        "row_ord": n,
    }
    row.update(values)
    return {name: value for name, value in row.items() if value is not None}


def google_listing(spark, *accounts):
    rows = [(int(a), f"Account {a}", "ENABLED", False, int(a)) for a in accounts]
    return google_accounts(spark.createDataFrame(rows, GOOGLE_ACCOUNT_DDL))


def meta_listing(spark, *accounts):
    rows = [(f"act_{a}", f"Account {a}", "EUR", int(a)) for a in accounts]
    return meta_accounts(spark.createDataFrame(rows, META_ACCOUNT_DDL))


def content(store, spec):
    """Table rows without the ingest time, sorted."""
    return sorted((tuple(r) for r in store.read(spec).drop(INGESTED_AT).collect()), key=repr)


def day(text):
    return date.fromisoformat(text)
