"""Responses as the platforms send them: text integers, zeros left out, camel case, lines that cannot be read."""

import json

import pytest

from spendmill.plans.catalog import FACTS
from spendmill.plans.loads import LoadFailed, flatten_report, load_fact
from spendmill.plans.spec import UNREADABLE, VIOLATION
from spendmill.plans.store import Run
from spendmill.sources import read_wire
from spendmill.sources.wire import camel_case
from tests.helpers import geo_row, google_listing, insight, land, meta_listing
from tests.test_loads import RUN, costs, load

GEO, KEYWORDS, SCHEDULE, INSIGHTS = (
    FACTS[n] for n in ("google_ads_geo", "google_ads_keywords", "google_ads_schedule", "meta_ads_performance")
)
LANDING = ("requested_account", "account_ord", "row_ord")


def sent(value, camel=False, top=True):
    """What the platform would send: whole numbers as text, zeros and empty messages left out."""
    if isinstance(value, dict):
        members = {
            (camel_case(k) if camel and not (top and k in LANDING) else k): v if top and k in LANDING else sent(v, camel, False)
            for k, v in value.items()
        }
        return {k: v for k, v in members.items() if v not in (None, 0, 0.0, {})} or None
    return str(value) if isinstance(value, int) and value else value


def wire(spark, spec, lines, folder, **options):
    folder.mkdir(parents=True)
    (folder / "part.json").write_text("".join((x if isinstance(x, str) else json.dumps(x)) + "\n" for x in lines))
    return read_wire(spark, spec, str(folder), **options)


def flat(spark, spec, landed, *accounts):
    listing = google_listing if spec.platform == "google" else meta_listing
    return sorted((tuple(r) for r in flatten_report(spec, landed, listing(spark, *accounts)).collect()), key=repr)


@pytest.mark.parametrize("camel", [False, True])
def test_wire_form_equals_the_spelled_out_one(spark, tmp_path, camel):
    nothing = {name: 0 for name in ("impressions", "clicks", "cost_micros", "view_through_conversions")}
    nothing.update({name: 0.0 for name in ("ctr", "conversions", "conversions_value", "all_conversions")})
    rows = [
        geo_row(1, "2024-01-05", 1),
        geo_row(1, "2024-01-05", 2, clicks=0, ctr=0.0),
        geo_row(2, "2024-01-06", 3, **nothing, average_cpc=None),  # no `metrics` at all
        geo_row(2, "2024-01-06", 4, cost_micros=2**53 + 1),
        geo_row(2, "bad", 5),
    ]
    spelled = flat(spark, GEO, land(spark, GEO, rows, tmp_path / "a"), 1, 2)
    lines = [sent(row, camel) for row in rows]
    lines[2].pop("metrics", None)
    assert flat(spark, GEO, wire(spark, GEO, lines, tmp_path / "b", camel=camel), 1, 2) == spelled
    assert len(spelled) == 5


def test_unset_flags_hours_and_amounts(spark, tmp_path):
    row = geo_row(1, "2024-01-05")
    row["metrics"]["average_cpc"] = {}
    got = wire(spark, SCHEDULE, [row], tmp_path / "w").first()
    assert got.segments.hour == 0 and got.metrics.average_cpc.micros == 0 and got[UNREADABLE] is None
    row = {"user_location_view": {}, "campaign": {}}
    got = wire(spark, FACTS["google_ads_user_location"], [row], tmp_path / "x").first()
    assert got.user_location_view.targeting_location is False and got.campaign.id is None
    assert got.metrics.average_cpc is None and got.metrics.clicks == 0


def test_social_rows_are_read_as_they_are(spark, tmp_path):
    rows = [insight(1, "2024-01-05"), insight(1, "2024-01-06", 2, clicks=None, actions=None)]
    spelled = flat(spark, INSIGHTS, land(spark, INSIGHTS, rows, tmp_path / "a"), 1)
    assert flat(spark, INSIGHTS, wire(spark, INSIGHTS, rows, tmp_path / "b"), 1) == spelled


@pytest.mark.parametrize(
    "change, message",
    [
        ({"metrics": {"clicks": "2.5"}}, "metrics.clicks is no bigint"),
        ({"metrics": {"ctr": "many"}}, "metrics.ctr is no double"),
        ({"metrics": 5}, "record cannot be read"),
        ({"campaign": {"name": "no id"}}, "campaign.id is missing"),
    ],
)
def test_bad_values_break_the_contract(spark, tmp_path, change, message):
    landed = wire(spark, GEO, [{**geo_row(1, "2024-01-05"), **change}], tmp_path / "w")
    rows = flatten_report(GEO, landed, google_listing(spark, 1)).collect()
    assert [(r.requested_account, r[VIOLATION]) for r in rows] == [("1", message)]


def test_cut_lines_pass_the_row_filter(spark, tmp_path):
    whole = json.dumps({"requested_account": "1", **geo_row(1, "2024-01-05")})
    rows = flatten_report(KEYWORDS, wire(spark, KEYWORDS, [whole[:90]], tmp_path / "w"), google_listing(spark, 1)).collect()
    assert [(r.requested_account, r[VIOLATION]) for r in rows] == [("1", "record cannot be read")]


def test_a_cut_line_loses_no_row(store, tmp_path):
    first = [geo_row(a, "2024-01-20", n) for a in (1, 2) for n in (1, 2)]
    load(store, GEO, first, tmp_path, [1, 2])
    before = costs(store)
    restated = [{"requested_account": str(a), **geo_row(a, "2024-01-20", n, cost_micros=5)} for a in (1, 2) for n in (1, 2)]
    lines = [*restated[:3], json.dumps(restated[3])[:70]]
    landed = wire(store.spark, GEO, lines, tmp_path / "cut")
    with pytest.raises(LoadFailed, match="2: record cannot be read"):
        load_fact(store, GEO, landed, google_listing(store.spark, 1, 2), Run(RUN))
    assert costs(store) == [("2024-01-20", "1", 5)] * 2 + before[2:]
    # A line that names no account may belong to any: nothing is replaced.
    landed = wire(store.spark, GEO, [*restated[:2], '{"metri'], tmp_path / "unnamed")
    with pytest.raises(LoadFailed, match="names no account; nothing was replaced"):
        load_fact(store, GEO, landed, google_listing(store.spark, 1, 2), Run(RUN))
    assert costs(store) == [("2024-01-20", "1", 5)] * 2 + before[2:]
