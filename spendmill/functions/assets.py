"""Text assets of an ad. Which landed fields hold them depends on the ad type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spendmill.fixed_values import EXPANDED_TEXT_AD, RESPONSIVE_DISPLAY_AD, RESPONSIVE_SEARCH_AD
from spendmill.functions.text import drop_blanks


def _no_text() -> Column:
    return F.array().cast("array<string>")


def _texts(assets: Column) -> Column:
    return F.coalesce(F.transform(assets, lambda asset: asset["text"]), _no_text())


def _by_ad_type(ad: Column, search: Column, display: Column, expanded: Column) -> Column:
    return (
        F.when(ad["type"] == RESPONSIVE_SEARCH_AD, search)
        .when(ad["type"] == RESPONSIVE_DISPLAY_AD, display)
        .when(ad["type"] == EXPANDED_TEXT_AD, expanded)
        .otherwise(_no_text())
    )


def asset_headlines(ad: Column) -> Column:
    """Headlines; a display ad's long headline comes last, an expanded ad's blank parts are left out."""
    display, expanded = ad["responsive_display_ad"], ad["expanded_text_ad"]
    long_headline = F.when(
        display["long_headline"].isNotNull(), F.array(display["long_headline"]["text"])
    ).otherwise(_no_text())
    return _by_ad_type(
        ad,
        search=_texts(ad["responsive_search_ad"]["headlines"]),
        display=F.concat(_texts(display["headlines"]), long_headline),
        expanded=drop_blanks(F.array(*[expanded[f"headline_part{part}"] for part in (1, 2, 3)])),
    )


def asset_descriptions(ad: Column) -> Column:
    expanded = ad["expanded_text_ad"]
    return _by_ad_type(
        ad,
        search=_texts(ad["responsive_search_ad"]["descriptions"]),
        display=_texts(ad["responsive_display_ad"]["descriptions"]),
        expanded=drop_blanks(F.array(expanded["description"], expanded["description2"])),
    )
