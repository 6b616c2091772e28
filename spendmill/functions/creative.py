"""Headline, body, link, button and picture of a creative, by source precedence."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spendmill.functions.text import blank_to_null


def _first_filled(*texts: Column) -> Column:
    """First text that is neither null nor empty, else the last one as it is."""
    return F.coalesce(*[blank_to_null(text) for text in texts[:-1]], texts[-1])


def _feed_or(feed: Column, member: str, otherwise: Column) -> Column:
    """A non-empty feed list decides through its first element, even if that is null."""
    return F.when(F.size(feed) > 0, F.get(feed, F.lit(0))[member]).otherwise(otherwise)


def creative_detail(
    name: str, image_url: Column, thumbnail_url: Column, url_tags: Column, button: Column, story: Column, feed: Column
) -> Column:
    """One of the five derived columns: headline, body, destination_url, call_to_action_type, image_url.

    Precedence: a feed asset wins over a video, a video over a link. The button and the picture work the other way
    round: the creative's own value wins, then link, then video, then (picture only) the feed.
    """
    link, video = story["link_data"], story["video_data"]
    nothing = F.lit(None).cast("string")
    if name == "headline":
        return _feed_or(feed["titles"], "text", _first_filled(video["title"], link["name"], nothing))
    if name == "body":
        return _feed_or(feed["bodies"], "text", _first_filled(video["message"], link["message"], nothing))
    if name == "destination_url":
        return _feed_or(feed["link_urls"], "website_url", _first_filled(link["link"], url_tags))
    if name == "call_to_action_type":
        return _last_source(
            button, (link, link["call_to_action"]["type"]), (video, video["call_to_action"]["type"])
        )
    if name == "image_url":
        first_image = F.get(feed["images"], F.lit(0))
        return _last_source(
            _first_filled(image_url, thumbnail_url),
            (link, link["picture"]),
            (video, video["image_url"]),
            (F.when(F.size(feed["images"]) > 0, F.lit(True)), first_image["url"]),
        )
    raise ValueError(f"{name!r} is no creative detail")


def _last_source(own: Column, *sources: tuple[Column, Column]) -> Column:
    """Own value if filled; else each present source in turn overwrites what is still unfilled."""
    value = own
    for present, candidate in sources:
        unfilled = value.isNull() | (value == "")
        value = F.when(unfilled & present.isNotNull(), candidate).otherwise(value)
    return value
