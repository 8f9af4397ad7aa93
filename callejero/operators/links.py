"""From the links of catalogue pages to the one data link to use per page."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callejero import constants as K
from callejero.functions.links import (
    is_data_response, is_excluded, link_score, link_score_simple, looks_like_data, looks_like_download,
    response_type,
)
from callejero.operators.filters import bind
from callejero.operators.ordering import best_link
from callejero.sources.documents import absolute_links, extract_candidates


def _with_text(links: DataFrame) -> DataFrame:
    """Link and label made once, since tests and scores look at them many times."""
    texts = {"__href": F.col("href"), "__label": F.col("label")}
    return bind(links.select("page", "pos", "label", "href"), texts)


def score_links(links: DataFrame, allow_zip: bool = False) -> DataFrame:
    """Links that look like data, with their score (lower is better)."""
    href, label = F.col("__href"), F.col("__label")
    return _with_text(links).where(looks_like_data(href, label, allow_zip)).select(
        "page", "pos", label.alias("label"), href.alias("href"),
        link_score(href, label, allow_zip).alias("score"),
    )


def score_links_simple(links: DataFrame) -> DataFrame:
    href, label = F.col("__href"), F.col("__label")
    return _with_text(links).where(looks_like_download(href, label)).select(
        "page", "pos", label.alias("label"), href.alias("href"),
        link_score_simple(href).alias("score"),
    )


def accepted_links(links: DataFrame, responses: DataFrame, allow_zip: bool = False) -> DataFrame:
    """Links whose logged response (status, headers, final URL) really is data.

    ``responses``: href, status, content_type, disposition, final_url, one row per
    href. ``href`` becomes the final URL and ``kind`` its type.
    """
    headers = F.col("content_type"), F.col("disposition"), F.col("final_url")
    verdict = {"kind": response_type(*headers), "is_data": is_data_response(*headers)}
    is_data = F.col("kind") != "" if allow_zip else F.col("is_data")
    good = bind(responses, verdict).where((F.col("status") < 400) & is_data).select(
        "href", "final_url", "kind"
    )
    return links.join(good, "href").withColumn("href", F.col("final_url")).drop("final_url")


def best_links(scored: DataFrame) -> DataFrame:
    """Per page the best-scored link, ties to the earlier on the page."""
    return best_link(scored, "page", "score", "pos")


def resolve_links(
    pages: DataFrame, responses: DataFrame, overrides: dict[str, str], page: str = "url",
    html: str = "html", allow_zip: bool = False,
) -> DataFrame:
    """(page, href, origin): the one data link of each page.

    A fixed link, else the best-scored anchor whose logged response is data, else the
    first data attribute whose response is. A page without any has a null link. Pages
    are read once for anchors and attributes; the best of a page is a minimum, which
    combines before its shuffle.
    """
    candidates = absolute_links(extract_candidates(pages, page, html))
    texts = {"__href": F.col("href"), "__label": F.col("label")}
    href, label = F.col("__href"), F.col("__label")
    bound = bind(candidates.select("page", "stage", "pos", "label", "href"), texts)
    anchor = F.col("stage") == 1
    scored = bound.where(
        F.when(anchor, looks_like_data(href, label, allow_zip)).otherwise(
            ~is_excluded(href, K.LINK_EXCLUDED_WITH_ZIP))
    ).select(
        "page", "stage", "pos", "label", href.alias("href"),
        F.when(anchor, link_score(href, label, allow_zip)).otherwise(0).alias("score"),
    )
    accepted = accepted_links(scored, responses, allow_zip)
    best = accepted.groupBy("page").agg(F.min(F.struct("stage", "score", "pos", "href")).alias("best"))
    every = override_links(pages.select(F.col(page).alias("page")), overrides).join(best, "page", "left")
    origin = F.when(F.col("forced").isNotNull(), "override").when(
        F.col("best.stage") == 1, "anchor").when(F.col("best.stage") == 2, "attribute")
    return every.select("page", F.coalesce("forced", "best.href").alias("href"), origin.alias("origin"))


def fallback_links(attributes: DataFrame, accepted: DataFrame) -> DataFrame:
    """``data-url`` links of the pages without any accepted anchor."""
    pages = accepted.select("page").distinct()
    return attributes.where(~is_excluded(F.col("href"), K.LINK_EXCLUDED_WITH_ZIP)).join(pages, "page", "left_anti")


def enabled_pages(sources: DataFrame) -> DataFrame:
    return sources.where(F.coalesce(F.col("enabled"), F.lit(True)))


def override_links(pages: DataFrame, overrides: dict[str, str], page: str = "page") -> DataFrame:
    """``forced``: the fixed link of a page whose URL contains a known id, else null.

    The id map is an argument, a handful of entries, so it becomes a CASE; the
    first entry that matches wins.
    """
    forced = F.lit(None).cast("string")
    for key, url in reversed(list(overrides.items())):
        forced = F.when(F.col(page).contains(key), F.lit(url)).otherwise(forced)
    return pages.withColumn("forced", forced)
