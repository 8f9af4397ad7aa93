"""Links and distributions inside documents held as table rows (HTML pages, DCAT XML)."""

from __future__ import annotations

import html as markup
from collections.abc import Callable
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callejero.functions.links import absolutize
from callejero.functions.text import squeeze

NOT_CONTENT = r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>"
# quoted values are units: a ``>`` inside one does not end the tag
ATTRIBUTES = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
ANCHOR = rf"(?is)<a(?=\s)({ATTRIBUTES})>(.*?)</a\s*>"


@F.pandas_udf(T.StringType())
def unescape(texts: pd.Series) -> pd.Series:
    """Named and numeric character references of markup text to characters."""
    return texts.map(markup.unescape, na_action="ignore")


def unescaped(text: Column) -> Column:
    """Character references decoded; only texts that hold an ``&`` are sent to Python."""
    asked = F.when(text.contains("&"), text)
    return F.coalesce(unescape(asked), text)


def _attribute(attributes: Column, name: str) -> Column:
    """The quoted or bare value of an attribute, looked for outside of other values."""
    form = rf"""(?is)^(?:[^"']|"[^"]*+"|'[^']*+')*?(?<=\s){name}\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)"""
    value = F.regexp_replace(F.regexp_extract(attributes, form, 1), r"""^["']|["']$""", "")
    return F.trim(value)


def _anchors(body: Column) -> Column:
    """Array of (href, label) of the links with a target, as written."""
    tags = F.regexp_extract_all(body, F.lit(ANCHOR), F.lit(1))
    labels = F.regexp_extract_all(body, F.lit(ANCHOR), F.lit(2))
    links = F.transform(
        F.arrays_zip(tags.alias("tag"), labels.alias("label")),
        lambda link: F.struct(_attribute(link["tag"], "href").alias("href"), link["label"].alias("label")),
    )
    return F.filter(links, lambda link: link["href"] != "")


def _data_attributes(body: Column) -> Column:
    """Array of (href, label) of ``data-url``, else ``data-href``, as written; the label is null."""
    def value(tag: Column, name: str) -> Column:
        return F.nullif(_attribute(tag, name), F.lit(""))

    tags = F.regexp_extract_all(body, F.lit(rf"(?is)<[a-z]({ATTRIBUTES})>"), F.lit(1))
    tagged = F.filter(tags, lambda tag: tag.rlike(r"(?is)\sdata-(?:url|href)\s*="))
    return F.transform(tagged, lambda tag: F.struct(
        F.coalesce(value(tag, "data-url"), value(tag, "data-href")).alias("href"),
        F.lit(None).cast("string").alias("label")))


def _exploded(pages: DataFrame, page: str, html: str, made: dict[int, Callable[[Column], Column]]) -> DataFrame:
    """(page, stage, pos, label, href) of some arrays of links, read from a page at once.

    Links come out of a page's own row, so nothing is shuffled.
    """
    body = F.regexp_replace(F.col(html), NOT_CONTENT, "")
    cut = pages.select(F.col(page).alias("page"), body.alias("body"))
    entries = [
        F.transform(make(F.col("body")), lambda link, i: F.struct(  # noqa: B023
            F.lit(stage).alias("stage"), i.alias("pos"), link["label"].alias("label"), link["href"].alias("href")))  # noqa: B023
        for stage, make in made.items()
    ]
    links = cut.select("page", F.inline(entries[0] if len(entries) == 1 else F.concat(*entries)))
    plain = F.regexp_replace("label", rf"<{ATTRIBUTES}>", " ")
    return links.where("href is not null").select(
        "page", "stage", "pos", unescaped(plain).alias("label"), unescaped(F.col("href")).alias("href"),
    ).select("page", "stage", "pos", squeeze(F.col("label")).alias("label"), F.trim("href").alias("href"))


def extract_anchors(pages: DataFrame, page: str = "url", html: str = "html") -> DataFrame:
    """(page, pos, label, href) for every link of every page; comments and scripts skipped."""
    return _exploded(pages, page, html, {1: _anchors}).drop("stage")


def extract_data_attributes(pages: DataFrame, page: str = "url", html: str = "html") -> DataFrame:
    """(page, pos, href) of elements with ``data-url`` or ``data-href``; ``data-url`` wins."""
    return _exploded(pages, page, html, {2: _data_attributes}).drop("stage", "label")


def extract_candidates(pages: DataFrame, page: str = "url", html: str = "html") -> DataFrame:
    """(page, stage, pos, label, href): the links (stage 1) and data attributes (2) of every page."""
    return _exploded(pages, page, html, {1: _anchors, 2: _data_attributes})


def absolute_links(links: DataFrame, protocol_relative: bool = True) -> DataFrame:
    return links.withColumn(
        "href", absolutize(F.col("page"), F.col("href"), protocol_relative)
    )


DCAT = "{http://www.w3.org/ns/dcat#}"
TERMS = "{http://purl.org/dc/terms/}"
RESOURCE = "{http://www.w3.org/1999/02/22-rdf-syntax-ns#}resource"


def _distributions(xml: str | None) -> list[dict[str, str]]:
    """Title, media and href of every distribution of one record, at any depth."""
    try:
        root = ElementTree.fromstring(xml or "")
    except ElementTree.ParseError:
        return []
    out = []
    for node in root.iter(f"{DCAT}Distribution"):
        access = node.find(f"{DCAT}accessURL")
        out.append({
            "title": (node.findtext(f"{TERMS}title") or "").strip(),
            "media": (node.findtext(f"{DCAT}mediaType") or "").strip(),
            "href": (access.get(RESOURCE, "") if access is not None else "").strip(),
        })
    return out


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("title", "media", "href")])))
def _parsed(xml: pd.Series) -> pd.Series:
    return xml.map(_distributions)


def extract_dcat_distributions(docs: DataFrame, doc: str, xml: str) -> DataFrame:
    """(doc, pos, title, media, href) per distribution with an access URL, CSV first.

    Bad XML yields no row. Elements of other vocabularies do not count. The order is
    settled inside each document's own row.
    """
    def entry(d: Column, i: Column) -> Column:
        is_csv = F.lower(d["media"]).contains("csv") | F.lower(d["href"]).endswith(".csv")
        return F.struct(
            F.when(is_csv, 0).otherwise(1).alias("order"), i.alias("at"), d["title"].alias("title"),
            d["media"].alias("media"), d["href"].alias("href"),
        )

    ranked = F.array_sort(F.filter(F.transform("found", entry), lambda d: d["href"] != ""))
    return (
        docs.select(F.col(doc).alias("doc"), _parsed(F.col(xml)).alias("found"))
        .select("doc", F.posexplode(ranked).alias("pos", "d"))
        .select("doc", "pos", "d.title", "d.media", "d.href")
    )
