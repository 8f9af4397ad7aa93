"""Data links on catalogue pages: absolute form, acceptance and scores."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from callejero import constants as K

ZIP_SUFFIX = r"\.zip$"
CSV_SUFFIX = r"\.csv$"
JSON_SUFFIX = r"\.(json|geojson)$"


def absolutize(base: Column, href: Column, protocol_relative: bool = True) -> Column:
    """``//host/x`` gets https, ``/x`` the page's scheme and host, the rest is left alone."""
    link = F.trim(href)
    root = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    scheme = F.when(F.lit(protocol_relative), F.lit("https:")).otherwise(
        F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)//", 1)
    )
    return (
        F.when(link.startswith("//"), F.concat(scheme, link))
        .when(link.startswith("/"), F.concat(root, link))
        .otherwise(link)
    )


def _any_of(words: list[str]) -> str:
    return "|".join(re.escape(w) for w in words)


def _suffix(href: Column, pattern: str) -> Column:
    return F.lower(href).rlike(pattern)


def is_excluded(href: Column, words: list[str]) -> Column:
    """Links to map services, documents and scripts."""
    return F.lower(href).rlike(_any_of(words))


def looks_like_data(href: Column, label: Column, allow_zip: bool = False) -> Column:
    """A web link that names no map service or document and has a data suffix or hint."""
    low = F.lower(href)
    hints = K.LINK_HINTS_WITH_ZIP if allow_zip else K.LINK_HINTS
    excluded = K.LINK_EXCLUDED_WITH_ZIP if allow_zip else K.LINK_EXCLUDED
    hinted = F.concat_ws(" ", low, F.lower(label)).rlike(_any_of(hints))
    # every data suffix (.csv, .json, .geojson, .zip) contains one of the hint words
    return low.rlike(r"^(https?:)?//") & ~is_excluded(href, excluded) & hinted


def looks_like_download(href: Column, label: Column) -> Column:
    """The accident pages' simpler test: a data suffix, or "descarg" in label or link."""
    low = F.lower(href)
    return (
        F.concat_ws(" ", F.lower(label), low).contains("descarg")
        | low.rlike(CSV_SUFFIX)
        | low.rlike(JSON_SUFFIX)
    )


def link_score(href: Column, label: Column, allow_zip: bool = False) -> Column:
    """Lower is better; see the two forms: with archives the hint bonus is 150, else 200."""
    low = F.lower(href)
    suffix = F.when(low.rlike(CSV_SUFFIX), -300).when(low.rlike(JSON_SUFFIX), -250)
    if allow_zip:
        suffix = suffix.when(low.rlike(ZIP_SUFFIX), -200)
    hinted = (
        low.contains("download") | low.contains("descarg")
        | F.lower(label).contains("descarga")
    )
    bonus = F.when(hinted, -150 if allow_zip else -200).otherwise(0)
    return F.lit(1000) + suffix.otherwise(100) + bonus


def link_score_simple(href: Column) -> Column:
    """Accident pages: 0 for CSV, 1 for JSON, 5 for the rest."""
    return F.when(_suffix(href, CSV_SUFFIX), 0).when(_suffix(href, JSON_SUFFIX), 1).otherwise(5)


def _type_by_suffix(name: Column) -> Column:
    low = F.lower(F.trim(name))
    return (
        F.when(low.rlike(ZIP_SUFFIX), "zip")
        .when(low.rlike(CSV_SUFFIX), "csv")
        .when(low.rlike(JSON_SUFFIX), "json")
    )


def response_type(content_type: Column, disposition: Column, url: Column) -> Column:
    """``zip``, ``csv``, ``json`` or empty: the header decides, then file name, then URL."""
    kind = F.lower(F.coalesce(content_type, F.lit("")))
    by_header = (
        F.when(kind.contains("zip"), "zip")
        .when(kind.contains("text/csv"), "csv")
        .when(kind.rlike("application/(geo[+])?json"), "json")
    )
    file_name = F.regexp_extract(F.coalesce(disposition, F.lit("")), K.FILENAME, 1)
    return F.coalesce(by_header, _type_by_suffix(file_name), _type_by_suffix(url), F.lit(""))


def is_data_response(content_type: Column, disposition: Column, url: Column) -> Column:
    """Whether a response is CSV or JSON (archives are not accepted here)."""
    kind = F.lower(F.coalesce(content_type, F.lit("")))
    file_name = F.regexp_extract(F.coalesce(disposition, F.lit("")), K.FILENAME, 1)
    accepted = F.array(F.lit("csv"), F.lit("json"))
    return (
        kind.contains("text/csv")
        | kind.rlike("application/(geo[+])?json")
        | F.coalesce(F.array_contains(accepted, _type_by_suffix(file_name)), F.lit(False))
        | F.coalesce(F.array_contains(accepted, _type_by_suffix(url)), F.lit(False))
    )
