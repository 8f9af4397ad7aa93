"""Links and documents over the page table."""

from __future__ import annotations

from pyspark.sql import functions as F

from callejero.bindings import query, sql
from callejero.bindings.views import spark_view, table, with_views
from callejero.functions import links as link_functions
from callejero.operators import links as link_operators
from callejero.operators.reshape import first_nonempty
from callejero.sources import documents

_ROOT = "regexp_extract(page, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1)"
# What the pages hold: menu links of their own, all of one plain form, and then what v_pages adds
_OWN = sql.quoted('<a href="(/[^"]*)">([^<]*)</a>')


def _plain(x: str) -> str:
    return f"replace(replace({x}, '&quot;', '\"'), '&amp;', '&')"


ANCHORS = f"""{with_views('v_answers')},
own AS (SELECT page_id, url AS page, regexp_extract_all(html, {_OWN}, 1) AS hrefs, regexp_extract_all(html, {_OWN}, 2) AS texts FROM pages),
added AS (SELECT page_id, page, CAST(len(hrefs) AS INT) AS n, CAST(page_id AS STRING) AS id FROM own),
anchors AS (
  SELECT page, CAST(i - 1 AS INT) AS pos, trim({_plain('texts[i]')}) AS label, {_ROOT} || {_plain('hrefs[i]')} AS href
  FROM own, unnest(range(1, len(hrefs) + 1)) AS r(i)
  UNION ALL SELECT page, n, 'Mapa', 'https://example.org/datos?x=1&f=json' FROM added WHERE page_id % 3 = 1
  UNION ALL SELECT page, n, 'Descarga datos de órdenes é', {_ROOT} || '/download/' || id || '.csv' FROM added WHERE page_id % 3 = 2
  UNION ALL SELECT page, n + 1, 'json', 'https://cdn.example.org/d/' || id || '.json' FROM added WHERE page_id % 3 = 2),
attributes AS (
  SELECT page, CAST(0 AS INT) AS pos, {_ROOT} || '/descarga/' || id || '.csv' AS href FROM added WHERE page_id % 3 = 0
  UNION ALL SELECT page, 1, {_ROOT} || '/mapa/wms' FROM added WHERE page_id % 3 = 0
  UNION ALL SELECT page, 0, 'https://cdn.example.org/' || id || '.zip' FROM added WHERE page_id % 3 = 1)"""
# the pages' own links name no data, so each gets a suffix by its place
SUFFIXES = ["", ".csv", ".json", ".zip", "/download"]
SUFFIXED = f"""{ANCHORS}, links AS (
  SELECT page, pos, label, href || CASE (length(href) + pos) % 5 {' '.join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(SUFFIXES))} END AS href
  FROM anchors)"""
EXCLUDED = ("wms|wmts|ogc|service|arcgis|esri|{zip}\\.shp|\\.dbf|\\.prj|\\.kml|\\.kmz|\\.pdf|\\.rdf|"
            "\\.xml|sparql|mailto:|javascript:|#")


def _scored(allow_zip: bool) -> str:
    excluded = EXCLUDED.replace("{zip}", "" if allow_zip else "\\.zip|")
    hints = "download|descarg|csv|json" + ("|zip" if allow_zip else "")
    zip_case = "WHEN lower(href) LIKE '%.zip' THEN -200" if allow_zip else ""
    return f"""scored AS (
  SELECT page, pos, label, href,
    CAST(1000 + CASE WHEN lower(href) LIKE '%.csv' THEN -300
      WHEN lower(href) LIKE '%.json' OR lower(href) LIKE '%.geojson' THEN -250 {zip_case}
      ELSE 100 END
    + CASE WHEN contains(lower(href), 'download') OR contains(lower(href), 'descarg')
        OR contains(lower(label), 'descarga') THEN {-150 if allow_zip else -200} ELSE 0 END AS INT) AS score
  FROM links
  WHERE regexp_matches(lower(href), '^(http://|https://|//)')
    AND NOT regexp_matches(lower(href), '{excluded}')
    AND regexp_matches(lower(href) || ' ' || lower(label), '{hints}'))"""


BEST = """SELECT page, score, pos, label, href FROM (
  SELECT *, row_number() OVER (PARTITION BY page ORDER BY score, pos, label, href) AS rank FROM scored)
WHERE rank = 1"""


def _pages(spark, sf_dir):
    return spark_view(spark, sf_dir, "v_pages")


def _links(spark, sf_dir):
    anchors = documents.absolute_links(documents.extract_anchors(_pages(spark, sf_dir)))
    suffix = F.element_at(
        F.array(*[F.lit(s) for s in SUFFIXES]), (F.char_length("href") + F.col("pos")) % 5 + 1
    )
    return anchors.withColumn("href", F.concat("href", suffix))


@query(f"{ANCHORS} SELECT page, pos, label, href FROM anchors")
def q_anchors(spark, sf_dir):
    return documents.absolute_links(documents.extract_anchors(_pages(spark, sf_dir)))


@query(f"""{SUFFIXED.replace('links AS', 'unused AS')},
links AS (SELECT * FROM anchors), {_scored(False)}
SELECT page, pos, href FROM attributes WHERE page NOT IN (SELECT page FROM scored)
  AND NOT regexp_matches(lower(href), '{EXCLUDED.replace("{zip}", "")}')""")
def q_anchors_fallback(spark, sf_dir):
    """Data attributes of the pages where no anchor looks like data."""
    pages = _pages(spark, sf_dir)
    anchors = documents.absolute_links(documents.extract_anchors(pages))
    attributes = documents.absolute_links(documents.extract_data_attributes(pages))
    return link_operators.fallback_links(attributes, link_operators.score_links(anchors))


@query(f"{SUFFIXED}, {_scored(False)} {BEST}")
def q_link_rank(spark, sf_dir):
    return link_operators.best_links(link_operators.score_links(_links(spark, sf_dir)))


@query(f"{SUFFIXED}, {_scored(True)} {BEST}")
def q_link_rank_zip(spark, sf_dir):
    scored = link_operators.score_links(_links(spark, sf_dir), allow_zip=True)
    return link_operators.best_links(scored)


@query(f"""{SUFFIXED}, scored AS (
  SELECT page, pos, label, href, CAST(CASE WHEN lower(href) LIKE '%.csv' THEN 0
    WHEN lower(href) LIKE '%.json' OR lower(href) LIKE '%.geojson' THEN 1 ELSE 5 END AS INT) AS score
  FROM links WHERE contains(lower(label || ' ' || href), 'descarg') OR lower(href) LIKE '%.csv'
    OR lower(href) LIKE '%.json' OR lower(href) LIKE '%.geojson') {BEST}""")
def q_link_rank_simple(spark, sf_dir):
    return link_operators.best_links(link_operators.score_links_simple(_links(spark, sf_dir)))


_KIND = r"""CASE WHEN contains(lower(coalesce(content_type, '')), 'zip') THEN 'zip'
  WHEN contains(lower(coalesce(content_type, '')), 'text/csv') THEN 'csv'
  WHEN regexp_matches(lower(coalesce(content_type, '')), 'application/(geo\+)?json') THEN 'json'
  WHEN fname LIKE '%.zip' THEN 'zip' WHEN fname LIKE '%.csv' THEN 'csv'
  WHEN fname LIKE '%.json' OR fname LIKE '%.geojson' THEN 'json'
  WHEN lower(final_url) LIKE '%.zip' THEN 'zip' WHEN lower(final_url) LIKE '%.csv' THEN 'csv'
  WHEN lower(final_url) LIKE '%.json' OR lower(final_url) LIKE '%.geojson' THEN 'json'
  ELSE '' END"""
_IS_DATA = r"""(contains(lower(coalesce(content_type, '')), 'text/csv')
  OR regexp_matches(lower(coalesce(content_type, '')), 'application/(geo\+)?json')
  OR fname LIKE '%.csv' OR fname LIKE '%.json' OR fname LIKE '%.geojson'
  OR lower(final_url) LIKE '%.csv' OR lower(final_url) LIKE '%.json'
  OR lower(final_url) LIKE '%.geojson')"""
_FNAME = """lower(trim(regexp_extract(coalesce(disposition, ''),
  '(?i)filename\\s*=\\s*"?([^";]+)"?', 1)))"""


@query(f"""{with_views('v_responses')} SELECT page_id, {_KIND} AS kind, {_IS_DATA} AS is_data
FROM (SELECT *, {_FNAME} AS fname FROM v_responses)""")
def q_response_type(spark, sf_dir):
    headers = F.col("content_type"), F.col("disposition"), F.col("final_url")
    return spark_view(spark, sf_dir, "v_responses").select(
        "page_id", link_functions.response_type(*headers).alias("kind"),
        link_functions.is_data_response(*headers).alias("is_data"),
    )


_GOOD = """good AS (SELECT href, final_url FROM (SELECT *, '' AS fname FROM v_answers) WHERE status < 400 AND {is_data})"""


@query(f"""{ANCHORS}, links AS (SELECT * FROM anchors), {_scored(False)}, {_GOOD.format(is_data=_IS_DATA)}
SELECT page, score, pos, label, href FROM (
  SELECT page, score, pos, label, final_url AS href,
    row_number() OVER (PARTITION BY page ORDER BY score, pos) AS rank FROM scored JOIN good USING (href))
WHERE rank = 1""")
def q_link_accepted(spark, sf_dir):
    """The best link whose logged response is data; refused and wrong ones are passed over."""
    anchors = documents.absolute_links(documents.extract_anchors(_pages(spark, sf_dir)))
    accepted = link_operators.accepted_links(
        link_operators.score_links(anchors), spark_view(spark, sf_dir, "v_answers")
    )
    return link_operators.best_links(accepted.drop("kind"))


@query(f"""{ANCHORS}, links AS (SELECT * FROM anchors), {_scored(False)}, {_GOOD.format(is_data=_IS_DATA)},
ranked AS (
  SELECT page, 1 AS stage, score, pos, final_url AS href FROM scored JOIN good USING (href)
  UNION ALL SELECT page, 2, 0, pos, final_url FROM attributes JOIN good USING (href)
  WHERE NOT regexp_matches(lower(href), '{EXCLUDED.replace("{zip}", "")}')),
best AS (SELECT page, stage, href FROM (
  SELECT *, row_number() OVER (PARTITION BY page ORDER BY stage, score, pos) AS rank FROM ranked) WHERE rank = 1)
SELECT url AS page, CASE WHEN contains(url, 'example.org') THEN 'https://datos.example/a.csv' ELSE href END AS href,
  CASE WHEN contains(url, 'example.org') THEN 'override' WHEN stage = 1 THEN 'anchor' WHEN stage = 2 THEN 'attribute' END AS origin
FROM pages LEFT JOIN best ON best.page = pages.url""")
def q_link_resolve(spark, sf_dir):
    """The one data link of each page: fixed, else the best anchor that answers with data, else
    the first data attribute that does."""
    return link_operators.resolve_links(
        _pages(spark, sf_dir), spark_view(spark, sf_dir, "v_answers"),
        {"example.org": "https://datos.example/a.csv"},
    )


@query("""SELECT page_id, url AS page, CASE WHEN contains(url, 'example.org') THEN
  'https://datos.example/a.csv' WHEN contains(url, '/fr/') THEN 'https://datos.example/b.csv' END
  AS forced FROM pages WHERE url LIKE 'https:%'""")
def q_link_override(spark, sf_dir):
    """Fixed links by page id, over the pages that are switched on."""
    pages = table(spark, sf_dir, "pages").select(
        "page_id", F.col("url").alias("page"), F.col("url").startswith("https:").alias("enabled")
    )
    overrides = {"example.org": "https://datos.example/a.csv",
                 "/fr/": "https://datos.example/b.csv"}
    return link_operators.override_links(link_operators.enabled_pages(pages), overrides).drop(
        "enabled"
    )


@query("""SELECT l_suppkey, l_linenumber, l_orderkey, l_partkey, l_quantity FROM lineitem l
WHERE l_linenumber = (SELECT min(l_linenumber) FROM lineitem k WHERE k.l_suppkey = l.l_suppkey)""")
def q_first_nonempty(spark, sf_dir):
    """Per supplier the lowest line number with any row."""
    items = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_linenumber", "l_orderkey", "l_partkey", "l_quantity"
    )
    return first_nonempty(items, "l_suppkey", "l_linenumber")


_XML = """
SELECT page_id, CASE WHEN page_id % 9 = 8 THEN '<rdf:RDF><roto' ELSE
  '<?xml version="1.0"?><rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" '
  || 'xmlns:dcat="http://www.w3.org/ns/dcat#" xmlns:dct="http://purl.org/dc/terms/">'
  || CASE WHEN page_id % 4 = 2 THEN '<dcat:Catalog><dcat:record>' ELSE '' END
  || CASE WHEN page_id % 2 = 0 THEN '<dcat:Dataset><dcat:distribution>' ELSE '' END
  || '<o:Distribution xmlns:o="http://other.example/"><dct:title>Ajena</dct:title></o:Distribution>'
  || '<dcat:Distribution><dct:title> Datos JSON ' || CAST(page_id AS STRING)
  || '</dct:title><dcat:accessURL rdf:resource="https://example.org/' || CAST(page_id AS STRING)
  || '.json"/></dcat:Distribution>'
  || CASE WHEN page_id % 2 = 0 THEN '</dcat:distribution><dcat:distribution>' ELSE '' END
  || '<dcat:Distribution><dct:title>Tabla</dct:title><dcat:mediaType>text/csv</dcat:mediaType>'
  || '<dcat:accessURL rdf:resource="https://example.org/t/' || CAST(page_id AS STRING)
  || '"/></dcat:Distribution>'
  || CASE WHEN page_id % 2 = 0 THEN '</dcat:distribution></dcat:Dataset>' ELSE '' END
  || CASE WHEN page_id % 4 = 2 THEN '</dcat:record></dcat:Catalog>' ELSE '' END
  || '<dcat:Distribution><dct:title>Sin enlace</dct:title></dcat:Distribution></rdf:RDF>'
  END AS xml
FROM {pages}"""


@query("""SELECT page_id AS doc, CAST(0 AS INT) AS pos, 'Tabla' AS title, 'text/csv' AS media,
  'https://example.org/t/' || CAST(page_id AS STRING) AS href FROM pages WHERE page_id % 9 <> 8
UNION ALL
SELECT page_id, 1, 'Datos JSON ' || CAST(page_id AS STRING), '',
  'https://example.org/' || CAST(page_id AS STRING) || '.json' FROM pages WHERE page_id % 9 <> 8""")
def q_dcat(spark, sf_dir):
    """A catalogue record per page; some are broken, some nest their distributions at some depth."""
    docs = spark.sql(_XML, pages=table(spark, sf_dir, "pages"))
    return documents.extract_dcat_distributions(docs, "page_id", "xml")
