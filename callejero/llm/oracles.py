"""DuckDB SQL of the queries that SQL can state, over the same tables."""

from __future__ import annotations

import string

UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase
SPACED = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def repetition(window: int, least: int, share: int, longest: int) -> str:
    def covered(size: int) -> str:
        return f"""SELECT doc_id, count(DISTINCT i + k) AS c
            FROM (SELECT doc_id, i, unnest(range({size})) AS k FROM (
                SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM (
                    SELECT doc_id, i, array_to_string(ws[i:i + {size - 1}], ' ') AS g
                    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {size - 2})) AS i FROM w)))
                WHERE c > 1) GROUP BY doc_id"""

    return rf"""
    WITH w AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{SPACED}') AS ws FROM documents),
    lines AS (SELECT doc_id, count(*) - count(DISTINCT line) AS dup FROM (
        SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w) WHERE regexp_matches(line, '{SPACED}') GROUP BY doc_id),
    r8 AS ({covered(window)}), r5 AS ({covered(least)}), far AS ({covered(longest + 1)}),
    m AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        coalesce(dup, 0) AS n_dup_lines, coalesce(r8.c, 0) AS n_repeat_words, coalesce(r5.c, 0) AS covered_words, far.c AS far
        FROM w LEFT JOIN lines USING (doc_id) LEFT JOIN r8 ON r8.doc_id = w.doc_id LEFT JOIN r5 ON r5.doc_id = w.doc_id
        LEFT JOIN far ON far.doc_id = w.doc_id),
    b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        NOT base_failed AND covered_words * 100 <= n_words * {share} AND far IS NULL AS kept, covered_words FROM b"""


def neardup(size: int, percent: int) -> str:
    return rf"""
    WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{SPACED}') AS ws FROM documents),
    s AS (SELECT DISTINCT doc_id, g FROM (
        SELECT doc_id, array_to_string(ws[i:i + {size - 1}], ' ') AS g FROM (
            SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - {size - 2}, 2))) AS i FROM w WHERE len(ws) > 0))),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    links AS (SELECT p.x, p.y FROM (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
        GROUP BY 1, 2) p JOIN n nx ON nx.doc_id = p.x JOIN n ny ON ny.doc_id = p.y WHERE 100 * common >= {percent} * (nx.n + ny.n - common)),
    reach(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
    c AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x)
    SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
    FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.doc_id = d.doc_id"""


def winnowing(window: int) -> str:
    def words(table: str, key: str) -> str:
        return f"SELECT {key} AS id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{ALNUM}') AS ws FROM {table}"

    return rf"""
    WITH d AS ({words('documents', 'doc_id')}), b AS ({words('benchmark', 'item_id')}),
    items AS (SELECT DISTINCT id AS item, n, array_to_string(ws[i:i + n - 1], ' ') AS g FROM (
        SELECT id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM (
            SELECT id, ws, least({window}, len(ws)) AS n FROM b WHERE len(ws) > 0))),
    found AS (SELECT id, i, n, item FROM (
        SELECT id, i, n, array_to_string(ws[i:i + n - 1], ' ') AS g FROM (
            SELECT id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM items)))
        JOIN items USING (n, g)),
    hit AS (SELECT id, count(DISTINCT place) AS n_hit FROM (SELECT id, i + unnest(range(n)) AS place FROM found) GROUP BY id),
    per AS (SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (
        SELECT DISTINCT id, CAST(item AS VARCHAR) AS item FROM found) GROUP BY id)
    SELECT d.id AS doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
        sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN hit ON hit.id = d.id LEFT JOIN per ON per.id = d.id"""


def sharding(shards: int, seed: str) -> str:
    # the table of CRC-32 (polynomial 0xEDB88320) from its rule, then byte by byte
    return rf"""
    WITH t AS (SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
            lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS crc),
    d AS (SELECT doc_id, coalesce('=' || source, '') AS src, octet_length(encode(coalesce(text, ''))) + 1 AS size,
        md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS ord,
        xor(4294967295, list_reduce(list_concat([4294967295], list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
            lambda h: CAST((strpos('0123456789ABCDEF', h[1]) - 1) * 16 + strpos('0123456789ABCDEF', h[2]) - 1 AS BIGINT))),
            lambda c, b: xor(t.crc[(xor(c, b) & 255) + 1], c >> 8))) AS text_crc32 FROM documents, t),
    r AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY ord, doc_id, text_crc32, size) AS rank,
        count(*) OVER (PARTITION BY src) AS n, count(*) OVER () AS total FROM d),
    p AS (SELECT *, row_number() OVER (ORDER BY (rank - 0.5::DOUBLE) / n, src, rank) - 1 AS place FROM r),
    s AS (SELECT *, CAST(place * {shards} // total AS INT) AS shard FROM p)
    SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'rows' AS law, shard,
        CAST(place - (CAST(shard AS BIGINT) * total + {shards - 1}) // {shards} AS BIGINT) AS slot, CAST(NULL AS INT) AS grown_shard FROM s"""


def url_models(rules: dict[str, str], order: int, alphabet: int, scale: int, bin_: int, last: int) -> str:
    fits = []
    for rule in sorted(rules, key=lambda r: (-len(r), r)):
        name, slash, rest = rule.partition("/")
        fits.append(f"WHEN (host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '{slash}{rest}') THEN '{rule}'")
    allow = ", ".join(f"'{r}'" for r, v in rules.items() if v == "allow")
    crc = ("xor(4294967295, list_reduce(list_concat([4294967295], list_transform(regexp_extract_all(hex(encode(s)), '..'), "
           "lambda h: CAST((strpos('0123456789ABCDEF', h[1]) - 1) * 16 + strpos('0123456789ABCDEF', h[2]) - 1 AS BIGINT))), "
           "lambda c, b: xor(t.crc[(xor(c, b) & 255) + 1], c >> 8)))")
    levels = [f"c{order + 1} AS (SELECT piece, sum(CASE WHEN counted AND side = 1 THEN n ELSE 0 END) AS n1, "
              f"sum(CASE WHEN counted AND side = 0 THEN n ELSE 0 END) AS n0 FROM pieces GROUP BY piece)"]
    for size in range(order, 0, -1):
        levels.append(f"c{size} AS (SELECT substr(piece, 2) AS piece, sum(n1) AS n1, sum(n0) AS n0 FROM c{size + 1} GROUP BY 1)")
    for size in range(1, order + 2):
        context = f"substr(l.piece, 1, {size - 1})"
        before = "" if size == 1 else f"JOIN p{size - 1} q ON q.piece = substr(l.piece, 2)"
        q1, q0 = (f"1e0 / {alphabet}",) * 2 if size == 1 else ("q.p1", "q.p0")
        levels.append(f"""t{size} AS (SELECT substr(piece, 1, {size - 1}) AS context, sum(n1) AS t1, sum(n0) AS t0,
            count(*) FILTER (n1 > 0) AS k1, count(*) FILTER (n0 > 0) AS k0 FROM c{size} GROUP BY 1),
        p{size} AS (SELECT l.piece,
            CASE WHEN t1 > 0 THEN CAST(n1 + k1 * {q1} AS DOUBLE) / CAST(t1 + k1 AS DOUBLE) ELSE {q1} END AS p1,
            CASE WHEN t0 > 0 THEN CAST(n0 + k0 * {q0} AS DOUBLE) / CAST(t0 + k0 AS DOUBLE) ELSE {q0} END AS p0
            FROM c{size} l JOIN t{size} ON context = {context} {before})""")
    return rf"""
    WITH t AS (SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
            lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS crc),
    u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
    h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
    f AS (SELECT *, host || path AS s, CASE {' '.join(fits)} END AS rule FROM h),
    d AS (SELECT s, count(*) AS n, max(CASE WHEN rule IN ({allow}) THEN 1 WHEN rule IS NOT NULL THEN 0 END) AS side FROM f GROUP BY s),
    x AS (SELECT s, n, side, {crc} % 4 = 0 AS held FROM d, t),
    pieces AS (SELECT s, n, side, held, side IS NOT NULL AND NOT held AS counted,
        substr(repeat(chr(2), {order}) || s || chr(3), i, {order + 1}) AS piece
        FROM (SELECT *, unnest(range(1, length(s) + 2)) AS i FROM x)),
    {', '.join(levels)},
    ratio AS (SELECT piece, CAST(round(ln(p1 / p0) * {scale}) AS BIGINT) AS r FROM p{order + 1}),
    m AS (SELECT s, n, side, CAST(sum(r) AS DOUBLE) / count(*) AS mean FROM pieces JOIN ratio USING (piece)
        WHERE side IS NULL OR held GROUP BY s, n, side),
    bins AS (SELECT CAST(greatest(least(floor(mean / {bin_}), {last}), -{last}) AS BIGINT) AS bin,
        sum(CASE WHEN side = 1 THEN n ELSE 0 END) AS n1, sum(CASE WHEN side = 0 THEN n ELSE 0 END) AS n0 FROM m WHERE side IS NOT NULL GROUP BY 1),
    gains AS (SELECT bin, sum(n1) OVER (ORDER BY bin DESC) * sum(n0) OVER () - sum(n0) OVER (ORDER BY bin DESC) * sum(n1) OVER () AS gain FROM bins),
    cut AS (SELECT coalesce((SELECT bin FROM gains ORDER BY gain DESC, abs(bin), bin DESC LIMIT 1), 0) * {bin_} AS cut)
    SELECT page_id, host, path, rule, CASE WHEN rule IN ({allow}) THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
        WHEN coalesce(mean, 0) >= cut THEN 'allow' ELSE 'block' END AS verdict,
        CASE WHEN rule IS NULL THEN coalesce(mean, 0) / {scale} END AS score
    FROM f LEFT JOIN (SELECT s, mean FROM m WHERE side IS NULL) USING (s), cut"""


# the table of CRC-32 (polynomial 0xEDB88320) from its rule, and the CRC of a text s, byte by byte
CRC_TABLE = """SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS crc"""


def _crc(s: str) -> str:
    return (f"xor(4294967295, list_reduce(list_concat([4294967295], list_transform(regexp_extract_all(hex(encode({s})), '..'), "
            "lambda h: CAST((strpos('0123456789ABCDEF', h[1]) - 1) * 16 + strpos('0123456789ABCDEF', h[2]) - 1 AS BIGINT))), "
            "lambda c, b: xor(t.crc[(xor(c, b) & 255) + 1], c >> 8)))")


def spelling(least: int, least_count: int, times: int, every: int) -> str:
    return rf"""
    WITH RECURSIVE t AS ({CRC_TABLE}),
    r AS (SELECT doc_id, run, count(*) AS k FROM (SELECT doc_id,
        unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[a-zÀ-ÿ]{{{least},}}')) AS run FROM documents) GROUP BY 1, 2),
    h AS (SELECT run, k, {_crc("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM r, t),
    w AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM (SELECT k,
        CASE WHEN h % {every} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM h)
        WHERE length(word) >= {least} GROUP BY word HAVING sum(k) >= {least_count}),
    cut AS (SELECT word, substr(word, 1, i) AS a, substr(word, i + 2) AS b FROM (SELECT word, unnest(range(length(word))) AS i FROM w)),
    near AS (SELECT x.word, y.word AS other FROM cut x JOIN cut y ON x.a = y.a AND x.b = y.b AND x.word <> y.word
        UNION SELECT cut.word, w.word FROM cut JOIN w ON w.word = cut.a || cut.b
        UNION SELECT w.word, cut.word FROM cut JOIN w ON w.word = cut.a || cut.b),
    best AS (SELECT near.word, count(*) AS n_near, first(other ORDER BY w.n DESC, other) AS other, max(w.n) AS most
        FROM near JOIN w ON w.word = other GROUP BY near.word),
    forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= {times} * w.n THEN other END AS form,
        CASE WHEN most >= {times} * w.n THEN most END AS form_n FROM w LEFT JOIN best USING (word)),
    walk(word, place, next) AS (SELECT word, word, form FROM forms
        UNION ALL SELECT walk.word, forms.word, forms.form FROM walk JOIN forms ON forms.word = walk.next)
    SELECT forms.word, forms.form, walk.place AS root, n, n_near, form_n FROM forms JOIN walk ON walk.word = forms.word AND walk.next IS NULL"""


def resample(longest: int, buckets: int, percent: int, least_words: int, seed: str) -> str:
    def grams(table: str, key: str) -> str:
        return f"""SELECT id, array_to_string(ws[i:i + n - 1], ' ') AS g FROM (
            SELECT id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM (
                SELECT {key} AS id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{ALNUM}') AS ws FROM {table}),
                (SELECT unnest(range(1, {longest + 1})) AS n))"""

    return rf"""
    WITH t AS ({CRC_TABLE}), d AS ({grams('documents', 'doc_id')}), b AS ({grams('benchmark', 'item_id')}),
    g AS (SELECT g, {_crc('g')} % {buckets} AS bucket FROM (SELECT DISTINCT g FROM (SELECT g FROM d UNION ALL SELECT g FROM b)), t),
    s AS (SELECT bucket, count(*) AS s FROM d JOIN g USING (g) GROUP BY bucket),
    q AS (SELECT bucket, count(*) AS t FROM b JOIN g USING (g) GROUP BY bucket),
    a AS (SELECT (SELECT count(*) FROM d) AS cs, (SELECT count(*) FROM b) AS ct),
    gain AS (SELECT s.bucket, CAST(floor(1000 * ln(CAST((coalesce(q.t, 0) + 1) * (cs + {buckets}) AS DOUBLE)
        / CAST((s.s + 1) * (ct + {buckets}) AS DOUBLE))) AS BIGINT) AS gain FROM s LEFT JOIN q USING (bucket), a),
    f AS (SELECT id, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight FROM d JOIN g USING (g) JOIN gain USING (bucket) GROUP BY id),
    r AS (SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
        len(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{ALNUM}')) AS n_words,
        CAST('0x' || substr(sha256('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
        FROM documents LEFT JOIN f ON f.id = doc_id),
    o AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5e0) / 4294967296e0))) AS BIGINT) AS score FROM r),
    p AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM o WHERE n_words >= {least_words})
    SELECT o.doc_id, n_features, weight, score, CASE WHEN place <= {percent} * n // 100 THEN place END AS rank FROM o LEFT JOIN p USING (doc_id)"""
