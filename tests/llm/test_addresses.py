"""Address models on awkward rows: clashing names, repeated rows, very long addresses, ties."""

from callejero.llm import queries, urlfilter


def test_judging_awkward_rows(spark):
    long = "http://long.example.net/" + "segment/" * 2_500
    urls = ["http://a.org/x", "http://b.com/de/y", "http://c.net/", "http://c.net/", long, long, None, "", "no address", "http://", "HTTP://É.ORG/ñ?q#f"]
    rows = [(i, u, "old host", f"s{i}", 1.5, True) for i, u in enumerate(urls)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, host string, rule string, score double, verdict boolean").repartition(3)
    out = {r.page_id: r for r in urlfilter.judge(df, queries.URL_RULES).collect()}
    assert len(out) == len(rows)
    assert [(out[i].host, out[i].rule, out[i].verdict) for i in (0, 1)] == [("a.org", "org/", "allow"), ("b.com", "com/de/", "block")]
    # repeated addresses are judged alike; what has no host and path fits no rule
    assert (out[2].score, out[2].verdict) == (out[3].score, out[3].verdict) and (out[4].score, out[4].verdict) == (out[5].score, out[5].verdict)
    assert out[4].path == "/" + "segment/" * 2_500
    assert {(out[i].host, out[i].path, out[i].rule) for i in (6, 7, 8, 9)} == {("", "", None)}
    assert (out[10].host, out[10].rule) == ("É.org", "org/")
    assert all(r.verdict in ("allow", "block") for r in out.values())


def test_one_side_only(spark):
    """Without any address of one side every score is 0 and passes."""
    df = spark.createDataFrame([(1, "http://a.org/"), (2, "http://b.org/x"), (3, "http://c.net/")], "page_id bigint, url string")
    out = {r.page_id: (r.rule, r.verdict) for r in urlfilter.judge(df, {"org/": "allow"}).collect()}
    assert out == {1: ("org/", "allow"), 2: ("org/", "allow"), 3: (None, "allow")}
