from pyspark.sql import functions as F
from test_sources import line, lines

from tidegauge.functions.labels import LAN
from tidegauge.operators import enrich
from tidegauge.operators.joins import keep_matching, lookup
from tidegauge.plans.jobs import enriched_log
from tidegauge.sources.access_log import parse_lines

SESSIONS = "kind string, token string, member_id string, qz_id string, user_id string, instance_id string"


def sessions(spark):
    rows = [
        ("esn", "sess", "1", "2", "3", "4"),
        ("api", "tok", "5", "6", "7", "8"),
        ("api", "blank", "", "6", "7", "8"),
        ("api", "a/b", "9", "9", "9", "9"),
    ]
    return spark.createDataFrame(rows, SESSIONS)


def identity(spark, **fields):
    parsed = parse_lines(lines(spark, line(**fields)))
    row = enrich.with_identity(parsed, sessions(spark)).first()
    return tuple(row[n] for n in ("member_id", "qz_id", "user_id", "instance_id"))


NOBODY = (None, None, None, None)


def test_identity_by_site_rule(spark):
    cookie = {"sent_http_set_cookie": "PHPSESSID=sess; path=/"}
    assert identity(spark, site="esn", **cookie) == ("1", "2", "3", "4")
    assert identity(spark, site="m", **cookie, request="GET /a HTTP/1.1") == NOBODY
    by_query = {"request": "GET /a?token=tok HTTP/1.1"}
    by_access = {"request": "GET /a?access_token=tok HTTP/1.1"}
    assert identity(spark, site="m", **by_query) == ("5", "6", "7", "8")
    assert identity(spark, site="api", **by_query) == NOBODY
    assert identity(spark, site="api", **by_access) == ("5", "6", "7", "8")
    assert identity(spark, site="h5-api", **by_access) == NOBODY


def test_arguments_come_before_the_query(spark):
    fields = {"request_args": '{"token":"tok"}', "request": "GET /a?token=other HTTP/1.1"}
    assert identity(spark, site="m", **fields) == ("5", "6", "7", "8")


def test_session_of_one_kind_is_not_one_of_the_other(spark):
    assert identity(spark, site="m", request="GET /a?token=sess HTTP/1.1") == NOBODY
    assert identity(spark, site="esn", sent_http_set_cookie="PHPSESSID=tok; path=/") == NOBODY


def test_page_requests_have_no_identity(spark):
    page = {"request": "GET /a.htm?token=tok HTTP/1.1"}
    ids = '"qz_id=80298882&instance_id=78136078&member_id=68175624"'
    assert identity(spark, site="m", **page) == NOBODY
    assert identity(spark, site="openapi", sent_http_set_cookie=ids, **page) == NOBODY


def test_open_api_ids_are_decoded(spark):
    ids = '"qz_id=80298882&instance_id=78136078&member_id=68175624"'
    got = identity(spark, site="openapi", sent_http_set_cookie=ids)
    assert got == ("385503", "79991", None, "88511")


def test_token_with_a_slash_is_not_looked_up(spark):
    assert identity(spark, request="GET /a?token=a/b HTTP/1.1") == NOBODY
    # It also hides the token of the query behind it.
    fields = {"request_args": '{"token":"a/b"}', "request": "GET /a?token=tok HTTP/1.1"}
    assert identity(spark, **fields) == NOBODY


def test_blank_ids_are_missing(spark):
    assert identity(spark, request="GET /a?token=blank HTTP/1.1") == (None, "6", "7", "8")


def test_one_row_does_not_inherit_from_another(spark):
    good = line(request="GET /a?token=tok HTTP/1.1")
    bad = line(request="GET /a?token=gone HTTP/1.1", connection="8")
    rows = enrich.with_identity(parse_lines(lines(spark, good, bad)), sessions(spark)).collect()
    assert {r["connection"]: r["member_id"] for r in rows} == {7: "5", 8: None}


def geo(spark):
    rows = [("10.0.0.1", "中国", "四川", "x"), ("10.0.0.2", LAN, None, None)]
    return spark.createDataFrame(rows, "ip string, country string, region string, city string")


def test_geo_drops_lan_and_keeps_unknown(spark):
    ips = ["10.0.0.1", "10.0.0.2", "10.0.0.3", "", None, "x" * 16]
    df = spark.createDataFrame([(i, ip) for i, ip in enumerate(ips)], "i int, remote_addr string")
    rows = {r["i"]: r["region"] for r in enrich.with_geo(df, geo(spark)).collect()}
    assert rows == {0: "四川", 2: None, 3: None, 4: None, 5: None}


def test_lookup_never_matches_a_missing_key(spark):
    """Rows without a key are joined by a hash of the row; even if it is a key, there is no match."""
    facts = spark.createDataFrame([(None, "a"), (1, "b")], "k bigint, v string")
    hashes = facts.select(F.xxhash64("k", "v").alias("k"))
    dim = hashes.withColumn("name", F.lit("by accident")).unionByName(
        spark.createDataFrame([(1, "one")], "k bigint, name string")
    )
    rows = {r["v"]: r["name"] for r in lookup(facts, dim, "k", "name").collect()}
    assert rows == {"a": None, "b": "one"}


def test_keep_matching_drops_missing_keys(spark):
    facts = spark.createDataFrame([("a", 1), ("a", 2), (None, 1)], "k string, n int")
    dim = spark.createDataFrame([("a", 1), (None, 1), ("a", 1)], "k string, n int")
    assert [tuple(r) for r in keep_matching(facts, dim, "k", "n").collect()] == [("a", 1)]


def test_clicks_of_an_enriched_log(spark):
    rows = [
        line(request="GET /rest/doc/index?token=tok HTTP/1.1", http_user_agent="an iPhone"),
        line(request="GET /other?token=tok HTTP/1.1"),
    ]
    log = enriched_log(lines(spark, *rows), geo(spark), sessions(spark))
    clicks = enrich.derive_clicks(log.withColumnRenamed("ip", "remote_addr")).collect()
    assert len(clicks) == 1
    click = clicks[0].asDict()
    assert click["action"] == "_click" and click["app_id"] == "50" and click["client"] == "ios"
    assert click["mtime"] == "1483804792000" and click["member_id"] == "5"


def test_enriched_log_drops_unreadable_times(spark):
    log = enriched_log(lines(spark, line(time_local="?"), line()), geo(spark), sessions(spark))
    assert log.count() == 1


def test_a_repeated_dimension_key_does_not_multiply_rows(spark):
    facts = spark.createDataFrame([("1",), ("1",), ("2",), ("x",), (None,)], "id string")
    dim = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (2, "two", 1)], "id bigint, name string, at int")
    found = lookup(facts, dim, "id", "name", latest="at").collect()
    assert sorted((r["id"] or "", r["name"] or "") for r in found) == [
        ("", ""), ("1", "new"), ("1", "new"), ("2", "two"), ("x", "")
    ]
    assert lookup(facts, dim, "id", "name").count() == 5


def test_ipv6_addresses_keep_their_geography(spark):
    long = "2001:0db8:85a3:0000:0000:8a2e:0370:7334"
    log = spark.createDataFrame([(long,), ("nonsense",)], "remote_addr string")
    geo = spark.createDataFrame([(long, "c", "r", "t")], "ip string, country string, region string, city string")
    got = {r["remote_addr"]: r["country"] for r in enrich.with_geo(log, geo).collect()}
    assert got == {long: "c", "nonsense": None}


def test_the_raw_line_is_in_no_shuffle(spark, sf):
    """And assets are dropped below the split."""
    raw = spark.createDataFrame([("x\ty",)], "value string")
    geo = spark.createDataFrame([("1", "c", "r", "t")], "ip string, country string, region string, city string")
    known = spark.createDataFrame([], "kind string, token string, member_id string, qz_id string, user_id string, instance_id string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = enriched_log(raw, geo, known)
        plan = frame._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = [x for x in plan.split("\n") if "Exchange" in x]
    assert exchanges and "value" not in frame.columns
    below = plan[plan.index("Exchange") :]
    assert "value#" not in "".join(x for x in below.split("\n") if "Project" in x and "Exchange" in x)
    generate = next(i for i, x in enumerate(plan.split("\n")) if "Generate" in x)
    assert any("Filter" in x and "Contains" in x for x in plan.split("\n")[generate + 1 :])
