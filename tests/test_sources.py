from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import filters
from tidegauge.schemas import ACCESS_FIELDS
from tidegauge.sources import access_log, app_events, archive, jdbc, lookups


def line(**fields):
    values = {name: "-" for name, _ in ACCESS_FIELDS}
    values |= {
        "remote_addr": "10.0.0.1",
        "site": "m",
        "connection": "7",
        "time_local": "[07/Jan/2017:23:59:52 +0800]",
        "request": "GET /x?token=abc HTTP/1.1",
        "bytes_sent": "12",
        "upstream_response_time": "0.25",
    }
    return "\t".join((values | fields).values())


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_parse_types_and_dirty_values(spark):
    row = access_log.parse_lines(lines(spark, line(status="x", body_bytes_sent="9"))).first()
    assert (row["connection"], row["status"], row["body_bytes_sent"]) == (7, None, 9)
    assert (row["bytes_sent"], row["upstream_response_time"], row["request_time"]) == (
        "12",
        0.25,
        None,
    )
    assert row["n_fields"] == 20
    assert row["ts"] == datetime(2017, 1, 7, 15, 59, 52)


def test_parse_keeps_short_and_empty_lines(spark):
    rows = access_log.parse_lines(lines(spark, "a\tb\t\t", "", line(time_local="?"))).collect()
    assert [r["n_fields"] for r in rows] == [2, 1, 20]
    assert [r["ts"] for r in rows] == [None, None, None]
    assert rows[0]["remote_user"] == "b" and not rows[0]["site"]


@pytest.mark.parametrize(
    "text, kept",
    [
        (line(), True),
        (line(request="GET /x HTTP/1.1"), False),
        (line(request="GET /x.js HTTP/1.1", request_args="token"), False),
        (line(request="GET /x.css?token=1 HTTP/1.1"), False),
        (line(request="GET /x.json?token=1 HTTP/1.1"), True),
        (line(request="GET /x.htm HTTP/1.1", site="other"), True),
        (line(site="other"), False),
        (line(site="esn"), False),
        (line(site="esn", sent_http_set_cookie="PHPSESSID=1; path=/"), True),
        (line(site="openapi", request="GET / HTTP/1.1"), True),
        (line(sent_http_set_cookie=""), False),
        ("a\t.htm", True),
        ("", False),
    ],
)
def test_request_filter(spark, text, kept):
    parsed = access_log.parse_lines(lines(spark, text))
    assert parsed.where(filters.is_business_request()).count() == int(kept)


def test_enriched_line_round_trip(spark):
    ids = {"member_id": "5", "qz_id": None, "user_id": "6", "instance_id": "7"}
    geo = {"country": "中国", "region": "四川", "city": None}
    row = {**geo, **ids, "value": line()}
    kinds = ", ".join(f"{name} string" for name in row)
    df = spark.createDataFrame([tuple(row.values())], kinds)
    rendered = df.select(access_log.render_enriched_line(F.col("value")).alias("value"))
    assert "member_id:5\tqz_id:empty" in rendered.first()["value"]
    parsed = access_log.parse_enriched_lines(rendered).first()
    assert {k: parsed[k] for k in (*geo, *ids)} == {**geo, **ids}
    assert parsed["n_fields"] == 27


def test_enriched_line_with_blank_or_malformed_ids(spark):
    text = line() + "\tcountry:a\tregion:b\tcity:c\tmember_id:\tqz_id:x:y\tuser_id:1"
    row = access_log.parse_enriched_lines(lines(spark, text)).first()
    assert (row["member_id"], row["qz_id"], row["user_id"], row["instance_id"]) == (
        None,
        None,
        "1",
        None,
    )


def test_app_events_need_a_time(spark):
    rows = lines(
        spark,
        '{"action":"view","app_id":"1","mtime":"1500000000123","object_id":"9","extra":1}',
        '{"action":"view","mtime":1500000000123}',
        '{"action":"view","mtime":""}',
        '{"action":"view","mtime":null}',
        '{"action":"view"}',
        "mtime",
        "",
    )
    parsed = app_events.parse_events(rows).collect()
    assert [(r["app_id"], r["mtime"], r["object_id"]) for r in parsed] == [
        ("1", "1500000000123", "9"),
        (None, "1500000000123", None),
    ]
    assert app_events.parse_behaviour(rows).count() == 2


def test_lookup_replies(spark):
    replies = [
        '{"ecode":"0","result":{"member_id":"1","qz_id":"2","user_id":"3","instance_id":"4"}}',
        '{"ecode":"1","result":{"member_id":"1"}}',
        "no json",
    ]
    df = spark.createDataFrame([(r,) for r in replies], "reply string")
    members = [r["member_id"] for r in lookups.parse_identity_replies(df).collect()]
    assert members == ["1", None, None]

    geo = '{"ecode":"0","result":{"1.2.3.4":{"country":"中国","region":"四川","city":"x"}}}'
    row = lookups.parse_geo_replies(spark.createDataFrame([(geo,)], "reply string")).first()
    assert (row["geo_ip"], row["country"], row["region"]) == ("1.2.3.4", "中国", "四川")

    app = '{"ecode":"0","error":"","result":{"app_id":"1","name":"n","open_appid":"77"}}'
    row = lookups.parse_app_replies(spark.createDataFrame([(app,)], "reply string")).first()
    assert (row["open_appid"], row["name"]) == ("77", "n")


@pytest.fixture
def log(spark):
    times = ["2017-01-07 23:10:00", "2017-01-08 00:10:00", "2017-01-08 05:00:00", "2017-01-09 01:00:00"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "id int, t string")
    return archive.with_partitions(df.select("id", F.col("t").cast("timestamp").alias("ts")))


def test_archive_scans_read_only_their_partitions(spark, log, tmp_path):
    path = str(tmp_path / "log")
    archive.append_partitioned(log, path, "dt", "hr")
    days = archive.read_days(spark, path, date(2017, 1, 8), date(2017, 1, 9))
    assert sorted(r["id"] for r in days.collect()) == [1, 2, 3]
    plan = days._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan

    as_of = datetime(2017, 1, 8, 0, 30)
    assert [r["id"] for r in archive.read_last_hour(spark, path, as_of).collect()] == [0]
    assert [r["id"] for r in archive.read_yesterday(spark, path, as_of).collect()] == [0]


def test_overwriting_partitions_does_not_duplicate_or_touch_others(spark, log, tmp_path):
    path = str(tmp_path / "log")
    archive.overwrite_partitions(log, path, "dt")
    archive.overwrite_partitions(log.where(F.col("id") == 1), path, "dt")
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [0, 1, 3]


def test_period_scan_floors_both_ends(spark, tmp_path):
    path = str(tmp_path / "keys")
    rows = [(date(2017, 1, 2), "a"), (date(2017, 1, 9), "b"), (date(2017, 1, 16), "c")]
    keys = spark.createDataFrame(rows, "period_start date, member_id string")
    archive.overwrite_partitions(keys, path, "period_start")
    got = archive.read_periods(spark, path, "week", date(2017, 1, 12), date(2017, 1, 15))
    assert [r["member_id"] for r in got.collect()] == ["b"]


def test_text_dump(spark, log, tmp_path):
    path = str(tmp_path / "dump")
    archive.write_text(log.select("id", "hr", F.lit(None).cast("string").alias("n")), path)
    assert sorted(r["value"] for r in spark.read.text(path).collect())[0] == "0\t23\t"


def test_jdbc_options():
    plain = jdbc.jdbc_options("jdbc:x", "t")
    assert plain == {"url": "jdbc:x", "dbtable": "t"}
    split = jdbc.jdbc_options("jdbc:x", "t", "id", (1, 100), 8, user="u")
    assert split["numPartitions"] == "8" and split["user"] == "u"
    with pytest.raises(ValueError):
        jdbc.jdbc_options("jdbc:x", "t", "id")


def test_dirty_event_times_are_counted_and_stop_nothing(spark):
    times = ['"1"', "5", '"99999999999999999"', "-99999999999999999", '"x"', '""', "null", "1e400"]
    lines = [f'{{"action": "a", "mtime": {t}}}' for t in times] + ["junk mtime", "", '{"action": "a"}']
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    assert sorted(r["mtime"] for r in app_events.parse_events(df).collect()) == ["1", "5"]
    assert sorted(r["mtime"] for r in app_events.parse_behaviour(df).collect()) == [1, 5]
    rejects = {r["reason"]: r["num"] for r in app_events.count_rejects(df).collect()}
    assert rejects["mtime is out of range"] == 2 and sum(rejects.values()) == len(lines) - 2
