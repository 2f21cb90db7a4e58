"""The driver's tables seen as access log, raw lines, app events and dimensions.

Facts are column arithmetic on ``events``. Dimensions come from ``customer``,
``nation``, ``region`` and ``part``. The oracles restate the same rules in SQL.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions.ids import scramble_number
from tidegauge.functions.labels import APP_PARAM_PATH, APP_PATHS, LAN
from tidegauge.functions.timebuckets import DAY, bucket, time_text, utc_instant
from tidegauge.operators.joins import lookup
from tidegauge.operators.metrics import fold
from tidegauge.sources.access_log import render_line
from tidegauge.sources.app_events import render_event

SITES = {
    "view": "esn",
    "click": "api",
    "purchase": "h5-api",
    "signup": "m",
    "error": "openapi",
}
# One region name is left out on purpose, to be counted under the default code.
AREA_CODES = {
    "AFRICA": "africa",
    "AMERICA": "america",
    "ASIA": "asia",
    "EUROPE": "europe",
}
ANDROID = "Mozilla/5.0 (Linux; Android 7.0) Mobile"
IPHONE = "Mozilla/5.0 (iPhone; CPU iPhone OS 10_2) Mobile"
DESKTOP = "Mozilla/5.0 (X11; Linux x86_64)"
PUBLIC_NET = "public"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _number() -> Column:
    return F.get_json_object("props", "$.k").try_cast("int")


def _text(c: Column) -> Column:
    return c.cast("string")


def as_hits(events: DataFrame) -> DataFrame:
    """Typed access log, one row per event, without the enterprise."""
    pairs = [F.lit(text) for pair in SITES.items() for text in pair]
    site = F.try_element_at(F.create_map(*pairs), F.col("event_type"))
    user, k = F.col("user_id"), F.col("k")
    ip = F.concat_ws(
        ".", F.lit("10"), _text(F.expr("user_id div 256")), _text(user % 256), _text(k % 8)
    )
    agent = F.when(user % 3 == 0, ANDROID).when(user % 3 == 1, IPHONE).otherwise(DESKTOP)
    bytes_text = F.when(k % 17 == 0, "-").otherwise(_text(F.floor(F.col("value") * 100)))
    return events.withColumn("k", _number()).select(
        "event_id",
        utc_instant("ts").alias("ts"),
        site.alias("site"),
        ip.alias("ip"),
        user.alias("custkey"),
        F.when(k % 10 != 0, _text(user)).alias("member_id"),
        _text(user % 20).alias("qz_id"),
        _text(user).alias("user_id"),
        (k % 25 != 1).alias("has_org"),
        F.when(k == 99, LAN).otherwise(PUBLIC_NET).alias("net"),
        bytes_text.alias("bytes_sent"),
        agent.alias("user_agent"),
        "event_type",
        "value",
        "k",
    )


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_hits(table(spark, sf_dir, "events"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per user with the enterprise."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("custkey"),
        _text(F.col("c_nationkey")).alias("org"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_nationkey").alias("nationkey"),
    )


def located_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users with country and region; ``nation`` and ``region`` have 25 and 5 rows at every scale."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    areas = nation.join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("nationkey"),
        F.col("n_name").alias("country"),
        F.col("r_name").alias("region"),
    )
    return users(spark, sf_dir).join(F.broadcast(areas), "nationkey", "left")


def with_org(df: DataFrame, people: DataFrame) -> DataFrame:
    """Adds ``instance_id`` by ``custkey``; fold first, so the join sees few rows."""
    found = lookup(df, people.select("custkey", "org"), "custkey", "org", unique=True)
    return found.withColumn("instance_id", F.when(F.col("has_org"), F.col("org"))).drop("org")


def with_area(df: DataFrame, people: DataFrame) -> DataFrame:
    return lookup(df, people.select("custkey", "region"), "custkey", "region", unique=True)


def org_hits(log: DataFrame, people: DataFrame, unit: str, *dims: str) -> DataFrame:
    """Hits folded per bucket, user and ``dims``, then joined to their enterprise."""
    keys = dict.fromkeys(("custkey", "has_org", "member_id", *dims))
    return with_org(fold(log, unit, *keys), people)


def dealt(people: DataFrame) -> DataFrame:
    """Users over all shuffle tasks. Their file is small enough for one task, and the rows made of each user are
    not: without this, that task would sort them all."""
    return people.repartition(int(people.sparkSession.conf.get("spark.sql.shuffle.partitions")), "custkey")


def sessions(people: DataFrame) -> DataFrame:
    """``(kind, token)`` to ids. Some users have no session of one kind or the other."""
    key = _text(F.col("custkey"))
    digest = F.md5(key)
    ids = (
        key.alias("member_id"),
        _text(F.col("custkey") % 20).alias("qz_id"),
        key.alias("user_id"),
        F.col("org").alias("instance_id"),
    )
    cookie = people.where(F.col("balance") >= 0).select(
        F.lit("esn").alias("kind"), F.substring(digest, 1, 26).alias("token"), *ids
    )
    token = people.where(F.col("segment") != "BUILDING").select(
        F.lit("api").alias("kind"),
        F.concat(digest, F.substring(digest, 1, 8)).alias("token"),
        *ids,
    )
    return cookie.unionByName(token)


def geo(people: DataFrame) -> DataFrame:
    """``ip`` to country, region and city: seven of each user's eight addresses, one a LAN."""
    ends = people.select("*", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("x"))
    ip = F.concat_ws(
        ".",
        F.lit("10"),
        _text(F.expr("custkey div 256")),
        _text(F.col("custkey") % 256),
        _text(F.col("x")),
    )
    country = F.when(F.col("x") == 6, LAN).otherwise(F.col("country"))
    return ends.select(
        ip.alias("ip"), country.alias("country"), "region", F.col("segment").alias("city")
    )


GENERATIONS = 4


def _generations(people: DataFrame, days: int) -> DataFrame:
    """Every user four times, each ``days`` after the one before, from a time of the day of their own."""
    each = people.select("*", F.explode(F.sequence(F.lit(0), F.lit(GENERATIONS - 1))).alias("g"))
    start = int(datetime(2024, 1, 1, tzinfo=timezone.utc).timestamp())
    begun = F.lit(start) + F.col("g") * days * DAY + F.col("custkey") * 7919 % DAY
    return each.withColumn("since", F.timestamp_seconds(begun))


def session_history(people: DataFrame) -> DataFrame:
    """``(kind, token, since, until)`` to ids: a token changes hands every eight days. Those of even users
    end a day before that."""
    runs = _generations(people, 8)
    over = F.col("since") + F.make_dt_interval(F.lit(7))
    until = F.when(F.col("custkey") % 2 == 0, over).alias("until")
    owner = sessions(people).withColumn("custkey", F.col("user_id").cast("bigint"))
    when = runs.select("custkey", "g", "since", until)
    # Rows that are generated here are many more than the file's size lets Spark expect, so none are broadcast.
    held = owner.join(when.hint("merge"), "custkey")
    return held.withColumns(
        {"member_id": F.concat_ws("-", "member_id", "g"), "user_id": F.concat_ws("-", "user_id", "g")}
    ).drop("custkey", "g")


def geo_history(people: DataFrame) -> DataFrame:
    """``(ip, since)`` to country, region and city: each address moves to another city every ten days."""
    places = geo(people.withColumn("segment", F.concat_ws("/", "segment", F.col("custkey").cast("string"))))
    parts = F.split("city", "/")
    owned = places.withColumns({"city": parts[0], "custkey": parts[1].cast("bigint")})
    when = _generations(people, 10).select("custkey", "g", "since")
    held = owned.join(when.hint("merge"), "custkey")  # never broadcast, as above
    return held.withColumn("city", F.concat_ws("-", "city", "g")).drop("custkey", "g")


def timed_payments(log: DataFrame, people: DataFrame) -> DataFrame:
    """``(instance_id, start, end, total_fee)`` in times: a signup pays from its instant on for some hours
    and seconds, every twentieth without an end."""
    fee = F.when(F.col("k") % 5 == 0, F.lit(0.0)).otherwise(F.col("value"))
    signups = log.where((F.col("event_type") == "signup") & F.col("has_org"))
    hours, seconds = (F.col("k") % 9 + 1) * 6, F.col("k")
    end = F.when(F.col("k") % 20 != 3, F.col("ts") + F.make_dt_interval(F.lit(0), hours, F.lit(0), seconds))
    own = signups.select("custkey", "has_org", F.col("ts").alias("start"), end.alias("end"), fee.alias("total_fee"))
    found = with_org(own, people).where(F.col("instance_id").isNotNull())
    return found.select("instance_id", "start", "end", "total_fee")


def payments(log: DataFrame, people: DataFrame) -> DataFrame:
    """``(instance_id, start, end, total_fee)``: a signup pays for its day and seven more."""
    fee = F.when(F.col("k") % 5 == 0, F.lit(0.0)).otherwise(F.col("value"))
    signups = log.where((F.col("event_type") == "signup") & F.col("has_org"))
    per_user = (
        signups.groupBy(bucket("ts", "day").alias("start"), "custkey", "has_org")
        .agg(F.max(fee).alias("total_fee"))
    )
    per_org = (
        with_org(per_user, people)
        .where(F.col("instance_id").isNotNull())
        .groupBy("instance_id", "start")
        .agg(F.max("total_fee").alias("total_fee"))
    )
    end = (F.col("start") + F.lit(7 * DAY)).alias("end")
    return per_org.select("instance_id", "start", end, "total_fee")


# --- raw lines -----------------------------------------------------------------


# Request targets by k % 20: app routes, pages with promotion codes, assets, token routes.
TARGETS = [
    *[path for path, _ in APP_PATHS],
    f"{APP_PARAM_PATH}?app_id=<k>&v=1",
    f"{APP_PARAM_PATH}?v=1",
    "/p/index.htm?r=c<k>",
    "/p/index.htm?r=",
    "/p/index.htm?x=1&r=p<k>&y=2",
    "/s/app.js",
    "/s/site.css?v=2",
    "/i/logo.png",
    "/rest/feed/list?access_token=<token>",
    "/rest/feed/list?token=<token>",
    "/rest/feed/list?v=1&token=<token>&w=2",
    "/rest/feed/list",
    "/rest/feed/list?token=a/b",
]


def _request(k: Column, token: Column) -> Column:
    template = F.get(F.array(*map(F.lit, TARGETS)), k % 20)
    target = F.replace(template, F.lit("<k>"), _text(k))
    target = F.replace(target, F.lit("<token>"), token)
    return F.concat(F.lit("GET "), target, F.lit(" HTTP/1.1"))


def _scrambled(number: Column) -> Column:
    return F.coalesce(scramble_number(number.try_cast("int")), F.lit(""))


def _open_ids(k: Column, user: Column) -> Column:
    """Scrambled ids; every ninth has a part missing, every ninth a broken id."""
    qz = F.concat(F.lit("qz_id="), _scrambled(user % 20))
    org = F.concat(F.lit("&instance_id="), _scrambled(k))
    member = F.when(k % 9 == 5, "12a").otherwise(_scrambled(user))
    last = F.when(k % 9 == 4, "").otherwise(F.concat(F.lit("&member_id="), member))
    return F.concat(F.lit('"'), qz, org, last, F.lit('"'))


def as_lines(log: DataFrame) -> DataFrame:
    """Raw access lines. Rows with k = 98 come in four variants, three of them broken:

    1 lacks the last field, 2 has two empty last fields, 3 has an unreadable time.
    """
    k, user = F.col("k"), F.col("custkey")
    digest, token = F.col("digest"), F.concat("digest", F.substring("digest", 1, 8))
    args = (
        F.when(
            k % 3 == 0,
            F.concat(
                F.lit(r"{\x22v\x22:\x221\x22,\x22access_token\x22:\x22"), token, F.lit(r"\x22}")
            ),
        )
        .when(k % 3 == 1, "-")
        .otherwise(r"{\x22token\x22:}")
    )
    cookie = (
        F.when(
            (F.col("site") == "esn") & (k % 7 != 6),
            F.concat(F.lit("PHPSESSID="), F.substring(digest, 1, 26), F.lit("; path=/")),
        )
        .when(F.col("site") == "openapi", _open_ids(k, user))
        .otherwise("-")
    )
    wall = time_text("ts", "dd/MMM/yyyy:HH:mm:ss")
    good_time = F.concat(F.lit("["), wall, F.lit(" +0000]"))
    fields = {
        "remote_addr": F.col("ip"),
        "remote_user": F.lit("-"),
        "server_addr": F.concat(F.lit("192.168.1."), _text(user % 4)),
        "site": F.col("site"),
        "connection": F.col("event_id"),
        "connection_requests": k,
        "request_length": k + 100,
        "time_local": good_time,
        "msec": (F.unix_millis("ts") / 1000).cast("decimal(17,3)"),
        "request": _request(k, token),
        "request_args": args,
        "status": F.when(k % 20 == 0, 404).otherwise(200),
        "body_bytes_sent": F.floor(F.col("value") * 100),
        "bytes_sent": F.col("bytes_sent"),
        "http_referer": F.lit("-"),
        "http_user_agent": F.col("user_agent"),
        "http_x_forwarded_for": F.lit("-"),
        "request_time": F.concat(F.lit("0."), F.lpad(_text(k), 3, "0")),
        "upstream_response_time": F.when(k % 13 == 0, "-").otherwise("0.001"),
        "sent_http_set_cookie": cookie,
    }
    whole = F.col("whole")
    broken = F.array(
        whole,
        F.substring_index(whole, "\t", 19),
        F.concat(F.substring_index(whole, "\t", 18), F.lit("\t\t")),
        F.regexp_replace(whole, r"\[[^\]]*\]", "[broken]"),
    )
    copies = F.when(k == 98, broken).otherwise(F.array(whole))
    # Generated rows, because Spark would copy a plain column's whole expression into filters.
    digested = log.withColumn("digest", F.md5(F.col("user_id")))
    return digested.select("k", render_line(fields).alias("whole")).select(
        F.explode(copies).alias("value")
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_lines(hits(spark, sf_dir))


# --- app events ----------------------------------------------------------------


def as_app_events(log: DataFrame) -> DataFrame:
    """App events as JSON text; the enterprise is arithmetic on the user, not a join."""
    k = F.col("k")
    org = F.when(F.col("has_org"), _text(F.col("custkey") % 25))
    app_id = F.when(k % 10 == 3, F.concat(F.lit("-"), _text(k))).otherwise(_text(k))
    fields = {
        "action": F.col("event_type"),
        "app_id": app_id,
        "client_ip": F.col("ip"),
        "instance_id": org,
        "member_id": F.col("member_id"),
        "mtime": F.unix_millis("ts"),
        "qz_id": F.col("qz_id"),
        "user_id": F.col("user_id"),
        "ver_code": F.col("event_id"),
        "object_id": k % 7,
    }
    # Generated rows again, so that the text is made once and not again inside each filter.
    return log.select(F.explode(F.array(render_event(fields))).alias("value"))


def app_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_app_events(hits(spark, sf_dir))


def _known_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as apps: every ninth is unknown, every fourth has no open id."""
    open_appid = F.when(F.col("p_partkey") % 4 == 0, "0").otherwise(_text(F.col("p_size")))
    part = table(spark, sf_dir, "part").where(F.col("p_partkey") % 9 != 5)
    return part.withColumn("open_appid", open_appid)


def apps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """App dimension, one row per app_id."""
    return _known_parts(spark, sf_dir).select(
        _text(F.col("p_partkey")).alias("app_id"), "open_appid", F.col("p_name").alias("name")
    )


def app_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surrogate keys given out so far: to the economy apps without an open id."""
    given = (F.col("open_appid") == "0") & (F.col("p_type") == "ECONOMY")
    return _known_parts(spark, sf_dir).where(given).select(
        (F.col("p_partkey") + 1).alias("rpid"),
        _text(F.col("p_partkey")).alias("app_id"),
        "open_appid",
        F.col("p_name").alias("name"),
    )
