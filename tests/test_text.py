import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidegauge.functions import ids, labels, text
from tidegauge.operators.enrich import open_numbers, valid_ip


def test_int_or_zero(column):
    values = ["12", "1.3", "-", None, "", " 12 ", "-5", "+5", "99999999999", "2147483647"]
    assert column(text.int_or_zero("c"), values) == [12, 0, 0, 0, 0, 0, -5, 5, 0, 2147483647]


def test_field_count_drops_empty_fields_at_the_end(column):
    assert column(text.field_count("c"), ["a\tb\t\t", "a\tb", "\ta", ""]) == [2, 2, 2, 1]


def test_request_target(column):
    values = ["GET /a?b=1 HTTP/1.1", "GET /a", "GET /a ", "", None]
    assert column(text.request_target("c"), values) == ["/a?b=1", "", "", "", None]


@pytest.mark.parametrize(
    "url, expected",
    [
        ("/a?token=x", "x"),
        ("/a?b=1&token=x&c=2", "x"),
        ("/a?token=&b=1", None),
        ("/a?token=x=y", None),
        ("/a?token=x=y&token=z", "z"),
        ("/a?token=x==", "x"),
        ("/a?mytoken=x", None),
        ("/a?b=1#token=x", None),
        ("/a?b=1&token=x#frag", "x"),
        ("/a/token=x", None),
        ("/a?token=first&token=second", "first"),
        ("/a?x=|\"{&token=t", "t"),
        ("/a?u=http://h?token=x&token=y", "y"),
        ("", None),
        (None, None),
    ],
)
def test_url_param(column, url, expected):
    assert column(text.url_param("c", "token"), [url]) == [expected]


def test_url_param_head_takes_the_first_parameter_as_it_is(column):
    urls = ["/p.htm?r=a", "/p.htm?r=", "/p.htm?r=a=b", "/p.htm?x=1&r=c&r=d", "/p.htm?bar=1"]
    assert column(text.url_param_head("c", "r"), urls) == ["a", None, "a", "c", None]


def test_session_cookie(column):
    cookies = ["PHPSESSID=abc123; path=/", "PHPSESSID=; path=/", "-", "x; PHPSESSID=abc", None]
    assert column(text.session_cookie("c"), cookies) == ["abc123", None, None, None, None]


def test_args_token(column):
    args = [
        r"{\x22v\x22:\x221\x22,\x22access_token\x22:\x22abc\x22}",
        '{"token":"abc","v":"1"}',
        r"{\x5C\x22token\x5C\x22:\x5C\x22abc\x5C\x22}",
        '{"token":""}',
        '{"a":"1"}',
        '{"token":"a:b"}',
        "-",
        None,
    ]
    assert column(text.args_token("c"), args) == ["abc", "abc", "abc"] + [None] * 5


def test_usable_token(column):
    assert column(text.is_usable_token("c"), ["a", "a/b", "a\\b", None]) == [True, False, False, None]


def test_patterns(column):
    line = "10.1.2.3 x 300.1.1.1 PHPSESSID=abcdefghijklmnopqrstuvwx12; token=" + "a1" * 20
    assert column(text.first_match("c", text.IPV4), [line, "1.2.3"]) == ["10.1.2.3", None]
    assert column(text.first_match("c", text.SESSION_26), [line]) == [
        "PHPSESSID=abcdefghijklmnopqrstuvwx12"
    ]
    assert column(text.first_match("c", text.TOKEN_40), [line]) == ["token=" + "a1" * 20]
    colon = "token:" + "a1" * 20
    assert column(text.first_match("c", text.TOKEN_40_COLON), [colon, "token:a1"]) == [colon, None]


def test_words(column):
    assert column(text.words("c"), ["a  b\nc ", "", None]) == [["a", "b", "c"], [], None]


GOLDEN = {
    "77295200": "2910809",
    "80298882": "79991",
    "78136078": "88511",
    "68175624": "385503",
}


def test_id_codec_known_values(column):
    assert column(ids.descramble("c"), list(GOLDEN)) == list(GOLDEN.values())
    assert column(ids.scramble("c"), list(GOLDEN.values())) == list(GOLDEN)


def test_id_codec_rejects_what_is_no_number(column):
    assert column(ids.descramble("c"), ["", "12a", "-5", "2147483648", None]) == [None] * 5


@settings(max_examples=5, deadline=None)
@given(values=st.lists(st.integers(0, 2**31 - 1), min_size=50, max_size=50))
def test_id_codec_round_trip(spark, values):
    # The top bit of a scrambled id is that of the id, so it stays non-negative.
    df = spark.createDataFrame([(str(v),) for v in values], "c string")
    back = df.select(ids.descramble(ids.scramble("c")).alias("r"))
    assert [row["r"] for row in back.collect()] == [str(v) for v in values]


def test_open_ids_need_three_parts(column):
    three = '"qz_id=80298882&instance_id=78136078&member_id=68175624"'
    two = '"qz_id=80298882&instance_id=78136078"'
    broken = '"qz_id=80298882&instance_id=78136078&member_id=12a"'
    member = ids.descramble_number(open_numbers("c")["member_id"])
    qz = ids.descramble_number(open_numbers("c")["qz_id"])
    assert column(member, [three, two, broken, "-", None]) == ["385503", None, None, None, None]
    assert column(qz, [three, two, broken, "-", None]) == ["79991", None, "79991", None, None]


def test_region_codes(column):
    names = ["四川", "陕西", "山西", "局域网", "Paris", None]
    assert column(labels.region_code("c"), names) == [
        "sichuan",
        "shanxi_shan",
        "shanxi_jin",
        "local",
        "haiwai",
        "haiwai",
    ]
    assert len({*labels.REGION_CODES.values(), labels.ELSEWHERE}) == 36


def test_client_class(column):
    agents = ["x Android y", "iPhone", "Android iPhone", "X11", None]
    assert column(labels.client_class("c"), agents) == ["android", "ios", "android", "", ""]


def test_app_of_request(column):
    requests = {
        "GET /rest/doc/index?app_id=9 HTTP/1.1": "50",
        "GET /rest/Yyfax/getYyfax.json HTTP/1.1": "900",
        "GET /rest/app/appOauth?x=1&app_id=77 HTTP/1.1": "77",
        "GET /rest/app/appOauth?app_id= HTTP/1.1": None,
        "GET /rest/app/appOauth?app_id=77": None,
        "GET / HTTP/1.1": None,
        "": None,
    }
    assert column(labels.app_of_request("c"), list(requests)) == list(requests.values())


def test_valid_ip(column):
    good = ["1.2.3.4", "2001:0db8:85a3:0000:0000:8a2e:0370:7334", "::1", "::", "fe80::1%eth0", "::ffff:10.0.0.1"]
    bad = ["", "1" * 15, "1.2.3", "unknown", "a:b", "10:30", None]
    assert column(valid_ip("c"), good + bad) == good + [None] * len(bad)


def test_bytes_or_zero_holds_large_responses(column):
    values = ["3000000000", "-1", "x", "", None, "99999999999999999999"]
    assert column(text.bytes_or_zero("c"), values) == [3_000_000_000, -1, 0, 0, 0, 0]


def test_expressions_stay_in_the_jvm(spark):
    df = spark.createDataFrame([("x",)], "c string").select(
        text.args_token("c"), labels.app_of_request("c"), ids.descramble("c"), F.lit(1)
    )
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
