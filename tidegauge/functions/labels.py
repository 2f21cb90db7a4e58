"""Classification of regions, clients and requests by fixed lists."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegauge.functions.text import request_target, url_param

# Region names and their report codes.
REGION_CODES = {
    "澳门": "aomen",
    "香港": "xianggang",
    "台湾": "taiwan",
    "广东": "guangdong",
    "广西": "guangxi",
    "海南": "hainan",
    "云南": "yunnan",
    "福建": "fujian",
    "江西": "jiangxi",
    "湖南": "hunan",
    "贵州": "guizhou",
    "浙江": "zhejiang",
    "安徽": "anhui",
    "上海": "shanghai",
    "江苏": "jiangsu",
    "湖北": "hubei",
    "西藏": "xizang",
    "青海": "qinghai",
    "陕西": "shanxi_shan",
    "山西": "shanxi_jin",
    "河南": "henan",
    "山东": "shandong",
    "河北": "hebei",
    "天津": "tianjin",
    "北京": "beijing",
    "宁夏": "ningxia",
    "内蒙古": "neimeng",
    "辽宁": "liaoning",
    "吉林": "jilin",
    "黑龙江": "heilongjiang",
    "重庆": "chongqing",
    "四川": "sichuan",
    "新疆": "xinjiang",
    "甘肃": "gansu",
    "局域网": "local",
}
ELSEWHERE = "haiwai"
LAN = "局域网"

# Client marks in a user agent, in order of preference.
CLIENT_MARKS = (("Android", "android"), ("iPhone", "ios"))

# Request paths that stand for an app, in order of preference.
APP_PATHS = (
    ("/rest/announce/getAnnounceList", "85"),
    ("/rest/message/folderNum", "55"),
    ("/rest/schedule/getUnreadList", "25"),
    ("/rest/doc/index", "50"),
    ("/rest/talk/getRecentTalkRecord", "185"),
    ("/rest/toutiao/getSubClasses", "165"),
    ("/rest/Yyfax/getYyfax.json", "900"),
)
# The path that names its app in a parameter.
APP_PARAM_PATH = "/rest/app/appOauth"
APP_PARAM = "app_id"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def region_code(
    region: Column | str,
    codes: Mapping[str, str] = REGION_CODES,
    default: str = ELSEWHERE,
) -> Column:
    """Report code of a region name; the map is a literal, so there is no join."""
    table = F.create_map(*[F.lit(text) for pair in codes.items() for text in pair])
    return F.coalesce(F.try_element_at(table, _col(region)), F.lit(default))


def client_class(user_agent: Column | str) -> Column:
    """``android``, ``ios`` or ''."""
    agent = _col(user_agent)
    chain = F
    for mark, client in CLIENT_MARKS:
        chain = chain.when(agent.contains(mark), client)
    return chain.otherwise("")


def app_of_request(request: Column | str) -> Column:
    """App id of a request; NULL when it belongs to none."""
    request = _col(request)
    chain = F
    for path, app_id in APP_PATHS:
        chain = chain.when(request.contains(path), app_id)
    named = url_param(request_target(request), APP_PARAM)
    return chain.when(request.contains(APP_PARAM_PATH), named)
