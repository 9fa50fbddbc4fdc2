"""Fixed values the results depend on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Merchant -> category; any other merchant is 'other'.
MERCHANT_CATEGORY = {
    "Grab": "transport",
    "Shopee": "ecommerce",
    "VinMart": "grocery",
    "MoMo": "fintech",
    "Tiki": "ecommerce",
    "Highlands": "food",
    "Circle K": "grocery",
    "ZaloPay": "fintech",
    "VNPay": "fintech",
    "Lazada": "ecommerce",
}
OTHER_CATEGORY = "other"

# Country -> (latitude, longitude); any other country is (0, 0).
COUNTRY_CENTROID = {
    "VN": (14.0583, 108.2772),
    "US": (37.0902, -95.7129),
    "SG": (1.3521, 103.8198),
    "JP": (36.2048, 138.2529),
    "KR": (35.9078, 127.7669),
    "CN": (35.8617, 104.1954),
    "TH": (15.8700, 100.9925),
    "MY": (4.2105, 101.9758),
    "AU": (-25.2744, 133.7751),
    "GB": (55.3781, -3.4360),
}

# ISO alpha-2 -> alpha-3.
COUNTRY_ALPHA3 = {
    "VN": "VNM",
    "US": "USA",
    "SG": "SGP",
    "JP": "JPN",
    "KR": "KOR",
    "CN": "CHN",
    "TH": "THA",
    "MY": "MYS",
    "AU": "AUS",
    "GB": "GBR",
}

# Heatmap row order, Monday first.
DAY_NAMES = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]

# Accepted device and currency codes.
DEVICES = ["mobile", "web", "pos"]
CURRENCIES = ["VND"]


def lookup(key: Column, table: dict, default=None) -> Column:
    """``table[key]`` as a constant-map expression: no join, no shuffle.

    A key outside the table gives ``default``.  The tables above have ten entries each; use a
    broadcast join for lookups that come from data.
    """
    entries = [F.lit(x) for pair in table.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*entries), key), F.lit(default))
