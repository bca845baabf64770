"""Value classification by alias lists and ordered substring rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Group -> spellings that belong to it (all lower case).
TRAFFIC_SOURCES = {
    "google": ["google", "youtube.com", "youtube", "google.com"],
    "meta": [
        "meta", "facebook", "facebook.com", "l.facebook.com", "lm.facebook.com",
        "m.facebook.com", "instagram", "instagram.com", "l.instagram.com",
    ],
    "tiktok": ["tiktok", "tiktok.com"],
    "rtbhouse": ["rtbhouse", "tradedoubler", "awin", "tradedesk"],
    "criteo": ["criteo", "dv360", "taboola"],
    "twitter": ["twitter", "twitter.com"],
}
MEDIUM_CATEGORIES = {
    "Organic": ["organic"],
    "Paid Search": ["cpc", "ppc", "paid"],
    "Social": ["social", "social-network", "social-media"],
    "Email": ["email", "newsletter"],
    "Display": ["display", "banner"],
    "Referral": ["affiliate", "referral"],
    "Video": ["video"],
    "Direct": ["(none)", "direct"],
    "Push": ["push", "notification"],
    "SMS": ["sms", "text"],
}
DEVICE_TYPES = {
    "Mobile": ["mobile", "smartphone", "phone"],
    "Tablet": ["tablet", "ipad"],
    "Desktop": ["desktop", "computer", "pc", "mac"],
    "Connected TV": ["tv", "smart tv", "connected tv"],
}
AD_CHANNELS = {
    "Search": ["google ads", "bing ads", "yahoo ads"],
    "Paid Social": [
        "facebook", "instagram", "twitter", "linkedin", "tiktok", "snapchat", "pinterest",
    ],
    "DSP": ["google display", "programmatic", "dsp", "demand side platform"],
    "Video": ["youtube", "video", "connected tv", "ctv"],
    "Retail Media": ["amazon", "walmart", "marketplace"],
    "Email": ["email", "newsletter"],
}
# Ordered (substrings, label) rules, first hit wins.
BROWSERS = (
    (["chrome"], "Chrome"),
    (["safari"], "Safari"),
    (["firefox"], "Firefox"),
    (["edge"], "Edge"),
    (["internet explorer", "ie"], "Internet Explorer"),
    (["opera"], "Opera"),
)
OPERATING_SYSTEMS = (
    (["windows"], "Windows"),
    (["mac", "osx"], "macOS"),
    (["ios"], "iOS"),
    (["android"], "Android"),
    (["linux"], "Linux"),
)


def alias_group(value: Column, groups: Mapping[str, Sequence[str]], default: Column) -> Column:
    """Group whose alias list holds the (lower-cased) value, else `default`."""
    out = None
    for group, aliases in groups.items():
        hit = value.isin(list(aliases))
        out = F.when(hit, group) if out is None else out.when(hit, group)
    return out.otherwise(default)


def substring_group(
    value: Column, rules: Sequence[tuple[Sequence[str], str]], default: Column
) -> Column:
    """Label of the first rule with a substring found in the lower-cased value."""
    low = F.lower(value)
    out = None
    for needles, label in rules:
        hit = low.contains(needles[0])
        for needle in needles[1:]:
            hit = hit | low.contains(needle)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(default)


def traffic_source(raw: Column) -> Column:
    """Known spellings folded into one source name; anything else passes unchanged."""
    return alias_group(F.lower(F.trim(raw)), TRAFFIC_SOURCES, raw)


def medium_category(medium: Column) -> Column:
    return alias_group(F.lower(medium), MEDIUM_CATEGORIES, F.lit("Other"))


def device_type(category: Column) -> Column:
    return alias_group(F.lower(category), DEVICE_TYPES, F.lit("Other"))


def ad_channel(platform: Column, groups: Mapping[str, Sequence[str]] | None = None) -> Column:
    return alias_group(F.lower(platform), groups or AD_CHANNELS, F.lit("Other"))


def browser(raw: Column) -> Column:
    return substring_group(raw, BROWSERS, F.coalesce(raw, F.lit("Unknown")))


def operating_system(raw: Column) -> Column:
    return substring_group(raw, OPERATING_SYSTEMS, F.coalesce(raw, F.lit("Unknown")))


def customer_state(is_plus: Column, orders: Column) -> Column:
    """Premium for plus members, else by number of orders."""
    return (
        F.when(is_plus, "Premium Customer")
        .when(orders >= 5, "Loyal Customer")
        .when(orders >= 2, "Repeat Customer")
        .otherwise("New Customer")
    )
