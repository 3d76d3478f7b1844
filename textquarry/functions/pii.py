"""Masking of e-mail addresses, IPv4 addresses and phone numbers.

The patterns are our own plain definitions: linear to match, without nested
quantifiers, and free of look-around so other engines can repeat them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4 = rf"(^|[^0-9.]){_OCTET}(?:\.{_OCTET}){{3}}($|[^0-9])"

# Placeholders written into the published text.
EMAIL_MARK = "email@example.com"
IP_MARK = "<IP_ADDRESS>"
PHONE_MARK = "<PHONE_NUMBER>"

# Which numbering regions are searched for which language.
PHONE_REGIONS = {
    "fr": ["ZZ", "FR", "CA", "BE"],
    "de": ["ZZ", "DE"],
    "es": ["ZZ", "ES"],
    "ca": ["ZZ", "ES"],
    "it": ["ZZ", "IT"],
    "pt": ["ZZ", "PT"],
    "nl": ["ZZ", "NL"],
}
DEFAULT_REGIONS = ["ZZ"]

# Number shapes per region; ZZ is the international form with a country code.
PHONE_SHAPES = {
    "ZZ": r"\+[1-9][0-9 .()-]{7,17}[0-9]",
    "FR": r"0[1-9](?:[ .-]?[0-9]{2}){4}",
    "CA": r"(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[-. ])[2-9][0-9]{2}[-. ][0-9]{4}",
    "BE": r"0[1-9][0-9]?[ ./-][0-9]{2,3}(?:[ ./-][0-9]{2}){2}",
    "DE": r"0[1-9][0-9]{1,4}[ /-][0-9]{3,8}",
    "ES": r"[6789][0-9]{2}(?:[ .-]?[0-9]{3}){2}",
    "IT": r"(?:0[0-9]{1,3}|3[0-9]{2})[ .-][0-9]{5,8}",
    "PT": r"[29][0-9]{2}[ .-]?[0-9]{3}[ .-]?[0-9]{3}",
    "NL": r"0[1-9][0-9]?[ -]?[0-9]{7,8}",
}


def phone_pattern(regions: list[str]) -> str:
    return "(^|[^0-9+])(?:" + "|".join(PHONE_SHAPES[r] for r in regions) + ")($|[^0-9])"


def mask_email(text: Column) -> Column:
    # Most texts have no @ at all and need no pattern.
    return F.when(F.contains(text, F.lit("@")), F.regexp_replace(text, EMAIL, EMAIL_MARK)).otherwise(text)


def mask_ip(text: Column, mark: str = IP_MARK) -> Column:
    return F.when(text.rlike(r"[0-9]\.[0-9]"), F.regexp_replace(text, IPV4, f"$1{mark}$2")).otherwise(text)


def mask_phones(text: Column, language: Column) -> Column:
    """Mask the number shapes of the regions that belong to the row's language."""
    by_regions: dict[tuple[str, ...], list[str]] = {}
    for lang, regions in PHONE_REGIONS.items():
        by_regions.setdefault(tuple(regions), []).append(lang)

    def masked(regions: list[str]) -> Column:
        return F.regexp_replace(text, phone_pattern(list(regions)), f"$1{PHONE_MARK}$2")

    branches = reduce(
        lambda acc, item: (acc.when if acc is not None else F.when)(language.isin(*item[1]), masked(item[0])),
        by_regions.items(),
        None,
    )
    found = branches.otherwise(masked(DEFAULT_REGIONS))
    return F.when(text.rlike("[0-9]"), found).otherwise(text)


def mask_pii(df: DataFrame, text: str = "text", remove_ips: bool = True, ip_mark: str = IP_MARK) -> DataFrame:
    masked = mask_email(F.col(text))
    return df.withColumn(text, mask_ip(masked, ip_mark) if remove_ips else masked)


def mask_phone(df: DataFrame, text: str = "text", language: str = "lang") -> DataFrame:
    return df.withColumn(text, mask_phones(F.col(text), F.col(language)))
