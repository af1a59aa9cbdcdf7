"""Column -> Column helpers: JSON payload access, strict casts, SQL macros.

All helpers return JVM-side expressions (no Python UDF), so they stay inside
whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INT_RE = r"^[+-]?[0-9]+$"
_FLOAT_RE = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --------------------------------------------------------------- JSON payload
def prop_raw(path: str, payload="properties") -> Column:
    """Sub-column read of a JSON payload; a missing path reads as '' (never NULL)."""
    return F.coalesce(F.get_json_object(c(payload), f"$.{path}"), F.lit(""))


def prop(path: str, payload="properties") -> Column:
    """Sub-column read with '' mapped to NULL (``nullIf(properties.x::String, '')``)."""
    return F.nullif(prop_raw(path, payload), F.lit(""))


def json_fields(keys, payload="properties") -> Column:
    """One parse of a JSON payload for several top-level keys: a struct of
    string fields, each holding the same text ``get_json_object`` returns for
    ``$.key`` (strings unquoted, other values as JSON text, NULL when missing
    or JSON null; keys match case-sensitively). Reading k fields costs one
    parse per row instead of k. For a key repeated inside one object the last
    occurrence wins."""
    from pyspark.sql.types import StringType, StructField, StructType
    return F.from_json(c(payload), StructType([StructField(k, StringType()) for k in keys]))


def field_raw(parsed: Column, key: str) -> Column:
    """``prop_raw`` over a ``json_fields`` struct: missing reads as ''."""
    return F.coalesce(parsed.getField(key), F.lit(""))


def field(parsed: Column, key: str) -> Column:
    """``prop`` over a ``json_fields`` struct: '' maps to NULL."""
    return F.nullif(field_raw(parsed, key), F.lit(""))


# ---------------------------------------------------------------- safe casts
def int_or_null(x, dtype: str = "int") -> Column:
    """Strict integer parse: digits only, anything else (incl. '1.5', '') -> NULL."""
    x = F.trim(c(x))
    return F.when(x.rlike(_INT_RE), x.try_cast(dtype))


def int_or_zero(x, dtype: str = "int") -> Column:
    return F.coalesce(int_or_null(x, dtype), F.lit(0).cast(dtype))


def float_or_null(x) -> Column:
    """Strict float parse (no 'd'/'f' suffixes, no blanks)."""
    x = c(x)
    return F.when(x.rlike(_FLOAT_RE), x.try_cast("double"))


def float_or_null_comma(x) -> Column:
    """Float parse that accepts a decimal comma ("145,93")."""
    return float_or_null(F.replace(c(x), F.lit(","), F.lit(".")))


def ts_or_null(x) -> Column:
    """Best-effort ISO-8601 timestamp parse; unparsable -> NULL."""
    x = c(x)
    return F.coalesce(
        F.try_to_timestamp(x, F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSS]XXX")),
        F.try_to_timestamp(x, F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSS]")),
        F.try_to_timestamp(x, F.lit("yyyy-MM-dd HH:mm:ss")),
        F.try_to_timestamp(x, F.lit("yyyy-MM-dd")),
    )


def bool_text(x) -> Column:
    """Case-insensitive 'true'/'false' -> 1/0, anything else NULL."""
    lx = F.lower(c(x))
    return F.when(lx == "true", F.lit(1)).when(lx == "false", F.lit(0))


# ------------------------------------------------------------------- macros
def version_parts(x) -> Column:
    """'a.b.c' -> struct(a, b, c) of ints, missing/non-numeric parts = 0."""
    x = F.coalesce(c(x), F.lit(""))
    return F.struct(*[int_or_zero(F.split_part(x, F.lit("."), F.lit(i))).alias(f"v{i}")
                      for i in (1, 2, 3)])


def version_gte(x, ver: str) -> Column:
    """Semantic (not lexical) version compare: '1.0.9' < '1.0.22'."""
    a, b, cc = (int(p) for p in ver.split("."))
    return version_parts(x) >= F.struct(F.lit(a).alias("v1"), F.lit(b).alias("v2"),
                                        F.lit(cc).alias("v3"))


def lifetime_bucket(days) -> Column:
    d = c(days)
    return (F.when(d.isNull(), "(unknown)").when(d == 0, "D00").when(d <= 3, "D01-03")
            .when(d <= 7, "D04-07").when(d <= 14, "D08-14").when(d <= 30, "D15-30")
            .otherwise("D31+"))


def lifetime_order(days) -> Column:
    d = c(days)
    return (F.when(d.isNull(), 99).when(d == 0, 0).when(d <= 3, 1).when(d <= 7, 2)
            .when(d <= 14, 3).when(d <= 30, 4).otherwise(5))


# Raw game spend source -> business category (must equal the
# reference's grouping; first matching category wins, else 'Other').
SPEND_CATEGORIES = [
    ("Gacha / Supply", ["AdventurerSupplyBox", "LegendarySupplyBox", "Chests", "ReleaseOfSpirits",
                        "ReleaseOfSpirits_RandomChest", "RoulettePackShop", "Roulette"]),
    ("Revive", ["Revive"]),
    ("Pet", ["Pets", "PetBuild"]),
    ("Energy / Resources", ["PurchaseEnergy", "BuyResourcePanel", "BuyResource"]),
    ("Shop / Pass", ["ShopPacks", "ShopSoftPacks", "ChapterPacks", "BattlePass", "7DaysMonetization"]),
    ("Cosmetics", ["Skins_Unlock", "TakeAllSkills"]),
    ("Progression", ["ChapterRewards", "Star", "Bestiary", "Spider Hollow", "Pirate Hoard", "AFKReward",
                     "Tasks", "TalentFund", "Roadmap"]),
    ("Daily / Login", ["DailyBenefits", "LoginReward"]),
    ("Rewards / Refresh", ["DoubleReward", "AdsDoubleReward", "LuckyRefresh"]),
    ("Cheats / Test", ["Cheats"]),
]


def spend_category(src) -> Column:
    s = c(src)
    out = None
    for name, members in SPEND_CATEGORIES:
        out = (F.when(s.isin(members), name) if out is None
               else out.when(s.isin(members), name))
    return out.otherwise("Other")


# ISO country code -> display name (fallback: the code itself).
COUNTRY_NAMES = {
    "PH": "Philippines", "GB": "United Kingdom", "US": "United States", "AU": "Australia",
    "SG": "Singapore", "ID": "Indonesia", "BR": "Brazil", "HK": "Hong Kong", "FR": "France",
    "IN": "India", "UA": "Ukraine", "TR": "Turkey", "DE": "Germany", "RU": "Russia",
    "VN": "Vietnam", "CN": "China", "CA": "Canada", "ZA": "South Africa",
    "AE": "United Arab Emirates", "AT": "Austria", "DZ": "Algeria", "JO": "Jordan", "IR": "Iran",
    "RO": "Romania", "EG": "Egypt", "HU": "Hungary", "CZ": "Czechia", "TH": "Thailand",
    "AL": "Albania", "PL": "Poland", "IQ": "Iraq", "KH": "Cambodia", "MA": "Morocco",
    "CO": "Colombia", "KR": "South Korea", "JP": "Japan", "ES": "Spain", "SA": "Saudi Arabia",
    "CR": "Costa Rica", "BG": "Bulgaria", "GR": "Greece", "IT": "Italy", "MD": "Moldova",
    "MM": "Myanmar", "NZ": "New Zealand", "EC": "Ecuador", "LY": "Libya", "MN": "Mongolia",
    "TT": "Trinidad and Tobago", "IE": "Ireland", "MX": "Mexico", "NI": "Nicaragua",
    "AZ": "Azerbaijan", "FI": "Finland",
}


def country_name(code) -> Column:
    """ISO code -> name through a literal map (a constant, evaluated in codegen)."""
    m = F.create_map(*[F.lit(x) for kv in COUNTRY_NAMES.items() for x in kv])
    return F.coalesce(F.try_element_at(m, c(code)), c(code))


def safe_div(a, b) -> Column:
    """a / nullIf(b, 0)."""
    return F.try_divide(c(a), F.nullif(c(b), F.lit(0)))


def days_between(a, b) -> Column:
    """Whole days from a to b (date - date)."""
    return F.datediff(c(b), c(a))


def seconds_between(a, b) -> Column:
    """Second-boundary difference, as ``dateDiff('second', a, b)``."""
    return F.unix_seconds(c(b).cast("timestamp")) - F.unix_seconds(c(a).cast("timestamp"))


def millis_between(a, b) -> Column:
    return F.unix_millis(c(b).cast("timestamp")) - F.unix_millis(c(a).cast("timestamp"))


def monday(d) -> Column:
    return F.to_date(F.date_trunc("week", c(d)))


def money_sum(x) -> Column:
    """Exact sum of money amounts: summed as DECIMAL micro-units, returned as DOUBLE.

    A float sum depends on the (partition-dependent) addition order; rounding
    such a sum to 2-4 digits can flip on ties. Summing fixed-point values is
    associative, so the rounded figure no longer depends on partitioning.
    """
    return money_total(c(x).cast("decimal(24,6)"))


def money_part(x) -> Column:
    """``money_sum`` of a part of the rows, still as DECIMAL; ``money_total`` sums the parts."""
    return F.sum(c(x).cast("decimal(24,6)"))


def money_total(part) -> Column:
    return F.sum(c(part)).cast("double")
