"""Labels derived from source attributes. Each rule list is read top to bottom, first hit wins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Channel, sub-channel and KPI names as the marketing source spells them.
OWNED_CHANNELS = ("App Organic", "Web Direct", "Email", "Other", "Paid Display", "Referral", "Paid Other")
FOLDED_CHANNELS = ("Email", "Other", "Paid Display", "Referral", "Paid Other")
PAID_CHANNELS = ("Web - Paid Search", "Web - Paid Social", "App - Paid Search", "App - Paid Social", "Affiliates")
DISPLAY_CHANNELS = ("Paid Display", "Paid Social", "Display", "Social")
LOWER_FUNNEL_SUB_CHANNELS = ("Apple Search", "Google", "Google UAC")
LOWER_FUNNEL_SOURCES = ("apple_search", "adwords")
VOLUME_KPIS = ("Installs", "New Customers", "Clicks", "Sales")
INCREMENTAL_KPIS = (
    "Incremental Gross Sales EUR", "Incremental Gross Sales GBP", "Incremental Gross Sales",
    "Incremental New Customers", "Incremental Spend EUR",
)
LAST_CLICK_KPIS = (
    "Spend", "Spend GBP", "Spend EUR", "Impressions", "Visits", "Last Click New Customers",
    "Last Click Total Transactions", "Last Click Net Sales GBP", "Last Click Net Sales EUR",
    "Last Click Marketing Spend GBP", "Last Click Marketing Spend EUR", "Last Click Gross Sales GBP",
    "Last Click Gross Sales EUR", "Last Click Transactions Tracked",
)


def first_match(rules: list[tuple[Column, Column | str]], default: Column | str | None) -> Column:
    """CASE built from ``(condition, label)`` pairs."""
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    chain = reduce(lambda acc, rule: acc.when(rule[0], as_col(rule[1])), rules, F)
    return chain if default is None else chain.otherwise(as_col(default))


def channel_category(kpi: Column, channel: Column) -> Column:
    organic_search = (channel == "Organic Search") & ~kpi.isin(*VOLUME_KPIS)
    return first_match(
        [
            (channel.isin(*OWNED_CHANNELS) | organic_search, "Organic Last Click"),
            (kpi.isin(*INCREMENTAL_KPIS), "Paid Incremental"),
            (kpi.isin(*LAST_CLICK_KPIS), "Paid Last Click"),
        ],
        "Other",
    )


def channel_sub_category(
    kpi: Column, channel: Column, sub_channel: Column, channel_source: Column, device: Column
) -> Column:
    installs = kpi == "Installs"
    in_app = F.coalesce(F.lower(device) == "app", F.lit(False)) | (F.lower(channel) == "app")
    lower_funnel = F.coalesce(sub_channel.isin(*LOWER_FUNNEL_SUB_CHANNELS), F.lit(False)) | F.coalesce(
        channel_source.isin(*LOWER_FUNNEL_SOURCES), F.lit(False)
    )
    app_lower, app_mid = F.lit("Paid App Lower Funnel"), F.lit("Paid App Mid Funnel")
    return first_match(
        [
            ((channel == "Organic Search") & ~kpi.isin(*VOLUME_KPIS), sub_channel),
            (channel == "App Organic", "App - Organic"),
            (channel == "Web Direct", "Web - Direct"),
            (channel.isin(*FOLDED_CHANNELS), "Other"),
            (channel.isin(*PAID_CHANNELS), channel),
            (in_app, F.when(lower_funnel, app_lower).otherwise(app_mid)),
            (channel == "Paid Search", F.when(installs, app_lower).otherwise("Web Lower Funnel")),
            (channel.isin(*DISPLAY_CHANNELS), F.when(installs, app_mid).otherwise("Web Mid Funnel")),
            (channel == "Brand", "Brand"),
        ],
        "Other",
    )


def payback_category(channel: Column) -> Column:
    return F.when(channel.isin("Organic Search", *OWNED_CHANNELS), "Organic Last Click").otherwise("Paid Last Click")


def payback_sub_category(channel: Column, sub_channel: Column) -> Column:
    return first_match(
        [
            (channel == "App Organic", "App - Organic"),
            (channel == "Web Direct", "Web - Direct"),
            (channel == "Organic Search", sub_channel),
            (channel.isin(*PAID_CHANNELS), channel),
            (channel.isin(*FOLDED_CHANNELS), "Other"),
        ],
        "Others",
    )


def journey_type(product_pl: Column, region: Column, train_class: Column, train_speed: Column) -> Column:
    uk = F.coalesce((product_pl == "UK") | (region == "UK"), F.lit(False))
    return F.coalesce(F.when(uk, train_class).otherwise(train_speed), F.lit("unknown"))


def journey_class(train_class: Column, travel_class: Column) -> Column:
    return first_match(
        [
            ((train_class == "long distance") & ~travel_class.isin("Commuting", "Business"), "Leisure and Long Distance"),
            ((train_class == "regional") & (travel_class == "Commuting"), "Commute and Regional"),
        ],
        None,
    )


# Spellings the hotel partner uses and the lookup's spelling of the same country.
COUNTRY_NAME_REPAIRS = {
    "korea, south": "korea, republic of",
    "abkhazia": "georgia",
    "congo (brazzaville)": "congo - brazzaville",
    "bonaire, saint eustatius and saba": "caribbean netherlands",
    "wallis and futuna islands": "france",
    "united states minor outlying islands": "united states",
    "congo (kinshasa)": "congo - kinshasa",
    "svalbard and jan mayen islands": "svalbard & jan mayen",
}
COUNTRY_CODE_REPAIRS = {"XY": "CY"}


def repaired(value: Column, repairs: dict[str, str]) -> Column:
    return first_match([(value == wrong, right) for wrong, right in repairs.items()], value)


def plan_region(region: Column) -> Column:
    return repaired(region, {"ROE": "RoE", "ROW": "Inbound", "Unknown": "France"})
