"""Record shaping: projections, keyed records, label joins, parent/child joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import payloads as P, values as V


def allow_list(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Declared columns that are there, in declared order; absent ones stay absent."""
    return df.select(*[F.col(f"`{c}`") for c in columns if c in df.columns])


def fixed_list(df: DataFrame, columns: Mapping[str, T.DataType] | Sequence[str]) -> DataFrame:
    """Every listed column; absent ones are NULL."""
    typed = columns if isinstance(columns, Mapping) else {c: T.StringType() for c in columns}
    return df.select(*[F.col(f"`{c}`") if c in df.columns else F.lit(None).cast(t).alias(c)
                       for c, t in typed.items()])


# Nested report paths and the flat columns they land in.
FIELD_MAPS: dict[str, dict[str, str]] = {
    "campaigns": {
        "campaign_id": "campaign.id",
        "campaign_name": "campaign.name",
        "status": "campaign.status",
        "advertising_channel_type": "campaign.advertisingChannelType",
        "budget_amount_micros": "campaignBudget.amountMicros",
    },
    "campaign_daily_stats": {
        "date": "segments.date",
        "campaign_id": "campaign.id",
        "campaign_name": "campaign.name",
        "impressions": "metrics.impressions",
        "clicks": "metrics.clicks",
        "cost_micros": "metrics.costMicros",
        "conversions": "metrics.conversions",
        "conversions_value": "metrics.conversionsValue",
    },
    "ad_group_daily_stats": {
        "date": "segments.date",
        "campaign_id": "campaign.id",
        "campaign_name": "campaign.name",
        "ad_group_id": "adGroup.id",
        "ad_group_name": "adGroup.name",
        "status": "adGroup.status",
        "impressions": "metrics.impressions",
        "clicks": "metrics.clicks",
        "cost_micros": "metrics.costMicros",
        "conversions": "metrics.conversions",
        "conversions_value": "metrics.conversionsValue",
    },
    "ad_daily_stats": {
        "date": "segments.date",
        "campaign_id": "campaign.id",
        "campaign_name": "campaign.name",
        "ad_group_id": "adGroup.id",
        "ad_group_name": "adGroup.name",
        "ad_id": "adGroupAd.ad.id",
        "status": "adGroupAd.status",
        "impressions": "metrics.impressions",
        "clicks": "metrics.clicks",
        "cost_micros": "metrics.costMicros",
        "conversions": "metrics.conversions",
        "conversions_value": "metrics.conversionsValue",
    },
    "keyword_daily_stats": {
        "date": "segments.date",
        "campaign_id": "campaign.id",
        "campaign_name": "campaign.name",
        "ad_group_id": "adGroup.id",
        "ad_group_name": "adGroup.name",
        "criterion_id": "adGroupCriterion.criterionId",
        "keyword_text": "adGroupCriterion.keyword.text",
        "keyword_match_type": "adGroupCriterion.keyword.matchType",
        "impressions": "metrics.impressions",
        "clicks": "metrics.clicks",
        "cost_micros": "metrics.costMicros",
        "conversions": "metrics.conversions",
        "conversions_value": "metrics.conversionsValue",
    },
}


def flatten(records: DataFrame, fields: Mapping[str, str], customer_id: Column,
            keep: Sequence[str] = ()) -> DataFrame:
    """Nested records to flat VARIANT columns plus the account they were asked for."""
    return records.select(*keep, customer_id.alias("customer_id"), *P.pick(fields))


def stamp_account(df: DataFrame, accounts: DataFrame, on: str) -> DataFrame:
    """Left join of per-account ``timezone_name`` and UTC offset; a bad offset is NULL.

    ``accounts`` holds one row per account.  It stays a plain join: Spark broadcasts
    it when it is measured to be small.
    """
    offset = V.lenient_float(F.col("timezone_offset_hours_utc").cast("string"))
    name = F.nullif(F.col("timezone_name"), F.lit(""))
    right = accounts.select(on, name.alias("timezone_name"), offset.alias("timezone_offset_hours_utc"))
    return df.join(right, on, "left")


def label_measures(df: DataFrame, body: str, pulled_at: datetime, keep: Sequence[str] = ()) -> DataFrame:
    """Charts to long rows: each entry of ``values`` with its measure's label.

    The label is looked up by position inside the same payload, so nothing is joined
    or shuffled.  Entries without a cohort are dropped.
    """
    parsed = df.select(*keep, F.parse_json(F.col(body)).alias("__v"))
    text = lambda v, step: F.nullif(P.get(v, [step], "string"), F.lit(""))
    fallback = lambda i: F.concat(F.lit("measure_"), i.cast("string"))
    labels = F.transform(P.as_list(F.col("__v"), ["measures"]),
                         lambda m, i: F.coalesce(text(m, "display_name"), text(m, "name"), fallback(i)))
    # Its own projection: labels are looked up once per payload, not once per entry.
    labelled = parsed.select(*keep, "__v", labels.alias("__labels"))
    rows = labelled.select(*keep, "__labels", F.explode(P.as_list(F.col("__v"), ["values"])).alias(P.RECORD))
    value = lambda step, type: P.get(F.col(P.RECORD), [step], type)
    entries = rows.select(*keep, "__labels", value("cohort", "bigint").alias("__cohort"),
                          F.coalesce(value("measure", "bigint"), F.lit(0)).alias("__index"),
                          value("value", "double").alias("value"),
                          value("incomplete", "boolean").alias("incomplete"))
    index = F.col("__index")
    named = F.when(index >= 0, F.try_element_at(F.col("__labels"), (index + 1).cast("int")))
    return entries.filter("__cohort IS NOT NULL").select(
        *keep,
        V.seconds_to_date(F.col("__cohort")).alias("cohort_date"),
        F.coalesce(named, fallback(index)).alias("measure_name"),
        "value",
        F.coalesce("incomplete", F.lit(False)).alias("incomplete"),
        F.lit(pulled_at).cast("timestamp").alias("pulled_at"))


def _truthy(col: Column) -> Column:
    return F.coalesce(col.cast("string") != "", F.lit(False))


def keyed(df: DataFrame, key: Sequence[str], extracted_at: datetime,
          account: str = "account_id", prefix: str = "act_") -> DataFrame:
    """Keyable rows only: ids as text, the account prefix stripped, the time stamped."""
    rows = df.filter(reduce(and_, [_truthy(F.col(k)) for k in key]))
    ids = {k: F.col(k).cast("string") for k in key if k.endswith("_id")}
    ids[account] = F.regexp_replace(F.col(account).cast("string"), f"^{prefix}", "")
    return rows.withColumns({**ids, "extracted_at": F.lit(extracted_at).cast("timestamp")})


def unkeyable(key: Sequence[str]) -> Column:
    """Aggregate: rows that ``keyed`` drops."""
    return F.count_if(reduce(or_, [~_truthy(F.col(k)) for k in key]))


def hourly(df: DataFrame, breakdown: str, extracted_at: datetime) -> DataFrame:
    """Hourly rows: the range's first hour, the raw range kept, the breakdown dropped."""
    hour = V.hour_of_range(F.col(breakdown))
    rows = df.withColumn("hour", hour).filter(F.col("hour").isNotNull())
    rows = keyed(rows, ["date_start", "account_id", "campaign_id"], extracted_at)
    return rows.withColumnRenamed(breakdown, "hour_range")


# The dimensions and metrics of a network report.
DIMENSIONS = ("app", "source", "os", "platform", "country_field", "adn_campaign_id", "adn_campaign_name")
INT_METRICS = ("adn_impressions", "custom_clicks", "custom_installs")
FLOAT_METRICS = ("adn_cost",)
COHORT_METRIC, COHORT_PERIOD = "revenue", "actual"


def network_record(df: DataFrame, agency: str | None = None) -> DataFrame:
    """Raw report rows (all text) to merge-safe records; rows without a date are dropped."""
    day = F.substring(F.coalesce(F.col("start_date"), F.lit("")), 1, 10)
    columns = [day.alias("date")]
    if agency is not None:
        columns.append(F.lit(agency).alias("agency"))
    columns += [V.key_text(F.col(d)).alias(d) for d in DIMENSIONS]
    columns += [V.lenient_int(F.col(m)).alias(m) for m in INT_METRICS]
    columns += [V.lenient_float(F.col(m)).alias(m) for m in FLOAT_METRICS]
    columns.append(V.period_value(F.col(COHORT_METRIC), COHORT_PERIOD).alias(COHORT_METRIC))
    return df.select(*columns).filter(F.col("date") != "")


# --------------------------------------------------------------------------
# subscriptions: parent and child payloads


def customer_record(records: DataFrame) -> DataFrame:
    """Customer payloads to their six columns; times arrive in epoch milliseconds."""
    text = lambda step: P.get(F.col(P.RECORD), [step], "string").alias(step)
    time = lambda step: V.millis_to_timestamp(P.get(F.col(P.RECORD), [step], "bigint")).alias(step)
    return records.select(text("id"), time("first_seen_at"), time("last_seen_at"),
                          text("last_seen_app_version"), text("last_seen_country"),
                          text("last_seen_platform"))


def subscription_record(children: DataFrame, parents: DataFrame, parent_of_page: str) -> DataFrame:
    """Subscription payloads joined to the customer whose page they came from.

    ``children`` carries the page's customer id in ``parent_of_page``; the record's own
    customer id wins where it has one.  The join is an inner one on the parent id:
    pages exist only for known parents.
    """
    at = lambda steps, type="string": P.get(F.col(P.RECORD), steps, type)
    time = lambda step: V.millis_to_timestamp(at([step], "bigint")).alias(step)
    plain = lambda step: at([step]).alias(step)
    rows = children.select(
        F.col(parent_of_page).alias("__parent"),
        plain("id"), F.coalesce(F.nullif(at(["customer_id"]), F.lit("")), F.col(parent_of_page)).alias("customer_id"),
        plain("product_id"), plain("status"),
        at(["gives_access"], "boolean").alias("gives_access"),
        plain("auto_renewal_status"), plain("store"), plain("store_subscription_identifier"),
        time("current_period_starts_at"), time("current_period_ends_at"),
        at(["total_revenue_in_usd", "gross"], "double").alias("total_revenue_gross_usd"),
        at(["total_revenue_in_usd", "proceeds"], "double").alias("total_revenue_proceeds_usd"))
    seen = parents.select(F.col("id").alias("__parent"), F.col("last_seen_at").alias("customer_last_seen_at"))
    joined = rows.join(seen, "__parent")
    order = rows.columns[1:3] + ["customer_last_seen_at"] + rows.columns[3:]
    return joined.select(*order)
