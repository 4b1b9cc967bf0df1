"""Silver and gold models on the driver tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from martkit.operators.editions import Editions, prepare_editions
from martkit.plans import gold, measures
from martkit.plans.build import Build
from martkit.plans.context import Context

from . import oracle
from .standins import CONTEXT, raw, workspace

Query = Callable[[SparkSession, str], DataFrame]
STOP_WORDS = ("the", "and", "for")


def editions(spark: SparkSession, sf: str) -> Editions:
    return prepare_editions(raw(spark, sf, "calendar"), CONTEXT.edition_rules, CONTEXT.window_days, CONTEXT.bound)


class Models(Build):
    """The build on stand-ins; one table stands for the two conversion reports of platform B."""

    def __init__(self, spark: SparkSession, sf: str, ctx: Context = CONTEXT):
        alias = {"b_age_gender_conversions": "b_events", "b_country": "b_events"}
        super().__init__(lambda name: raw(spark, sf, alias.get(name, name)), ctx)


def _silver(name: str) -> Query:
    # The 64-bit id has no counterpart in the oracle engine; its parts are compared.
    return lambda spark, sf: getattr(Models(spark, sf), name)().drop("id")


def campaign(spark: SparkSession, sf: str) -> DataFrame:
    return Models(spark, sf).campaign_mart().drop("unique_id")


def conversion(spark: SparkSession, sf: str) -> DataFrame:
    return Models(spark, sf).conversion_mart().drop("unique_id")


def ad(spark: SparkSession, sf: str) -> DataFrame:
    return Models(spark, sf).ad_mart().drop("unique_id")


def demographics(spark: SparkSession, sf: str) -> DataFrame:
    return Models(spark, sf).demographics_mart().drop("unique_id")


def geo(spark: SparkSession, sf: str) -> DataFrame:
    return Models(spark, sf).geo_mart().drop("unique_id")


def targeted_geo(spark: SparkSession, sf: str) -> DataFrame:
    return Models(spark, sf).targeted_geo_mart().drop("unique_id")


def phrases(spark: SparkSession, sf: str) -> DataFrame:
    return Models(spark, sf).phrases_mart().drop("id")


def words(spark: SparkSession, sf: str) -> DataFrame:
    def store(phrases: DataFrame) -> DataFrame:
        path = f"{workspace(spark)}/phrases"
        phrases.write.parquet(path)
        return spark.read.schema(phrases.schema).parquet(path)

    return gold.coded_word_mart(Models(spark, sf).phrase_parts(), STOP_WORDS, store)


def roi(spark: SparkSession, sf: str) -> DataFrame:
    df = Models(spark, sf).roi_mart()
    return df.withColumn("conversion_timestamp", F.unix_micros("conversion_timestamp"))


DIMS = ["year", "platform", "event_name"]


def financials(spark: SparkSession, sf: str) -> DataFrame:
    return measures.financials(Models(spark, sf).roi_mart(), DIMS)


def yoy(spark: SparkSession, sf: str) -> DataFrame:
    yearly = financials(spark, sf).select(*DIMS, "cost", "revenue")
    return measures.year_over_year(yearly, ["platform", "event_name"], ["cost", "revenue"])


def ytd(spark: SparkSession, sf: str) -> DataFrame:
    return measures.year_to_date(Models(spark, sf).roi_mart(), ["platform"], ["cost", "revenue"])


# Parts of the ids of models and marts, in the columns that their rows still have.
IDS = {"a_campaign": ["date", "campaign_id"], "a_conversion": ["date", "campaign_id", "conversion_action_id"],
       "a_performance": ["date", "ad_id", "coalesce(device, '')", "coalesce(ad_network_type, '')"],
       "a_search_terms": ["date", "campaign_id", "ad_group_id", "search_term"], "b_performance": ["date", "ad_id"]}
MART_IDS = {"campaign_mart": ("unique_id", ["date", "campaign_id"], oracle.mart_campaign),
            "phrases_mart": ("id", ["date", "event_edition", "platform", "campaign_id", "top_search_combinations"], oracle.mart_phrases)}


def model_ids(spark: SparkSession, sf: str) -> DataFrame:
    """The 64-bit ids are as many as the tuples of their parts, and missing exactly where a part is."""
    models, counts = Models(spark, sf), []
    for name, key in {**dict.fromkeys(IDS, "id"), **{n: key for n, (key, _, _) in MART_IDS.items()}}.items():
        counts.append(getattr(models, name)().agg(
            F.lit(name).alias("model"), F.count(F.lit(1)).alias("n_rows"), F.count_distinct(key).alias("n_ids"),
            F.count_if(F.col(key).isNull()).alias("n_missing")))
    return reduce(DataFrame.unionAll, counts)


def _ids_sql(model: str, parts: list[str], rows: str) -> str:
    there = " AND ".join(f"{p} IS NOT NULL" for p in parts)
    return (f"SELECT '{model}' AS model, count(*) AS n_rows, count(DISTINCT ({', '.join(parts)})) FILTER ({there}) AS n_ids, "
            f"count(*) FILTER (NOT ({there})) AS n_missing FROM ({rows})")


QUERIES: dict[str, Query] = {
    **{f"silver_{name}": _silver(name) for name in oracle.SILVER},
    "silver_crm": lambda spark, sf: Models(spark, sf).crm().withColumn(
        "conversion_timestamp", F.unix_micros("conversion_timestamp")),
    "mart_campaign": campaign, "mart_conversion": conversion, "mart_ad": ad, "mart_demographics": demographics,
    "mart_geo": geo, "mart_targeted_geo": targeted_geo, "mart_phrases": phrases, "mart_words": words,
    "model_ids": model_ids, "mart_roi": roi, "measures_financials": financials, "measures_yoy": yoy, "measures_ytd": ytd,
}
ORACLES: dict[str, str] = {
    **{f"silver_{name}": oracle.silver_sql(name) for name in oracle.SILVER},
    "silver_crm": oracle.statement(oracle.CRM_CTES, "SELECT * REPLACE (epoch_us(conversion_timestamp) "
                                                    "AS conversion_timestamp) FROM crm"),
    "mart_campaign": oracle.mart_campaign(), "mart_conversion": oracle.mart_conversion(),
    "mart_ad": oracle.mart_ad(), "mart_demographics": oracle.mart_demographics(), "mart_geo": oracle.mart_geo(),
    "mart_targeted_geo": oracle.mart_targeted_geo(), "mart_phrases": oracle.mart_phrases(),
    "model_ids": " UNION ALL ".join([*[_ids_sql(m, parts, oracle.silver_sql(m)) for m, parts in IDS.items()],
                                     *[_ids_sql(m, parts, sql()) for m, (_, parts, sql) in MART_IDS.items()]]),
    "mart_words": oracle.mart_words(), "mart_roi": oracle.mart_roi(),
    "measures_financials": oracle.measures_financials(), "measures_yoy": oracle.measures_yoy(),
    "measures_ytd": oracle.measures_ytd(),
}
