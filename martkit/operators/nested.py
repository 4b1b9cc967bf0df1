"""Nested report payloads to flat rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from ..functions.casts import as_col
from ..functions.text import blank_to_null
from .dedup import first_wins

ACTION_SCHEMA = "array<struct<action_type:string,value:string>>"


@dataclass(frozen=True)
class Field:
    """One landed column: source path, name, type, value when it is missing."""

    path: str
    name: str
    dtype: str = "string"
    default: object = None


def flatten_report(df: DataFrame, fields: Sequence[Field], strict: bool = False) -> DataFrame:
    """Typed flat rows of a nested report (A2).

    ``strict`` raises on text that does not parse; otherwise it becomes the
    default. Paths absent from the payload schema also take the default.
    """
    present = set(_paths(df.schema))
    cols = []
    for f in fields:
        if f.path in present:
            c = F.col(f.path).cast(f.dtype) if strict else F.col(f.path).try_cast(f.dtype)
        else:
            c = F.lit(None).cast(f.dtype)
        if f.default is not None:
            c = F.coalesce(c, F.lit(f.default).cast(f.dtype))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _paths(schema, prefix: str = "") -> list[str]:
    out = []
    for field in schema:
        path = f"{prefix}{field.name}"
        out.append(path)
        if field.dataType.typeName() == "struct":
            out += _paths(field.dataType, path + ".")
    return out


def parse_actions(df: DataFrame, column: str) -> Column:
    """Action array, from JSON text when the column is a string."""
    c = F.col(column)
    return F.from_json(c, ACTION_SCHEMA) if isinstance(df.schema[column].dataType, StringType) else c


def _number(c: Column, strict: bool) -> Column:
    return c.cast("double") if strict else c.try_cast("double")


def sum_actions(actions: str | Column, strict: bool = False) -> Column:
    """Sum of all action values of a row, 0.0 for none."""
    return F.coalesce(
        F.aggregate(as_col(actions), F.lit(0.0),
                    lambda acc, x: acc + F.coalesce(_number(x["value"], strict), F.lit(0.0))),
        F.lit(0.0))


def explode_actions(df: DataFrame, actions: str = "actions", values: str = "action_values",
                    names: tuple[str, str, str] = ("conversion_action_name", "conversions", "conversion_value"),
                    duplicate: str = "first", missing: float | None = None, strict: bool = False) -> DataFrame:
    """One row per action with the value of the same type.

    Rows without actions vanish, actions without a type too. Among values of
    one type the ``first`` or ``last`` counts; ``missing`` replaces no value.
    Both arrays are parsed below the generator, once per row and not per action.
    The outer form is used because the inner one makes Spark add a size filter
    that parses the JSON a second time; rows without actions go in the filter.
    """
    position = {"first": 1, "last": -1}[duplicate]
    kind, count, value = names
    keep = [c for c in df.columns if c not in (actions, values)]
    unfolded = (df.withColumns({"_a": parse_actions(df, actions), "_v": parse_actions(df, values)})
                .select(*keep, "_v", F.explode_outer("_a").alias("_x"))
                .where(F.col("_x.action_type").isNotNull()))
    same = F.filter(F.col("_v"), lambda v: v["action_type"] == F.col("_x.action_type"))
    found = _number(F.try_element_at(same, F.lit(position))["value"], strict)
    if missing is not None:
        found = F.coalesce(found, F.lit(missing))
    return unfolded.select(*keep, F.col("_x.action_type").alias(kind), _number(F.col("_x.value"), strict).alias(count),
                           found.alias(value))


def resolve_creative(df: DataFrame) -> DataFrame:
    """Five creative texts from link, video and asset-feed structures.

    Empty text counts as missing. The first asset-feed element overrides
    headline, body and url even when it is NULL; the image only fills a gap.
    """
    link, video, feed = "object_story_spec.link_data", "object_story_spec.video_data", "asset_feed_spec"

    def text(path):
        return blank_to_null(F.col(path))

    def feed_first(items, leaf, otherwise):
        c = F.col(f"{feed}.{items}")
        return F.when(F.size(c) > 0, F.try_element_at(c, F.lit(1))[leaf]).otherwise(otherwise)

    first_image = F.try_element_at(F.col(f"{feed}.images"), F.lit(1))["url"]
    return df.withColumns({
        "headline": feed_first("titles", "text", F.coalesce(text(f"{video}.title"), text(f"{link}.name"))),
        "body": feed_first("bodies", "text", F.coalesce(text(f"{video}.message"), text(f"{link}.message"))),
        "destination_url": feed_first("link_urls", "website_url", F.coalesce(text(f"{link}.link"), F.col("url_tags"))),
        "call_to_action_type": F.coalesce(text("call_to_action_type"), text(f"{link}.call_to_action.type"),
                                          text(f"{video}.call_to_action.type")),
        "image_url": F.coalesce(text("image_url"), text("thumbnail_url"), text(f"{link}.picture"),
                                text(f"{video}.image_url"), blank_to_null(first_image)),
    })


def ad_assets(df: DataFrame, ad: str = "ad") -> DataFrame:
    """(ad_id, ad_type, final_urls, headlines, descriptions) by ad type."""
    kind = F.col(f"{ad}.type")
    empty = F.array().cast("array<string>")

    def texts(path):
        return F.coalesce(F.transform(F.col(f"{ad}.{path}"), lambda x: x["text"]), empty)

    def parts(*names):
        return F.array_compact(F.array(*[blank_to_null(F.col(f"{ad}.expanded_text_ad.{n}")) for n in names]))

    long_headline = F.array_compact(F.array(blank_to_null(F.col(f"{ad}.responsive_display_ad.long_headline.text"))))
    headlines = (F.when(kind == "RESPONSIVE_SEARCH_AD", texts("responsive_search_ad.headlines"))
                 .when(kind == "RESPONSIVE_DISPLAY_AD",
                       F.concat(texts("responsive_display_ad.headlines"), long_headline))
                 .when(kind == "EXPANDED_TEXT_AD", parts("headline_part1", "headline_part2", "headline_part3"))
                 .otherwise(empty))
    descriptions = (F.when(kind == "RESPONSIVE_SEARCH_AD", texts("responsive_search_ad.descriptions"))
                    .when(kind == "RESPONSIVE_DISPLAY_AD", texts("responsive_display_ad.descriptions"))
                    .when(kind == "EXPANDED_TEXT_AD", parts("description", "description2"))
                    .otherwise(empty))
    return df.select(F.col(f"{ad}.id").cast("string").alias("ad_id"), kind.alias("ad_type"),
                     F.coalesce(F.col(f"{ad}.final_urls"), empty).alias("final_urls"),
                     headlines.alias("headlines"), descriptions.alias("descriptions"))


def asset_display(text: str | Column, name: str | Column) -> Column:
    """Text of an asset, else its name."""
    return F.coalesce(blank_to_null(text), as_col(name))


def audience_dim(df: DataFrame, types: Sequence[str], order: Sequence[str],
                 key: str = "audience_criterion_id", kind: str = "audience_type") -> DataFrame:
    """Audiences of the listed types, one row per id."""
    return first_wins(df.where(F.col(kind).isin(list(types))), [key], order)


def actions_json(c: str | Column) -> Column:
    """Action array as JSON text, ``[]`` when missing."""
    return F.coalesce(F.to_json(as_col(c)), F.lit("[]"))
