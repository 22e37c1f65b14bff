"""Projections: ids, points, tags and the wide place / user / status rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pulse.functions.time import created_at_text
from pulse.schema import USER
from pulse.settings import MISSING_LATITUDE, MISSING_LONGITUDE


def status_ids(statuses: DataFrame) -> DataFrame:
    """The status id."""
    return statuses.select("id")


def geo_points(statuses: DataFrame, as_float: bool = True, carry: tuple = ()) -> DataFrame:
    """P3 (after F4): id, longitude, latitude.  The result table stores floats."""
    lon, lat = F.col("geo.longitude"), F.col("geo.latitude")
    if as_float:
        lon, lat = lon.cast("float"), lat.cast("float")
    return statuses.select("id", lon.alias("longitude"), lat.alias("latitude"), *carry)


def hashtags(statuses: DataFrame, keep: tuple[str, ...] = ("id",)) -> DataFrame:
    """P5: one row per hashtag, lower-cased; repeats inside a status are kept.

    ``pos`` is the hashtag's place in its status, so repeats stay distinct.
    """
    cols = list(keep)
    return statuses.select(
        *cols, F.posexplode(F.transform("hashtags", lambda t: F.lower(t))).alias("pos", "tag")
    )


def place_rows(statuses: DataFrame, keep_placeless: bool = True, carry: tuple = ()) -> DataFrame:
    """The 7-column place row.

    A status without a place yields a row keyed by its own id as text when
    ``keep_placeless`` (the reference's behaviour, D6); otherwise it is dropped.
    ``carry`` appends extra columns (e.g. an order for upserts).
    """
    src = statuses if keep_placeless else statuses.where(F.col("place").isNotNull())
    return src.select(
        F.coalesce(F.col("place.id"), F.col("id").cast("string")).alias("id"),
        F.col("place.country").alias("country"),
        F.col("place.country_code").alias("country_code"),
        F.col("place.full_name").alias("full_name"),
        F.col("place.name").alias("name"),
        F.col("place.place_type").alias("place_type"),
        F.col("place.url").alias("url"),
        *carry,
    )


def no_bounding_box() -> Column:
    """The place table's bounding box, which no job fills."""
    return F.lit(None).cast("struct<coords:array<string>,kind:string>").alias("bounding_box")


USER_COLUMNS = tuple(USER.fieldNames())


def user_rows(statuses: DataFrame, text_form: bool = True, carry: tuple = ()) -> DataFrame:
    """The 22-column user row.

    ``text_form`` renders ``created_at`` as Java date text and the withheld
    country array joined by commas, as the result table stores them (D5).
    """
    cols = []
    for c in USER_COLUMNS:
        col = F.col(f"user.{c}")
        if text_form and c == "created_at":
            col = created_at_text(col)
        elif text_form and c == "withheld_in_countries":
            col = F.array_join(col, ",")
        cols.append(col.alias(c))
    return statuses.select(*cols, *carry)


def status_rows(statuses: DataFrame, text_form: bool = True, carry: tuple = ()) -> DataFrame:
    """The 22-column status row.

    A missing geo becomes the out-of-range sentinels 181 / 91 (D7); nested
    quoted and retweeted texts are lifted; arrays become comma-joined text in
    ``text_form``.
    """
    has_geo = F.col("geo").isNotNull()
    lon = F.when(has_geo, F.col("geo.longitude")).otherwise(F.lit(MISSING_LONGITUDE))
    lat = F.when(has_geo, F.col("geo.latitude")).otherwise(F.lit(MISSING_LATITUDE))
    tags, media = F.col("hashtags"), F.col("media")
    created = F.col("created_at")
    if text_form:
        tags, media = F.array_join(tags, ","), F.array_join(media, ",")
        created = created_at_text(created)
    return statuses.select(
        "id",
        lon.cast("float").alias("longitude"),
        lat.cast("float").alias("latitude"),
        created.alias("created_at"),
        tags.alias("entities"),
        media.alias("extended_entities"),
        "favorite_count",
        "favorited",
        "in_reply_to_screen_name",
        "in_reply_to_status_id",
        "in_reply_to_user_id",
        "lang",
        F.col("place.id").alias("place_id"),
        "possibly_sensitive",
        F.col("quoted_status.text").alias("quoted_status"),
        "quoted_status_id",
        "retweet_count",
        "retweeted",
        F.col("retweeted_status.text").alias("retweeted_status"),
        "text",
        "truncated",
        F.col("user.id").alias("user_id"),
        *carry,
    )


def created_at_texts(statuses: DataFrame) -> DataFrame:
    """Id and the date-time text."""
    return statuses.select("id", created_at_text(F.col("created_at")).alias("created_at_text"))


def as_text(rows: DataFrame) -> DataFrame:
    """Stored user or status rows in text form: Java date text, arrays joined by commas."""
    out = {}
    for name, kind in rows.dtypes:
        if kind == "timestamp_ntz":
            out[name] = created_at_text(F.col(name))
        elif kind == "array<string>":
            out[name] = F.array_join(name, ",")
    return rows.withColumns(out) if out else rows
