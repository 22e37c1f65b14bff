"""Raw status JSON, as a public status feed delivers it, into the ``STATUS`` record (SRC1).

A raw status nests its hashtags and media in entity lists, writes dates as text
and its point as ``[latitude, longitude]`` (``geo``) or ``[longitude, latitude]``
(``coordinates``).  Fields that it lacks become null; absent reply and quote
ids become -1, as the record has them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from pulse.schema import STATUS, USER

# --- fixed values: names and formats of the raw record -----------------------
RAW_DATE = "MMM dd HH:mm:ss Z yyyy"  # after the day of the week and a space
_POINT = "struct<coordinates:array<double>>"
_PLACE = "struct<id:string,country:string,country_code:string,full_name:string,name:string,place_type:string,url:string>"
RAW_NAMES = {"profile_image_url": "profile_image_url_https"}  # where they differ from the record's
# -----------------------------------------------------------------------------


def _user_type() -> str:
    kinds = {"created_at": "string"}
    return "struct<" + ",".join(f"{RAW_NAMES.get(f.name, f.name)}:{kinds.get(f.name, f.dataType.simpleString())}" for f in USER.fields) + ">"


def raw_schema() -> T.StructType:
    """Schema of a raw line (needs a running session)."""
    inner = f"text:string,full_text:string,user:{_user_type()}"
    media = "array<struct<expanded_url:string>>"
    return T.StructType.fromDDL(
        f"""id bigint, created_at string, lang string, text string, full_text string, truncated boolean,
        possibly_sensitive boolean, favorite_count int, favorited boolean, retweet_count int, retweeted boolean,
        in_reply_to_screen_name string, in_reply_to_status_id bigint, in_reply_to_user_id bigint,
        quoted_status_id bigint, quoted_status struct<{inner}>, retweeted_status struct<{inner}>,
        entities struct<hashtags:array<struct<text:string>>>, extended_entities struct<media:{media}>,
        geo {_POINT}, coordinates {_POINT}, place {_PLACE}, user {_user_type()}"""
    )


def _date(text: Column) -> Column:
    """UTC wall clock of a raw date, or null."""
    return F.try_to_timestamp(F.substring(text, 5, 64), F.lit(RAW_DATE)).cast("timestamp_ntz")


def _text(at: str) -> Column:
    return F.coalesce(f"{at}full_text", f"{at}text")


def from_raw(raw: DataFrame) -> DataFrame:
    """Rows of ``raw_schema`` as status records; the session's zone must be UTC."""
    user = F.struct(
        *[
            (_date(F.col("user.created_at")) if f.name == "created_at" else F.col(f"user.{RAW_NAMES.get(f.name, f.name)}"))
            .cast(f.dataType)
            .alias(f.name)
            for f in USER.fields
        ]
    )
    latitude = F.coalesce(F.get("geo.coordinates", F.lit(0)), F.get("coordinates.coordinates", F.lit(1)))
    longitude = F.coalesce(F.get("geo.coordinates", F.lit(1)), F.get("coordinates.coordinates", F.lit(0)))
    texts = lambda c, field: F.coalesce(F.transform(c, lambda x: x[field]), F.array().cast("array<string>"))
    made = {
        "created_at": _date(F.col("created_at")),
        "text": _text(""),
        "quoted_status": F.when(F.col("quoted_status").isNotNull(), F.struct(_text("quoted_status.").alias("text"))),
        "retweeted_status": F.when(
            F.col("retweeted_status").isNotNull(),
            F.struct(
                _text("retweeted_status.").alias("text"),
                F.struct(F.col("retweeted_status.user.screen_name").alias("screen_name")).alias("user"),
            ),
        ),
        "hashtags": texts("entities.hashtags", "text"),
        "media": texts("extended_entities.media", "expanded_url"),
        "geo": F.when(latitude.isNotNull() & longitude.isNotNull(), F.struct(latitude.alias("latitude"), longitude.alias("longitude"))),
        "user": F.when(F.col("user").isNotNull(), user),
        **{c: F.coalesce(c, F.lit(-1)).cast("long") for c in ("in_reply_to_status_id", "in_reply_to_user_id", "quoted_status_id")},
    }
    extra = [c for c in raw.columns if c.startswith("_")]  # where a row came from
    return raw.select(*[made.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in STATUS.fields], *extra)
