"""Schemas of the nested status record and of the lexicon."""

from pyspark.sql import types as T

PLACE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("country_code", T.StringType()),
        T.StructField("full_name", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("place_type", T.StringType()),
        T.StructField("url", T.StringType()),
    ]
)

USER = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("contributors_enabled", T.BooleanType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("default_profile", T.BooleanType()),
        T.StructField("default_profile_image", T.BooleanType()),
        T.StructField("description", T.StringType()),
        T.StructField("favourites_count", T.IntegerType()),
        T.StructField("follow_request_sent", T.BooleanType()),
        T.StructField("followers_count", T.IntegerType()),
        T.StructField("friends_count", T.IntegerType()),
        T.StructField("geo_enabled", T.BooleanType()),
        T.StructField("lang", T.StringType()),
        T.StructField("listed_count", T.IntegerType()),
        T.StructField("location", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("profile_image_url", T.StringType()),
        T.StructField("protected", T.BooleanType()),
        T.StructField("screen_name", T.StringType()),
        T.StructField("statuses_count", T.IntegerType()),
        T.StructField("url", T.StringType()),
        T.StructField("verified", T.BooleanType()),
        T.StructField("withheld_in_countries", T.ArrayType(T.StringType())),
    ]
)

GEO = T.StructType(
    [
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
    ]
)

QUOTED = T.StructType([T.StructField("text", T.StringType())])

RETWEETED = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("user", T.StructType([T.StructField("screen_name", T.StringType())])),
    ]
)

# The nested status record.  Event time stays TIMESTAMP_NTZ (UTC wall clock)
# in batch; streams cast it to TIMESTAMP for watermarks.
STATUS = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("lang", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("truncated", T.BooleanType()),
        T.StructField("possibly_sensitive", T.BooleanType()),
        T.StructField("favorite_count", T.IntegerType()),
        T.StructField("favorited", T.BooleanType()),
        T.StructField("retweet_count", T.IntegerType()),
        T.StructField("retweeted", T.BooleanType()),
        T.StructField("in_reply_to_screen_name", T.StringType()),
        T.StructField("in_reply_to_status_id", T.LongType()),
        T.StructField("in_reply_to_user_id", T.LongType()),
        T.StructField("quoted_status_id", T.LongType()),
        T.StructField("quoted_status", QUOTED),
        T.StructField("retweeted_status", RETWEETED),
        T.StructField("hashtags", T.ArrayType(T.StringType())),
        T.StructField("media", T.ArrayType(T.StringType())),
        T.StructField("geo", GEO),
        T.StructField("place", PLACE),
        T.StructField("user", USER),
    ]
)

LEXICON = T.StructType(
    [
        T.StructField("word", T.StringType()),
        T.StructField("score", T.IntegerType()),
    ]
)
