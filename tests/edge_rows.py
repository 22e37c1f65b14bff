"""Hand-made status records for edge cases (FIXTURES.md §6)."""

from __future__ import annotations

import datetime as dt

from pulse.schema import STATUS

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def user(uid: int, screen_name: str | None = None, followers: int = 10) -> dict:
    return {
        "id": uid,
        "contributors_enabled": False,
        "created_at": dt.datetime(2020, 1, 1),
        "default_profile": True,
        "default_profile_image": False,
        "description": None,
        "favourites_count": 1,
        "follow_request_sent": False,
        "followers_count": followers,
        "friends_count": 2,
        "geo_enabled": True,
        "lang": "en",
        "listed_count": 3,
        "location": None,
        "name": f"Name {uid}",
        "profile_image_url": f"https://img.example.com/{uid}",
        "protected": False,
        "screen_name": screen_name or f"User_{uid}",
        "statuses_count": 5,
        "url": None,
        "verified": False,
        "withheld_in_countries": [],
    }


def place(pid: str = "p1", country_code: str | None = "US") -> dict:
    return {
        "id": pid,
        "country": "AMERICA",
        "country_code": country_code,
        "full_name": "Somewhere, AMERICA",
        "name": "Somewhere",
        "place_type": "city",
        "url": f"https://place.example.com/{pid}",
    }


def status(sid: int, **kw) -> dict:
    row = {
        "id": sid,
        "created_at": T0 + dt.timedelta(minutes=sid),
        "lang": "en",
        "text": "",
        "truncated": False,
        "possibly_sensitive": False,
        "favorite_count": 0,
        "favorited": False,
        "retweet_count": 0,
        "retweeted": False,
        "in_reply_to_screen_name": None,
        "in_reply_to_status_id": -1,
        "in_reply_to_user_id": -1,
        "quoted_status_id": -1,
        "quoted_status": None,
        "retweeted_status": None,
        "hashtags": [],
        "media": [],
        "geo": None,
        "place": None,
        "user": user(sid % 3),
    }
    row.update(kw)
    return row


def retweet_of(name: str, text: str = "orig") -> dict:
    return {"text": text, "user": {"screen_name": name}}


def edge_statuses() -> list[dict]:
    return [
        status(1, place=None, hashtags=["Alpha"]),  # null place
        status(2, place=place(country_code=None), hashtags=["Alpha"]),  # null country code
        status(3, place=place(), hashtags=["Alpha", "ALPHA", "beta"]),  # mixed case, repeat
        status(4, place=place(), hashtags=[]),  # no hashtags
        status(5, lang=None, place=place(), hashtags=["gamma"]),  # null language
        status(6, geo={"latitude": 10.5, "longitude": -20.25}),
        status(7, geo=None),
        status(8, retweeted_status=retweet_of("BTS_TWT")),  # other case
        status(9, retweeted_status=retweet_of("someone")),
        status(10, text=""),  # empty text
        status(11, text="that, with commas, this"),
        status(12, text="that\nwith"),  # newline joins two words: no match
        status(13, text="that! this"),  # punctuation stuck to a word
        status(14, text="Eriner rely that"),  # both test tracks
        status(15, text="That THAT that"),  # duplicate lexicon word: first score wins
    ]


def edge_df(spark):
    return spark.createDataFrame(edge_statuses(), STATUS)
