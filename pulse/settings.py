"""Job settings and the fixed values that must equal the reference's.

The reference hard-codes its language, country, watched account and keyword
tracks; here they are defaults of plain typed arguments.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values (reference defaults) -------------------------------------
DEFAULT_LANG = "en"
DEFAULT_COUNTRY_CODE = "US"
DEFAULT_ACCOUNT = "bts_twt"
TRACK_A_KEYWORDS = ("communism", "putin", "russia")
TRACK_B_KEYWORDS = ("trump", "realdonaldtrump", "maga", "potus")
MISSING_LONGITUDE = 181.0
MISSING_LATITUDE = 91.0
PREVIEW_ROWS = 100
WIDE_TABLES_INTERVAL = "1 second"  # the wide-table program's own micro-batch
# Java's Date.toString layout, printed for a UTC wall clock.
CREATED_AT_PATTERN = "EEE MMM dd HH:mm:ss 'UTC' yyyy"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class JobSettings:
    """Typed replacement for the reference's properties file."""

    run_seconds: int = 60  # <= 0: run until stopped
    interval: str = "10 seconds"
    out_path: str | None = None
    lexicon_path: str | None = None
    account: str = DEFAULT_ACCOUNT
    lang: str = DEFAULT_LANG
    country_code: str = DEFAULT_COUNTRY_CODE
    track_a: tuple[str, ...] = field(default=TRACK_A_KEYWORDS)
    track_b: tuple[str, ...] = field(default=TRACK_B_KEYWORDS)
    source_format: str = "parquet"  # or "json" (records) or "raw" (raw statuses)
    files_per_trigger: int | None = None  # None: all new files in one micro-batch
    state_partitions: int | None = None  # None: the session's shuffle partitions
    bad_lines: str = "FAILFAST"  # or "PERMISSIVE": a JSON line that is no status
