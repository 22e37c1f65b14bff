"""Command line: run one of the seven apps on a folder of status files.

    spark-submit --py-files pulse.zip pulse/run.py trending_hashtags \
        --source /data/statuses --out /data/tables --interval "10 seconds" --run-seconds 60

``--available-now`` replays what is in ``--source`` and stops.  Results are
registered as temporary views named after their tables and a preview of each
is printed (``--preview 100``, the reference's ``show(100)``).
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from pulse.settings import PREVIEW_ROWS, TRACK_A_KEYWORDS, TRACK_B_KEYWORDS, JobSettings
from pulse.streaming.apps import APPS

STREAM_DEFAULTS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="pulse.run")
    ap.add_argument("app", choices=sorted(APPS))
    ap.add_argument("--source", required=True, help="folder or glob of status parquet files")
    ap.add_argument("--out", required=True, help="output folder for the app's tables")
    ap.add_argument("--interval", default="10 seconds")
    ap.add_argument("--run-seconds", type=int, default=60)
    ap.add_argument("--available-now", action="store_true")
    ap.add_argument("--lexicon", default=None, help="word<TAB>score file")
    ap.add_argument("--account", default=JobSettings.account)
    ap.add_argument("--lang", default=JobSettings.lang)
    ap.add_argument("--track-a", default=",".join(TRACK_A_KEYWORDS))
    ap.add_argument("--track-b", default=",".join(TRACK_B_KEYWORDS))
    ap.add_argument("--preview", type=int, default=PREVIEW_ROWS)
    ap.add_argument("--format", default="parquet", choices=["parquet", "json", "raw", "variant"], help="status file format")
    ap.add_argument("--files-per-trigger", type=int, default=None, help="files a micro-batch takes (default: all new ones)")
    ap.add_argument("--state-partitions", type=int, default=None)
    ap.add_argument("--bad-lines", default="FAILFAST", choices=["FAILFAST", "PERMISSIVE"])
    args = ap.parse_args(argv)

    settings = JobSettings(
        run_seconds=args.run_seconds,
        interval=args.interval,
        out_path=args.out,
        lexicon_path=args.lexicon,
        account=args.account,
        lang=args.lang,
        track_a=tuple(k for k in args.track_a.split(",") if k),
        track_b=tuple(k for k in args.track_b.split(",") if k),
        source_format=args.format,
        files_per_trigger=args.files_per_trigger,
        state_partitions=args.state_partitions,
        bad_lines=args.bad_lines,
    )
    spark = SparkSession.builder.appName(f"pulse-{args.app}").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")  # records hold UTC wall clocks
    # Large streaming state lives off-heap in RocksDB, checkpointed by
    # changelog.  Set only where the user (spark-submit --conf) has not.
    for key, value in STREAM_DEFAULTS.items():
        if spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)
    tables = APPS[args.app](spark, args.source, settings, available_now=args.available_now)
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
        if args.preview:
            df.show(args.preview, truncate=80)


if __name__ == "__main__":
    main()
