"""Jobs for spark-submit:

    spark-submit jobs/run.py backfill
    spark-submit jobs/run.py stations --documents /landing/stations/*.json
    spark-submit jobs/run.py weather --archive ... --recent ...
    spark-submit jobs/run.py train --kind poisson_trees
    spark-submit jobs/run.py materialize
    spark-submit jobs/run.py score
    spark-submit jobs/run.py replay --since 2026-08-01T00:00:00+00:00
    spark-submit jobs/run.py compact
    spark-submit jobs/run.py stream

Settings come from CHRONOFEAT_* variables; `--as-of` replaces the clock. A replay goes on from where
the last one ended; `--since` is where the first one starts, and `--folder` takes its messages in
place of the topic. `compact` runs beside readers and writers of the latest-value tables.
"""

from __future__ import annotations

import argparse
import json
import sys
from datetime import UTC, datetime
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from chronofeat.plans import runs  # noqa: E402
from chronofeat.plans.backfill import run_backfill  # noqa: E402
from chronofeat.plans.reports import freshness_status  # noqa: E402
from chronofeat.session import STREAM_CONF, build_session  # noqa: E402
from chronofeat.settings import Settings  # noqa: E402
from chronofeat.sources.topics import (  # noqa: E402
    kafka_options,
    write_json_folder,
    write_json_topic,
)
from chronofeat.streaming.pipeline import run_stream  # noqa: E402


def arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    commands = "backfill stations weather train materialize score replay compact stream".split()
    parser.add_argument("command", choices=commands)
    parser.add_argument("--as-of", type=datetime.fromisoformat, default=datetime.now(UTC))
    parser.add_argument("--since", type=datetime.fromisoformat)
    parser.add_argument("--folder")
    parser.add_argument("--documents")
    parser.add_argument("--archive")
    parser.add_argument("--recent")
    parser.add_argument("--kind", default="poisson_trees")
    parser.add_argument("--rounds", type=int, default=600)
    parser.add_argument("--max-rows", type=int, default=400_000)
    parser.add_argument("--watermark", choices=("union", "each"), default="union")
    return parser.parse_args()


def main() -> None:
    args, settings = arguments(), Settings.from_env()
    conf = STREAM_CONF if args.command == "stream" else None
    spark = build_session(f"chronofeat-{args.command}", conf=conf)
    if args.command == "backfill":
        print(json.dumps(run_backfill(spark, settings)))
    elif args.command == "stations":
        print(runs.load_stations(spark, settings, args.documents))
    elif args.command == "weather":
        runs.load_weather(spark, settings, args.archive, args.recent, args.as_of)
    elif args.command == "train":
        record = runs.run_training(spark, settings, args.as_of, args.kind, args.rounds, args.max_rows)
        print(json.dumps(record, default=str))
    elif args.command == "materialize":
        runs.run_materialize(spark, settings, args.as_of)
    elif args.command == "score":
        report, ages = runs.run_scoring(spark, settings, args.as_of)
        report.write.mode("overwrite").parquet(settings.table("reports", "scores"))
        freshness_status(ages).write.mode("overwrite").parquet(settings.table("reports", "freshness"))
    elif args.command == "replay":
        options = kafka_options(settings.kafka_servers, settings.kafka_auth)

        def send(messages, number):
            if args.folder:
                write_json_folder(messages, f"{args.folder}/slice={number:010d}", "station_id")
            else:
                write_json_topic(messages, settings.trip_topic, "station_id", options)

        print(runs.run_replaying(spark, settings, args.as_of, send, args.since))
    elif args.command == "compact":
        print(json.dumps(runs.run_compaction(spark, settings)))
    else:
        run_stream(spark, settings, args.watermark)


if __name__ == "__main__":
    main()
