"""spark-submit entry points for the five jobs:

    spark-submit --py-files stationflow.zip stationflow/jobs.py ingest  --feed info --payloads P --messages M --checkpoint C
    spark-submit --py-files stationflow.zip stationflow/jobs.py stream  --info I --status S --weather W --out O --checkpoint C
    spark-submit --py-files stationflow.zip stationflow/jobs.py compact --parts P --out O
    spark-submit --py-files stationflow.zip stationflow/jobs.py train   --history H --model M [--split window|random]
    spark-submit --py-files stationflow.zip stationflow/jobs.py score   --forecasts F --model M --out O [--horizons all]

Message folders can be replaced by Kafka topics (``stream --source kafka``,
``ingest --sink kafka``, with ``--bootstrap-servers`` and topic names in place of
folders); payloads are always read from a folder. Every endpoint
and path comes from the command line.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import Observation, SparkSession


def _session() -> SparkSession:
    from stationflow.session import build_session
    return build_session()


def _trigger(args) -> dict | None:
    if args.available_now:
        return {"availableNow": True}
    if args.every:
        return {"processingTime": args.every}
    return None


def cmd_ingest(spark: SparkSession, args) -> None:
    from stationflow.streaming.ingest import start_ingest_stream
    q = start_ingest_stream(spark, args.payloads, args.feed, checkpoint_path=args.checkpoint,
                            sink=args.sink, path=args.messages, topic=args.messages,
                            bootstrap_servers=args.bootstrap_servers,
                            quarantine_path=args.quarantine, trigger=_trigger(args),
                            max_files_per_trigger=args.max_files_per_trigger)
    q.awaitTermination()


def _typed_feeds(spark: SparkSession, args):
    """Parsed feed tables landed as Parquet, read as streams with watermarks."""
    from stationflow import schemas as S
    out = []
    for loc, schema, ts in ((args.info, S.PARSED_INFO, "info_timestamp"),
                            (args.status, S.PARSED_STATUS, "status_timestamp"),
                            (args.weather, S.PARSED_WEATHER, "timestamp")):
        reader = spark.readStream.schema(schema)
        if args.max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", args.max_files_per_trigger)
        out.append(reader.parquet(loc)
                   .withWatermark(ts, args.watermark))
    return out


def cmd_stream(spark: SparkSession, args) -> None:
    from stationflow.sources.feeds import read_messages
    from stationflow.streaming.utilization import (
        start_feeds_stream, start_quarantine_stream, start_utilization_stream,
    )
    if args.source == "parquet":
        q = start_feeds_stream(*_typed_feeds(spark, args), sink_path=args.out,
                               checkpoint_path=args.checkpoint, mode=args.mode,
                               trigger=_trigger(args), fmt=args.format)
        q.awaitTermination()
        return
    feeds = [read_messages(spark, source=args.source, path=loc, topic=loc,
                           bootstrap_servers=args.bootstrap_servers,
                           starting_offsets=args.starting_offsets,
                           max_files_per_trigger=args.max_files_per_trigger,
                           max_offsets_per_trigger=args.max_offsets_per_trigger,
                           min_partitions=args.min_partitions)
             for loc in (args.info, args.status, args.weather)]
    q = start_utilization_stream(*feeds, sink_path=args.out, checkpoint_path=args.checkpoint,
                                 mode=args.mode, watermark=args.watermark,
                                 trigger=_trigger(args), fmt=args.format,
                                 dedupe_messages=args.dedupe)
    queries = [q]
    if args.quarantine:
        queries.append(start_quarantine_stream(
            *feeds, path=args.quarantine,
            checkpoint_path=f"{args.checkpoint.rstrip('/')}_quarantine", trigger=_trigger(args)))
    for query in queries:
        query.awaitTermination()


def cmd_compact(spark: SparkSession, args) -> None:
    from stationflow.operators.history import combine_history, distinct_values
    combined = combine_history(spark, args.parts, out_path=args.out,
                               quarantine_path=args.quarantine)
    if args.distinct:
        (distinct_values(combined, args.distinct).orderBy(args.distinct)
         .write.mode("overwrite").parquet(args.distinct_out or f"{args.out}_distinct"))


def _history(spark: SparkSession, path: str, fmt: str):
    from stationflow.sources.history import read_csv_parts
    return read_csv_parts(spark, path) if fmt == "csv" else spark.read.parquet(path)


def cmd_train(spark: SparkSession, args) -> dict:
    from stationflow.operators import model as ML
    counts = Observation("training")
    rows = ML.training_rows(_history(spark, args.history, args.history_format),
                            grain=args.grain, counts=counts).persist()
    try:
        train, test = (ML.random_split(rows) if args.split == "random"
                       else ML.window_split(rows))
        model = ML.train(train)
        result = {"null_rows": counts.get["null_rows"], "train_rows": train.count(), "test_rows": test.count(),
                  "rmse": ML.evaluate(model, test), **ML.coefficients(model)}
        ML.save(model, args.model)
    finally:
        rows.unpersist()
    print(json.dumps(result))
    return result


def cmd_score(spark: SparkSession, args) -> None:
    from stationflow.operators import model as ML
    from stationflow.operators.normalize import flatten_forecast
    forecasts = flatten_forecast(spark.read.schema("payload string").json(args.forecasts),
                                 horizons=args.horizons)
    ML.score(ML.load(args.model), forecasts).drop("features") \
        .write.mode("append").parquet(args.out)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="stationflow.jobs")
    sub = p.add_subparsers(dest="cmd", required=True)

    def triggers(sp):
        sp.add_argument("--every", help="processing-time trigger, e.g. '5 minutes'")
        sp.add_argument("--available-now", action="store_true",
                        help="process what has landed, then stop")
        sp.add_argument("--max-files-per-trigger", type=int,
                        help="bound on the files of one micro-batch")

    ing = sub.add_parser("ingest", help="landed payloads -> keyed messages")
    ing.add_argument("--feed", choices=["info", "status", "weather"], required=True)
    ing.add_argument("--payloads", required=True)
    ing.add_argument("--messages", required=True, help="folder, or topic with --sink kafka")
    ing.add_argument("--sink", choices=["files", "kafka"], default="files")
    ing.add_argument("--bootstrap-servers")
    ing.add_argument("--quarantine")
    ing.add_argument("--checkpoint", required=True)
    triggers(ing)

    stm = sub.add_parser("stream", help="messages -> utilization report")
    for name in ("info", "status", "weather"):
        stm.add_argument(f"--{name}", required=True, help="folder, or topic with --source kafka")
    stm.add_argument("--source", choices=["files", "kafka", "parquet"], default="files",
                     help="files/kafka: keyed JSON messages; parquet: parsed feed tables")
    stm.add_argument("--bootstrap-servers")
    stm.add_argument("--starting-offsets", default="earliest")
    stm.add_argument("--max-offsets-per-trigger", type=int,
                     help="bound on the Kafka records of one micro-batch")
    stm.add_argument("--min-partitions", type=int, help="read tasks of a Kafka topic")
    stm.add_argument("--out", required=True)
    stm.add_argument("--checkpoint", required=True)
    stm.add_argument("--mode", choices=["snapshot", "event_time"], default="event_time")
    stm.add_argument("--watermark", default="1 minute")
    stm.add_argument("--format", choices=["parquet", "csv", "console"], default="parquet",
                     help="console: preview each batch's report instead of writing it")
    stm.add_argument("--dedupe", action="store_true")
    stm.add_argument("--quarantine", help="folder for messages the report cannot use")
    triggers(stm)

    cmp_ = sub.add_parser("compact", help="CSV report parts -> distinct Parquet table")
    cmp_.add_argument("--parts", required=True)
    cmp_.add_argument("--out", required=True)
    cmp_.add_argument("--quarantine", help="folder that lists the parts that could not be used")
    cmp_.add_argument("--distinct", help="also write the distinct values of this column")
    cmp_.add_argument("--distinct-out")

    trn = sub.add_parser("train", help="history -> regression model")
    trn.add_argument("--history", required=True, help="compacted Parquet or CSV parts")
    trn.add_argument("--history-format", choices=["parquet", "csv"], default="parquet")
    trn.add_argument("--model", required=True)
    trn.add_argument("--split", choices=["window", "random"], default="window")
    trn.add_argument("--grain", choices=["station", "window"], default="station")

    sco = sub.add_parser("score", help="forecast payloads -> predictions")
    sco.add_argument("--forecasts", required=True, help="JSON lines with a 'payload' field")
    sco.add_argument("--model", required=True)
    sco.add_argument("--out", required=True)
    sco.add_argument("--horizons", choices=["first", "all"], default="first")
    return p


COMMANDS = {"ingest": cmd_ingest, "stream": cmd_stream, "compact": cmd_compact,
            "train": cmd_train, "score": cmd_score}


def main(argv: list[str] | None = None, spark: SparkSession | None = None):
    args = parser().parse_args(argv)
    return COMMANDS[args.cmd](spark or _session(), args)


if __name__ == "__main__":
    main(sys.argv[1:])
