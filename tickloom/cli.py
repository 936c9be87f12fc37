"""Command line: ``python -m tickloom <command> --help``."""

import argparse

from pyspark.sql import functions as F

from tickloom.models.zscore import MODEL_TYPE
from tickloom.operators.evaluate import compare_models
from tickloom.operators.labels import TRAINING_THRESHOLD
from tickloom.plans import reports, scoring, training
from tickloom.plans.replay import replay
from tickloom.session import fresh_path, get_spark
from tickloom.sources.raw import read_archive, stream_archive, stream_kafka
from tickloom.sources.sinks import save_stream, to_folder, to_table, to_topic, write_table
from tickloom.streaming.bounded import first_stream_features
from tickloom.streaming.trailing import check_messages, stream_features


def _source(spark, args):
    if args.servers:
        return stream_kafka(spark, args.servers, args.topic, args.messages_per_batch)
    return stream_archive(spark, args.input, args.messages_per_batch)


def run_replay(spark, args):
    result = replay(spark, args.input, args.output, args.window_seconds)
    result.counts.show()
    print(f"features: {result.features.count()}")


def run_featurize(spark, args):
    if args.max_messages:
        return run_first(spark, args)
    features = stream_features(_source(spark, args), args.window_seconds, args.delay_seconds)
    messages = None
    if args.servers and args.output_topic:
        messages = to_topic(args.servers, args.output_topic)
    elif args.messages:
        messages = to_folder(args.messages)
    save_stream(features, to_table(args.output), messages, args.checkpoint, args.once).awaitTermination()


def run_first(spark, args):
    """Features of a run that ends after a number of messages, from files."""
    if args.servers:
        raise SystemExit("--max-messages reads files: give --input")
    arrivals = read_archive(spark, args.input)
    rows = first_stream_features(
        _source(spark, args), arrivals, args.max_messages, fresh_path(spark, "streamed"), args.checkpoint, args.window_seconds,
        args.delay_seconds, args.once,
    )
    write_table(rows, args.output)


def run_train(spark, args):
    result = training.train(spark, spark.read.parquet(args.features), args.output, args.threshold)
    compare_models(result.metrics).show(truncate=False)
    result.importance.show(truncate=False)


def run_infer(spark, args):
    scored, counts, latency = scoring.score_table(spark, args.model_path, args.data_path, args.output_path, args.model_type)
    counts.show()
    latency.show()
    scored.select("predicted_label", "spike_probability").show(10)


def run_evaluate(spark, args):
    for table in reports.model_report(spark, args.folder, args.baseline, args.challenger):
        table.show(truncate=False)


def run_drift(spark, args):
    report = reports.early_late_report(spark.read.parquet(args.features), args.split_ratio)
    reports.save_report(report, args.output)
    spark.read.parquet(args.output).where(F.col("section").startswith("d")).show(100, truncate=False)


def run_train_test_drift(spark, args):
    report = reports.train_test_report(spark.read.parquet(args.train), spark.read.parquet(args.test))
    reports.save_report(report, args.output)
    spark.read.parquet(args.output).where(F.col("section").startswith("d")).show(100, truncate=False)


def run_check(spark, args):
    """Counts messages as they come, until there are enough or none come any more."""
    check_messages(_source(spark, args), fresh_path(spark, "check"), args.min, args.idle_seconds).show()


def parser() -> argparse.ArgumentParser:
    main = argparse.ArgumentParser(prog="tickloom")
    commands = main.add_subparsers(dest="command", required=True)

    def command(name, function, **options):
        sub = commands.add_parser(name)
        sub.set_defaults(run=function)
        for option, default in options.items():
            flag = "--" + option.replace("_", "-")
            if default is ...:
                sub.add_argument(flag, required=True)
            elif isinstance(default, bool):
                sub.add_argument(flag, action="store_true")
            else:
                sub.add_argument(flag, default=default, type=type(default) if default is not None else str)
        return sub

    # For files, the number of files per batch.
    source = dict(input=None, servers=None, topic="ticks.raw", messages_per_batch=None)
    command("replay", run_replay, input=..., output=..., window_seconds=60)
    command(
        "featurize", run_featurize, **source, output=..., checkpoint=..., output_topic=None, messages=None,
        window_seconds=60, delay_seconds=10.0, once=False, max_messages=0,
    )
    command("train", run_train, features=..., output=..., threshold=TRAINING_THRESHOLD)
    command("infer", run_infer, model_path=..., data_path=..., output_path=None, model_type="auto")
    command("evaluate", run_evaluate, folder=..., baseline=MODEL_TYPE, challenger="logistic_regression")
    command("drift", run_drift, features=..., output=..., split_ratio=0.5)
    command("train-test-drift", run_train_test_drift, train=..., test=..., output=...)
    command("check", run_check, **source, min=100, idle_seconds=10.0)
    return main


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(get_spark(), args)
