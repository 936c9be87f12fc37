"""Queries over the shared test tables, one per operator.

``events`` plays the part of a tick stream: its type is the pair, its value the price and
its id the order of arrival. Events are minutes apart, so windows are an hour wide.
Queries that look at features first store the feature table, as a pipeline would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.models.boosting import TREES, boost
from tickloom.models.classifiers import importance
from tickloom.models.logistic import LOGISTIC
from tickloom.models.registry import load_model, predict, prediction_counts, save_model
from tickloom.models.zscore import fit_zscore
from tickloom.operators import drift, evaluate, labels, profile, quality
from tickloom.operators.ordering import percentiles
from tickloom.operators.parse import ingest_counts, parse_ticks
from tickloom.operators.rollups import bars, sessions, stream_bars, stream_sessions
from tickloom.operators.sketches import merge_range, range_drift, range_percentiles, sketch_rows
from tickloom.operators.trailing import forward_volatility, tick_features
from tickloom.plans import reports, training
from tickloom.plans.replay import bounded_features, replay
from tickloom.plans.scoring import score_table
from tickloom.schemas import FEATURES
from tickloom.session import fresh_path, stored
from tickloom.sources.compaction import compact, read_batches
from tickloom.sources.delivery import deliver_stream, numbered_messages, renamed_table, without_redelivered
from tickloom.sources.raw import read_archive, read_metrics, stream_archive
from tickloom.sources.sinks import append_stream, json_messages, json_stream, tee_stream, write_metrics, write_table
from tickloom.streaming.bounded import first_stream_features
from tickloom.streaming.horizon import label_stream, stream_horizon
from tickloom.streaming.revisions import merge_changes, stream_changes
from tickloom.streaming.triggers import current_triggers, reference_figures, watch_stream
from tickloom.streaming.trailing import count_messages, parity, stream_features

WINDOW = 3600
THRESHOLD = 1.0
PROFILED = FEATURES + ["window_size", "window_duration", "raw_price"]
MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 9, skip: tuple = ("ts",)) -> DataFrame:
    """Doubles rounded, so that two engines adding in different orders agree."""
    return df.select(
        *[F.round(c, digits).alias(c) if t == "double" and c not in skip else F.col(c) for c, t in df.dtypes]
    )


def event_us() -> F.Column:
    return F.unix_micros(F.col("ts").cast("timestamp"))


def envelopes(spark: SparkSession, folder: str) -> DataFrame:
    """Events as raw messages that carry a price only."""
    return table(spark, folder, "events").select(
        F.col("event_type").alias("pair"),
        (event_us() / F.lit(1e6)).alias("ts"),
        F.col("event_id").alias("seq"),
        F.to_json(F.struct(F.col("value").alias("price"))).alias("raw"),
    )


# One payload form per remainder of the event id; <v>, <b> and <a> stand for the value, a
# bid just below and an ask just above it.
SHAPES = [
    '{"type":"ticker","price":"<v>","best_bid":"<b>","best_ask":"<a>","volume_24h":"5","time":"t"}',
    '{"price":<v>}',
    '{"price":<v>,"best_bid":<b>}',
    '{"best_bid":"<b>","best_ask":"<a>","timestamp":"t"}',
    '{"last_price":"<v>","bid":"<b>","ask":"<a>"}',
    '{"price":<v>,"best_bid":0,"best_ask":<a>}',
    '{"best_bid":"0","best_ask":"<a>"}',
    '{"price":"0"}',
    '{"type":"subscriptions"}',
    '{"price":',
    '{"price":"abc","best_bid":"<b>","best_ask":"<a>"}',
    '{"price":" <v> ","volume_24h":7}',
    "[<v>]",
    '{"price":true}',
    "",
]


def shaped_envelopes(spark: SparkSession, folder: str) -> DataFrame:
    """Events as raw messages in every payload form, usable and not."""
    value = F.col("value")
    shape = F.element_at(F.array(*[F.lit(s) for s in SHAPES]), (F.pmod("event_id", F.lit(len(SHAPES))) + 1).cast("int"))
    raw = shape
    for mark, number in {"<v>": value, "<b>": value - 0.01, "<a>": value + 0.01}.items():
        raw = F.replace(raw, F.lit(mark), number.cast("string"))
    return table(spark, folder, "events").select(
        F.col("event_type").alias("pair"),
        (event_us() / F.lit(1e6)).alias("ts"),
        F.col("event_id").alias("seq"),
        raw.alias("raw"),
    )


def features(spark: SparkSession, folder: str) -> DataFrame:
    return stored(rounded(tick_features(parse_ticks(envelopes(spark, folder)), WINDOW)), "features")


def gappy_features(spark: SparkSession, folder: str) -> DataFrame:
    """Features of which some are blanked by rule, to have something to find."""
    blank = lambda c, every: F.when(F.pmod("seq", F.lit(every)) != 0, F.col(c)).alias(c)
    every = {"midprice_return_std": 7, "bid_ask_spread": 11, "raw_price": 5}
    rows = features(spark, folder)
    return rows.select(*[blank(c, every[c]) if c in every else F.col(c) for c in rows.columns])


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    return labels.label_next_row(features(spark, folder), THRESHOLD)


def split_rows(spark: SparkSession, folder: str) -> DataFrame:
    return stored(labels.split_train_validation_test(stored(labelled(spark, folder), "labelled")), "split")


def two_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions of two z-score rules on all splits."""
    rows = split_rows(spark, folder)
    train = rows.where("split = 'train'")
    models = {"volatility": fit_zscore(train), "spread": fit_zscore(train, "bid_ask_spread", 1.0)}
    return stored(training.predictions(models, rows), "predictions")


def halves(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = labelled(spark, folder).select("ts_us", "seq", *FEATURES, "label")
    split = stored(labels.split_early_late(stored(rows, "labelled")), "halves")
    return split.where("split = 'reference'"), split.where("split = 'current'")


def line_sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    lines = table(spark, folder, "lineitem")
    return lines.where("l_linestatus = 'O'"), lines.where("l_linestatus = 'F'")


def line_both(spark: SparkSession, folder: str) -> DataFrame:
    reference, current = line_sides(spark, folder)
    return drift.both_sides(reference, current, [*MEASURES, "l_returnflag", "l_shipdate"])


# --- sources and parsing ---------------------------------------------------------------


def parse_payloads(spark, folder):
    return rounded(parse_ticks(shaped_envelopes(spark, folder)))


def count_ingest(spark, folder):
    return ingest_counts(shaped_envelopes(spark, folder))


def archive_counts(spark, folder):
    """The same messages through a newline-delimited archive with a bad line per document."""
    path = fresh_path(spark, "archive")
    good = json_messages(shaped_envelopes(spark, folder))
    bad = table(spark, folder, "documents").select(F.regexp_replace("text", r"[\r\n]", " ").alias("value"))
    good.unionByName(bad).write.text(path)
    return ingest_counts(read_archive(spark, path))


def archive_replay(spark, folder):
    archive, output = fresh_path(spark, "archive"), fresh_path(spark, "replayed")
    json_messages(envelopes(spark, folder)).write.text(archive)
    return rounded(replay(spark, archive, output, WINDOW).features)


# --- windows ---------------------------------------------------------------------------


def window_features(spark, folder):
    return rounded(tick_features(parse_ticks(envelopes(spark, folder)), WINDOW))


def window_features_one_sequence(spark, folder):
    return rounded(tick_features(parse_ticks(envelopes(spark, folder)), WINDOW / 4, keys=()))


def forward_std(spark, folder):
    ticks = parse_ticks(envelopes(spark, folder))
    return rounded(forward_volatility(ticks, WINDOW)).select("pair", "ts", "seq", "ticks_ahead", "forward_return_std")


def first_messages(spark, folder):
    return rounded(bounded_features(shaped_envelopes(spark, folder), 500, WINDOW))


def tick_bars(spark, folder):
    return rounded(bars(parse_ticks(envelopes(spark, folder)), WINDOW))


def sliding_bars(spark, folder):
    return rounded(bars(parse_ticks(envelopes(spark, folder)), WINDOW, WINDOW / 4))


def tick_sessions(spark, folder):
    return rounded(sessions(parse_ticks(envelopes(spark, folder)), WINDOW / 2))


# --- labels and splits -----------------------------------------------------------------


def next_row_label(spark, folder):
    return labelled(spark, folder).select("pair", "ts", "seq", "midprice_return_std", "label")


def horizon_label(spark, folder):
    ticks = parse_ticks(envelopes(spark, folder))
    return labels.label_horizon(ticks, THRESHOLD, WINDOW).select("pair", "seq", "label")


def same_row_shares(spark, folder):
    rows = stored(labels.label_same_row(features(spark, folder), THRESHOLD).select("label"), "labels")
    return rounded(profile.value_shares(rows, "label"))


def next_row_counts(spark, folder):
    return rounded(labels.label_counts(labelled(spark, folder)))


def training_projection(spark, folder):
    return labels.prepare_training_rows(labels.label_next_row(gappy_features(spark, folder), THRESHOLD))


def missing_values(spark, folder):
    return labels.missing_report(gappy_features(spark, folder), FEATURES)


def train_validation_test(spark, folder):
    return rounded(labels.split_counts(split_rows(spark, folder)))


def split_members(spark, folder):
    return split_rows(spark, folder).select("seq", "split", "label")


def early_late(spark, folder):
    reference, current = halves(spark, folder)
    both = reference.unionByName(current).groupBy("split")
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.min("ts_us").alias("first_us"), F.max("ts_us").alias("last_us"))


# --- models ----------------------------------------------------------------------------


def zscore_params(spark, folder):
    train = split_rows(spark, folder).where("split = 'train'")
    return rounded(fit_zscore(train).params(spark))


def zscore_scores(spark, folder):
    rows = split_rows(spark, folder)
    model = fit_zscore(rows.where("split = 'train'"))
    scored = predict(model, rows).withColumn("decision_value", model.decision())
    return rounded(scored.select("seq", "predicted_label", "spike_probability", "decision_value"))


def zscore_spikes(spark, folder):
    rows = split_rows(spark, folder)
    return rounded(prediction_counts(predict(fit_zscore(rows.where("split = 'train'")), rows)))


def zscore_saved(spark, folder):
    """Saved, loaded again and applied to a stored table."""
    rows = split_rows(spark, folder)
    model_path, data = fresh_path(spark, "model"), fresh_path(spark, "data")
    save_model(fit_zscore(rows.where("split = 'train'")), model_path, spark)
    write_table(rows, data)
    scored, _, _ = score_table(spark, model_path, data)
    return rounded(scored.select("seq", "label", "predicted_label", "spike_probability"))


def scoring_latency(spark, folder):
    rows = split_rows(spark, folder)
    model_path, data = fresh_path(spark, "model"), fresh_path(spark, "data")
    save_model(fit_zscore(rows.where("split = 'train'")), model_path, spark)
    write_table(rows, data)
    return score_table(spark, model_path, data)[2].select("window_seconds", "allowed_seconds", "status")


_fitted: dict[tuple, tuple] = {}


def fitted(spark, folder, kind, rounds=100):
    """Rows and a model fitted to them, once per session."""
    key = (spark.sparkContext.applicationId, folder, kind, rounds)
    if key not in _fitted:
        rows = split_rows(spark, folder)
        _fitted[key] = rows, training.fit_all(rows, [kind], rounds)[kind]
    return _fitted[key]


def logistic_scores(spark, folder):
    rows, model = fitted(spark, folder, LOGISTIC)
    scored = predict(model, rows).select("seq", "split", "label", "predicted_label", "spike_probability")
    return rounded(scored, 7)


def logistic_importance(spark, folder):
    return rounded(importance(fitted(spark, folder, LOGISTIC)[1], LOGISTIC, spark), 6)


def boosted_first_tree(spark, folder):
    """Every node of the first tree: its split, or its value."""
    train = split_rows(spark, folder).where("split = 'train'")
    sizes = {r.label: r["count"] for r in train.groupBy("label").count().collect()}
    nodes = boost(train, FEATURES, "label", sizes[0] / sizes[1], rounds=1).nodes(spark)
    return rounded(nodes.select("place", "feature", "cut", "gain", "cover", "value"), 6)


def trees_metrics(spark, folder):
    rows, model = fitted(spark, folder, TREES)
    return evaluate.metrics_long(evaluate.evaluate(stored(training.predictions({TREES: model}, rows), "predictions")))


def trees_importance(spark, folder):
    return importance(fitted(spark, folder, TREES)[1], TREES, spark)


def _saved(spark, folder, kind):
    """Rows, and how many of them are predicted otherwise by the model saved and loaded again."""
    rows, model = fitted(spark, folder, kind)
    path = fresh_path(spark, "model")
    save_model(model, path, spark, kind)
    columns = ["seq", "predicted_label", "spike_probability"]
    before = predict(model, rows).select(*columns)
    after = predict(load_model(path, spark)[0], rows).select("seq", *[F.col(c).alias(f"after_{c}") for c in columns[1:]])
    same = F.lit(True)
    for c in columns[1:]:
        same &= F.col(c).eqNullSafe(F.col(f"after_{c}"))
    return before.join(after, "seq").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(~same).alias("n_different"))


def trees_saved(spark, folder):
    return _saved(spark, folder, TREES)


def logistic_saved(spark, folder):
    return _saved(spark, folder, LOGISTIC)


def run_records(spark, folder):
    path = fresh_path(spark, "runs")
    rows = split_rows(spark, folder)
    models = training.fit_all(rows, ["zscore"])
    scores = stored(training.predictions(models, rows), "predictions")
    metrics = evaluate.metrics_long(evaluate.evaluate(scores))
    training.log_run(metrics, training.run_params(models, THRESHOLD), path)
    return spark.read.parquet(path).groupBy("model", "kind").agg(F.count(F.lit(1)).alias("n_records"))


# --- evaluation ------------------------------------------------------------------------


def confusion_counts(spark, folder):
    return evaluate.confusion(two_rules(spark, folder), ["model", "split"])


def metrics_by_split(spark, folder):
    return rounded(evaluate.evaluate(two_rules(spark, folder)))


def metrics_table(spark, folder):
    """Written as JSON documents and read back."""
    path = fresh_path(spark, "metrics")
    write_metrics(stored(evaluate.metrics_long(evaluate.evaluate(two_rules(spark, folder))), "metrics"), path)
    return rounded(read_metrics(spark, path, ["volatility", "spread"])[0])


def curve_points(spark, folder):
    curve = evaluate.score_curve(two_rules(spark, folder), ["model", "split"])
    return rounded(curve.select("model", "split", "threshold", "precision", "recall", "false_positive_rate"))


def curve_area(spark, folder):
    keys = ["model", "split"]
    return rounded(evaluate.curve_areas(evaluate.score_curve(two_rules(spark, folder), keys), keys))


def model_comparison(spark, folder):
    metrics = evaluate.metrics_long(evaluate.evaluate(two_rules(spark, folder)))
    return rounded(evaluate.compare_models(metrics))


def model_verdict(spark, folder):
    metrics = evaluate.metrics_long(evaluate.evaluate(two_rules(spark, folder)))
    return rounded(evaluate.verdict(metrics, "spread", "volatility"))


def retraining(spark, folder):
    rows = two_rules(spark, folder)
    metrics = evaluate.metrics_long(evaluate.evaluate(rows))
    spikes = prediction_counts(rows.where("model = 'volatility' and split = 'test'"))
    moved = drift.dataset_drift(drift.drift_by_column(*halves(spark, folder), FEATURES))
    return rounded(evaluate.retrain_triggers(metrics, spikes, moved, "volatility"))


def retraining_live(spark, folder):
    """The same rules while the test rows stream in, four files, one a batch; scores in 1,000 ranges."""
    source, sums, marks = (fresh_path(spark, n) for n in ("scored", "sums", "progress"))
    rows = split_rows(spark, folder)
    train, test = rows.where("split = 'train'"), rows.where("split = 'test'")
    model = fit_zscore(train)
    for part in range(4):
        predict(model, test.where(F.pmod("seq", F.lit(4)) == part)).coalesce(1).write.mode("append").parquet(source)
    reference = stored(reference_figures(train, FEATURES, WHOLE_K), "reference")
    scored = spark.readStream.schema(spark.read.parquet(source).schema).option("maxFilesPerTrigger", 1).parquet(source)
    watch_stream(scored, reference, FEATURES, sums, marks, True, k=WHOLE_K).awaitTermination()
    return rounded(current_triggers(spark, sums, reference, k=WHOLE_K), 7)


# --- profiling -------------------------------------------------------------------------


def describe_features(spark, folder):
    return rounded(profile.describe(features(spark, folder), PROFILED), 7)


def describe_tail(spark, folder):
    fractions = [0.5, 0.95, 0.99, 0.999]
    return rounded(profile.describe(features(spark, folder), ["midprice_return_std"], fractions))


def describe_lines(spark, folder):
    return rounded(profile.describe(table(spark, folder, "lineitem"), MEASURES), 4)


def feature_nulls(spark, folder):
    return profile.null_counts(gappy_features(spark, folder), PROFILED)


def feature_zeros(spark, folder):
    return rounded(profile.zero_shares(features(spark, folder), PROFILED))


def volatility_percentiles(spark, folder):
    return rounded(profile.tail_percentiles(features(spark, folder), "midprice_return_std"))


def line_percentiles(spark, folder):
    return rounded(profile.tail_percentiles(table(spark, folder, "lineitem"), "l_extendedprice"), 4)


def volatility_histogram(spark, folder):
    return rounded(profile.histogram(features(spark, folder), "midprice_return_std", 50))


def line_histogram(spark, folder):
    return rounded(profile.histogram(table(spark, folder, "lineitem"), "l_quantity", 100))


def volatility_ecdf(spark, folder):
    return rounded(profile.ecdf(features(spark, folder), "midprice_return_std"))


def line_ecdf(spark, folder):
    return rounded(profile.ecdf(table(spark, folder, "lineitem"), "l_quantity"))


def infinite_percentiles(spark, folder):
    """Prices of which some are made infinite by rule; once as one group, once cut into buckets."""
    price = F.when(F.pmod("l_orderkey", F.lit(7)) == 0, F.lit(float("inf"))).when(
        F.pmod("l_orderkey", F.lit(5)) == 0, F.lit(float("-inf"))
    ).otherwise(F.col("l_extendedprice"))
    rows = table(spark, folder, "lineitem").select(price.alias("price"))
    points = [0.05, 0.25, 0.5, 0.75, 0.9, 0.99]
    found = None
    for way, small in (("whole", None), ("buckets", 100)):
        part = percentiles(rows, ["price"], points, small_group=small).select(F.lit(way).alias("way"), "fraction", "value")
        found = part if found is None else found.unionByName(part)
    return rounded(found, 4)


def threshold_options(spark, folder):
    return rounded(profile.percentile_sweep(features(spark, folder), "midprice_return_std"))


def chosen_threshold(spark, folder):
    return rounded(profile.choose_threshold(features(spark, folder)))


def feature_correlations(spark, folder):
    return rounded(profile.correlations(features(spark, folder), ["ts", *PROFILED]), 8)


def line_correlations(spark, folder):
    return rounded(profile.correlations(table(spark, folder, "lineitem"), MEASURES))


def gap_description(spark, folder):
    gaps = stored(profile.arrival_gaps(features(spark, folder)).select("gap_seconds"), "gaps")
    return rounded(profile.describe(gaps, ["gap_seconds"]), 6)


def first_features(spark, folder):
    return profile.first_rows(features(spark, folder), 10)


def volatility_series(spark, folder):
    return profile.time_series(features(spark, folder))


# --- drift and quality -----------------------------------------------------------------


def drift_distances(spark, folder):
    reference, current = halves(spark, folder)
    sides = drift.both_sides(reference, current, [*FEATURES, "label"])
    return rounded(drift.distances(sides, [*FEATURES, "label"]), 8)


def line_distances(spark, folder):
    sides = drift.both_sides(*line_sides(spark, folder), MEASURES)
    return rounded(drift.distances(sides, MEASURES), 7)


def drift_tests(spark, folder):
    return rounded(drift.drift_by_column(*halves(spark, folder), [*FEATURES, "label"]), 8)


def drift_of_empty_columns(spark, folder):
    """A column without values on either side, one without them on one side, and a full one."""
    reference, current = line_sides(spark, folder)
    nothing = F.lit(None).cast("double")
    pick = lambda df, one: df.select(nothing.alias("neither"), one.alias("one_side"), F.col("l_quantity").alias("both"))
    tests = drift.drift_by_column(
        pick(reference, F.col("l_tax")), pick(current, nothing), ["neither", "one_side", "both"]
    )
    return tests.select("column_name", "test", "drift")


def drift_verdict(spark, folder):
    tests = drift.drift_by_column(*halves(spark, folder), [*FEATURES, "label"])
    return rounded(drift.dataset_drift(tests))


def feature_densities(spark, folder):
    return rounded(drift.densities(*halves(spark, folder), [*FEATURES, "label"]), 7)


def line_summary(spark, folder):
    return quality.dataset_summary(line_both(spark, folder))


def feature_summary(spark, folder):
    sides = drift.both_sides(*halves(spark, folder), [*FEATURES, "label"])
    return quality.dataset_summary(sides)


def line_uniques(spark, folder):
    """The most common value as a number where it is one, as engines write numbers differently."""
    number = F.col("top_value").try_cast("double")
    return quality.uniques(line_both(spark, folder)).select(
        "side", "column_name", "n_rows", "n_missing", "n_unique", "top_n", number.alias("top_number"),
        F.when(number.isNull(), F.col("top_value")).alias("top_text"),
    )


def line_column_summary(spark, folder):
    sides = drift.both_sides(*line_sides(spark, folder), MEASURES)
    return quality.column_summary(sides).withColumn("most_common", F.col("most_common").try_cast("double"))


def gaps_in(spark, folder):
    """Lines whose measures are blanked or made infinite by rule, to have something to find."""
    blank = lambda c, test, other: F.when(test, F.lit(other)).otherwise(F.col(c)).alias(c)
    rows = table(spark, folder, "lineitem").select(
        "l_linestatus",
        blank("l_quantity", F.col("l_quantity") == 1, None),
        blank("l_extendedprice", F.col("l_discount") == 0.05, float("inf")),
        blank("l_tax", F.col("l_tax") == 0.02, float("-inf")),
        blank("l_returnflag", F.col("l_returnflag") == "N", ""),
    )
    names = ["l_quantity", "l_extendedprice", "l_tax", "l_returnflag"]
    return drift.both_sides(rows.where("l_linestatus = 'O'"), rows.where("l_linestatus = 'F'"), names)


WHOLE_K = 1 << 15  # sketches of this size hold every value of the test table


def _daily_sketches(spark, folder):
    table = stored(sketch_rows(features(spark, folder), FEATURES, 86_400, k=WHOLE_K), "sketches")
    low, high = table.agg(F.min("bucket_us"), F.max("bucket_us")).first()
    return table, low + (high - low) // 2


def line_columns(spark, folder):
    return profile.columns_and_shape(table(spark, folder, "lineitem"))


def sketched_percentiles(spark, folder):
    """Of the later half of the days."""
    table, middle = _daily_sketches(spark, folder)
    return rounded(range_percentiles(merge_range(table, middle, None, WHOLE_K), [0.5, 0.95, 0.99]))


def sketched_drift(spark, folder):
    """Between the earlier and the later half of the days."""
    table, middle = _daily_sketches(spark, folder)
    found = range_drift(merge_range(table, None, middle, WHOLE_K), merge_range(table, middle, None, WHOLE_K), 100, WHOLE_K)
    return rounded(found.drop("error"), 7)


def missing_by_kind(spark, folder):
    return quality.missing_kinds(gaps_in(spark, folder))


def missing_totals(spark, folder):
    return rounded(quality.missing_overview(gaps_in(spark, folder)))


def early_late_report(spark, folder):
    return reports.early_late_report(features(spark, folder))


def train_test_report(spark, folder):
    rows = split_rows(spark, folder)
    return reports.train_test_report(rows.where("split = 'train'"), rows.where("split = 'test'"))


# --- streams ---------------------------------------------------------------------------


def _streamed(spark, folder):
    source, sink, marks = (fresh_path(spark, n) for n in ("queue", "streamed", "progress"))
    json_messages(envelopes(spark, folder)).write.text(source)
    query = append_stream(stream_features(stream_archive(spark, source), WINDOW), sink, marks, once=True)
    query.awaitTermination()
    return spark.read.parquet(sink)


def streamed_in_parts(spark, folder):
    """The stream stopped and started again on the same state for each fifth of the time; some
    messages of the first fifth come last of all, and are dropped as too late."""
    source, sink, marks = (fresh_path(spark, n) for n in ("queue", "streamed", "progress"))
    events = table(spark, folder, "events")
    low, high = events.agg(F.min(event_us()), F.max(event_us())).first()
    part = F.least(F.floor((event_us() - low) * 5 / (high - low + 1)), F.lit(4))
    late = (F.col("event_id") % 50 == 0) & (part == 0)
    order = F.when(late, 5).otherwise(part)
    numbered = stored(events.withColumn("part", order.cast("int")), "parts")
    for number in range(6):
        rows = numbered.where(F.col("part") == number).select(
            F.col("event_type").alias("pair"), (event_us() / F.lit(1e6)).alias("ts"), F.col("event_id").alias("seq"),
            F.to_json(F.struct(F.col("value").alias("price"))).alias("raw"),
        )
        json_messages(rows).write.mode("append").text(source)
        query = append_stream(stream_features(stream_archive(spark, source), WINDOW), sink, marks, once=True)
        query.awaitTermination()
    return rounded(spark.read.parquet(sink))


END = "~end"  # a pair that only moves the watermark on


def _late_arrivals(spark, folder, flow):
    """What ``flow`` gives of the events when they land by thirds of their time, every seventh of them one
    part late, and the stream starts again on its state for each part. A last message, far ahead of
    the others, ends all waiting."""
    source, sink, marks = (fresh_path(spark, n) for n in ("queue", "late", "progress"))
    events = table(spark, folder, "events")
    low, high = events.agg(F.min(event_us()), F.max(event_us())).first()
    part = F.least(F.floor((event_us() - low) * 3 / (high - low + 1)), F.lit(2)) + F.when(F.col("event_id") % 7 == 0, 1).otherwise(0)
    numbered = stored(envelopes(spark, folder).join(events.select(F.col("event_id").alias("seq"), part.alias("part")), "seq"), "parts")
    delay = (high - low) / 1e6
    end = spark.createDataFrame([(END, high / 1e6 + 2 * delay + 100 * WINDOW, 0, '{"price":1}')], "pair string, ts double, seq long, raw string")
    for number in range(4):
        rows = numbered.where(F.col("part") == number).select(*end.columns)
        json_messages(rows if number < 3 else rows.unionByName(end)).write.mode("append").text(source)
        append_stream(flow(stream_archive(spark, source), delay), sink, marks, once=True).awaitTermination()
    return spark.read.parquet(sink).where(F.col("pair") != END)


def horizon_streamed(spark, folder):
    rows = _late_arrivals(spark, folder, lambda lines, delay: stream_horizon(lines, WINDOW, delay))
    return rounded(rows).select("pair", "ts", "seq", "ticks_ahead", "forward_return_std")


def horizon_label_streamed(spark, folder):
    rows = _late_arrivals(spark, folder, lambda lines, delay: label_stream(stream_horizon(lines, WINDOW, delay), THRESHOLD))
    return rows.select("pair", "seq", "label")


def revised_features(spark, folder):
    """Rows sent too early and revised since, merged by key."""
    return rounded(merge_changes(_late_arrivals(spark, folder, lambda lines, delay: stream_changes(lines, WINDOW, delay))))


def bars_streamed(spark, folder):
    return rounded(_late_arrivals(spark, folder, lambda lines, delay: stream_bars(parse_ticks(lines), WINDOW, WINDOW / 4, delay)))


def sessions_streamed(spark, folder):
    return rounded(_late_arrivals(spark, folder, lambda lines, delay: stream_sessions(parse_ticks(lines), WINDOW / 2, delay)))


def streamed_features(spark, folder):
    return rounded(_streamed(spark, folder))


def stream_parity(spark, folder):
    return parity(tick_features(parse_ticks(envelopes(spark, folder)), WINDOW), _streamed(spark, folder))


def message_count(spark, folder):
    return count_messages(envelopes(spark, folder), 100)


def teed_messages(spark, folder):
    """Messages read back from both copies a tee wrote."""
    source, queue, archive, marks = (fresh_path(spark, n) for n in ("in", "queue", "archive", "progress"))
    json_messages(envelopes(spark, folder)).write.text(source)
    tee_stream(stream_archive(spark, source), queue, archive, marks, once=True).awaitTermination()
    copy = lambda path, name: read_archive(spark, path).select(F.lit(name).alias("copy"), "pair", "ts", "seq", "raw")
    return copy(queue, "queue").unionByName(copy(archive, "archive"))


def delivered_once(spark, folder):
    """Messages of which every tenth comes twice, delivered to two targets by a query whose second target
    fails once, and that is then started again."""
    source, first, second, ledger, marks = (fresh_path(spark, n) for n in ("in", "first", "second", "ledger", "progress"))
    rows = envelopes(spark, folder)
    json_messages(rows).write.text(source)
    json_messages(rows.where("seq % 10 = 0")).write.mode("append").text(source)
    failures = [True]

    def failing(batch, batch_id):
        if failures:
            failures.clear()
            raise OSError("the target is away")
        renamed_table(second)(batch, batch_id)

    for _ in range(2):
        messages = without_redelivered(stream_archive(spark, source, 1), 10**7).select("ts", "pair", "raw", "seq")
        query = deliver_stream(messages, {"first": renamed_table(first), "second": failing}, ledger, marks, True, numbered_messages)
        try:
            query.awaitTermination()
        except Exception:  # the query's own error, after which it is started again
            if failures:
                raise
    copy = lambda path, name: read_archive(spark, path).select(F.lit(name).alias("copy"), "pair", "ts", "seq", "raw")
    for path in (first, second):
        spark.read.parquet(path).select("value").write.text(f"{path}-lines")
    return copy(f"{first}-lines", "first").unionByName(copy(f"{second}-lines", "second"))


def first_messages_streamed(spark, folder):
    """A stream, one file a batch, that is stopped after 500 messages and cut at the row that ends it."""
    source, sink, marks = (fresh_path(spark, n) for n in ("queue", "first", "progress"))
    rows = stored(shaped_envelopes(spark, folder), "shaped")
    low, high = rows.agg(F.min("ts"), F.max("ts")).first()
    for part in range(8):
        begin, end = (low + (high - low) * n / 8 for n in (part, part + 1))
        inside = (F.col("ts") >= begin) & ((F.col("ts") < end) | F.lit(part == 7))
        json_messages(rows.where(inside)).coalesce(1).write.mode("append").text(source)
    found = first_stream_features(stream_archive(spark, source, 1), read_archive(spark, source), 500, sink, marks, WINDOW, 0.0)
    return rounded(found)


def compacted_features(spark, folder):
    """Features written in many small batches, compacted after half of them and again after all."""
    path = fresh_path(spark, "batches")
    rows = features(spark, folder)
    for half in range(2):
        for number in range(4):
            renamed_table(path)(rows.where(F.pmod("seq", F.lit(8)) == 4 * half + number), 4 * half + number)
        compact(spark, path)
    return read_batches(spark, path)


def message_sink(spark, folder):
    """Features sent as JSON messages by a stream, parsed again."""
    source, sink, marks = (fresh_path(spark, n) for n in ("in", "messages", "progress"))
    write_table(window_features(spark, folder), source)
    rows = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
    json_stream(rows, sink, marks, once=True).awaitTermination()
    schema = spark.read.parquet(source).schema
    return spark.read.text(sink).select(F.from_json("value", schema).alias("r")).select("r.*")
