"""The registered queries over the events table as a log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logloom.functions.text import detector_label, mask_message, page_offset, percent, template_id
from logloom.functions.time import iso_millis, window_floor, window_id
from logloom.operators import aggregate, compare, constraints, evaluate, load, metrics
from logloom.operators.detect import TRAIN, ZScore
from logloom.operators.features import Matrix, build_matrix, cutoff, split_parts, top_templates
from logloom.operators.parse import good, parse, rejects
from logloom.plans import api
from logloom.sources import topic
from logloom.sources.log_text import event_lines, read_lines
from logloom.sources.schemas import WINDOW_COUNTS
from logloom.sources.scratch import checkpointed
from logloom.sources.tables import read_table
from logloom.streaming import exact, inspect, native, replay, scoring, sink

HOUR = 3600
TEMPLATES = 20
SQL_TEMPLATES = 3  # of the queries that have SQL


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return good(parse(event_lines(spark, sf_dir)))


def _windows(spark: SparkSession, sf_dir: str, seconds: int = HOUR) -> DataFrame:
    return aggregate.window_features(_events(spark, sf_dir), seconds)


def _tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Hourly windows and template counts. The events are parsed once for both, and what is left of
    them after counting is written; both tables are small against them and read by every later step."""
    counted = checkpointed(aggregate.counted(_events(spark, sf_dir), HOUR))
    few = aggregate.without_nodes(counted).persist()
    return aggregate.features_of(few, HOUR, aggregate.distinct_nodes(counted)).persist(), aggregate.counts_of(few, HOUR).persist()


def _matrix(spark: SparkSession, sf_dir: str, templates: int = SQL_TEMPLATES, tables: tuple[DataFrame, DataFrame] | None = None) -> Matrix:
    matrix = build_matrix(*(tables or _tables(spark, sf_dir)), 0.7, templates)
    return Matrix(matrix.rows.persist(), matrix.features)


def _base_predictions(spark: SparkSession, sf_dir: str, tables: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """The detectors that SQL can follow: rule and z-score."""
    matrix = _matrix(spark, sf_dir, tables=tables)
    return evaluate.rule_predictions(matrix).unionByName(evaluate.zscore_predictions(matrix))


def _predictions(spark: SparkSession, sf_dir: str, tables: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """All seven detectors over the default templates and rounds, fitted once."""
    return evaluate.evaluate(_matrix(spark, sf_dir, TEMPLATES, tables)).persist()


# Sources and parsing


def parse_roundtrip(spark, sf_dir):
    return _events(spark, sf_dir).drop("event_time", "template")


def damaged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event lines, most of them damaged in one of nine ways by their number."""
    lines = event_lines(spark, sf_dir)
    p = F.split("value", " ", 10)
    part = lambda i: F.get(p, F.lit(i))
    rebuilt = lambda **new: F.concat_ws(" ", *(new.get(f"p{i}", part(i)) for i in range(10)))
    way = F.col("line_no") % 10
    value = (
        F.when(way == 1, F.concat(F.col("value"), F.lit("�")))
        .when(way == 2, F.concat(F.col("value"), F.lit("\x00")))
        .when(way == 3, F.lit("   "))
        .when(way == 4, F.concat_ws(" ", *(part(i) for i in range(5))))
        .when(way == 5, rebuilt(p1=F.lit("12345")))
        .when(way == 6, rebuilt(p2=F.lit("2024/01/01")))
        .when(way == 7, rebuilt(p4=F.lit("15:42:50")))
        .when(way == 8, rebuilt(p8=F.lit("NOTICE")))
        .when(way == 9, rebuilt(p1=F.lit("epoch")))
        .otherwise(F.col("value"))
    )
    return lines.withColumn("value", value)


def quarantine_reasons(spark, sf_dir):
    return rejects(parse(damaged_lines(spark, sf_dir))).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def quarantined_lines(spark, sf_dir):
    return rejects(parse(damaged_lines(spark, sf_dir))).filter(F.col("reason") != "undecodable_bytes")


def prefix_limit(spark, sf_dir):
    """The first 500 lines, bad ones counted."""
    parsed = parse(damaged_lines(spark, sf_dir).filter(F.col("line_no") <= 500))
    return parsed.agg(F.count(F.lit(1)).alias("lines_read"), F.count_if(F.col("reason").isNull()).alias("parsed"), F.max("line_no").alias("last_line"))


def mask_templates(spark, sf_dir):
    """Messages with every kind of variable part."""
    n = F.col("event_id").cast("string")
    kind = F.col("event_id") % 6
    message = (
        F.when(kind == 0, F.concat(F.lit("generating core."), n))
        .when(kind == 1, F.concat(F.lit("read 0x"), F.lower(F.hex("event_id")), F.lit(" at 10.0."), (F.col("event_id") % 256).cast("string"), F.lit(".7")))
        .when(kind == 2, F.concat(F.lit("node R02-M1-N0-C:J12-U11  lost "), n, F.lit(".5 packets")))
        .when(kind == 3, F.concat(F.lit("file /p/gb1/job"), n, F.lit("/input closed ")))
        .when(kind == 4, F.concat(F.lit("word deadbeef"), F.lpad(n, 8, "0"), F.lit(" stored")))
        .otherwise(F.concat_ws(" ", F.col("event_type"), n))
    )
    template = mask_message(message)
    events = read_table(spark, sf_dir, "events")
    return events.select("event_id", message.alias("message"), template.alias("template"), template_id(template).alias("template_id"))


def template_catalog(spark, sf_dir):
    return aggregate.template_catalog(_events(spark, sf_dir))


def scalar_functions(spark, sf_dir):
    """Names, pages, percentages and instants, one row per window."""
    w = _windows(spark, sf_dir)
    return w.select(
        "window_start",
        window_id(F.col("window_start")).alias("window_id"),
        iso_millis(F.col("window_start") * 1000 + 250).alias("produced_at"),
        page_offset(F.col("event_count"), 10).alias("page"),
        percent(F.col("error_rate")).alias("error_share"),
        F.substring(F.date_format(F.timestamp_seconds("window_start"), "HH:mm:ss"), 1, 5).alias("clock"),
        F.format_number(F.col("event_count") * 1000, 0).alias("shown"),
        detector_label(F.lit("z-score"), F.when(F.col("is_anomalous"), "all").otherwise("-")).alias("label"),
        F.round(F.log10(F.col("event_count") + 0.7), 6).alias("log_count"),
    )


def event_time_span(spark, sf_dir):
    return replay.event_time_span(event_lines(spark, sf_dir))


def orphan_events(spark, sf_dir):
    """Events per template that the catalogue of even lines lacks."""
    events = _events(spark, sf_dir)
    known = aggregate.template_catalog(events.filter("line_no % 1000 = 0"))
    return load.orphans(events, known).groupBy("template_id").agg(F.count(F.lit(1)).alias("n"))


# Windows


def window_features_60(spark, sf_dir):
    return _windows(spark, sf_dir, 60)


def window_features_3600(spark, sf_dir):
    return _windows(spark, sf_dir, HOUR)


def rolled_up_windows(spark, sf_dir):
    """Hourly windows out of sketches of minutes; distinct counts against exact ones, within three standard errors."""
    events = _events(spark, sf_dir)
    hours = aggregate.sketched_features(aggregate.rolled_up(aggregate.rolled_up(aggregate.window_sketches(events, 60), 300), HOUR), HOUR)
    exact_ = aggregate.window_features(events, HOUR).select("window_start", F.col("distinct_nodes").alias("_n"), F.col("distinct_templates").alias("_t"))
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) <= 3 * aggregate.SKETCH_ERROR * F.col(b)
    out = hours.join(exact_, "window_start").withColumns({"nodes_near": near("distinct_nodes", "_n"), "templates_near": near("distinct_templates", "_t")})
    return out.drop("_n", "_t", "distinct_nodes", "distinct_templates", "window_seconds")


def window_template_counts(spark, sf_dir):
    return aggregate.template_counts(_events(spark, sf_dir), HOUR)


def last_line_per_window(spark, sf_dir):
    return _events(spark, sf_dir).groupBy(window_floor(F.col("epoch"), HOUR).alias("window_start")).agg(F.max("line_no").alias("last_line"), F.min("line_no").alias("first_line"))


def daily_histogram(spark, sf_dir):
    return aggregate.daily_histogram(_windows(spark, sf_dir), F.col("is_anomalous"))


def windows_at_least(spark, sf_dir):
    return _windows(spark, sf_dir).filter("event_count >= 15").agg(F.count(F.lit(1)).alias("n"))


def duplicate_keys(spark, sf_dir):
    """(user, event type) pairs that occur twice or more."""
    return aggregate.duplicate_keys(_events(spark, sf_dir), "node", "severity")


def lag_percentiles(spark, sf_dir):
    """Delays between an event and the end of its window."""
    events = _events(spark, sf_dir)
    return aggregate.delay_percentiles(events.withColumn("lag", F.lit(HOUR).cast("long") - F.col("epoch") % HOUR), "lag")


# Splits, features, detectors


def split_parts_query(spark, sf_dir):
    """Training and test windows."""
    return split_parts(_windows(spark, sf_dir).persist(), 0.7).select("window_start", "position", F.when(F.col("part").isin(*TRAIN), "train").otherwise("test").alias("part"))


def fit_validation_parts(spark, sf_dir):
    return split_parts(_windows(spark, sf_dir).persist(), 0.7, 0.8).groupBy("part").agg(F.count(F.lit(1)).alias("windows"), F.min("window_start").alias("first_window"), F.max("window_start").alias("last_window"))


def top_templates_train(spark, sf_dir):
    events = _events(spark, sf_dir)
    before = cutoff(split_parts(aggregate.window_features(events, HOUR), 0.7))
    return top_templates(aggregate.template_counts(events, HOUR), before, SQL_TEMPLATES)


def _by_rank(matrix: Matrix) -> DataFrame:
    """Template columns named by rank, which are the same for any data."""
    names = [f for f in matrix.features if f.startswith("tpl_")]
    return matrix.rows.withColumnsRenamed({n: f"tpl_{i}" for i, n in enumerate(names, 1)})


def full_feature_matrix(spark, sf_dir):
    """The matrix of the detectors: the default number of templates."""
    return _by_rank(_matrix(spark, sf_dir, TEMPLATES))


def feature_matrix(spark, sf_dir):
    return _by_rank(_matrix(spark, sf_dir))


def severity_free_matrix(spark, sf_dir):
    return _by_rank(_matrix(spark, sf_dir).severity_free())


def severity_rule_scores(spark, sf_dir):
    return evaluate.scores(evaluate.rule_predictions(_matrix(spark, sf_dir))).drop("ordinal")


def zscore_stats(spark, sf_dir):
    """Mean and deviation of each feature over the training windows."""
    m = _matrix(spark, sf_dir)
    z = ZScore.fit(m)
    names = [f if not f.startswith("tpl_") else f"tpl_{i - 9}" for i, f in enumerate(m.features)]
    rows = [(n, round(a, 6), round(b, 6)) for n, a, b in zip(names, z.mean, z.std, strict=True)]
    return spark.createDataFrame(rows, "feature string, mean double, std double")


def zscore_scores(spark, sf_dir):
    m = _matrix(spark, sf_dir)
    return m.rows.select("window_start", "part", F.round(ZScore.fit(m).score(), 6).alias("score"))


def zscore_threshold(spark, sf_dir):
    m = _matrix(spark, sf_dir)
    return spark.createDataFrame([(round(ZScore.fit(m).threshold, 6), round(ZScore.fit(m.severity_free()).threshold, 6))], "all_features double, severity_free double")


def zscore_eval(spark, sf_dir):
    return evaluate.scores(evaluate.zscore_predictions(_matrix(spark, sf_dir))).drop("ordinal")


def threshold_sweep(spark, sf_dir):
    """F1 at every position of the training windows by falling event count."""
    parts = split_parts(_windows(spark, sf_dir).persist(), 0.7).filter(F.col("part").isin(*TRAIN))
    swept = metrics.sweep(parts.select("window_start", F.col("event_count").cast("double").alias("score"), F.col("is_anomalous").alias("label")))
    return swept.select("position", "window_start", "score", F.col("tp").cast("long").alias("tp"), F.round("f1", 6).alias("f1"))


def _ranked(predictions: DataFrame) -> DataFrame:
    scored = evaluate.scores(predictions).drop("ordinal")
    return api.detectors(scored.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")}))


def _best(predictions: DataFrame) -> DataFrame:
    return evaluate.best(evaluate.scores(predictions)).select("detector", "variant", F.round("f1", 6).alias("f1"))


def detector_scores_ranked(spark, sf_dir):
    return _ranked(_predictions(spark, sf_dir))


def rule_zscore_scores_ranked(spark, sf_dir):
    return _ranked(_base_predictions(spark, sf_dir))


def best_detector(spark, sf_dir):
    return _best(_predictions(spark, sf_dir))


def rule_zscore_best(spark, sf_dir):
    return _best(_base_predictions(spark, sf_dir))


def logistic_eval(spark, sf_dir):
    from logloom.operators.supervised import logistic_regression

    return metrics.confusion(logistic_regression(_matrix(spark, sf_dir, TEMPLATES).severity_free()).filter("part = 'test'"), "threshold")


def gbt_eval(spark, sf_dir):
    from logloom.operators.supervised import gradient_boosting

    return metrics.confusion(gradient_boosting(_matrix(spark, sf_dir, TEMPLATES).severity_free()).filter("part = 'test'"), "threshold", "rounds")


def iforest_eval(spark, sf_dir):
    from logloom.operators.iforest import isolation_forest

    return metrics.confusion(isolation_forest(_matrix(spark, sf_dir, TEMPLATES)).filter("part = 'test'"), "threshold")


# Read queries


def _health(spark, sf_dir, detect) -> DataFrame:
    tables = _tables(spark, sf_dir)
    return api.health(None, tables[0], evaluate.scores(detect(spark, sf_dir, tables)))


def health(spark, sf_dir):
    return _health(spark, sf_dir, _predictions)


def rule_zscore_health(spark, sf_dir):
    return _health(spark, sf_dir, _base_predictions)


def summary(spark, sf_dir):
    """Counts and spans; the windows that any detector scores are those that each scores."""
    tables = _tables(spark, sf_dir)
    return api.summary(tables[0], _base_predictions(spark, sf_dir, tables))


def first_anomalous_index(spark, sf_dir):
    tables = _tables(spark, sf_dir)
    return api.first_anomalous(tables[0], _base_predictions(spark, sf_dir, tables))


def _flags(predictions: DataFrame) -> DataFrame:
    """Flags of each scored window as JSON in the order of names."""
    return api.detector_flags(predictions).select("window_start", F.to_json("flags").alias("flags"))


def _page(spark, sf_dir, detect) -> DataFrame:
    tables = _tables(spark, sf_dir)
    page = api.windows_page(tables[0], detect(spark, sf_dir, tables), limit=100, offset=20, scored_only=True)
    return page.withColumns({"detector_flags": F.to_json("detector_flags"), "error_rate": F.round("error_rate", 6)})


def detector_flags(spark, sf_dir):
    return _flags(_predictions(spark, sf_dir))


def rule_zscore_flags(spark, sf_dir):
    return _flags(_base_predictions(spark, sf_dir))


def all_detectors_windows_page(spark, sf_dir):
    return _page(spark, sf_dir, _predictions)


def windows_page(spark, sf_dir):
    """The page with the flags of rule and z-score, as its SQL has it."""
    return _page(spark, sf_dir, _base_predictions)


def window_top_templates(spark, sf_dir):
    """The most frequent templates of the fullest window."""
    events = _events(spark, sf_dir)
    counts = aggregate.template_counts(events, HOUR)
    fullest = counts.groupBy("window_start").agg(F.sum("event_count").alias("n")).orderBy(F.desc("n"), "window_start").first()[0]
    return api.window_templates(counts, aggregate.template_catalog(events), fullest, 20)


# Loads and sinks


def _reloaded(spark, sf_dir):
    """Two overlapping loads of a log: all lines up to the 2000th, then all lines."""
    warehouse = sink.shared_folder(spark)
    lines = damaged_lines(spark, sf_dir)
    first = load.load(spark, lines.filter("line_no <= 2000"), warehouse)
    return warehouse, first, load.load(spark, lines, warehouse)


def idempotent_append(spark, sf_dir):
    """Counts of two overlapping loads, as the audit table has them."""
    warehouse, _, _ = _reloaded(spark, sf_dir)
    return load.runs(spark, warehouse).select("run_id", "lines_read", "rows_inserted", "rows_duplicate", "lines_quarantined")


def loaded_events(spark, sf_dir):
    """What the two loads leave in the event table."""
    warehouse, _, _ = _reloaded(spark, sf_dir)
    return load.table(spark, warehouse, "log_events").select("line_no", "epoch", "severity", "template_id", "line_sha256")


def replaced_windows(spark, sf_dir):
    """Rows of both window tables after sizes were built, one of them twice."""
    warehouse = sink.shared_folder(spark)
    load.load(spark, event_lines(spark, sf_dir), warehouse)
    for seconds in (HOUR, 300, HOUR):
        load.refresh_windows(spark, warehouse, seconds)
    count = lambda t: spark.read.parquet(f"{warehouse}/{t}").groupBy("window_seconds").agg(F.count(F.lit(1)).alias("n"), F.sum("event_count").alias("events"))
    a, b = count("window_features"), count("window_template_counts")
    return a.select(F.lit("features").alias("tab"), "*").unionByName(b.select(F.lit("templates").alias("tab"), "*"))


def constraint_violations(spark, sf_dir):
    """Rules that the event table breaks where every 11th node is null, every 13th line twice, every 17th
    template unknown and every 19th epoch outside of its span, with those it keeps."""
    events = _events(spark, sf_dir)
    known = aggregate.template_catalog(events).withColumn("first_seen", F.timestamp_seconds("first_seen"))
    each = lambda n: F.col("line_no") % n == 0
    broken = events.withColumns(
        {
            "node": F.when(~each(11), F.col("node")),
            "template_id": F.when(each(17), "none").otherwise(F.col("template_id")),
            "epoch": F.when(each(19), F.lit(5).cast("long")).otherwise(F.col("epoch")),
        }
    )
    broken = broken.unionByName(broken.filter(each(13)))
    return constraints.violations({"log_events": broken, "event_templates": known})


def refreshed_days(spark, sf_dir):
    """Hourly windows after a first load, a refresh, a second load of the last day alone, and a second
    refresh, which rebuilds that day; refreshed: how many days the second refresh rebuilt."""
    warehouse, lines = sink.shared_folder(spark), event_lines(spark, sf_dir)
    day = F.floor(F.split("value", " ", 3)[1].cast("bigint") / 86400)
    last = lines.agg(F.max(day)).first()[0]
    load.load(spark, lines.filter(day < last), warehouse)
    load.refresh_windows(spark, warehouse, HOUR)
    load.load(spark, lines.filter(day == last), warehouse)
    load.refresh_windows(spark, warehouse, HOUR)
    days = load.table(spark, warehouse, "window_refreshes").agg(F.max_by("days", "through_run")).first()[0]
    return load.table(spark, warehouse, "window_features").drop("window_seconds").withColumn("refreshed", F.lit(days))


def _written_log(spark, lines: DataFrame) -> str:
    """A folder with the lines as text, in their order over several files."""
    folder = f"{sink.shared_folder(spark)}/log"
    lines.repartitionByRange(4, "line_no").sortWithinPartitions("line_no").select("value").write.option("lineSep", "\n").text(folder)
    return folder


def text_lines(spark, sf_dir):
    """Lines read back from text files and numbered through, parsed."""
    lines = read_lines(spark, _written_log(spark, event_lines(spark, sf_dir)))
    sizes = lines.groupBy("source_file").agg(F.max("line_no").alias("n"))  # a row a file
    before = F.coalesce(F.sum("n").over(Window.orderBy("source_file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parsed = good(parse(lines)).join(F.broadcast(sizes.select("source_file", before.alias("before"))), "source_file")
    return parsed.select((F.col("line_no") + F.col("before")).alias("line_no"), "epoch", "node", "severity", "message", "is_alert")


def text_load_windows(spark, sf_dir):
    """A damaged log in text files, loaded and built into hourly windows."""
    warehouse = sink.shared_folder(spark)
    load.load(spark, read_lines(spark, _written_log(spark, damaged_lines(spark, sf_dir))), warehouse)
    load.refresh_windows(spark, warehouse, HOUR)
    return load.table(spark, warehouse, "window_features").drop("window_seconds", "day")


# Streams


def _topic(spark, sf_dir) -> str:
    folder = sink.shared_folder(spark)
    replay.produce(event_lines(spark, sf_dir), f"{folder}/topic", HOUR)
    return folder


_SHOWN = ("window_start", "event_count", "distinct_nodes", "distinct_templates", *exact.COUNTS, "error_rate", "alert_count", "is_anomalous")


def stream_native_windows(spark, sf_dir):
    """Hourly windows by streaming aggregation over a replayed topic."""
    folder = _topic(spark, sf_dir)
    stream = native.window_stream(replay.parsed_events(replay.topic_stream(spark, f"{folder}/topic")), HOUR)
    sink.run_available(stream, folder, "update")
    return sink.latest(spark, f"{folder}/out", "window_start").select(*_SHOWN)


def _exact(spark, sf_dir) -> DataFrame:
    """One batch of all records, with a record per partition that drains it."""
    folder = _topic(spark, sf_dir)
    drains = replay.drain_stream(spark, f"{folder}/drains", exact.PARTITIONS)
    events = replay.parsed_events(replay.topic_stream(spark, f"{folder}/topic")).unionByName(drains, allowMissingColumns=True)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", exact.PROVIDER)
    sink.run_available(exact.exact_stream(events, HOUR), folder)
    return spark.read.schema(exact.OUT).parquet(f"{folder}/out")


def stream_exact_windows(spark, sf_dir):
    """The same by exact lateness accounting, drained at the end."""
    return exact.closed_windows(_exact(spark, sf_dir), HOUR).select(*_SHOWN)


def stream_delays(spark, sf_dir):
    """Windows of the stream's index, read back: those with a delay since production, and those ahead of it."""
    windows = exact.closed_windows(_exact(spark, sf_dir), HOUR)
    stats = ZScore(WINDOW_COUNTS, (0.0,) * len(WINDOW_COUNTS), (1.0,) * len(WINDOW_COUNTS))
    folder = f"{sink.shared_folder(spark)}/index"
    scoring.documents(scoring.score_windows(windows, stats)).write.parquet(folder)
    lag = F.col("ingest_lag_ms")
    return spark.read.parquet(folder).agg(F.count(F.lit(1)).alias("windows"), F.count(lag).alias("delayed"), F.count_if(lag < 0).alias("ahead"))


def late_side_output(spark, sf_dir):
    """Late events per window when the second half of the log arrives before the first."""
    folder = sink.shared_folder(spark)
    lines = event_lines(spark, sf_dir)
    half = lines.agg(F.max("line_no")).first()[0] // 2
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", exact.PROVIDER)
    # A run after each half; the second takes up the checkpoint of the first.
    for part, condition in (("part=1", F.col("line_no") > half), ("part=2", F.col("line_no") <= half)):
        replay.produce(lines.filter(condition), f"{folder}/topic/{part}", HOUR)
        events = replay.parsed_events(replay.topic_stream(spark, f"{folder}/topic/part=*"))
        sink.run_available(exact.exact_stream(events, HOUR), folder)
    return exact.late_events(spark.read.schema(exact.OUT).parquet(f"{folder}/out"))


def _clocks(spark, sf_dir) -> str:
    """A topic whose two partitions hold the even and the odd days, read in steps; every 50th
    line arrives after all others. The folder of the run."""
    folder = sink.shared_folder(spark)
    lines = event_lines(spark, sf_dir)
    delayed, day = F.col("line_no") % 50 == 0, (F.floor(F.col("epoch") / 86400) % 2).cast("int")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", exact.PROVIDER)
    for part in (~delayed, delayed):
        ends = replay.produce_partitioned(lines.filter(part), f"{folder}/topic", 2, HOUR, day)
        stream = topic.topic_stream(spark, f"{folder}/topic", -(-sum(ends.values()) // 4), f"{folder}/progress")
        sink.run_until_idle(exact.exact_stream(replay.parsed_events(stream), HOUR), folder)
    return folder


def stream_partition_clocks(spark, sf_dir):
    """Windows and late events of two partitions whose clocks are a day apart: each closes by its own."""
    rows = spark.read.schema(exact.OUT).parquet(f"{_clocks(spark, sf_dir)}/out")
    closed = rows.filter("kind = 'window'").select("partition", "window_start", "event_count", "distinct_nodes", "distinct_templates", "alert_count")
    late = rows.filter("kind = 'late'").groupBy("partition", "window_start").agg(F.count(F.lit(1)).alias("late_events"))
    return closed.join(late, ["partition", "window_start"], "full_outer").fillna(0)


def stream_open_windows(spark, sf_dir):
    """What the same run's checkpoint holds: each partition's clock, and its windows that no event has closed yet."""
    checkpoint = f"{_clocks(spark, sf_dir)}/checkpoint"
    left = inspect.open_windows(spark, checkpoint).select("partition", "window_start", "event_count", "distinct_nodes", "distinct_templates")
    return inspect.clocks(spark, checkpoint).join(left, "partition", "left")


def member_totals(spark, sf_dir):
    """Totals and work span over the members that share a replay (users by their number)."""
    events = _events(spark, sf_dir).withColumn("member", F.col("node").cast("bigint") % 3)
    members = events.groupBy("member").agg(F.count(F.lit(1)).alias("records"), F.count_if("is_alert").alias("alerts"), F.min("epoch").alias("first"), F.max("epoch").alias("last"))
    return members.agg(
        F.count(F.lit(1)).alias("members"), F.sum("records").alias("records"), F.sum("alerts").alias("alerts"), (F.max("last") - F.min("first")).alias("span"), F.median("records").alias("median_records")
    )


def stream_batch_parity(spark, sf_dir):
    """Windows of the stream against those of the batch."""
    batch, stream = _windows(spark, sf_dir), stream_native_windows(spark, sf_dir)
    return compare.parity(batch, stream, "window_start", list(_SHOWN[1:]))


def scored_documents(spark, sf_dir):
    """Index rows of the windows, scored with statistics of the training half."""
    events = _events(spark, sf_dir)
    windows = aggregate.window_features(events, HOUR).persist()
    stats = scoring.load_statistics(scoring.export_statistics(windows, aggregate.template_counts(events, HOUR), HOUR))
    docs = scoring.documents(scoring.score_windows(windows.withColumn("late_events", F.lit(0).cast("long")), stats))
    return docs.withColumns({"zscore": F.round("zscore", 6), "error_rate": F.round("error_rate", 6)})


def flagged_top10(spark, sf_dir):
    docs = scored_documents(spark, sf_dir)
    return docs.filter("flagged").orderBy(F.desc("zscore"), "window_id").limit(10).select("window_id", "event_count", "zscore", "severity_flag", "zscore_flag")
