"""One query per operator, on the shared test tables. Each takes (spark, folder) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, NaiveBayes, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trisect.operators import auc_difference as auc_test
from trisect.operators import checks, cross_checks, drift, features, metrics, profiles, summary
from trisect.operators.joint_drift import joint_drift as joint_distance
from trisect.operators.quantiles import edge_probabilities, quantiles
from trisect.operators.split import SplitSpec, fit_split, random_split_by_hash, split, split_in_blocks
from trisect.plans import calibration, distinct_users, halving, interpretation, monitoring, search
from trisect.plans.extra_trees import ExtraTreesClassifier
from trisect.plans.selection import MODEL_NAME, PARAMS_NAME, RANKING_NAME, run_selection
from trisect.session import scratch_path
from trisect.sources import tables, versions
from trisect.streaming import continuous

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

LINE_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
PRICES = ("l_quantity", "l_extendedprice", "l_discount")
DRIFT_CUT = "1999-01-01"


def query(make: Callable[[SparkSession, str], DataFrame]):
    QUERIES[make.__name__] = make
    return make


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return tables.read_table(spark, f"{folder}/{name}.parquet")


def digits(name: str) -> Column:
    """A double to eight significant digits, so that the order of additions does not show."""
    return F.format_string("%.7e", F.col(name)).cast("double").alias(name)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*[digits(c) if c in names else c for c in df.columns])


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


# Distinct entities


@query
def monthly_distinct(spark, folder):
    return distinct_users.monthly_distinct(read(spark, folder, "orders"), "o_orderdate", ["o_custkey", "o_orderpriority"])


@query
def monthly_distinct_range(spark, folder):
    return distinct_users.monthly_distinct(
        read(spark, folder, "orders"), "o_orderdate", ["o_custkey", "o_orderpriority"], "1997-03-15", "1999-06-30"
    )


# Splits


@query
def split_random_stratified(spark, folder):
    spec = SplitSpec("random", target="o_orderstatus", stratify=("o_orderpriority",), key=("o_orderkey",))
    return split(read(spark, folder, "orders"), spec).select("o_orderkey", "subset")


@query
def split_random_hash(spark, folder):
    return random_split_by_hash(read(spark, folder, "orders"), ["o_orderkey"]).select("o_orderkey", "subset")


@query
def split_time_fraction(spark, folder):
    spec = SplitSpec("time", time="ts", key=("event_id",), train=0.7, test=0.2)
    return split(read(spark, folder, "events"), spec).select("event_id", "subset")


@query
def split_time_cut(spark, folder):
    spec = SplitSpec("time", time="o_orderdate", train="1998-01-01", test="2000-01-01")
    return split(read(spark, folder, "orders"), spec).select("o_orderkey", "subset")


@query
def split_metric(spark, folder):
    spec = SplitSpec("metric", metric="o_totalprice")
    return split(read(spark, folder, "orders"), spec).select("o_orderkey", "subset")


@query
def split_within_group(spark, folder):
    spec = SplitSpec("time", time="l_shipdate", key=LINE_KEY, train=0.7, test=0.2, by=("l_returnflag",))
    return split(read(spark, folder, "lineitem"), spec).select(*LINE_KEY, "subset")


@query
def split_metric_within_group(spark, folder):
    spec = SplitSpec("metric", metric="o_totalprice", by=("o_orderpriority",))
    return split(read(spark, folder, "orders"), spec).select("o_orderkey", "subset")


@query
def split_random_within_group(spark, folder):
    spec = SplitSpec("random", target="l_linestatus", key=LINE_KEY, by=("l_returnflag",))
    return split(read(spark, folder, "lineitem"), spec).select(*LINE_KEY, "subset")


@query
def split_blockwise(spark, folder):
    spec = SplitSpec("time", time="ts", key=("event_id",), train=0.7, test=0.2)
    blocks = split_in_blocks(read(spark, folder, "events"), spec, "event_id", 1000)
    return blocks.select("event_id", "block", "subset")


@query
def split_sizes(spark, folder):
    spec = SplitSpec("random", target="o_orderstatus", key=("o_orderkey",), train=0.7, test=0.2, backtest=0.1)
    assigned = split(read(spark, folder, "orders"), spec)
    return assigned.groupBy("subset", "o_orderstatus").agg(F.count("*").alias("n"))


# Drift


def orders_over_time(spark, folder) -> DataFrame:
    return drift.marked(read(spark, folder, "orders"), F.col("o_orderdate") < ntz(DRIFT_CUT), ["o_totalprice"])


def lines_over_time(spark, folder) -> DataFrame:
    return drift.marked(read(spark, folder, "lineitem"), F.col("l_shipdate") < ntz(DRIFT_CUT), PRICES)


@query
def quantile_edges(spark, folder):
    found = quantiles(read(spark, folder, "lineitem"), PRICES, edge_probabilities(10))
    return found.select("column", "i", F.round("quantile", 6).alias("quantile"))


@query
def histogram_by_edges(spark, folder):
    both = lines_over_time(spark, folder)
    return drift.histogram_by_edges(both, drift.reference_edges(both, PRICES))


@query
def psi(spark, folder):
    return rounded(drift.psi(lines_over_time(spark, folder), PRICES), "psi")


@query
def psi_open_ends(spark, folder):
    both = orders_over_time(spark, folder)
    return rounded(drift.psi(both, ["o_totalprice"], open_ends=True), "psi")


@query
def psi_categories(spark, folder):
    columns = ["l_returnflag", "l_linestatus"]
    both = drift.marked(read(spark, folder, "lineitem"), F.col("l_shipdate") < ntz(DRIFT_CUT), columns)
    return rounded(drift.divergences(drift.category_counts(both, columns)), "psi", "js_divergence")


@query
def js_divergence(spark, folder):
    return rounded(drift.js_divergence(lines_over_time(spark, folder), PRICES), "js_divergence")


@query
def ks_stat(spark, folder):
    return rounded(drift.ks(lines_over_time(spark, folder), PRICES).select("column", "ks_stat"), "ks_stat")


@query
def ks_pvalue(spark, folder):
    found = drift.ks(orders_over_time(spark, folder), ["o_totalprice"])
    return rounded(found.select("column", "ks_pvalue", "n_ref", "n_cur"), "ks_pvalue")


@query
def mean_var_diff(spark, folder):
    return rounded(drift.mean_var_diff(lines_over_time(spark, folder), PRICES), "mean_diff", "var_diff")


@query
def stability_report(spark, folder):
    return rounded(drift.stability_report(lines_over_time(spark, folder), PRICES), *drift.STATISTICS)


@query
def split_stability(spark, folder):
    spec = SplitSpec("time", time="o_orderdate", key=("o_orderkey",))
    assigned = split(read(spark, folder, "orders"), spec)
    return rounded(drift.split_report(assigned, ["o_totalprice"]), *drift.STATISTICS)


@query
def drift_alert(spark, folder):
    both = drift.marked(
        read(spark, folder, "orders"), F.col("o_orderstatus") == "F", ["o_totalprice", "o_custkey"]
    )
    return rounded(monitoring.drift_alert(both, ["o_totalprice", "o_custkey"]), *drift.STATISTICS)


@query
def drift_by_period(spark, folder):
    found = monitoring.drift_by_period(
        read(spark, folder, "orders"), "o_orderdate", "year", F.col("o_orderdate") < ntz("1996-01-01"), ["o_totalprice"]
    )
    return rounded(found, "psi", "js_divergence")


@query
def joint_drift(spark, folder):
    """Distance of the joint distribution of prices before and after a date."""
    found = joint_distance(lines_over_time(spark, folder), PRICES, features=16)
    return found.select(F.round("mmd2", 10).alias("mmd2"), "n_ref", "n_cur")


def monthly_profiles(spark, folder) -> DataFrame:
    """Stored profiles of the orders by month, as later queries read them."""
    orders = read(spark, folder, "orders")
    month = orders.withColumn("month", F.date_trunc("month", "o_orderdate").cast("timestamp_ntz"))
    root = scratch_path(spark, "profiles")
    found = profiles.profile(month, ["o_totalprice"], ["o_orderpriority", "o_orderstatus"], by=["month"])
    tables.write_artifact(found, root, "orders", "1")
    return tables.read_artifact(spark, root, "orders", "1").withColumn("year", F.year("month"))


@query
def profile_quantiles(spark, folder):
    """Quartiles of prices by year, from merged monthly profiles; exact up to about 4,000 orders a year."""
    years = profiles.merge(monthly_profiles(spark, folder), ["year"])
    return profiles.profile_quantiles(years, [0.25, 0.5, 0.75], ["year"])


@query
def profile_drift(spark, folder):
    """Drift of categories by year against the years before 1997, from merged monthly profiles."""
    months = monthly_profiles(spark, folder).where(F.col("kind") == profiles.CATEGORY)
    found = profiles.profile_drift(
        profiles.merge(months.where("year < 1997")), profiles.merge(months, ["year"]), ["year"]
    )
    return rounded(found, "psi", "js_divergence")


# Streams


@query
def stream_monitor(spark, folder):
    """The events as a stream, watched by day against the first ten days."""
    events = read(spark, folder, "events")
    reference = events.where(F.col("ts") < ntz("2024-01-11")).select("value", "user_id")
    edges = drift.reference_edges(reference.withColumn("is_ref", F.lit(True)), ["value", "user_id"])
    watch = continuous.Watch("ts", "1 day", edges, high=0.04, low=0.02, up=2, down=2, least_rows=20)
    monitor = continuous.Monitor(scratch_path(spark, "monitor"), watch, continuous.reference_counts(reference, edges))
    # A pattern, since a table may be one file, which a stream cannot take for its base folder.
    monitor.start(spark.readStream.schema(events.schema).parquet(f"{folder}/events[.]parquet")).awaitTermination()
    state = F.when(F.col("alert").isNull(), "open").when(F.col("alert"), "alert").otherwise("calm")
    found = monitor.report(spark).withColumn("state", state).drop("alert")
    return rounded(found, "psi", "js_divergence")


# Summaries


@query
def histogram_equal_width(spark, folder):
    found = summary.histogram_equal_width(read(spark, folder, "customer"), ["c_acctbal"], ["c_mktsegment"])
    return rounded(found, "low", "high")


@query
def box_summary(spark, folder):
    found = summary.box_summary(read(spark, folder, "documents"), ["n_chars"], ["lang"])
    return rounded(found, "q1", "median", "q3", "whisker_low", "whisker_high")


@query
def ecdf(spark, folder):
    spec = SplitSpec("time", time="o_orderdate", train="1998-01-01", test="2000-01-01")
    assigned = split(read(spark, folder, "orders"), spec)
    return rounded(summary.ecdf(assigned, ["o_totalprice"], ["subset"]), "cdf_low", "cdf_high")


@query
def eda_univariate(spark, folder):
    found = summary.describe_columns(read(spark, folder, "lineitem"), [*PRICES, "l_tax"])
    return rounded(found, "mean", "sd", "min", "max", "skewness", "kurtosis", "q1", "median", "q3")


@query
def eda_outliers(spark, folder):
    found = summary.outlier_counts(read(spark, folder, "documents"), ["n_chars"])
    return rounded(found, "outlier_share")


@query
def eda_bivariate(spark, folder):
    lines = read(spark, folder, "lineitem").withColumn("returned", F.col("l_returnflag") == "R")
    return rounded(summary.target_by_bin(lines, PRICES, "returned"), "low", "high", "target_mean")


# Guards, projections, sources


@query
def label_cardinality(spark, folder):
    return metrics.label_cardinality(read(spark, folder, "labels"), "quality")


@query
def distinct_labels(spark, folder):
    return read(spark, folder, "lineitem").select("l_returnflag").distinct()


@query
def target_null_check(spark, folder):
    orders = read(spark, folder, "orders").withColumn("target", F.nullif("o_orderpriority", F.lit("5-LOW")))
    old = F.col("o_orderdate") < ntz(DRIFT_CUT)
    return checks.target_nulls({"train": orders.where(old), "test": orders.where(~old)}, "target")


@query
def feature_projection(spark, folder):
    return features.project(read(spark, folder, "lineitem"), [*PRICES, "l_tax"], "l_returnflag")


@query
def label_map(spark, folder):
    orders = read(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return features.display_names(orders, "o_orderstatus", {"F": "Filled", "O": "Open"}, "status_name")


@query
def feature_metadata(spark, folder):
    orders = read(spark, folder, "orders")
    priority = F.col("o_orderpriority")
    document = (
        F.when(priority == "1-URGENT", F.lit('{"target": null, "all": []}'))
        .when(priority == "2-HIGH", F.concat(F.lit('{"all": "'), "o_orderstatus", F.lit('"}')))
        .when(priority == "3-MEDIUM", F.to_json(F.struct(F.col("o_orderstatus").alias("target"), F.array("o_orderstatus", priority).alias("all"))))
        .otherwise(F.to_json(F.struct(F.array(priority, F.lit("y")).alias("target"), F.array(priority).alias("all"))))
    )
    read_back = tables.read_metadata(orders.select("o_orderkey", document.alias("document")), "document")
    return read_back.select("o_orderkey", "target", F.array_join("features", ",").alias("features"))


@query
def artifact_roundtrip(spark, folder):
    root = scratch_path(spark, "artifacts")
    tables.write_artifact(read(spark, folder, "customer"), root, "customers", "1")
    return tables.read_artifact(spark, root, "customers", "1")


@query
def scan_csv_dates(spark, folder):
    path = scratch_path(spark, "csv")
    form = "yyyy-MM-dd HH:mm:ss"
    orders = read(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    orders.write.options(header=True, timestampNTZFormat=form).csv(path)
    return tables.read_csv(spark, path, orders.schema, form)


def dirty_orders(spark, folder) -> tables.Ingested:
    """Orders as JSON text in which some prices are not numbers, read back with their schema."""
    path = scratch_path(spark, "json")
    orders = read(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    price = F.when(F.col("o_orderpriority") == "5-LOW", "n/a").otherwise(F.col("o_totalprice").cast("string"))
    orders.withColumn("o_totalprice", price).write.json(path)
    return tables.ingest(spark, path, orders.schema)


@query
def ingest_valid_rows(spark, folder):
    return dirty_orders(spark, folder).valid


@query
def ingest_rejected_rows(spark, folder):
    rejected = dirty_orders(spark, folder).rejected
    return rejected.select("o_orderkey", "o_totalprice", F.array_join("faults", ",").alias("faults"))


@query
def compare_versions(spark, folder):
    """Customers as published, and once more with some removed, added and changed."""
    root = scratch_path(spark, "versions")
    first = read(spark, folder, "customer")
    moved = F.when(F.col("c_custkey") % 97 == 5, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))
    second = first.where("c_custkey % 89 <> 3").withColumn("c_acctbal", moved)
    more = first.where("c_custkey % 83 = 7").withColumn("c_custkey", F.col("c_custkey") + 1_000_000_000)
    old = versions.publish(first, root, "customers", "1", ["c_custkey"], buckets=64)
    new = versions.publish(second.unionByName(more), root, "customers", "2", ["c_custkey"], parent="1")
    return versions.compare(old, new)


# Checks


@query
def validate_rules(spark, folder):
    orders = read(spark, folder, "orders")
    return checks.apply_rules(orders, [
        checks.not_null(orders, "o_totalprice"),
        checks.in_range("o_totalprice", 2000, 450000),
        checks.one_of("o_orderstatus", ["F", "O"]),
        checks.has_type(orders, "o_orderkey", "bigint"),
        checks.has_type(orders, "o_totalprice", "decimal(12,2)"),
    ])


@query
def validate_across_tables(spark, folder):
    """References between orders, customers, lines and parts, dependencies and numbers of lines."""
    orders, lines = read(spark, folder, "orders"), read(spark, folder, "lineitem")
    customers, parts = read(spark, folder, "customer"), read(spark, folder, "part")
    # Only customers of some segments, so that the rule has something to find.
    known = customers.where("c_mktsegment <> 'BUILDING'")
    found = cross_checks.report(
        cross_checks.refers_to("orders.o_custkey", orders, ["o_custkey"], customers, ["c_custkey"]),
        cross_checks.refers_to("orders.o_custkey, known", orders, ["o_custkey"], known, ["c_custkey"]),
        cross_checks.refers_to("lineitem.l_partkey", lines, ["l_partkey"], parts, ["p_partkey"]),
        cross_checks.determines("orders.o_custkey -> o_orderstatus", orders, ["o_custkey"], ["o_orderstatus"]),
        cross_checks.has_children("lines of an order", orders, ["o_orderkey"], lines, ["l_orderkey"], 1, 7),
        cross_checks.adds_up("o_totalprice", orders, ["o_orderkey"], "o_totalprice", lines, ["l_orderkey"], "l_extendedprice", 1000.0),
    )
    shown = F.array_join(F.transform("sample", lambda s: F.concat(s["key"], F.lit(":"), s["n"].cast("string"))), " ")
    return found.withColumn("sample", shown)


@query
def validate_duplicates(spark, folder):
    return checks.duplicate_keys(read(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def validate_predictions(spark, folder):
    scored = read(spark, folder, "documents").select((F.col("n_chars") / 5000.0).alias("score"), "lang")
    english = F.col("lang") == "en"
    return checks.check_predictions(
        scored.where(~english), "score", "lang", ["de", "fr"], reference=scored.where(english)
    )


# Classifier metrics


def scored_documents(spark, folder) -> DataFrame:
    """Labelled documents with a score and a prediction made from their length."""
    documents = read(spark, folder, "documents").select("doc_id", "n_chars")
    scored = read(spark, folder, "labels").join(documents, "doc_id")
    length = F.col("n_chars").cast("double")
    return scored.select(
        "doc_id", "quality", (length / (length + 1500.0)).alias("score"), (length > 900).cast("int").alias("predicted")
    )


def scored_lines(spark, folder) -> tuple[DataFrame, dict[object, Column]]:
    """Order lines with one score per return flag, made from their numbers."""
    lines = read(spark, folder, "lineitem")
    a, n = F.col("l_quantity") / 100.0, F.col("l_discount") * 4.0
    lines = lines.select("l_returnflag", a.alias("A"), n.alias("N"), (1.0 - F.col("l_tax") * 5.0).alias("R"))
    best = F.when((F.col("A") >= F.col("N")) & (F.col("A") >= F.col("R")), "A").when(F.col("N") >= F.col("R"), "N").otherwise("R")
    return lines.withColumn("predicted", best), {c: F.col(c) for c in ("A", "N", "R")}


@query
def roc_auc_binary(spark, folder):
    return rounded(metrics.roc_auc_binary(scored_documents(spark, folder), "quality", "score"), "auc")


@query
def roc_auc_per_class(spark, folder):
    lines, scores = scored_lines(spark, folder)
    return rounded(metrics.roc_auc_per_class(lines, "l_returnflag", scores), "auc")


@query
def roc_auc_ovr_weighted(spark, folder):
    lines, scores = scored_lines(spark, folder)
    return rounded(metrics.roc_auc_ovr_weighted(lines, "l_returnflag", scores), "auc")


@query
def confusion_matrix(spark, folder):
    return metrics.confusion_matrix(scored_documents(spark, folder), "quality", "predicted")


@query
def accuracy(spark, folder):
    return rounded(metrics.accuracy(confusion_matrix(spark, folder)), "accuracy")


@query
def f1_weighted(spark, folder):
    return rounded(metrics.f1_weighted(confusion_matrix(spark, folder)), "f1")


@query
def classification_report(spark, folder):
    scored = scored_documents(spark, folder)
    scores = {0: 1 - F.col("score"), 1: F.col("score")}
    return rounded(metrics.classification_report(scored, "quality", "predicted", scores), "value")


@query
def classification_report_multiclass(spark, folder):
    lines, scores = scored_lines(spark, folder)
    return rounded(metrics.classification_report(lines, "l_returnflag", "predicted", scores), "value")


@query
def auc_difference(spark, folder):
    """How well price and quantity tell returned lines from others, and whether one does better."""
    found = auc_test.auc_difference(read(spark, folder, "lineitem"), "l_returnflag", "l_extendedprice", "l_quantity", "R")
    return found.select("n_pos", "n_neg", *[F.round(c, 9).alias(c) for c in found.columns[2:]])


@query
def score_deciles(spark, folder):
    found = metrics.score_deciles(scored_documents(spark, folder), "quality", F.col("score"), ["doc_id"])
    return rounded(found, "min_score", "max_score", "rate", "lift", "gain")


@query
def calibration_bins(spark, folder):
    found = metrics.calibration_bins(scored_documents(spark, folder), "quality", F.col("score"))
    return rounded(found, "mean_score", "rate")


@query
def isotonic_calibration(spark, folder):
    """Share of returned lines by quantity, observed and fitted to be non-decreasing."""
    found = calibration.isotonic_table(read(spark, folder, "lineitem"), "l_returnflag", "l_quantity", "R")
    return rounded(found, "rate", "fitted")


# Features


@query
def feature_information_value(spark, folder):
    lines = read(spark, folder, "lineitem").withColumn("returned", (F.col("l_returnflag") == "R").cast("int"))
    return rounded(features.information_value(lines, PRICES, "returned"), "information_value")


@query
def feature_correlation(spark, folder):
    found = features.correlations(read(spark, folder, "lineitem"), [*PRICES, "l_tax"])
    return found.select("feature_a", "feature_b", F.round("correlation", 9).alias("correlation"))


@query
def features_impute_scale(spark, folder):
    customers = read(spark, folder, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance")
    )
    scaled = features.impute_and_scale(["balance"]).fit(customers).transform(customers)
    return scaled.select("c_custkey", F.round(vector_to_array("scaled")[0], 9).alias("scaled"))


@query
def features_index_onehot(spark, folder):
    orders = read(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    encoded = features.index_and_onehot(["o_orderpriority"]).fit(orders).transform(orders)
    position = F.array_position(vector_to_array("o_orderpriority_onehot"), F.lit(1.0)) - 1
    return encoded.select("o_orderkey", F.col("o_orderpriority_index").cast("int").alias("index"), position.alias("position"))


@query
def features_date_parts(spark, folder):
    orders = read(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return features.date_parts(orders, "o_orderdate").drop("o_orderdate")


@query
def feature_selection(spark, folder):
    lines = read(spark, folder, "lineitem").withColumn("returned", (F.col("l_returnflag") == "R").cast("int"))
    found = features.feature_selection(lines, [*PRICES, "l_tax"], "returned", top=2)
    return found.select(
        "feature", F.round("variance", 4).alias("variance"), F.round("f_value", 6).alias("f_value"), "most_correlated", "kept"
    )


# Model search

FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linestatus")
QUICK = (
    search.Candidate("Logistic Regression (L1)", search.LOGISTIC_L1.make, search.LOGISTIC_L1.grid[:1]),
    search.LINEAR,
)
# Fits of the catalog: a fixed number of partitions, and no time budget.
PARTITIONS = 8


def model_lines(spark, folder) -> DataFrame:
    return read(spark, folder, "lineitem").withColumn("returned", (F.col("l_returnflag") == "R").cast("int"))


def model_tables(spark, folder) -> tuple[DataFrame, DataFrame]:
    lines = model_lines(spark, folder)
    spec = SplitSpec("time", time="l_shipdate", train="1999-06-01", test="2001-06-01")
    parts = fit_split(lines, spec).parts(lines)
    return parts.train, parts.test


def ranking_rows(ranking: DataFrame) -> DataFrame:
    return ranking.select("estimator_name", "metric_train", "metric_test", F.to_json("hiperparameters").alias("hiperparameters"))


@query
def model_search(spark, folder):
    train, test = model_tables(spark, folder)
    return ranking_rows(search.search_models(
        train, test, FEATURES, "returned", search.SEARCH_FAMILIES, budget_s=None, partitions=PARTITIONS, parallelism=4
    ).ranking)


@query
def model_search_f1(spark, folder):
    lines = read(spark, folder, "lineitem")
    found = search.search_with_holdout(
        lines, FEATURES, "l_returnflag", LINE_KEY, budget_s=None, partitions=PARTITIONS, parallelism=3
    )
    return ranking_rows(found.ranking)


@query
def model_ranking(spark, folder):
    train, test = model_tables(spark, folder)
    return ranking_rows(search.search_models(train, test, FEATURES, "l_returnflag", QUICK, budget_s=None, partitions=PARTITIONS, parallelism=4).ranking)


@query
def best_model(spark, folder):
    train, test = model_tables(spark, folder)
    return ranking_rows(search.best_model(
        search.search_models(train, test, FEATURES, "returned", QUICK, budget_s=None, partitions=PARTITIONS, parallelism=4).ranking
    ))


# A family of the caller's own, with a fit that SQL can repeat.
OWN_FAMILY = search.Candidate(
    "Gaussian Naive Bayes", lambda *_: NaiveBayes(modelType="gaussian", labelCol=search.LABEL, featuresCol=search.FEATURES)
)


def own_search(spark, folder) -> search.SearchResult:
    train, test = model_tables(spark, folder)
    return search.search_models(train, test, PRICES, "returned", (OWN_FAMILY,), budget_s=None, partitions=PARTITIONS)


@query
def own_family_ranking(spark, folder):
    ranking = search.best_model(own_search(spark, folder).ranking)
    return ranking.select("estimator_name", F.round("metric_train", 6).alias("metric_train"), F.round("metric_test", 6).alias("metric_test"))


@query
def own_family_scores(spark, folder):
    """Probability and label of every line by the best model."""
    scored = own_search(spark, folder).predict_proba(model_lines(spark, folder))
    return scored.select(
        *LINE_KEY, F.round(F.col("scores")[1], 7).alias("score"), F.round(F.col("scores")[0] + F.col("scores")[1], 7).alias("total"),
        F.col("predicted").cast("int").alias("predicted"),
    )


@query
def table_guards(spark, folder):
    """Which tables have the target, hold rows, and miss no target."""
    return checks.guard_report({n: read(spark, folder, n) for n in ("orders", "customer", "events")}, "o_orderstatus")


@query
def selection_job(spark, folder):
    root = scratch_path(spark, "selection")
    train, test = model_tables(spark, folder)
    tables.write_artifact(train, root, "train", "1")
    tables.write_artifact(test, root, "test", "1")
    names = F.transform(F.lit(list(FEATURES)), lambda c: c)
    document = F.to_json(F.struct(F.lit("returned").alias("target"), names.alias("all"))).alias("document")
    tables.write_artifact(spark.range(1).select(document), root, "features", "1")
    run_selection(
        spark, root, ("train", "1"), ("test", "1"), ("features", "1"), "1", budget_s=None, partitions=PARTITIONS, parallelism=4
    )
    ranking = tables.read_artifact(spark, root, RANKING_NAME, "1")
    params = tables.read_artifact(spark, root, PARAMS_NAME, "1")
    PipelineModel.load(tables.artifact_path(root, MODEL_NAME, "1"))
    return ranking_rows(ranking).join(
        params.select("estimator_name", F.lit(True).alias("selected")), "estimator_name", "left"
    )


@query
def halving_samples(spark, folder):
    """Samples of a search over 18 parameter sets for the price of four full fits."""
    lines = read(spark, folder, "lineitem")
    n = lines.count()
    return halving.rung_sizes(lines, LINE_KEY, halving.plan_rungs(n, 18, 4 * n, least_rows=100))


@query
def halving_search(spark, folder):
    train, test = model_tables(spark, folder)
    linear = halving.spread_grid(search.LINEAR, {"regParam": (1e-4, 1.0, "log"), "elasticNetParam": (0.0, 1.0)}, 6)
    forest = halving.spread_grid(search.FOREST, {"numTrees": (4, 10), "maxDepth": (3, 6)}, 3)
    _, fits = halving.search_halving(
        train, test, FEATURES, "returned", LINE_KEY, (linear, forest), 4 * train.count(), partitions=PARTITIONS, parallelism=2
    )
    return fits.withColumn("hiperparameters", F.to_json("hiperparameters"))


@query
def hyperparam_search(spark, folder):
    train, _ = model_tables(spark, folder)
    found, _ = search.search_hyperparams(
        train, FEATURES, "returned", LINE_KEY, LogisticRegression(), {"regParam": [0.001, 0.1]}, partitions=PARTITIONS
    )
    return found.select(F.to_json("hiperparameters").alias("hiperparameters"), "metric")


@query
def feature_reduction(spark, folder):
    train, _ = model_tables(spark, folder)
    forest, _ = search.fit_final(train, FEATURES, "returned", RandomForestClassifier(numTrees=10, seed=42), partitions=PARTITIONS)
    slicer = features.keep_important(list(forest.stages[-1].featureImportances), 2, search.FEATURES)
    # Fitted on the train part, applied to all lines.
    sliced = PipelineModel([*forest.stages[:-1], slicer])
    components = features.principal_components(1, "reduced").fit(sliced.transform(train))
    parts = components.transform(sliced.transform(model_lines(spark, folder)))
    return parts.select(
        *LINE_KEY, vector_to_array("reduced").alias("reduced"), vector_to_array("components")[0].alias("component")
    )


def saved_model(spark, folder, name: str, estimator) -> tuple[PipelineModel, list[str], DataFrame]:
    """Fit, save and load a final model; its labels and the rows held back for validation."""
    train, test = model_tables(spark, folder)
    model, labels = search.fit_final(train, FEATURES, "returned", estimator, partitions=PARTITIONS)
    path = tables.write_model(model, scratch_path(spark, "models"), name, "1")
    return PipelineModel.load(path), labels, test


@query
def final_model(spark, folder):
    model, labels, test = saved_model(spark, folder, "final", LogisticRegression(regParam=0.001))
    return search.evaluate(model, labels, test, "returned")


@query
def batch_score(spark, folder):
    model, labels, _ = saved_model(spark, folder, "scorer", LogisticRegression(regParam=0.001))
    return search.score(model, labels, model_lines(spark, folder)).select(*LINE_KEY, F.col("scores")[1].alias("score"), "predicted")


@query
def compare_models(spark, folder):
    new, labels, test = saved_model(spark, folder, "new", LogisticRegression(regParam=0.001))
    old, _, _ = saved_model(spark, folder, "old", LogisticRegression(regParam=0.5, elasticNetParam=1.0))
    return monitoring.compare_models(
        search.evaluate(new, labels, test, "returned"), search.evaluate(old, labels, test, "returned")
    )


@query
def feature_importance(spark, folder):
    train, _ = model_tables(spark, folder)
    model, _ = search.fit_final(train, FEATURES, "returned", RandomForestClassifier(numTrees=10, seed=42), partitions=PARTITIONS)
    return search.importances(spark, model)


LINEAR_SCORE = "0.02 * l_quantity - 3 * l_discount + 0.000001 * l_extendedprice"


def with_linear_score(df: DataFrame) -> DataFrame:
    return df.withColumn("score", F.expr(LINEAR_SCORE))


@query
def permutation_importance(spark, folder):
    """How much each number of a line counts in a linear score for returned lines."""
    found = interpretation.permutation_importance(
        read(spark, folder, "lineitem").select(*LINE_KEY, *PRICES, "l_returnflag"), LINE_KEY, PRICES, "l_returnflag", with_linear_score,
        {"other": -F.col("score"), "R": F.col("score")}, repeats=2,
    )
    return found.select("feature", "repeats", *[F.round(c, 9).alias(c) for c in ("auc", "auc_exchanged", "importance", "std")])


@query
def partial_dependence(spark, folder):
    """Mean of the linear score over all lines, each number held at its quintiles."""
    found = interpretation.partial_dependence(
        read(spark, folder, "lineitem"), PRICES, with_linear_score, F.col("score"), points=6
    )
    return rounded(found.withColumn("value", F.col("value").cast("double")), "value", "mean_score")


@query
def extra_trees(spark, folder):
    """Predictions of extremely randomised trees on the validation lines, counted by return flag."""
    train, test = model_tables(spark, folder)
    model, labels = search.fit_final(train, FEATURES, "returned", ExtraTreesClassifier(numTrees=10, maxDepth=6), partitions=PARTITIONS)
    scored = search.score(model, labels, test)
    return scored.groupBy("returned", F.col("predicted").cast("int").alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col("scores")[1]).alias("mean_score")
    )


@query
def model_interpretation(spark, folder):
    """Permutation importance of a fitted model on the validation lines."""
    model, labels, test = saved_model(spark, folder, "explained", LogisticRegression(regParam=0.001))
    scores = {int(c): F.col("scores")[i] for i, c in enumerate(labels)}
    return interpretation.permutation_importance(
        test.select(*LINE_KEY, *FEATURES, "returned"), LINE_KEY, FEATURES, "returned", lambda df: search.score(model, labels, df), scores, repeats=1
    )
