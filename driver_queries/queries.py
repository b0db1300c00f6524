"""One query per operator. All of them read whole tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from driver_queries.view import ROLES, cleaned, history, january, occurrences, scored
from georisk.functions import scalars as S
from georisk.operators import (
    calendar,
    cleaning,
    encoding,
    evaluation,
    feeds,
    models,
    profile,
    risk,
    sampling,
    scaling,
    scenario,
)
from georisk.operators.ordering import exact_median
from georisk.plans.forecast import forecast, load_or_train
from georisk.sinks import write_csv, write_feed, write_forecast, write_metrics
from georisk.sources.forecast import load_forecast_text, scan_forecast
from georisk.sources.merged import load_merged, merge_files, read_merged
from georisk.sources.occurrences import (
    layouts,
    load_yearly,
    scan_layout,
    split_spoiled,
    unparsed_counts,
)
from georisk.workspace import new_path, settle

Query = Callable[[SparkSession, str], DataFrame]

YEAR = 1998
SCENARIO_YEAR = 2026
SEED = 4224
SCALED = ("dry_days", "precip", "frp", "lat", "lon")


def r6(value: Column | str) -> Column:
    """Sums of doubles depend on their order; six places do not."""
    return F.round(value, 6)


def rounded(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumns({name: r6(name) for name in names})


# --- ingest and cleaning -----------------------------------------------------

RAW = ("occ_id", "event_ts", "region", "locality", "dry_days", "precip", "risk", "frp", "lat", "lon")
TYPED = ("occ_id", "event_ts", "event_date", *RAW[2:])


def drop_sentinels(spark, sf_dir):
    return cleaning.drop_sentinels(occurrences(spark, sf_dir), ROLES.measures).select(*RAW)


def drop_nulls(spark, sf_dir):
    return cleaning.drop_missing(occurrences(spark, sf_dir), ROLES.measures).select(*RAW)


def spoiled_places(spark, sf_dir):
    """Occurrences that lack a place or a date now and then."""
    key = F.col("occ_id")
    return occurrences(spark, sf_dir).select(
        "occ_id",
        F.when(key % 11 != 0, F.col("lat")).alias("lat"),
        F.when(key % 13 != 0, F.col("lon")).alias("lon"),
        F.when(key % 17 != 0, F.to_date("event_ts")).alias("event_date"),
    )


def drop_missing_coords(spark, sf_dir):
    return cleaning.drop_unlocated(spoiled_places(spark, sf_dir), ROLES)


def clean_counts(spark, sf_dir):
    spoiled = spoiled_places(spark, sf_dir)
    valid = S.all_of([cleaning.present(spoiled, name) for name in ("lat", "lon", "event_date")])
    return cleaning.clean_counts(spoiled, valid)


def any_invalid_date(spark, sf_dir):
    return cleaning.any_invalid_time(spoiled_places(spark, sf_dir), "event_date")


def rescale_risk(spark, sf_dir):
    return history(spark, sf_dir).select(*TYPED)


def union_years(spark, sf_dir):
    even = F.year("event_ts") % 2 == 0
    raw = occurrences(spark, sf_dir)
    first = raw.filter(even).select("occ_id", "region", "precip")
    second = raw.filter(~even).select("frp", "occ_id", "region")
    return cleaning.union_years([first, second])


def dirty_text(spark, sf_dir):
    """Occurrences as text, spoiled by key: headers, bad numbers, bad dates."""
    key = F.col("occ_id")
    day = F.date_format("event_ts", "yyyy-MM-dd")
    slashed = F.date_format("event_ts", "yyyy/MM/dd")
    return occurrences(spark, sf_dir).select(
        key.cast("string").alias("occ_id"),
        F.when(key % 23 == 0, " event_date ")
        .when(key % 29 == 0, "not a day")
        .when(key % 31 != 0, F.when(key % 2 == 0, day).otherwise(slashed)).alias("event_date"),
        F.when(key % 37 == 0, "12,5").when(key % 41 == 0, "NaN")
        .otherwise(F.concat(F.lit(" "), F.col("lat").cast("string"))).alias("lat"),
        F.when(key % 43 == 0, "1d").otherwise(F.col("lon").cast("string")).alias("lon"),
        F.col("precip").cast("string").alias("precip"),
    )


def drop_repeated_header(spark, sf_dir):
    return cleaning.drop_repeated_header(dirty_text(spark, sf_dir), ROLES)


def coerce_text(spark, sf_dir):
    return cleaning.coerce_text(dirty_text(spark, sf_dir), ROLES)


def distinct_days(spark, sf_dir):
    return profile.edge_days(occurrences(spark, sf_dir), "event_ts")


def year_filter(spark, sf_dir):
    return cleaning.keep_year(occurrences(spark, sf_dir), "event_ts", YEAR).select(*RAW)


# --- sources and sinks -------------------------------------------------------

def write_yearly_files(spark, sf_dir):
    """Occurrences as CSV in two layouts: other column order, other dates."""
    folder = new_path(spark, "yearly")
    raw, even = occurrences(spark, sf_dir), F.year("event_ts") % 2 == 0

    def timed(part, layout):
        return part.withColumn("event_ts", F.date_format("event_ts", layout))

    plain = timed(raw.filter(even), "yyyy-MM-dd HH:mm:ss")
    slashed = timed(raw.filter(~even), "yyyy/MM/dd HH:mm:ss").select(*reversed(raw.columns))
    for name, part in (("even", plain), ("odd", slashed)):
        part.write.options(header="true", nullValue="NA", escape='"').csv(f"{folder}/{name}")
    return f"{folder}/*/*.csv"


def write_spoiled_files(spark, sf_dir):
    """Yearly files in which some texts are no numbers."""
    folder, key = new_path(spark, "spoiled"), F.col("occ_id")
    spoiled = occurrences(spark, sf_dir).select(
        "occ_id", "region",
        F.when(key % 37 == 0, "12,5").when(key % 41 == 0, "NaN")
        .otherwise(F.concat(F.lit(" "), F.col("lat").cast("string"))).alias("lat"),
        F.when(key % 43 == 0, "1d").otherwise(F.col("lon").cast("string")).alias("lon"),
        F.when(key % 47 == 0, "0x10").otherwise(F.col("precip").cast("string")).alias("precip"),
        F.when(F.year("event_ts") % 2 == 0, "even").otherwise("odd").alias("part"),
    )
    spoiled.write.partitionBy("part").options(header="true", escape='"').csv(folder)
    return f"{folder}/*/*.csv"


def spoiled_file_numbers(spark, sf_dir):
    """Rows and values that are no numbers, per yearly file with spoiled ones."""
    counts = unparsed_counts(spark, write_spoiled_files(spark, sf_dir), ROLES)
    part = F.regexp_extract("source_file", "part=([a-z]+)/", 1).alias("part")
    sums = [F.sum(name).alias(name) for name in ("rows", "lat", "lon", "precip")]
    return counts.groupBy(part).agg(*sums)


def quarantined_numbers(spark, sf_dir):
    """All rows of spoiled files: those that are kept, and those set apart with their columns and text."""
    good, spoiled = split_spoiled(spark, write_spoiled_files(spark, sf_dir), new_path(spark, "parsed"), ROLES)
    first = F.regexp_extract("row_text", "^([0-9]+),", 1)
    apart = spoiled.select(first.cast("long").alias("occ_id"), F.array_join("spoiled", ",").alias("columns"))
    return good.select(F.col("occ_id").cast("long"), F.lit("").alias("columns")).unionByName(apart)


def missing_columns(spark, sf_dir):
    """Rows per set of columns that yearly files lack."""
    folder, even = new_path(spark, "lacking"), F.year("event_ts") % 2 == 0
    raw = occurrences(spark, sf_dir).withColumn("event_ts", F.date_format("event_ts", "yyyy-MM-dd"))
    for name, part in (("even", raw.filter(even)), ("odd", raw.filter(~even).drop("frp", "region"))):
        part.write.options(header="true", escape='"').csv(f"{folder}/{name}")
    found = []
    for header, files in layouts(spark, f"{folder}/*/*.csv").items():
        part = scan_layout(spark, files, header, ROLES)
        lacking = ", ".join(cleaning.missing_columns(part, RAW))
        found.append(part.agg(F.lit(lacking).alias("lacking"), F.count(F.lit(1)).alias("rows")))
    return cleaning.union_years(found)


def guarded_occurrences(spark, sf_dir):
    """Occurrences that have all columns, any row, and only valid times."""
    rows = cleaning.require_columns(occurrences(spark, sf_dir), RAW)
    return cleaning.require_valid_time(cleaning.require_rows(rows, "occurrences"), "event_ts").select(*RAW)


def from_files(df):
    return df.withColumn("occ_id", F.col("occ_id").cast("long")).select(*TYPED)


def csv_yearly_scan(spark, sf_dir):
    return from_files(load_yearly(spark, write_yearly_files(spark, sf_dir), ROLES))


def merged_table_scan(spark, sf_dir):
    files, merged = write_yearly_files(spark, sf_dir), new_path(spark, "merged")
    load_merged(spark, files, merged, ROLES)
    return from_files(load_merged(spark, files, merged, ROLES))


def merged_in_steps(spark, sf_dir):
    """Two years merged first, the other files by a second merge, which parses only those."""
    files, merged = write_yearly_files(spark, sf_dir), new_path(spark, "merged")
    merge_files(spark, files.replace("/*/", "/even/"), merged, ROLES)
    merge_files(spark, files, merged, ROLES)
    return from_files(cleaning.prepare_occurrences(read_merged(spark, merged), ROLES))


def dirty_forecast_scan(spark, sf_dir):
    """Write a spoiled forecast file, read it as text and repair it."""
    path, key = new_path(spark, "dirty"), F.col("occ_id").cast("long")
    dirty = dirty_text(spark, sf_dir).withColumns({
        "region": F.when(key % 5 == 0, "NA").otherwise(F.concat(F.lit("region "), key % 7)),
        "locality": F.concat(F.lit('the "'), key % 9, F.lit('", inland')),
        "risk": (key % 101).cast("string"),
        "dry_days": F.when(key % 47 == 0, "null").otherwise((key % 60).cast("string")),
        "frp": F.col("occ_id"),
    })
    write_csv(dirty.select(*ROLES.forecast), path)
    return load_forecast_text(spark, path, ROLES)


# --- calendar and features ---------------------------------------------------

def month_one_hot(spark, sf_dir):
    flagged = calendar.month_one_hot(history(spark, sf_dir), ROLES)
    return flagged.select("occ_id", F.to_date("event_date").alias("event_date"), *ROLES.month_flags)


def calendar_parts(spark, sf_dir):
    return calendar.calendar_parts(occurrences(spark, sf_dir).select("occ_id", "event_ts"), "event_ts")


def month_lengths(spark, sf_dir):
    return calendar.month_lengths(occurrences(spark, sf_dir), "event_ts")


def with_gaps(spark, sf_dir):
    """Categories with missing ones among them."""
    region = F.when(F.col("occ_id") % 19 != 0, F.col("region"))
    return occurrences(spark, sf_dir).select("occ_id", region.alias("region"), "locality")


def encoded(spark, sf_dir):
    gaps = with_gaps(spark, sf_dir)
    labels = models.fit_category_labels(gaps, ROLES)
    coded = gaps
    for name in ROLES.categories:
        coded = encoding.apply_labels(coded, labels, name, f"{name}_code")
    return coded, labels


def label_encode(spark, sf_dir):
    return encoded(spark, sf_dir)[0]


def label_decode(spark, sf_dir):
    coded, labels = encoded(spark, sf_dir)
    plain = coded.select("occ_id", "region_code", "locality_code")
    named = encoding.decode_labels(plain, labels, "region", "region_code", "region")
    return encoding.decode_labels(named, labels, "locality", "locality_code", "locality")


def standardize(spark, sf_dir):
    table = history(spark, sf_dir).select("occ_id", *SCALED)
    return rounded(scaling.standardize(table, SCALED), SCALED)


def numeric_only(spark, sf_dir):
    return calendar.numeric_only(history(spark, sf_dir))


def feature_table(spark, sf_dir):
    rows = history(spark, sf_dir)
    labels = models.fit_category_labels(rows, ROLES)
    table = calendar.feature_table(rows, labels, ROLES)
    names = calendar.feature_names(rows, ROLES)
    return calendar.project_features(table, names, [ROLES.risk])


def features_with_sources(spark, sf_dir):
    """Features next to the date and the categories they come from."""
    rows = history(spark, sf_dir)
    labels = models.fit_category_labels(rows, ROLES)
    kept = ("event_date", *ROLES.categories)
    table = calendar.feature_table(rows, labels, ROLES, keep=kept)
    return table.select("occ_id", *kept, "year", "day_of_year", "region_code", "locality_code")


# --- evaluation --------------------------------------------------------------

METRICS = ("MAE", "RMSE", "R2")


def metrics_by_year(spark, sf_dir):
    return rounded(evaluation.metrics_by_year(scored(spark, sf_dir), ROLES), METRICS)


def margin_accuracy_by_year(spark, sf_dir):
    return rounded(evaluation.margin_by_year(scored(spark, sf_dir), ROLES), ["accuracy_margin"])


def metric_files(spark, sf_dir):
    """Both metric files, written and read back."""
    folder = new_path(spark, "metrics")
    scores = rounded(evaluation.yearly_scores(scored(spark, sf_dir), ROLES), [*METRICS, "accuracy_margin"])
    write_metrics(scores, folder, ROLES)

    def read(name, columns):
        return spark.read.options(header="true", enforceSchema="false").schema(columns).csv(f"{folder}/{name}")

    fits = read("metrics_continuas_por_ano.csv", "year int, MAE double, RMSE double, R2 double, n bigint")
    hits = read("metrics_margem_por_ano.csv", "year int, accuracy_margin double, n bigint")
    return fits.join(hits, ["year", "n"])


def holdout_quality(spark, sf_dir):
    """One row of metrics over the rows that training leaves out."""
    marked = models.mark_held_out(scored(spark, sf_dir), ROLES, key="occ_id")
    found = evaluation.overall_scores(marked.filter(models.HELD_OUT), ROLES)
    return rounded(found, [*METRICS, "accuracy_margin"])


def metric_chart_feed(spark, sf_dir):
    scores = evaluation.yearly_scores(scored(spark, sf_dir), ROLES)
    return rounded(evaluation.metric_chart_feed(scores, ROLES), ["value"])


def outcome_class(spark, sf_dir):
    judged = evaluation.with_outcome(scored(spark, sf_dir), ROLES)
    return judged.select("occ_id", "risk", "predicted", "result_margem", "colour")


def error_map(spark, sf_dir):
    return evaluation.error_map(scored(spark, sf_dir), YEAR, ROLES)


def error_map_sample(spark, sf_dir):
    """A map of at most 500 points of the year, drawn by key."""
    return evaluation.error_map(scored(spark, sf_dir), YEAR, ROLES, sample=500, key="occ_id")


def error_center(spark, sf_dir):
    return rounded(evaluation.map_centre(scored(spark, sf_dir), ROLES), ["lat", "lon"])


def measure_medians(spark, sf_dir):
    names = ["dry_days", "precip", "frp", "risk"]
    return rounded(exact_median(history(spark, sf_dir), names), names)


def error_heat(spark, sf_dir):
    points = settle(evaluation.complete_points(scored(spark, sf_dir), ROLES), "points")
    return rounded(evaluation.error_heat(points, ROLES), ["erro_abs", "weight"])


# --- profile -----------------------------------------------------------------

def month_share(spark, sf_dir):
    return rounded(profile.month_share(history(spark, sf_dir), ROLES), ["share"])


def month_region_stats(spark, sf_dir):
    return rounded(profile.month_region_stats(history(spark, sf_dir), ROLES), ROLES.measures)


def coord_frequency(spark, sf_dir):
    return profile.coord_frequency(history(spark, sf_dir), ROLES)


def bounding_box(spark, sf_dir):
    return profile.bounding_box(history(spark, sf_dir), ROLES)


def history_report(spark, sf_dir):
    return rounded(profile.history_report(history(spark, sf_dir), ROLES), ["percent"])


def hotspot_rank(spark, sf_dir):
    frequency = settle(profile.coord_frequency(history(spark, sf_dir), ROLES), "frequency")
    return profile.hotspot_rank(frequency, ROLES)


def top_hotspots(spark, sf_dir):
    ranked = settle(hotspot_rank(spark, sf_dir), "ranked")
    return profile.top_hotspots(ranked, ranked.count())


def distinct_coords(spark, sf_dir):
    return profile.distinct_places(occurrences(spark, sf_dir), ROLES)


def date_range(spark, sf_dir):
    return profile.date_range(history(spark, sf_dir), "event_date")


# --- scenario ----------------------------------------------------------------

def profiled(df):
    return profile.profile_history(df, ROLES)


def month_quota(spark, sf_dir):
    known = profiled(history(spark, sf_dir))
    return scenario.month_quota(known.shares, known.rows, ROLES)


def default_quota(spark, sf_dir):
    """Rows per month of a scenario of the default size."""
    known = profiled(history(spark, sf_dir))
    return scenario.month_quota(known.shares, scenario.scenario_total(spark, SEED), ROLES)


def scenario_rows(spark, sf_dir):
    known = profiled(history(spark, sf_dir))
    quotas = scenario.month_quota(known.shares, known.rows, ROLES)
    return scenario.scenario_rows(quotas, SCENARIO_YEAR, SEED, ROLES)


def scenario_coords(spark, sf_dir):
    known = profiled(history(spark, sf_dir))
    quotas = scenario.month_quota(known.shares, known.rows, ROLES)
    rows = scenario.scenario_rows(quotas, SCENARIO_YEAR, SEED, ROLES)
    return scenario.scenario_places(rows, known, SEED, ROLES)


def expanded(df):
    known = profiled(df)
    return scenario.expand_scenario(known, SCENARIO_YEAR, known.rows, SEED, ROLES)


def scenario_measures(spark, sf_dir):
    return expanded(history(spark, sf_dir))


def scenario_defaults(spark, sf_dir):
    """A history of January only: other months take the fixed ranges."""
    return expanded(january(spark, sf_dir))


# --- risk and forecast -------------------------------------------------------

def clustered(spark, sf_dir):
    """History with a cluster number in place of a model's output."""
    cluster = (F.col("occ_id") * 31 % 23).cast("int")
    return history(spark, sf_dir).withColumn("cluster", cluster)


def cluster_risks(spark, sf_dir):
    """Mean risk share of the first clusters; the last ones have no statistics."""
    rows = clustered(spark, sf_dir)
    means = rows.groupBy("cluster").agg((F.avg("risk") / F.lit(100.0)).alias("mean_risk"))
    return means.filter(F.col("cluster") < 16)


def risk_from_clusters(spark, sf_dir):
    rows = clustered(spark, sf_dir).select("occ_id", "cluster")
    found = risk.risk_from_clusters(rows, cluster_risks(spark, sf_dir), ROLES)
    return rounded(found, ["risk"])


def risk_from_max(spark, sf_dir):
    rows = clustered(spark, sf_dir).select("occ_id", "cluster")
    return risk.score_to_risk(rows, None, ROLES)


def adjust_measures(spark, sf_dir):
    rows = clustered(spark, sf_dir)
    adjusted = risk.adjust_measures(risk.score_to_risk(rows, None, ROLES), ROLES)
    return adjusted.select("occ_id", "cluster", "risk", "dry_days", "precip", "frp")


def scenario_forecast(spark, sf_dir):
    """Scenario with a repeatable score, turned into risk and adjusted."""
    rows = expanded(history(spark, sf_dir))
    score = (F.col("row_id") * 37 % 97).cast("double") + F.col("dry_days")
    scores = rows.withColumn("cluster", score)
    return risk.adjust_measures(risk.score_to_risk(settle(scores, "scored"), None, ROLES), ROLES)


def forecast_output(spark, sf_dir):
    return risk.forecast_output(scenario_forecast(spark, sf_dir), ROLES)


def forecast_csv_round_trip(spark, sf_dir):
    path = new_path(spark, "forecast")
    write_forecast(scenario_forecast(spark, sf_dir), path, ROLES)
    return scan_forecast(spark, path, ROLES)


def forecast_month_files(spark, sf_dir):
    """The forecast written by month and read back."""
    path = new_path(spark, "by-month")
    write_forecast(scenario_forecast(spark, sf_dir), path, ROLES, by_month=True)
    kinds = T.StructType([*scan_forecast(spark, path, ROLES).schema, T.StructField("month", T.IntegerType())])
    return spark.read.options(header="true", quote='"', escape='"').schema(kinds).csv(path)


def forecast_by_month(spark, sf_dir):
    return risk.forecast_by_month(scenario_forecast(spark, sf_dir), ROLES)


def forecast_summary(spark, sf_dir):
    means = ["risk_mean", "dry_days_mean", "precip_mean", "frp_mean"]
    return rounded(risk.forecast_summary(scenario_forecast(spark, sf_dir), ROLES), means)


def cluster_counts(spark, sf_dir):
    return risk.cluster_counts(clustered(spark, sf_dir), ROLES)


# --- feeds -------------------------------------------------------------------

def sourced(spark, sf_dir):
    """History in which every region stands for one file."""
    return history(spark, sf_dir).withColumn("source_file", F.col("region"))


def modal_year(spark, sf_dir):
    return feeds.modal_year(sourced(spark, sf_dir), "source_file", "event_date")


def yearly_map_feed(spark, sf_dir):
    return feeds.yearly_map_feed(sourced(spark, sf_dir), ROLES)


def map_year_list(spark, sf_dir):
    return feeds.years_in_order(yearly_map_feed(spark, sf_dir))


def year_or_latest(spark, sf_dir):
    """The wanted year is not in the feed, so the latest one is read back."""
    path = new_path(spark, "feed")
    write_feed(yearly_map_feed(spark, sf_dir), path)
    return cleaning.year_or_latest(spark.read.parquet(path), "ano", 2025)


def year_if_present(spark, sf_dir):
    rows = scored(spark, sf_dir).select("occ_id", "year")
    return cleaning.year_or_latest(rows, "year", YEAR)


def forecast_map_feed(spark, sf_dir):
    return feeds.forecast_map_feed(forecast_csv_round_trip(spark, sf_dir), ROLES)


# --- sampling ----------------------------------------------------------------

def exact_sample(spark, sf_dir):
    """A tenth of the cleaned rows, exactly."""
    rows = cleaned(spark, sf_dir).select("occ_id", "region")
    return sampling.exact_sample(rows, rows.count() // 10, "occ_id")


def train_test_split(spark, sf_dir):
    rows = cleaned(spark, sf_dir).select("occ_id")
    train, test = sampling.split_by_key(rows, "occ_id")
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )


# --- models (at the published settings, which are the library defaults) ------

def published_forest(spark, rows):
    """Train, save and load again: the loaded model is the one that scores."""
    path = new_path(spark, "bundle")
    load_or_train(spark, path, rows, ROLES, key="occ_id")
    return load_or_train(spark, path, rows, ROLES, key="occ_id")


def forest_scores(spark, sf_dir):
    rows = settle(history(spark, sf_dir), "history")
    found = models.score_history(rows, published_forest(spark, rows), ROLES)
    return found.select("occ_id", "event_date", "region", "locality", "risk", "predicted")


def planted(spark, sf_dir):
    """History whose risk is a step function of dry days and month."""
    step = F.lit(20.0) + F.when(F.col("dry_days") >= 30, 40.0).otherwise(0.0)
    step += F.when(F.month("event_date") == 7, 15.0).otherwise(0.0)
    return settle(history(spark, sf_dir).withColumn("risk", step), "planted")


def planted_forest(spark, sf_dir):
    """The published forest on planted risk.

    Every leaf is pure then, so the saved and loaded model gives the risk back.
    """
    rows = planted(spark, sf_dir)
    path = new_path(spark, "bundle")
    load_or_train(spark, path, rows, ROLES, key="occ_id")
    found = models.score_history(rows, load_or_train(spark, path, rows, ROLES), ROLES)
    return found.select("occ_id", "event_date", "region", "locality", "risk", "predicted")


def planted_scenario(spark, sf_dir):
    """Scenario rows scored by the forest of planted risk: the step function of their own values."""
    rows = planted(spark, sf_dir)
    return models.score_scenario(expanded(rows), published_forest(spark, rows), ROLES)


def planted_forecast(spark, sf_dir):
    """The whole forecast with the forest of planted risk."""
    rows = planted(spark, sf_dir)
    result = forecast(rows, published_forest(spark, rows), SCENARIO_YEAR, rows.count(), SEED, ROLES)
    return risk.forecast_output(result, ROLES)


def forecast_scores(spark, sf_dir):
    rows = settle(history(spark, sf_dir), "history")
    bundle = published_forest(spark, rows)
    result = forecast(rows, bundle, SCENARIO_YEAR, rows.count(), SEED, ROLES)
    return risk.forecast_output(result, ROLES)


def cluster_forecast(spark, sf_dir):
    """Forecast in which a cluster stands for its mean risk."""
    rows = settle(history(spark, sf_dir), "history")
    bundle = models.train_clusters(rows, ROLES, key="occ_id")
    result = forecast(rows, bundle, SCENARIO_YEAR, rows.count(), SEED, ROLES)
    return result.select(*ROLES.forecast, "cluster")


def sweep(spark, sf_dir):
    rows = settle(history(spark, sf_dir), "history")
    return models.kmeans_sweep(*models.all_features(rows, ROLES, key="occ_id"))


def kmeans_sweep(spark, sf_dir):
    return rounded(sweep(spark, sf_dir), ["inertia", "silhouette"])


def best_k(spark, sf_dir):
    return rounded(
        models.best_k(sweep(spark, sf_dir)), ["silhouette", "reported_silhouette"]
    )


def planted_sweep(spark, sf_dir):
    """Three groups far apart: the sweep must give their inertia and silhouette."""
    key = F.col("occ_id")
    rows = occurrences(spark, sf_dir).select(
        (key % 3 * 100 + key % 7).cast("double").alias("a"),
        (key % 3 * (key % 3) * 50 + key % 5).cast("double").alias("b"),
    )
    found = models.kmeans_sweep(rows, ["a", "b"], [3])
    return found.select("k", F.round("inertia", 4).alias("inertia"), r6("silhouette").alias("silhouette"))


def planted_ladder(spark, sf_dir):
    """Two groups far apart, of two groups each, of two places each: k of 2, 4 and 8 in one sweep."""
    key = F.col("occ_id")
    bits = [F.shiftright(key, i).bitwiseAND(F.lit(1)) for i in range(3)]
    place = bits[0] + bits[1] * 40 + bits[2] * 1600
    rows = occurrences(spark, sf_dir).select(place.cast("double").alias("a"), (place * 3 + 5).cast("double").alias("b"))
    found = models.kmeans_sweep(rows, ["a", "b"], [2, 4, 8])
    return found.select("k", F.round("inertia", 4).alias("inertia"), r6("silhouette").alias("silhouette"))


def best_k_of_table(spark, sf_dir):
    """The best k of a made-up sweep with ties."""
    rows = history(spark, sf_dir).groupBy((F.col("occ_id") % 18 + 2).cast("int").alias("k"))
    made_up = rows.agg(F.count(F.lit(1)).cast("double").alias("inertia"))
    silhouette = (F.col("k") * 7 % 6).cast("double") / F.lit(8.0)
    return models.best_k(made_up.withColumn("silhouette", silhouette))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        drop_sentinels, drop_nulls, drop_missing_coords, clean_counts, any_invalid_date,
        rescale_risk, union_years, drop_repeated_header, coerce_text, distinct_days, year_filter,
        csv_yearly_scan, merged_table_scan, dirty_forecast_scan,
        spoiled_file_numbers, quarantined_numbers, merged_in_steps, missing_columns, guarded_occurrences, features_with_sources,
        metric_files, holdout_quality, default_quota, forecast_month_files,
        planted_forest, planted_scenario, planted_forecast, planted_sweep, planted_ladder, best_k_of_table,
        month_one_hot, calendar_parts, month_lengths, label_encode, label_decode, standardize,
        numeric_only, feature_table,
        metrics_by_year, margin_accuracy_by_year, metric_chart_feed, outcome_class, error_map,
        error_map_sample, error_center, measure_medians, error_heat,
        month_share, month_region_stats, coord_frequency, bounding_box, history_report,
        hotspot_rank, top_hotspots, distinct_coords, date_range,
        month_quota, scenario_rows, scenario_coords, scenario_measures, scenario_defaults,
        risk_from_clusters, risk_from_max, adjust_measures, forecast_output,
        forecast_csv_round_trip, forecast_by_month, forecast_summary, cluster_counts,
        modal_year, yearly_map_feed, map_year_list, year_or_latest, year_if_present,
        forecast_map_feed,
        exact_sample, train_test_split,
        forest_scores, forecast_scores, cluster_forecast, kmeans_sweep, best_k,
    )
}
