"""Forest and cluster models, and how tables are scored with them."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, functions as F

from georisk.functions.scalars import clip, round_half_even
from georisk.operators.calendar import feature_names, feature_table, project_features
from georisk.operators.cleaning import require_rows
from georisk.operators.encoding import Labels, fit_labels
from georisk.operators.forest import Forest, grow_forest, predict
from georisk.operators.sampling import held_out
from georisk.operators.scaling import standardize
from georisk.operators.sweep import sweep
from georisk.roles import DEFAULT_ROLES, Roles
from georisk.workspace import lay_out, settle

# Settings of the published model and of the cluster sweep.
TREES = 200
DEPTH = 20
LEAST_SPLIT = 5
SEED = 4224
TRAIN_SHARE = 0.8
SWEEP_SEED = 657
SWEEP_RANGE = range(2, 20)
REPORTED_K = 12
SWEEP_ITERATIONS = 300

# Fitted models depend on the parts their rows lie in. The number of parts
# follows the number of rows (or is given), and never the cluster.
LEAST_PARTS, PART_ROWS = 8, 250_000

HELD_OUT = "held_out"
_ROW_KEY = "__row_key"


@dataclass(frozen=True)
class ModelBundle:
    """Everything needed to score a table.

    ``stages``, a forest or a pipeline, turn features into ``prediction``;
    ``labels`` hold the category codes; ``cluster_risk`` optionally maps a
    predicted cluster to a risk share.
    """

    stages: PipelineModel | Forest
    features: list[str]
    labels: Labels
    cluster_risk: DataFrame | None = None


def fit_category_labels(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> Labels:
    return fit_labels(df, [name for name in roles.categories if name in df.columns])


def mark_held_out(
    history: DataFrame,
    roles: Roles = DEFAULT_ROLES,
    key: str | None = None,
    train_share: float = TRAIN_SHARE,
    seed: int = SEED,
) -> DataFrame:
    """Rows with ``held_out``: whether training under these settings leaves them out.

    Without a row key the split is by a hash of the row, without the name of its
    file, so moving files changes no model.
    """
    split_key = F.col(key) if key else F.xxhash64(
        *sorted(name for name in history.columns if name != roles.source))
    keyed = history.withColumn(_ROW_KEY, split_key)
    return keyed.withColumn(HELD_OUT, held_out(_ROW_KEY, train_share, seed)).drop(_ROW_KEY)


def parts_for(table: DataFrame, parts: int | None) -> int:
    return parts or max(LEAST_PARTS, -(-table.count() // PART_ROWS))


def scaled_vector(features: list[str]) -> list:
    """Assemble and scale as model stages, so training and scoring agree."""
    return [
        VectorAssembler(inputCols=features, outputCol="__raw", handleInvalid="error"),
        StandardScaler(inputCol="__raw", outputCol="__scaled", withMean=True, withStd=True),
    ]


def train_forest(
    history: DataFrame,
    roles: Roles = DEFAULT_ROLES,
    trees: int = TREES,
    depth: int = DEPTH,
    seed: int = SEED,
    train_share: float = TRAIN_SHARE,
    key: str | None = None,
    max_bins: int = 64,
    parts: int | None = None,
    least_split: int = LEAST_SPLIT,
) -> ModelBundle:
    """Fit the risk forest on the training part of a history.

    The feature table is written once and laid out by its values, so the draws
    of the trees depend on the rows only. ``mark_held_out`` tells which rows are
    left for testing.
    """
    require_rows(history, "history")
    labels = fit_category_labels(history, roles)
    names = feature_names(history.drop(key) if key else history, roles)
    marked = mark_held_out(history, roles, key, train_share, seed)
    train = marked.filter(~F.col(HELD_OUT)).drop(HELD_OUT)
    table = feature_table(train, labels, roles)
    train_rows = settle(project_features(table, names, [roles.risk]), "train")
    train_rows = lay_out(train_rows, [*names, roles.risk], parts_for(train_rows, parts))
    forest = grow_forest(train_rows, names, roles.risk, trees, depth, seed, max_bins, least_split)
    return ModelBundle(stages=forest, features=names, labels=labels)


def train_clusters(
    history: DataFrame,
    roles: Roles = DEFAULT_ROLES,
    k: int = REPORTED_K,
    seed: int = SWEEP_SEED,
    key: str | None = None,
    parts: int | None = None,
) -> ModelBundle:
    """Cluster bundle: the predicted cluster stands for its mean risk share."""
    require_rows(history, "history")
    labels = fit_category_labels(history, roles)
    names = feature_names(history.drop(key) if key else history, roles)
    table = feature_table(history, labels, roles)
    rows = settle(project_features(table, names, [roles.risk]), "train")
    rows = lay_out(rows, [*names, roles.risk], parts_for(rows, parts))
    means = KMeans(
        featuresCol="__scaled", predictionCol="prediction", k=k, seed=seed,
        maxIter=SWEEP_ITERATIONS,
    )
    model = Pipeline(stages=[*scaled_vector(names), means]).fit(rows)
    risk = model.transform(rows).groupBy(F.col("prediction").alias(roles.cluster)).agg(
        (F.avg(roles.risk) / F.lit(100.0)).alias("risk")
    )
    return ModelBundle(model, names, labels, settle(risk, "cluster-risk"))


def apply_model(
    df: DataFrame, bundle: ModelBundle, roles: Roles = DEFAULT_ROLES, keep: Iterable[str] = ()
) -> DataFrame:
    """Features plus ``prediction``; the columns in ``keep`` stay on the row."""
    table = feature_table(df, bundle.labels, roles, tuple(keep))
    project_features(table, bundle.features)
    if isinstance(bundle.stages, Forest):
        return predict(table, bundle.stages, bundle.features)
    return bundle.stages.transform(table).drop("__raw", "__scaled")


def score_history(
    df: DataFrame, bundle: ModelBundle, roles: Roles = DEFAULT_ROLES
) -> DataFrame:
    """Predicted risk as an integer from 0 to 100, for every row."""
    keep = [name for name in (roles.date, *roles.categories) if name in df.columns]
    scored = apply_model(df, bundle, roles, keep)
    whole = round_half_even(clip("prediction", 0.0, 100.0)).cast("int")
    return scored.withColumn(roles.prediction, whole).drop("prediction")


def score_scenario(
    scenario: DataFrame, bundle: ModelBundle, roles: Roles = DEFAULT_ROLES
) -> DataFrame:
    """Scenario rows with the raw model score in the cluster column."""
    scored = apply_model(scenario, bundle, roles, (roles.date, *roles.categories))
    score = F.col("prediction").alias(roles.cluster)
    return scored.select(*scenario.columns, score)


def all_features(
    history: DataFrame, roles: Roles = DEFAULT_ROLES, key: str | None = None
) -> tuple[DataFrame, list[str]]:
    """The feature table of a whole history and its columns, as the sweep takes them."""
    labels = fit_category_labels(history, roles)
    names = feature_names(history.drop(key) if key else history, roles)
    return project_features(feature_table(history, labels, roles), names), names


def kmeans_sweep(
    df: DataFrame,
    columns: list[str],
    ks: Iterable[int] = SWEEP_RANGE,
    seed: int = SWEEP_SEED,
    iterations: int = SWEEP_ITERATIONS,
    parts: int | None = None,
) -> DataFrame:
    """Inertia and silhouette per number of clusters.

    The rows are written once; every scan serves all numbers of clusters. The
    silhouette uses squared distances, which needs one pass instead of all pairs
    of rows.
    """
    plain = settle(df.select(*[F.col(c).cast("double").alias(c) for c in columns]), "unscaled")
    # Laid out by the plain values: the last digits of scaled ones depend on the order of sums.
    scaled = standardize(lay_out(plain, columns, parts_for(plain, parts)), columns)
    found = sweep(scaled, columns, ks, seed, iterations)
    return df.sparkSession.createDataFrame(found, "k int, inertia double, silhouette double")


def best_k(sweep: DataFrame, reported: int = REPORTED_K) -> DataFrame:
    """The k with the largest silhouette, the smaller one on ties."""
    at_reported = F.max(F.when(F.col("k") == reported, F.col("silhouette")))
    top = F.max(F.struct(F.col("silhouette"), (-F.col("k")).alias("neg")))
    return sweep.agg(
        (-top["neg"]).alias("k"),
        top["silhouette"].alias("silhouette"),
        at_reported.alias("reported_silhouette"),
    )
