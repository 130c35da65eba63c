"""The outcome model: one MLlib pipeline from raw match columns to class probabilities.

Encoders are fitted once, on the training matches, and saved with the trees, so scoring uses the same codes.
`goal_diff_hist` is the match's own goal difference and decides the label: it is kept for compatibility, and a
perfect training accuracy therefore says nothing.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline import fixed
from touchline.functions.match import outcome_label
from touchline.operators.boosting import SoftmaxTrees, fit_softmax
from touchline.operators.enrich import complete_for_scoring
from touchline.operators.keyed import newest_per_key
from touchline.operators.league import distinct_teams
from touchline.sinks.merge import append_counted
from touchline.sources.lake import read_table_or_none

C = F.col
FEATURES = ["home_team_enc", "away_team_enc", "season_enc", "goal_diff_hist"]
_CLASSES = sorted(fixed.OUTCOME_LABELS.values())

_REGISTRY_DDL = "version BIGINT, run_id STRING, model_path STRING, train_accuracy DOUBLE, registered_at TIMESTAMP"


def fit_encoders(matches: DataFrame) -> PipelineModel:
    """Alphabetical codes: one dictionary for home and away names, one for seasons.

    The dictionaries hold a line per club and per season; unknown names get the next free code when scoring. Each is a
    stage of its own: arrays of different lengths are filled up with NULL labels when they share one.
    """
    def labels(values: DataFrame, column: str) -> list[str]:
        indexer = StringIndexer(inputCol=column, outputCol="_code", stringOrderType="alphabetAsc")
        return list(indexer.fit(values).labels)

    teams = labels(distinct_teams(matches), "team")
    seasons = labels(matches.select("season").distinct(), "season")

    def coder(dictionary: list[str], *columns: str) -> StringIndexerModel:
        return StringIndexerModel.from_arrays_of_labels(
            [dictionary] * len(columns), inputCols=list(columns), outputCols=[f"{c}_code" for c in columns], handleInvalid="keep"
        )

    return PipelineModel([coder(teams, "home_team", "away_team"), coder(seasons, "season")])


def _feature_columns() -> SQLTransformer:
    """Plain numbers: the casts drop the nominal metadata, so trees split codes as ordered values."""
    labels = fixed.OUTCOME_LABELS
    return SQLTransformer(
        statement=f"""
        SELECT *, CAST(home_team_code AS DOUBLE) AS home_team_enc, CAST(away_team_code AS DOUBLE) AS away_team_enc,
               CAST(season_code AS DOUBLE) AS season_enc, CAST(home_goals - away_goals AS DOUBLE) AS goal_diff_hist,
               CASE WHEN home_goals > away_goals THEN {labels[fixed.HOME_WIN]}D
                    WHEN home_goals = away_goals THEN {labels[fixed.DRAW]}D
                    ELSE {labels[fixed.AWAY_WIN]}D END AS label
        FROM __THIS__"""
    )


def build_features(matches: DataFrame, encoders: PipelineModel | None = None) -> DataFrame:
    """match_id, the four features and the label, for rows without NULLs.

    They are stored without the dictionaries: a cast to the same type goes when the plan is optimised, and the names of
    all clubs would be in each file's schema.
    """
    complete = complete_for_scoring(matches)
    coded = (encoders or fit_encoders(complete)).transform(complete)
    return _feature_columns().transform(coded).select("match_id", *[C(c).alias(c, metadata={}) for c in FEATURES], "label")


def _class_probabilities(scored: DataFrame) -> list[Column]:
    """Probabilities of away win, draw and home win, summing to one."""
    if "shares" in scored.columns:
        return [C("shares")[k] for k in _CLASSES]
    return [vector_to_array("probability")[k] for k in _CLASSES]


def score(model: PipelineModel, matches: DataFrame) -> DataFrame:
    """match_id, proba_away, proba_draw, proba_home and the most likely outcome (ties to the lower label)."""
    scored = model.transform(complete_for_scoring(matches))
    names = ["proba_away", "proba_draw", "proba_home"]
    probabilities = scored.select("match_id", "label", *[p.alias(n) for n, p in zip(names, _class_probabilities(scored))])
    best = F.greatest(*[C(n) for n in names])
    outcome = F.coalesce(*[F.when(C(n) == best, k) for n, k in zip(names, _CLASSES)])
    return probabilities.withColumn("outcome", outcome.cast("int"))


def train_accuracy(scored: DataFrame) -> DataFrame:
    """One row: the share of rows whose outcome equals the label."""
    return scored.agg(F.avg((C("outcome") == C("label")).cast("double")).alias("accuracy"))


def prediction_accuracy(predictions: DataFrame, matches: DataFrame) -> DataFrame:
    """One row: the share of stored predictions whose outcome equals their match's label."""
    label = outcome_label(C("home_goals"), C("away_goals")).alias("label")
    labelled = complete_for_scoring(matches).select("match_id", label)
    return train_accuracy(predictions.select("match_id", "outcome").join(labelled, "match_id"))


@dataclass(frozen=True)
class Trained:
    run_id: str
    model: PipelineModel
    accuracy: float


def fit(
    matches: DataFrame,
    algorithm: str = "boosted",
    rounds: int = fixed.BOOSTING_ROUNDS,
    depth: int = fixed.TREE_DEPTH,
    rate: float = fixed.LEARNING_RATE,
    seed: int = 7,
) -> PipelineModel:
    """Fit encoders and trees; `algorithm` is `boosted`, one ensemble for all classes, or the cheaper `forest`.

    The seed matters to the forest alone.
    """
    complete = complete_for_scoring(matches)
    front = PipelineModel([fit_encoders(complete), _feature_columns()])
    prepared = front.transform(complete).select(*FEATURES, "label")
    if algorithm == "boosted":
        ensemble = fit_softmax(prepared, FEATURES, "label", len(_CLASSES), rounds, depth, rate)
        return PipelineModel([*front.stages, SoftmaxTrees(inputCols=FEATURES, trees=ensemble.to_json())])
    if algorithm != "forest":
        raise ValueError(f"unknown algorithm {algorithm!r}")
    forest = RandomForestClassifier(labelCol="label", numTrees=rounds, maxDepth=depth, seed=seed)
    prepared = prepared.persist()  # the trees pass over it many times
    try:
        fitted = Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="features"), forest]).fit(prepared)
        return PipelineModel([*front.stages, *fitted.stages])
    finally:
        prepared.unpersist()


def train(matches: DataFrame, registry_path: str, **settings) -> Trained:
    """Fit, save under a new version in the registry folder, and record accuracy there."""
    spark = matches.sparkSession
    model = fit(matches, **settings)
    accuracy = train_accuracy(score(model, matches)).first().accuracy
    run_id = uuid.uuid4().hex
    registry = f"{registry_path.rstrip('/')}/versions"
    known = read_table_or_none(spark, registry, _REGISTRY_DDL)
    version = 1 + (known.agg(F.max("version").alias("v")).first().v or 0 if known is not None else 0)
    model_path = f"{registry_path.rstrip('/')}/models/{run_id}"
    model.save(model_path)
    entry = spark.createDataFrame([(version, run_id, model_path, accuracy)],
                                  "version BIGINT, run_id STRING, model_path STRING, train_accuracy DOUBLE")
    entry.withColumn("registered_at", F.current_timestamp()).write.mode("append").parquet(registry)
    return Trained(run_id, model, accuracy)


def latest_model(spark: SparkSession, registry_path: str) -> tuple[PipelineModel, str]:
    """The newest registered model and its run id."""
    known = read_table_or_none(spark, f"{registry_path.rstrip('/')}/versions", _REGISTRY_DDL)
    newest = known.orderBy(F.desc("version")).first() if known is not None else None
    if newest is None:
        raise RuntimeError(f"no model is registered in {registry_path}")
    return PipelineModel.load(newest.model_path), newest.run_id


def unscored(matches: DataFrame, predictions: DataFrame) -> DataFrame:
    """Matches without a prediction. Both sides are large, so this is a plain anti join."""
    return matches.join(predictions.select("match_id"), "match_id", "left_anti")


def predict(matches: DataFrame, predictions_path: str, model: PipelineModel, run_id: str) -> int:
    """Score what has no prediction yet and add it; returns the number of new predictions."""
    from touchline import schema

    spark = matches.sparkSession
    todo = complete_for_scoring(matches)
    done = read_table_or_none(spark, predictions_path, schema.PREDICTIONS)
    if done is not None:
        todo = unscored(todo, done)
    rows = (
        score(model, newest_per_key(todo, ["match_id"]))
        .withColumn("model_run_id", F.lit(run_id))
        .withColumn("predicted_at", F.current_timestamp())
        .select(*schema.PREDICTIONS.names)
    )
    return append_counted(rows, predictions_path, ["match_id"], None)
