import pytest
from pyspark.sql import functions as F

from test_league import random_matches
from touchline import schema
from touchline.operators import scoring
from touchline.sources.lake import read_lake


@pytest.fixture(scope="module")
def played(spark):
    return random_matches(spark, n=300)[1].cache()


def test_features(matches):
    rows = {r.match_id: r for r in scoring.build_features(matches).collect()}
    teams = sorted({"Arsenal", "Wolves", "Chelsea", "Man City", "Liverpool", "Brentford", "Tottenham", "Leicester",
                    "Brighton", "Ipswich", "Crystal Palace"})
    assert rows["m001"].home_team_enc == teams.index("Arsenal")
    assert rows["m001"].away_team_enc == teams.index("Wolves")
    assert (rows["m001"].season_enc, rows["m001"].goal_diff_hist, rows["m001"].label) == (0.0, 2.0, 2.0)
    assert rows["m005"].label == 1.0 and rows["m002"].label == 0.0


def test_features_can_be_stored(spark, matches, tmp_path):
    """One season and eleven teams: the dictionaries differ in length."""
    features = scoring.build_features(matches)
    features.write.parquet(str(tmp_path / "features"))
    back = spark.read.parquet(str(tmp_path / "features"))
    assert {tuple(r) for r in back.collect()} == {tuple(r) for r in features.collect()}
    assert not any(f.metadata for f in back.schema.fields)


def test_unknown_names_get_the_next_free_code(matches, match_row):
    encoders = scoring.fit_encoders(matches)
    row = scoring.build_features(match_row(home_team="Newcomers", season="2030-31"), encoders).first()
    assert (row.home_team_enc, row.season_enc) == (11.0, 1.0)


@pytest.mark.parametrize("algorithm, rounds", [("boosted", 3), ("forest", 10)])
def test_train_predict_and_predict_again(spark, played, tmp_path, algorithm, rounds):
    registry, predictions = str(tmp_path / "registry"), str(tmp_path / "predictions")
    with pytest.raises(RuntimeError):
        scoring.latest_model(spark, registry)
    trained = scoring.train(played, registry, algorithm=algorithm, rounds=rounds)
    assert trained.accuracy > 0.9
    model, run_id = scoring.latest_model(spark, registry)
    assert run_id == trained.run_id

    first = played.filter("season = '2020-21'")
    assert scoring.predict(first, predictions, model, run_id) == first.count()
    assert scoring.predict(played, predictions, model, run_id) == played.count() - first.count()
    assert scoring.predict(played, predictions, model, run_id) == 0

    stored = read_lake(spark, predictions, schema.PREDICTIONS)
    assert stored.count() == stored.select("match_id").distinct().count() == played.count()
    total = F.col("proba_away") + F.col("proba_draw") + F.col("proba_home")
    assert stored.filter(F.abs(total - 1) > 1e-9).isEmpty()
    assert stored.filter("predicted_at IS NULL OR outcome NOT IN (0, 1, 2)").isEmpty()


def test_versions_count_up_and_the_newest_is_used(spark, played, tmp_path):
    registry = str(tmp_path)
    runs = [scoring.train(played, registry, algorithm="forest", rounds=2).run_id for _ in range(2)]
    assert scoring.latest_model(spark, registry)[1] == runs[-1]
    versions = spark.read.parquet(f"{registry}/versions")
    assert sorted(r.version for r in versions.collect()) == [1, 2]


def test_unknown_teams_can_be_scored(played, match_row):
    model = scoring.fit(played, algorithm="forest", rounds=3)
    assert scoring.score(model, match_row(home_team="Newcomers", season="2030-31")).count() == 1


def test_unknown_algorithm(played):
    with pytest.raises(ValueError):
        scoring.fit(played, algorithm="svm")


def test_unscored(spark, played):
    done = played.filter("season = '2020-21'").select("match_id")
    assert scoring.unscored(played, done).filter("season = '2020-21'").isEmpty()
