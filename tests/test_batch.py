import random

import pytest
from pyspark.sql import functions as F

from touchline import schema
from touchline.operators.league import standings_mart
from touchline.operators.quality import DataQualityError, match_constraints, split_valid
from touchline.plans import batch
from touchline.sinks.merge import merge_table
from touchline.sources.lake import read_lake


def test_folder_to_lake_to_mart(spark, csv_folder, tmp_path):
    lake, mart, summary = (str(tmp_path / name) for name in ("lake", "mart", "summary"))
    for _ in range(2):
        assert batch.ingest_folder(spark, str(csv_folder), lake, summary, season_from_file=True) == 8
    assert read_lake(spark, lake).count() == 8
    assert spark.read.parquet(summary).count() == 11
    batch.refresh_standings(spark, lake, mart)
    assert read_lake(spark, mart, schema.STANDINGS).select("season").distinct().count() == 2


def test_mart_refresh_touches_only_new_seasons(spark, csv_folder, tmp_path):
    lake, mart = str(tmp_path / "lake"), str(tmp_path / "mart")
    batch.ingest_folder(spark, str(csv_folder), lake, season="2023-24", season_from_file=True)
    batch.refresh_standings(spark, lake, mart)
    old_files = set(read_lake(spark, mart, schema.STANDINGS).inputFiles())
    batch.ingest_folder(spark, str(csv_folder), lake, season_from_file=True)
    batch.refresh_standings(spark, lake, mart)
    files = set(read_lake(spark, mart, schema.STANDINGS).inputFiles())
    assert old_files < files
    batch.refresh_standings(spark, lake, mart)
    assert set(read_lake(spark, mart, schema.STANDINGS).inputFiles()) == files
    batch.refresh_standings(spark, lake, mart, refresh_seasons=["2023-24"])
    assert not old_files & set(read_lake(spark, mart, schema.STANDINGS).inputFiles())
    places = read_lake(spark, mart, schema.STANDINGS).filter(F.col("season") == "2023-24")
    assert sorted(r.position for r in places.collect()) == list(range(1, 9))


def test_a_refreshed_season_without_matches_leaves_the_mart(spark, csv_folder, tmp_path):
    lake, mart = str(tmp_path / "lake"), str(tmp_path / "mart")
    batch.ingest_folder(spark, str(csv_folder), lake, season_from_file=True)
    nameless = read_lake(spark, lake).limit(1).withColumn("season", F.lit(None).cast("string"))
    nameless.write.mode("append").partitionBy("season").parquet(lake)
    batch.refresh_standings(spark, lake, mart)
    assert {r.season for r in read_lake(spark, mart, schema.STANDINGS).collect()} == {"2023-24", "2024-25"}
    left = str(tmp_path / "left")
    read_lake(spark, lake).filter("season = '2024-25'").write.partitionBy("season").parquet(left)
    batch.refresh_standings(spark, left, mart, refresh_seasons=["2023-24", "2024-25"])
    assert {r.season for r in read_lake(spark, mart, schema.STANDINGS).collect()} == {"2024-25"}


def some_matches(spark, dice, ids):
    rows = [
        (f"c{i}", None, dice.choice(["2001-02", "2002-03", "2003-04", None]), *dice.sample(["Alpha", "Beta", "Gamma", "Delta"], 2), dice.randrange(4), dice.randrange(4))
        for i in ids
    ]
    frame = spark.createDataFrame(rows, "match_id STRING, match_date DATE, season STRING, home_team STRING, away_team STRING, home_goals INT, away_goals INT")
    missing = [f for f in schema.MATCHES.fields if f.name not in frame.columns]
    return frame.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}).select(*schema.MATCHES.names)


def test_mart_from_changes_equals_the_full_mart(spark, tmp_path):
    dice = random.Random(6)
    lake, mart = str(tmp_path / "lake"), str(tmp_path / "mart")

    def agrees():
        known = read_lake(spark, lake, schema.MATCHES).filter("season IS NOT NULL")
        full = {tuple(r) for r in standings_mart(known).select(*schema.STANDINGS.names).collect()}
        return {tuple(r) for r in read_lake(spark, mart, schema.STANDINGS).select(*schema.STANDINGS.names).collect()} == full

    batch.merge_and_refresh(spark, some_matches(spark, dice, range(40)), lake, mart)
    assert agrees()
    for ids in (range(30, 50), range(5, 8)):  # corrections, moves between seasons, new matches
        batch.merge_and_refresh(spark, some_matches(spark, dice, ids), lake, mart)
        assert agrees()
    again = read_lake(spark, lake, schema.MATCHES).filter("match_id < 'c2'").select(*schema.MATCHES.names)
    assert batch.merge_and_refresh(spark, spark.createDataFrame(again.collect(), schema.MATCHES), lake, mart) == []
    batch.remove_and_refresh(spark, spark.createDataFrame([(f"c{i}",) for i in range(3, 20)], "match_id STRING"), lake, mart)
    assert agrees()
    season = read_lake(spark, lake, schema.MATCHES).filter("season = '2002-03'").select("match_id")
    assert batch.remove_and_refresh(spark, spark.createDataFrame(season.collect(), "match_id STRING"), lake, mart) == ["2002-03"]
    assert agrees()
    assert {r.season for r in read_lake(spark, mart, schema.STANDINGS).collect()} <= {"2001-02", "2003-04"}
    assert batch.remove_and_refresh(spark, spark.createDataFrame([("none",)], "match_id STRING"), lake, mart) == []


def test_changes_read_no_other_season(spark, tmp_path):
    dice = random.Random(9)
    lake, mart = str(tmp_path / "lake"), str(tmp_path / "mart")
    rows = some_matches(spark, dice, range(30))
    batch.merge_and_refresh(spark, rows, lake, mart)
    for kind in ("lake", "mart"):  # whoever reads these fails
        (next((tmp_path / kind).glob("season=2001-02*")) / "part-broken.parquet").write_bytes(b"PAR1 nothing PAR1")
    one = rows.filter("season = '2003-04'").orderBy("match_id").limit(1).withColumn("home_goals", F.lit(9))
    changes = str(tmp_path / "changes")
    merge_table(one, str(tmp_path / "other"), schema.MATCHES, ["match_id"], changes=changes)
    assert batch.standings_from_changes(spark, mart, changes) == ["2003-04"]


def test_invalid_rows_stop_or_are_set_aside(spark, tmp_path, monkeypatch):
    header = ",".join(schema.RAW_CSV.names)
    (tmp_path / "2023-24.csv").write_text(
        f"{header}\nx1,2024-01-01,2023-24,A,B,1,0,,,,,,\nx2,2024-01-01,2023-24,A,B,-1,0,,,,,,\n"
    )
    with pytest.raises(DataQualityError, match="negative"):
        batch.ingest_folder(spark, str(tmp_path), str(tmp_path / "lake"))
    scans, real = [], batch.load_matches
    monkeypatch.setattr(batch, "load_matches", lambda *a, **k: scans.append(1) or real(*a, **k))
    batch.ingest_with_quarantine(spark, str(tmp_path), str(tmp_path / "lake"), str(tmp_path / "bad"))
    assert len(scans) == 1
    assert [r.match_id for r in read_lake(spark, str(tmp_path / "lake")).collect()] == ["x1"]
    assert spark.read.parquet(str(tmp_path / "bad")).first().reasons == ["home_goals_negative"]


def test_quarantine_equals_the_split_and_reads_files_once(spark, tmp_path):
    header = ",".join(schema.RAW_CSV.names)
    lines = [f"x{i},2024-01-0{1 + i % 9},2023-24,A,{'AB'[i % 3 > 0]},{i % 5 - 1},{i % 4},,,,,," for i in range(60)]
    (tmp_path / "2023-24.csv").write_text("\n".join([header, *lines, ",2024-01-01,2023-24,A,B,1,0,,,,,,"]) + "\n")
    lake, bad = str(tmp_path / "lake"), str(tmp_path / "bad")
    batch.ingest_with_quarantine(spark, str(tmp_path / "2023-24.csv"), lake, bad)
    valid, broken = split_valid(batch.load_matches(spark, str(tmp_path / "2023-24.csv")), match_constraints())
    assert sorted(r.match_id for r in read_lake(spark, lake).collect()) == sorted(r.match_id for r in valid.collect())
    kept = spark.read.parquet(bad)
    assert kept.columns == broken.columns
    assert sorted(map(str, kept.collect())) == sorted(map(str, broken.collect()))
    (tmp_path / "torn.csv").write_text(header + "\nx1,2024-01-01,2023-24,A,B,many,0,,,,,,\n")
    with pytest.raises(Exception):
        batch.ingest_with_quarantine(spark, str(tmp_path / "torn.csv"), str(tmp_path / "lake2"), str(tmp_path / "bad2"))
    assert not (tmp_path / "lake2").exists() and not (tmp_path / "bad2").exists()
