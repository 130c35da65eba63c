import pytest
from pyspark.sql import functions as F

from touchline import schema
from touchline.sinks.kafka import producer_options, to_messages
from touchline.sinks.jdbc import upsert_statement, write_options
from touchline.sources.csv import load_matches, read_csv
from touchline.sources.jdbc import JdbcTarget, postgres, read_jdbc, season_predicates
from touchline.sources.kafka import stream_options

HEADER = ",".join(schema.RAW_CSV.names)


def write(path, *lines):
    path.write_text("\n".join([HEADER, *lines]) + "\n")
    return str(path)


def test_folder_of_csv_files(spark, csv_folder):
    rows = load_matches(spark, str(csv_folder))
    assert rows.schema == schema.MATCHES
    assert rows.count() == 8
    assert rows.filter("match_date = DATE '2024-08-17'").count() == 2


def test_every_csv_file_of_a_folder_counts(spark, csv_folder, tmp_path):
    """Also one that repeats another's rows: nothing is deduplicated while reading."""
    source = (csv_folder / "2024-25.csv").read_bytes()
    for part in range(3):
        (tmp_path / f"delivery_{part}.csv").write_bytes(source)
    assert load_matches(spark, str(tmp_path)).count() == 12
    assert load_matches(spark, [str(tmp_path / "delivery_0.csv"), str(tmp_path / "delivery_2.csv")]).count() == 8


def test_season_from_the_file_name(spark, csv_folder):
    rows = read_csv(spark, str(csv_folder), season_from_file=True)
    counts = {r.season: r["count"] for r in rows.groupBy("season").count().collect()}
    assert counts == {"2023-24": 4, "2024-25": 4}
    one = read_csv(spark, str(csv_folder), season="2024-25", season_from_file=True)
    assert one.count() == 4
    assert all("2024-25.csv" in f for f in one.inputFiles())


def test_season_column_filter(spark, csv_folder):
    assert read_csv(spark, str(csv_folder), season="2024").count() == 8
    assert read_csv(spark, str(csv_folder), season="1999").isEmpty()


def test_cells_are_trimmed_and_blanks_are_null(spark, tmp_path):
    full = "cup-9,1987-03-21,1986-87,  Eastwick  ,Westmoor,4,4,12,11, 48.5 ,51.5,Old Ground ,P. Quill"
    sparse = "cup-10,1987-03-22,1986-87,Westmoor,Eastwick,0,2,,   ,,,,"
    rows = {r.match_id: r for r in load_matches(spark, write(tmp_path / "cup.csv", full, sparse)).collect()}
    first, second = rows["cup-9"], rows["cup-10"]
    assert (first.home_team, first.home_possession, first.stadium) == ("Eastwick", 48.5, "Old Ground")
    assert [second[c] for c in ("home_shots", "away_shots", "home_possession", "stadium", "referee")] == [None] * 5


def test_nothing_to_read(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_matches(spark, str(tmp_path / "missing.csv"))
    with pytest.raises(ValueError, match="No data"):
        load_matches(spark, write(tmp_path / "empty.csv"))
    (tmp_path / "folder").mkdir()
    with pytest.raises(FileNotFoundError):
        load_matches(spark, str(tmp_path / "folder"))


@pytest.mark.parametrize("goals", ["many", "1.5"])
def test_a_bad_cell_fails_the_job(spark, tmp_path, goals):
    path = write(tmp_path / "bad.csv", f"cup-11,1987-04-01,1986-87,Eastwick,Westmoor,{goals},2,,,,,,")
    with pytest.raises(Exception, match="Malformed records"):
        load_matches(spark, path).collect()


def test_shuffled_columns_are_refused(spark, tmp_path):
    names = schema.RAW_CSV.names[::-1]
    (tmp_path / "odd.csv").write_text(",".join(names) + "\n" + ",".join(["1"] * len(names)) + "\n")
    with pytest.raises(Exception, match="does not conform to the schema"):
        read_csv(spark, str(tmp_path / "odd.csv")).collect()


def test_other_layouts_become_canonical(spark):
    lineage = spark.createDataFrame(
        [("7", "A", "B", 2, 1, "2024-01-05", "Cup", "2023-24")],
        "match_id STRING, home_team STRING, away_team STRING, home_score INT, away_score INT, date STRING, "
        "competition STRING, season STRING",
    )
    row = schema.canonical(lineage).first()
    assert (row.home_goals, row.away_goals, str(row.match_date), row.competition) == (2, 1, "2024-01-05", "Cup")
    keyed_by_number = spark.createDataFrame([(7, 2024)], "match_id INT, season INT")
    row = schema.canonical(keyed_by_number).first()
    assert (row.match_id, row.season, row.home_team) == ("7", "2024", None)


def test_messages(spark):
    rows = spark.createDataFrame(
        [("m1", "2023-24", 2, None), (None, "2023-24", 1, "Ref")],
        "match_id STRING, season STRING, home_goals INT, referee STRING",
    )
    sent = to_messages(rows).collect()
    keys = [r.key for r in sent]
    assert keys[0] == "2023-24:m1"
    assert keys[1].startswith("2023-24:") and keys[1].split(":")[1].isdigit()
    assert sent[0].value == '{"match_id":"m1","season":"2023-24","home_goals":"2","referee":null}'


def test_message_key_falls_back_to_the_other_id(spark):
    rows = spark.createDataFrame([(5, "s")], "MatchID INT, season STRING")
    assert to_messages(rows).first().key == "s:5"


def test_kafka_options():
    options = stream_options("broker:9092", "matches")
    assert options["subscribe"] == "matches"
    assert options["failOnDataLoss"] == "true" and options["maxOffsetsPerTrigger"] == "1000"
    loose = stream_options("broker:9092", "matches", max_per_trigger=None, fail_on_data_loss=False)
    assert loose["failOnDataLoss"] == "false" and "maxOffsetsPerTrigger" not in loose
    assert producer_options("broker:9092", "matches")["kafka.acks"] == "all"


def test_jdbc_options():
    target = postgres("db", 5432, "league", "reader", "secret")
    assert target.url == "jdbc:postgresql://db:5432/league"
    assert target.properties() == {"user": "reader", "password": "secret", "driver": "org.postgresql.Driver"}
    assert JdbcTarget("jdbc:x", extra={"fetchsize": "1000"}).properties() == {"fetchsize": "1000"}
    assert write_options(8, 500, True) == {"numPartitions": "8", "batchsize": "500", "truncate": "true"}
    with pytest.raises(ValueError):
        read_jdbc(None, target, "matches", partition_column="id")


def test_season_predicates_are_disjoint_and_complete(spark):
    rows = spark.createDataFrame([("a",), ("b",), ("o'c",), ("z",), (None,)], "season STRING")
    parts = season_predicates(["a", "o'c"])
    hits = [{r.season for r in rows.filter(F.expr(p.replace("''", "\\'"))).collect()} for p in parts]
    assert hits == [{"a"}, {"o'c"}, {"b", "z", None}]


def test_upsert_statement():
    assert upsert_statement("matches", "staging", ["id", "goals"], "id") == (
        "INSERT INTO matches (id, goals) SELECT id, goals FROM staging "
        "ON CONFLICT (id) DO UPDATE SET goals = EXCLUDED.goals"
    )
