from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from touchline import schema  # noqa: E402
from touchline.session import build_session, local_settings  # noqa: E402

# Eight sample matches.
SAMPLE = [
    ("m001", "2024-08-17", "2024", "Arsenal", "Wolves", 2, 0, 14, 6, 62.3, 37.7, "Emirates Stadium", "M. Oliver"),
    ("m002", "2024-08-17", "2024", "Chelsea", "Man City", 1, 2, 9, 13, 44.1, 55.9, "Stamford Bridge", "A. Taylor"),
    ("m003", "2024-08-18", "2024", "Liverpool", "Brentford", 3, 1, 18, 8, 67.5, 32.5, "Anfield", "S. Attwell"),
    ("m004", "2024-08-18", "2024", "Tottenham", "Leicester", 3, 0, 16, 5, 58.2, 41.8, "Tottenham Hotspur Stadium",
     "C. Kavanagh"),
    ("m005", "2024-08-24", "2024", "Arsenal", "Brighton", 1, 1, 12, 10, 55.4, 44.6, "Emirates Stadium", "P. Bankes"),
    ("m006", "2024-08-24", "2024", "Man City", "Ipswich", 4, 1, 22, 4, 71.2, 28.8, "Etihad Stadium", "R. Jones"),
    ("m007", "2024-08-25", "2024", "Chelsea", "Crystal Palace", 2, 1, 15, 7, 58.9, 41.1, "Stamford Bridge",
     "T. Harrington"),
    ("m008", "2024-08-25", "2024", "Liverpool", "Brentford", 2, 0, 19, 5, 69.3, 30.7, "Anfield", "M. Dean"),
]


@pytest.fixture(scope="session")
def spark():
    settings = {**local_settings(4), "spark.driver.memory": "4g"}
    session = build_session("tests", "local[4]", settings)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def matches(spark):
    rows = [(m, dt.date.fromisoformat(d), *rest) for m, d, *rest in SAMPLE]
    return spark.createDataFrame(rows, schema.MATCHES).cache()


@pytest.fixture
def match_row(spark):
    """One canonical match with some columns replaced."""
    def make(**changes):
        base = dict(zip(schema.MATCHES.names, SAMPLE[0]))
        base["match_date"] = dt.date(2024, 8, 17)
        return spark.createDataFrame([tuple({**base, **changes}.values())], schema.MATCHES)

    return make


@pytest.fixture(scope="session")
def csv_folder(tmp_path_factory):
    """The sample as two CSV files named after a season."""
    folder = tmp_path_factory.mktemp("csv")
    header = ",".join(schema.RAW_CSV.names)
    for name, rows in (("2023-24.csv", SAMPLE[:4]), ("2024-25.csv", SAMPLE[4:])):
        lines = [",".join(str(v) for v in row) for row in rows]
        (folder / name).write_text("\n".join([header, *lines]) + "\n")
    (folder / "notes.txt").write_text("not a csv file\n")
    return folder
