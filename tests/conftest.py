import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

from scholarmill.session import build_session, settings  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "6g",
        "spark.default.parallelism": "4", "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()


@pytest.fixture(scope="module", autouse=True)
def own_settings(spark):
    """The operators on texts set these for the whole session; other modules start without that."""
    keys = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    with settings(spark, {key: spark.conf.get(key) for key in keys}):
        yield


# id, title, abstract, authors, category, day, counts at 12 and 24 months: one each that is short, undated by counts,
# without an abstract, without authors, and never cited
SHELF = [
    ("p-a", "Tides", "A novel survey of tides [1]. We propose a benchmark at $5$ a day, the state-of-the-art [22].", "Ana, Ben, Cai", "ocean",
     dt.date(2018, 2, 1), 2, 4),
    ("p-b", "Wind over dunes", "Sand moves where the wind is strong enough.", "Dee", "desert", dt.date(2019, 6, 15), 0, 0),
    ("p-c", "Ice", "Short", "Eli, Fay", "polar", dt.date(2017, 11, 30), 9, 12),
    ("p-d", "Salt marshes", "Plants that grow in salt water, and who eats them.", "", "ocean", dt.date(2021, 1, 10), 7, None),
    ("p-e", "Coral counts", "How many corals are there? Nobody knows.", "Gus, Hal, Ivy, Jo", "ocean", dt.date(2016, 5, 5), 30, 44),
    ("p-f", "River deltas", None, "Kim", "polar", dt.date(2015, 8, 20), 1, 3),
]


@pytest.fixture(scope="session")
def shelf(spark):
    """Papers and their counts."""
    papers = spark.createDataFrame([row[:6] for row in SHELF], "paper_id string, title string, abstract string, authors string, "
                                                               "category string, submitted date")
    counts = [(row[0], *row[6:]) for row in SHELF]
    return papers, spark.createDataFrame(counts, "paper_id string, citations_12mo int, citations_24mo int")
