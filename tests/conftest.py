import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from geoweave.session import get_session  # noqa: E402

from geo_cells import cell_text  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = get_session("local[*]", "geoweave-tests", shuffle_partitions=8,
                    conf={"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g",
                          "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
                          "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


PLACE_ROWS = [
    (1, 31, "Harbor Grill", 501, "PT", "Porto", 41.15, -8.61),
    (2, 32, "Canal Kitchen", 502, "NL", "Utrecht", 52.09, 5.12),
    (3, 33, "Fjord Diner", 503, "NO", "Bergen", 60.39, 5.32),
    (4, 34, "Vineyard Table", 504, "PT", "Evora", None, None),
    (5, 35, "Lighthouse Snacks", 505, "DK", "Aarhus", 95.5, 10.2),
]

OBS_ROWS = [(lat, lng, cell_text(lat, lng), *rest) for lat, lng, *rest in (
    (41.16, -8.62, 17.5, 71, 1009.4, "Drizzle", "2023-05-11"),
    (52.08, 5.11, 14.25, 66, 1012.9, "Overcast", "2023-05-11"),
    (60.38, 5.33, 9.75, 88, 1001.3, "Showers", "2023-05-11"),
    (38.57, -7.91, 21.0, 49, 1018.6, "Clear", "2023-05-11"),
)]


@pytest.fixture(scope="session")
def places(spark):
    from geoweave import schemas
    return spark.createDataFrame(PLACE_ROWS, schemas.PLACES)


@pytest.fixture(scope="session")
def places_csv(spark, places, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("csv") / "restaurant_csv")
    places.write.option("header", True).csv(path)
    return path


@pytest.fixture(scope="session")
def obs_test_shape(spark):
    """Observations in the original test shape (geohash column present), with an order key."""
    rows = [(i,) + r for i, r in enumerate(OBS_ROWS)]
    return spark.createDataFrame(rows, "event_id long, lat double, lng double, geohash string, "
                                       "temperature_c double, humidity_pct long, pressure_mb double, "
                                       "condition string, observation_date string")


@pytest.fixture(scope="session")
def obs_real_shape(spark):
    """Observations in the real weather shape (no geohash column)."""
    rows = [(i, r[1], r[0], r[3] * 9 / 5 + 32, r[3], r[7]) for i, r in enumerate(OBS_ROWS)]
    return spark.createDataFrame(rows, "event_id long, lng double, lat double, avg_tmpr_f double, "
                                       "avg_tmpr_c double, wthr_date string")
