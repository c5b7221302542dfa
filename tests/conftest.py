import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from shelfcast.session import build_session, materialize  # noqa: E402
from shelfcast.sources.generator import synthetic_sales  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("ERROR")
    return session


CATALOG = [
    ("K01", "Norvik", "Lantern 3 Lite", "Smartphone", 24, 4, 949, None, None),
    ("K02", "Norvik", "Lantern 4 Lite", "Smartphone", 19, 4, 1149, None, None),
    ("K03", "Norvik", "Lantern 4 Lite Plus", "Smartphone", 17, 4, 1249, None, None),
    ("K04", "Ostra", "Beacon 24", "Smartphone", 21, 3, 749, None, None),
    ("K05", "Ostra", "Cold Chest 450L", "Refrigerator", 9, 7, 1190, None, None),
    ("K06", "Tarn", "Breeze 2 Cooler", "Air Conditioner", 12, 6, 640, [4, 5, 6, 7], 2.0),
    ("K07", "Tarn", "Wide Screen 48\"", "Television", 11, 5, 1080, None, None),
]


@pytest.fixture(scope="session")
def catalog(spark):
    return spark.createDataFrame(
        CATALOG, "product_id string, brand string, product_name string, category string, base_demand int, "
                 "lead_time_days int, price int, seasonal_months array<int>, seasonal_factor double")


@pytest.fixture(scope="session")
def sales(spark, catalog):
    """Reference-shaped daily sales: 7 products x 366 days."""
    return materialize(synthetic_sales(catalog, "2024-01-01", "2024-12-31"), "test-sales")
