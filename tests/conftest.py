import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from clickweave.session import build_session, checkpoint_dir

    s = build_session("local[2]", 4, app_name="clickweave-tests", extra={"spark.driver.memory": "4g"})
    checkpoint_dir(s)
    yield s
    s.stop()


CLICK_SCHEMA = ("`session ID` BIGINT, `order` INT, price INT, `price 2` INT, `page 2 (clothing model)` STRING, "
                "main_category STRING, colour STRING, page INT, location INT")


@pytest.fixture
def clicks_basic(spark):
    rows = [(1, 1, 20, 2, "A1", "trousers", "black", 1, 1), (1, 2, 30, 1, "A2", "skirts", "black", 1, 2),
            (1, 3, 40, 1, "A3", "skirts", "red", 2, 3), (2, 1, 100, 1, "B1", "sale", "white", 3, 4),
            (2, 2, 120, 1, "B2", "sale", "white", 4, 5), (3, 1, 10, 2, "C1", "blouses", "blue", 1, 6)]
    return spark.createDataFrame(rows, CLICK_SCHEMA)


@pytest.fixture
def clicks_sequence(spark):
    rows = [(1, 1, 20, 2, "A1", "trousers", "black", 1, 1), (1, 2, 30, 1, "A2", "skirts", "black", 1, 2),
            (1, 3, 20, 2, "A1", "trousers", "red", 2, 3), (2, 1, 100, 1, "B1", "sale", "white", 3, 4),
            (2, 2, 120, 1, "B2", "sale", "white", 4, 5), (3, 1, 10, 2, "C1", "blouses", "blue", 1, 6)]
    return spark.createDataFrame(rows, CLICK_SCHEMA)
