import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def pytest_addoption(parser):
    parser.addoption("--all-queries", action="store_true", help="compare every registered query with its SQL")


@pytest.fixture(scope="session")
def spark():
    from menumix.session import local_session

    session = local_session("4", shuffle_partitions=4, memory="4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rules(spark):
    """Name rules of the tests beside the built-in blocklist and tags."""
    from menumix.session import rule_frame
    from menumix.sources.files import default_rules

    names = [("burrito", "BYO Indian Burrito"), ("hot sauce - side", "Hot Sauce"), ("additonal", "Additional"),
             ("grain bowl", "Grain Bowl")]
    return {**default_rules(spark), "names": rule_frame(spark, names, "key string, value string")}


@pytest.fixture(scope="session")
def frame(spark):
    """Build a frame from tuples and a schema string."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def rows():
    """Rows of a frame as a sorted list of tuples."""
    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(x is not None, str(x)) for x in r])

    return collect
