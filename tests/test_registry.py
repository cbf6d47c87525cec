import pytest

from checks.compare import connect, difference
from checks.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    with connect(sf) as connection:
        yield connection


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, con, sf, name):
    assert difference(spark, con, name, sf) is None


def test_only_the_trained_model_has_no_sql():
    assert set(QUERIES) - set(ORACLES) == {"ml_sentiment", "ml_fit_metrics"}
