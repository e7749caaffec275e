import pytest


@pytest.fixture(scope="module", autouse=True)
def nothing_stays_cached(spark):
    """The session is shared: what a module's tests cache goes when they are over."""
    yield
    spark.catalog.clearCache()
