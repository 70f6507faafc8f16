from pathlib import Path

import pytest

REPO = str(Path(__file__).resolve().parents[2])
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def _workers_find_the_package(spark):
    spark.sparkContext.environment["PYTHONPATH"] = REPO


@pytest.fixture
def documents(spark):
    """Documents from (id, text) pairs, with the other columns null."""

    def build(*rows):
        return spark.createDataFrame([(i, text, None, None, None) for i, text in rows], DOCUMENTS)

    return build


@pytest.fixture
def labels(spark):
    def build(*rows):
        return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")

    return build
