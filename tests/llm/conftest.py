import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from helpers import DOCUMENT, ODD, stored, table  # noqa: E402


@pytest.fixture()
def files(tmp_path):
    return lambda df, name="docs": stored(df, str(tmp_path / name))


@pytest.fixture()
def odd(spark, files):
    return files(table(spark, ODD), "odd")


@pytest.fixture()
def crowded(odd):
    """The odd documents with columns whose names the operators use themselves."""
    clash = ["row", "size", "base", "hash", "score", "label", "tokens", "epoch", "_id", "_row", "key", "group"]
    return odd.withColumns({name: odd["source"] for name in clash})


@pytest.fixture()
def none(spark, files):
    return files(spark.createDataFrame([], DOCUMENT), "none")
