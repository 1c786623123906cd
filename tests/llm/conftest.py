import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).parent))


@pytest.fixture(scope="session")
def table(spark):
    from plain import DIR

    return lambda name: spark.read.parquet(f"{DIR}/{name}.parquet")


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs, with columns whose names may clash."""

    def build(rows, **more):
        schema = "doc_id long, text string, n_tokens string, _hits string, _quality int, _lines int"
        full = [(d, t, "x", "y", 1, 2) for d, t in rows]
        df = spark.createDataFrame(full, schema)
        from pyspark.sql import functions as F

        return df.withColumns({k: F.lit(v) for k, v in more.items()})

    return build
