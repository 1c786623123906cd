import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from clickloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        spark__master="local[4]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def actions(spark):
    """Builds ``user_visit_action`` rows from dicts that name only what matters."""
    from clickloom.schemas import USER_VISIT_ACTION

    def build(rows):
        full = [tuple(r.get(n) for n in USER_VISIT_ACTION.names) for r in rows]
        return spark.createDataFrame(full, USER_VISIT_ACTION)

    return build


@pytest.fixture
def one(spark):
    """Values of column expressions over one row of text columns."""

    def evaluate(columns, **values):
        ddl = ", ".join(f"{n} string" for n in values) or "none string"
        df = spark.createDataFrame([tuple(values.values()) or (None,)], ddl)
        return tuple(df.select(*columns).head())

    return evaluate
