from __future__ import annotations

import contextlib
import io
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from crawlframe.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="4",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__driver__memory="8g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def one(spark):
    """Evaluate expressions of the columns of one row."""

    def evaluate(expression, schema: str, *values):
        return spark.createDataFrame([values], schema).select(expression).first()[0]

    return evaluate


def explained(df) -> str:
    """What ``explain("formatted")`` prints."""
    with contextlib.redirect_stdout(io.StringIO()) as printed:
        df.explain("formatted")
    return printed.getvalue()
