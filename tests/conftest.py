import itertools
import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clinflat.session import get_session


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests",
        spark__master="local[4]",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        spark__sql__shuffle__partitions="4",
        spark__python__sql__dataFrameDebugging__enabled="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def ndjson(spark, tmp_path):
    """Write records as newline-delimited JSON and read them with a schema."""

    number = itertools.count()

    def read(records, schema):
        path = tmp_path / f"records{next(number)}.ndjson"
        path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records))
        return spark.read.schema(schema).option("mode", "FAILFAST").json(str(path))

    return read


def rows(df):
    """Rows as a sorted list of dicts without Row objects."""
    return sorted((r.asDict(recursive=True) for r in df.collect()), key=repr)


def same(df, expected):
    got = rows(df)
    want = sorted(expected, key=repr)
    assert got == want
