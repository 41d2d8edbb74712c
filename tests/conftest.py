import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerloom.session import configure, local_session  # noqa: E402


# Started here, because test modules build columns when they are imported.
SESSION = configure(local_session("4", **{"spark.sql.shuffle.partitions": "4"}))


@pytest.fixture(scope="session")
def spark():
    yield SESSION
    SESSION.stop()


@pytest.fixture(scope="session")
def values(spark):
    """Evaluate an expression over a column ``x`` of literals, in input order."""

    def run(rows, expression, kind="string"):
        df = spark.createDataFrame([(i, row) for i, row in enumerate(rows)], f"i int, x {kind}")
        return [r[0] for r in df.select(expression.alias("v"), "i").orderBy("i").select("v").collect()]

    return run
