import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from checks.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(4)


@pytest.fixture(scope="session")
def values(spark):
    """Evaluate a column function over rows given as tuples."""
    def run(rows, schema, column):
        from pyspark.sql import functions as F
        df = spark.createDataFrame(
            [(i, *r) for i, r in enumerate(rows)], f"__i int, {schema}"
        )
        return [r[0] for r in df.repartition(1).sortWithinPartitions("__i").select(column).collect()]

    return run
