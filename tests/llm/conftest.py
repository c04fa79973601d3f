import sys

import pytest

EXTRA = {"row": "x", "score": 1.0, "kept": "k", "key": None, "block": 3, "a": 1, "side": "s"}


@pytest.fixture
def frame(spark):
    """DataFrame of rows with columns of the given schema and, beside them, columns whose names operators use too."""
    from pyspark.sql import functions as F

    def make(rows, schema, extra=True):
        df = spark.createDataFrame(rows, schema)
        if extra:
            df = df.select("*", *[F.lit(v).alias(k) for k, v in EXTRA.items() if k not in df.columns])
        return df

    return make


assert sys.version_info >= (3, 11)
