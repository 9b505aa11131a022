import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[4]").appName("assay-tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.bindAddress", "127.0.0.1").config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def table(spark):
    """table(ddl, rows) -> DataFrame; ISO text becomes a date where the schema says so."""
    import datetime as dt

    from pyspark.sql import types as T

    def make(ddl, rows):
        schema = T.StructType.fromDDL(ddl)
        out = []
        for r in rows:
            out.append(tuple(
                dt.date.fromisoformat(v) if isinstance(f.dataType, T.DateType) and isinstance(v, str) else
                float(v) if isinstance(f.dataType, T.DoubleType) and v is not None else v
                for f, v in zip(schema.fields, r)))
        return spark.createDataFrame(out, schema)

    return make


def rows(df, *cols):
    d = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in d.collect()), key=repr)
