import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from martwright.session import build_session  # noqa: E402

SF_DIR = os.environ.get("MARTWRIGHT_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "martwright-tests", "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip("sample data not present")
    return SF_DIR


@pytest.fixture
def table(spark):
    """Small literal DataFrame from DDL and rows; timestamps and dates as text are cast."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import StructType

    def build(ddl, rows):
        schema = StructType.fromDDL(ddl)
        texts = ", ".join(f"{f.name} string" for f in schema.fields)
        body = [tuple(None if v is None else str(v) for v in row) for row in rows]
        raw = spark.createDataFrame(body, texts)
        return raw.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields))

    return build


@pytest.fixture
def role(table):
    """Literal role table with the declared schema; columns left out are NULL."""
    from martwright.sources.schemas import DDL, schema_of

    def build(name, *rows):
        columns = schema_of(name).names
        unknown = {c for row in rows for c in row} - set(columns)
        assert not unknown, unknown
        return table(DDL[name], [tuple(row.get(c) for c in columns) for row in rows])

    return build
