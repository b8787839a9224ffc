import pytest
from pyspark.sql.types import StructType

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def frame(spark):
    """Rows as a DataFrame of the given DDL."""

    def build(ddl, rows):
        return spark.createDataFrame(list(rows), StructType.fromDDL(ddl))

    return build


@pytest.fixture
def documents(frame):
    def build(texts, lang="en", source="s"):
        rows = [(k, t, lang, source, len(t or "")) for k, t in (texts.items() if isinstance(texts, dict) else texts)]
        return frame(DOCS, rows)

    return build
