import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([T.StructField(c, T.LongType() if c in ("doc_id", "n_chars") else T.StringType()) for c in ("doc_id", "text", "lang", "source", "n_chars")])


@pytest.fixture(scope="session", autouse=True)
def checkpoint(spark, tmp_path_factory):
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.conf.set("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")


@pytest.fixture
def docs(spark):
    """documents from (doc_id, text) pairs, with the table's other columns."""

    def make(rows, extra=()):
        schema = T.StructType([*DOCUMENTS.fields, *[T.StructField(c, T.StringType()) for c in extra]])
        return spark.createDataFrame([(i, t, "en", "src0", None if t is None else len(t), *["x"] * len(extra)) for i, t in rows], schema)

    return make
