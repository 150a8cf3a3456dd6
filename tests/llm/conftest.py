import pytest

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture()
def docs(spark):
    """docs([(doc_id, text) | (doc_id, text, source), ...]) -> documents table."""
    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCS)
    return make


@pytest.fixture()
def sf(tmp_path):
    """sf(documents=df, ...) -> folder with these tables as Parquet."""
    def make(**tables):
        for name, df in tables.items():
            df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)
    return make
