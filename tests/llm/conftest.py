import pytest


@pytest.fixture(scope="session")
def stored_docs(spark, tmp_path_factory):
    """Write rows as a Parquet table with extra, clashing columns and read it back."""
    def make(rows, schema="doc_id long, text string, lang string, source string, n_chars long"):
        path = str(tmp_path_factory.mktemp("docs") / "t")
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(path)
        return spark.read.parquet(path)
    return make
