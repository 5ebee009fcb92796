import pytest


@pytest.fixture(scope="session", autouse=True)
def workers_import(spark):
    from lapsekit.llm.common import let_workers_import
    let_workers_import(spark)


@pytest.fixture(scope="session")
def small_docs(spark):
    """The smallest documents table and its rows by doc_id."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return df, {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}
