import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import cases  # noqa: E402


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(cases.documents(), cases.COLUMNS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], cases.COLUMNS)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The odd documents as a folder of tables, as the queries read them."""
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(cases.documents(), cases.COLUMNS).write.parquet(f"{path}/documents.parquet")
    labels = [(i, i % 3 != 0, i % 7 == 0) for i in range(30)]
    spark.createDataFrame([(a, int(b), int(c)) for a, b, c in labels], "doc_id long, quality int, toxic int").write.parquet(
        f"{path}/labels.parquet"
    )
    return path


@pytest.fixture(scope="module")
def empty_folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("nothing"))
    spark.createDataFrame([], cases.COLUMNS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{path}/embeddings.parquet")
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{path}/pages.parquet")
    return path
