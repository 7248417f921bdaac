import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from llm_corpus import DOCS, corpus  # noqa: E402


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    langs = ("en", "fr", None)
    spark.createDataFrame(
        [(i, t, langs[(i or 0) % 3], "s", None if t is None else len(t), "r", "k", "s", "c", "p",
          "d") for i, t in rows], DOCS).repartition(4).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
