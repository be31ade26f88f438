import os
import tempfile

import pytest

from atende.session import local_session

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, memory="6g", **{"spark.checkpoint.dir": tempfile.mkdtemp(prefix="llm-tests-")})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]


def make_docs(spark, rows):
    """Documents with all their columns from (id, text) pairs, plus a column whose name an operator uses inside."""
    full = [(i, t, "en", "s", None if t is None else len(t), "x") for i, t in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, code string")
