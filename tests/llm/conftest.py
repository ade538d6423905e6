import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def docs_schema():
    return "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def write_tables(spark, tmp_path):
    """Writes tables as ``<folder>/<name>.parquet`` and returns the folder."""
    def write(**tables):
        for name, df in tables.items():
            df.write.parquet(os.path.join(str(tmp_path), f"{name}.parquet"))
        return str(tmp_path)
    return write
