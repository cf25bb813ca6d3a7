import pytest
from compare import compare, duck

from tillwork.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="session")
def same(spark):
    """Differences between a query and its SQL check over the sample tables."""

    def check(key: str, sf_dir: str = "/root/testdata/sf0.001") -> list[str]:
        return compare(QUERIES[key](spark, sf_dir), duck(sf_dir), ORACLES[key])

    return check


@pytest.fixture
def folder(spark, tmp_path):
    """Writes tables to a folder that a query can read: folder(documents=df)."""

    def write(**tables) -> str:
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
