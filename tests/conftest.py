from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tidemark.session import importable  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return importable(session)


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def oracle():
    """Runs SQL over the Parquet tables of a folder."""
    import glob

    import duckdb

    def run(sql: str, folder: str) -> list[tuple]:
        con = duckdb.connect()
        for path in glob.glob(f"{folder}/*.parquet"):
            con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
        con.execute(f"CREATE TABLE answer AS {sql}")
        names = sorted(r[0] for r in con.execute("DESCRIBE answer").fetchall())
        return names, con.execute("SELECT " + ", ".join(f'"{n}"' for n in names) + " FROM answer").fetchall()

    return run


def rounded(rows) -> list[tuple]:
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows), key=repr)


@pytest.fixture(scope="session")
def same(oracle):
    """Asserts that a DataFrame and SQL give the same columns and rows."""

    def check(df, sql: str, folder: str) -> None:
        names, expected = oracle(sql, folder)
        assert sorted(df.columns) == names
        assert rounded(tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()) == rounded(expected)

    return check
