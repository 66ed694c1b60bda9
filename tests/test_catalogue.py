"""Every query that has SQL agrees with DuckDB on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from docpipe.plans import catalogue, markdown, roundtrips  # noqa: F401


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for name in os.listdir(sf_dir):
        if name.endswith(".parquet"):
            path = f"{sf_dir}/{name}"
            c.sql(f"create view {name[:-8]} as select * from '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return c


def rows(df):
    k = sorted(df.columns)
    return df[k].astype(str).sort_values(k).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_matches_sql(name, spark, duck, sf_dir):
    got, want = rows(catalogue.QUERIES[name](spark, sf_dir).toPandas()), rows(duck.sql(catalogue.ORACLES[name]).df())
    assert list(got.columns) == list(want.columns)
    assert got.equals(want)


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_runs(name, spark, sf_dir):
    assert catalogue.QUERIES[name](spark, sf_dir).count() > 0


def agrees(name, spark, folder, **tables):
    """The query over own tables, against its SQL over the same."""
    for table, df in tables.items():
        df.coalesce(1).write.parquet(f"{folder}/{table}.parquet")
        duckdb.sql(f"create or replace view {table} as select * from '{folder}/{table}.parquet/*.parquet'")
    got, want = rows(catalogue.QUERIES[name](spark, str(folder)).toPandas()), rows(duckdb.sql(catalogue.ORACLES[name]).df())
    assert len(want) and got.equals(want)


def documents(spark, texts):
    found = [(i, t, "en", f"src{i}", len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(found, "doc_id long, text string, lang string, source string, n_chars long")


def test_imports_above_any_text(spark, tmp_path):
    """Blank texts and lines at the head stay, and lines that look like imports."""
    texts = ["a", "", " ", "\n", "\n\n", "\n\na", " \n a", "a\n\n", "import a from 'b';\nc", "a\nexport default B;\n\nc", "export const a = 1\n\n# B", "import {\n a\n} from 'b'\n", "|a\n|b\n|",
             "\r\n\r\na", "a\rimport b\r\r\nc", "\u2028import a\u0085\u0085export { b }\u2029|", "$1\\1"]
    agrees("strip_imports", spark, tmp_path, documents=documents(spark, texts))


def test_files_without_a_byte(spark, tmp_path):
    """Empty files are read like others; rows that make no file stay."""
    docs = documents(spark, ["a", "", " ", "\n", ""])
    odd = spark.createDataFrame([(90, None, "en", "src1", 0), (91, "a", None, "src1", 1), (92, "a", "en", None, 1)], docs.schema)
    agrees("spec_paths", spark, tmp_path / "d", documents=docs.unionByName(odd))
    pages = spark.createDataFrame([(i, f"http://a/{i}", "" if i % 3 else "<p>") for i in range(20)], "page_id long, url string, html string")
    for name in ("read_pages", "unmatched_files"):
        agrees(name, spark, tmp_path / name, pages=pages)


def test_entry_names():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
