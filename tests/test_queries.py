"""Every registered query against its SQL on the smallest supplied tables."""

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]
DATA = "/root/testdata/sf0.001"

duckdb = pytest.importorskip("duckdb")
import __spark_entry__ as entry  # noqa: E402
from check import compare  # noqa: E402

@pytest.mark.skipif(not Path(DATA).exists(), reason="no supplied tables")
@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.TEXT_QUERIES)))
def test_query_equals_sql(spark, name):
    result = compare(spark, name, entry.queries()[name], entry.oracle_sql().get(name), DATA)
    assert result.startswith("ok"), result
