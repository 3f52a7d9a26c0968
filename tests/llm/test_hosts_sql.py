"""Host reputation against its SQL where one host holds most of the rows."""

import random

import duckdb
import pytest
from compare import difference
from skylane.llm import catalog


@pytest.mark.parametrize("hot", [0, 2000, 40000])
def test_reputation_equals_its_sql_beside_a_hot_host(spark, tmp_path, hot):
    draw = random.Random(7)
    hosts = [f"h{i}.example.org" for i in range(30)] + [f"b{i}.bad.co.uk" for i in range(3)] + [f"s{i}.co.uk" for i in range(20)]
    hosts += ["co.uk", "org", "", "lone"]
    rows = [(host, draw.random() < (0.97 if ".bad." in host else 0.24)) for host in hosts for _ in range(draw.randrange(1, 40))]
    rows += [("hot.example.com", draw.random() < 0.24) for _ in range(hot)]
    pages = [(i, f"http://{host}/p{i}" if host else None) for i, (host, _) in enumerate(rows)]
    labels = [(i, 0 if bad else 1, None) for i, (_, bad) in enumerate(rows)]
    spark.createDataFrame(pages, "page_id long, url string").write.parquet(str(tmp_path / "pages.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    con = duckdb.connect()
    for table in ("pages", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{tmp_path}/{table}.parquet/*.parquet')")
    name = "op1_host_reputation"
    df = catalog.queries()[name](spark, str(tmp_path))
    assert difference(df, con, catalog.oracle_sql()[name]) is None
    verdicts = {(r.host, r.verdict) for r in df.select("host", "verdict").distinct().collect()}
    assert {(f"b{i}.bad.co.uk", "block") for i in range(3)} & verdicts and ("s0.co.uk", "allow") in verdicts
