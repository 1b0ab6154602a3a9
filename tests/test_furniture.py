"""Page furniture: the query counts by the rules of its SQL, the operator by all of its own."""

import duckdb

from foliomill.operators import cleaning
from foliomill.plans.all import QUERIES, SQL

TEXT = "Un\n\ndeux est écrit à jo@example.com ici\nquatre\nle site www .example est ouvert\nétél : 12\n12 / 34\nsix\nsept\nhuit\nneuf\ndix"


def test_equals_sql(spark, tmp_path):
    spark.createDataFrame([(k, TEXT, f"src{k % 2}") for k in range(5)], "doc_id long, text string, source string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    found = QUERIES["boilerplate_removed"](spark, str(tmp_path)).select("doc", "lines", "removed")
    assert sorted(map(tuple, found.collect())) == sorted(con.execute(f"select doc, lines, removed from ({SQL['boilerplate_removed']})").fetchall())


def test_operator_spares_sentences(spark):
    lines = spark.createDataFrame([(1, 1, k, x) for k, x in enumerate(TEXT.split("\n"))], "doc int, page int, line_no int, line string")
    removed = {r["line"] for r in cleaning.without_furniture(lines).where("removed").collect()}
    assert removed == {"12 / 34"}
