"""A search sees the table as it is now, not as it was when the session first indexed it."""

import pyarrow.parquet as pq

from foliomill.plans import retrieval


def test_index_follows_its_input(spark, sf, tmp_path):
    for name in ("documents", "labels"):
        pq.write_table(pq.read_table(f"{sf}/{name}.parquet"), tmp_path / f"{name}.parquet")
    many = retrieval.bm25_topk(spark, str(tmp_path)).select("doc").distinct().count()
    index = retrieval.shared_index(spark, str(tmp_path))
    assert retrieval.shared_index(spark, str(tmp_path)) is index  # unchanged files: written once
    pq.write_table(pq.read_table(f"{sf}/documents.parquet").slice(0, 3), tmp_path / "documents.parquet")
    few = retrieval.bm25_topk(spark, str(tmp_path)).select("doc").distinct().count()
    assert few <= 3 < many
