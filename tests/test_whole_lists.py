"""Conversations are answered from all documents that have a word, not from the first of its posting list."""

import json

from foliomill.plans import retrieval
from foliomill.plans.all import QUERIES


def test_document_past_the_bound(spark, tmp_path):
    filler = lambda n: " ".join(f"{a}{b}" for a in ("zor", "vek", "pul") for b in range(100, 100 + n))
    docs = [(i, f"{filler(99)} marche puis marche", "src", "fr") for i in range(450)] + [(450, f"{'z' * 200} marche", "src", "fr")]  # short: the best, with the least frequency
    put = lambda rows, schema, name: spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    put(docs, "doc_id long, text string, source string, lang string", "documents")
    put([(0, 0)], "doc_id long, toxic int", "labels")
    put([(1, 0, "user", "marche marche"), (1, 1, "assistant", "marche")], "conv_id long, turn long, role string, text string", "conversations")
    (row,) = QUERIES["dialogue"](spark, str(tmp_path)).collect()
    assert 450 in [x["doc"] for x in json.loads(row["shown"])] and row["left_docs"][0] == 450
    assert retrieval.whole_index(spark, str(tmp_path))[1].where("term = 'marche'").count() == 451
