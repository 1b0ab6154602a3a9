"""Queries whose questions were literals read a given table."""

from foliomill.plans.all import QUERIES


def test_question_references_of_all_turns(spark, sf, tmp_path):
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    found = QUERIES["question_references"](spark, sf)
    assert found.count() == turns.where("role = 'user'").count()
    assert any("conversations.parquet" in f for f in found.inputFiles())
    spark.createDataFrame([(-7, 0, "user", None), (13, 0, "user", "99999999999999999999999 article 4"), (5, 0, "assistant", "x")], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["query"]: r for r in QUERIES["question_references"](spark, str(tmp_path)).collect()}
    assert sorted(got) == ["-7/0", "13/0"] and got["13/0"]["regulation_article"] == "37"
