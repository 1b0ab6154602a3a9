"""The pipeline against a plain version of what its stages decide."""

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from foliomill.llm import quality, secrets, simhash

from .test_decontam import plain as contaminated
from .test_simhash import groups
from .test_simhash import plain as fingerprint

#: Columns with the names of what stages work out.
ODD = ["spans", "score", "stats", "n_words", "contaminated", "Item_Ids", "__base", "fp", "root", "ids", "decoded", "component_id"]
SF = "/root/testdata/sf0.001"


def test_stages_take_effect_and_match_a_plain_version(spark):
    docs, bench, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark", "labels"))
    stats = quality.with_statistics(docs.select("doc_id", "text"))
    score = {r["doc_id"]: r["score"] for r in quality.scored(stats, quality.fit(stats, quality.chosen(labels))).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect() if score[r["doc_id"]] >= 0.3}
    root = groups([fingerprint(t) for t in texts.values()])
    first = {}
    for i in sorted(texts):
        first.setdefault(root[fingerprint(texts[i])], i)
    items = [(r["item_id"], r["text"]) for r in bench.collect()]
    left = {i: texts[i] for i in first.values() if not contaminated(texts[i], items)[3]}
    spans = {r["doc_id"]: r["spans"] for r in secrets.annotate(docs.where(docs.doc_id.isin(list(left)))).collect()}
    for i, own in spans.items():
        out, at = "", 0
        for s in own:
            if s["start"] >= at:
                out += left[i][at : s["start"]] + "[SECRET]"
            at = max(at, s["end"])
        left[i] = out + left[i][at:]
    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(got) == set(left) and 0 < len(left) < docs.count()
    assert all(got[i]["ids"] == lib.encode(t, add_bos=True, add_eos=True) and got[i]["n_tokens"] == len(got[i]["ids"]) and got[i]["round_trip"] for i, t in left.items())


def test_stages_return_documents_columns_and_stand_odd_rows(spark, tmp_path):
    from .helpers import documents

    docs = documents(spark)
    extra = docs.select("*", *(F.col("lang").alias(c) for c in ODD[3:]))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, extra, SF)
        assert out.schema == extra.schema and {r["doc_id"]: r for r in out.select("doc_id", *ODD).collect()}.items() <= {r["doc_id"]: r for r in extra.select("doc_id", *ODD).collect()}.items(), name
        assert stage(spark, docs.where("false"), SF).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()
    assert simhash.keep_one(docs).count() <= docs.count()
