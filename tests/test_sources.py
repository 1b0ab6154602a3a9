import json

from pyspark.sql import functions as F

from foliomill.operators import cleaning, corrections, index, search
from foliomill.sources import readers
from foliomill.streaming.ingest import gained


def put(path, value):
    path.write_text(value if isinstance(value, str) else json.dumps(value, ensure_ascii=False), encoding="utf-8")
    return str(path)


def test_documents_and_pages(spark, tmp_path):
    put(tmp_path / "instruction_1.json", {"fichier": "a.pdf", "pages": 1, "mode": "natif", "confiance_moyenne": 100.0, "pages_faibles": [], "detail": [{"numero": 1, "mode": "natif", "confiance": 100.0, "caracteres": 3, "texte": "été"}]})
    put(tmp_path / "base_02.json", {"fichier": "b.pdf"})
    docs = readers.documents(spark, str(tmp_path))
    got = {r["ident"]: r for r in docs.collect()}
    assert got["base_02"]["mode"] == "ocr" and got["base_02"]["weak"] == [] and got["base_02"]["confidence"] == 0.0
    assert [tuple(r) for r in readers.pages(docs).collect()] == [("instruction_1", 1, "natif", 100.0, 3, "été")]


def test_optional_files_are_empty_tables(spark, tmp_path):
    none = str(tmp_path / "none.json")
    assert [readers.manifest(spark, none).count(), readers.contributions(spark, none).count(), readers.statuses(spark, none).count(), readers.corrections(spark, none).count()] == [0, 0, 0, 0]


def test_manifest_statuses_and_corrections(spark, tmp_path):
    m = put(tmp_path / "m.json", [{"id": 7, "titre": "vieux"}, {"id": 7, "titre": "neuf"}, {"id": 8, "titre": "autre"}])
    assert {r["id"]: r["titre"] for r in readers.manifest(spark, m).collect()} == {"7": "neuf", "8": "autre"}
    s = put(tmp_path / "s.json", {"_note": "x", "a_1": {"par": "b", "par_slug": "s", "_clause": "c"}, "a_2": ["no"]})
    assert [tuple(r) for r in readers.statuses(spark, s).collect()] == [("a_1", "b", "s")]
    c = put(tmp_path / "c.json", {"_note": [], "d": [{"page": 1, "avant": "a", "apres": "b"}, {"page": 2, "remplacer_page": "tout"}], "e": {"par": "no"}})
    rules = readers.corrections(spark, c)
    pages = spark.createDataFrame([("d", 1, "la page a"), ("d", 3, "reste")], "doc string, page int, text string")
    fixed, totals = corrections.outcomes(rules, pages)
    assert {(r["page"], r["text"], r["patched"]) for r in fixed.collect()} == {(1, "lb pbge b", True), (3, "reste", False)}
    assert tuple(totals.first()) == (1, 0, 1)
    again, second = corrections.outcomes(rules, fixed.select("doc", "page", "text"))
    assert {r["text"] for r in again.collect()} == {"lb pbge b", "reste"} and tuple(second.first()) == (0, 1, 1)


def test_words_of_a_recogniser(spark, tmp_path):
    head = "level\tpage_num\tblock_num\tpar_num\tline_num\tword_num\tleft\ttop\twidth\theight\tconf\ttext\n"
    rows = ["4\t1\t1\t1\t1\t0\t0\t0\t9\t9\t-1\t", "5\t1\t1\t1\t1\t1\t0\t0\t9\t9\t90\tArticle", '5\t1\t1\t1\t1\t2\t0\t0\t9\t9\t80\t"un', "5\t1\t1\t1\t2\t1\t0\t0\t9\t9\t20\to", "5\t1\t1\t1\t2\t2\t0\t0\t9\t9\t20\t|", "5\t1\t1\t1\t2\t3\t0\t0\t9\t9\t20\tx", "5\t1\t1\t1\t2\t4\t0\t0\t9\t9\t20\t-", "5\t1\t2\t1\t1\t1\t0\t0\t9\t9\tbad\tno", "5\t1\t2\t1\t1\t2\t0\t0\t9\t9\t70\tsuite"]
    words = readers.recognised_words(spark, put(tmp_path / "w.tsv", head + "\n".join(rows)))
    got = cleaning.recognised_lines(words).orderBy("block", "line").collect()
    assert [(r["text"], r["confidence"], r["new_paragraph"]) for r in got] == [('Article "un', 85.0, False), ("suite", 70.0, True)]


def test_site_sitemap_and_pdfs(spark, tmp_path):
    (tmp_path / "a").mkdir()
    put(tmp_path / "a" / "index.html", "<title>x</title>")
    put(tmp_path / "a" / "other.html", "<title>y</title>")
    assert readers.site(spark, str(tmp_path)).count() == 1
    assert [r["url"] for r in readers.sitemap(spark, put(tmp_path / "s.xml", "<urlset><url><loc>u1</loc></url><loc>u2</loc></urlset>")).collect()] == ["u1", "u2"]
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "good.pdf").write_bytes(b"%PDF-1.4")
    (tmp_path / "p" / "bad.pdf").write_bytes(b"<html>")
    (tmp_path / "p" / "none.pdf").write_bytes(b"")
    assert readers.valid_pdfs(spark, str(tmp_path / "p")).count() == 1


def test_search_index_in_json(spark, tmp_path):
    one = {"docs": [["s-1", "Un", "loi", "2021", 0, "5", "abrégé", 12], ["s-2", "Deux", "rapport", None, 1, "", "", 0]], "termes": {"agrément": [[0, 255], [1, 3]], "taux": [[1, 1]]}, "longueurMoyenne": 6}
    docs, postings, stats = readers.search_index(spark, put(tmp_path / "i.json", one))
    assert [tuple(r) for r in docs.orderBy("doc").collect()] == [(0, "s-1", "Un", "loi", "2021", False, "5", "abrégé", 12), (1, "s-2", "Deux", "rapport", None, True, "", "", 0)]
    assert {tuple(r) for r in postings.collect()} == {("agrément", 0, 255), ("agrément", 1, 3), ("taux", 1, 1)}
    assert tuple(stats.first()) == (2, 6.0)
    words = search.query_terms(spark.createDataFrame([(1, "taux")], "query int, text string"))
    assert [r["doc"] for r in search.scores(search.expanded(words, postings.select("term").distinct()), docs, postings, stats).collect()] == [1]
    empty = readers.search_index(spark, put(tmp_path / "e.json", {"docs": [], "termes": {}, "longueurMoyenne": 1}))
    assert [t.count() for t in empty] == [0, 0, 1]


def test_index_is_saved_and_loaded(spark, tmp_path):
    docs = spark.createDataFrame([(1, "loi", False, "taux taux agrément"), (2, "loi", False, "sociétés"), (3, "loi", True, "")], "doc int, type string, repealed boolean, body string")
    built = index.build(docs)
    index.save(*built, str(tmp_path / "i"))
    index.save(*built, str(tmp_path / "i"))  # a second time replaces the first
    for before, after in zip(built, index.load(spark, str(tmp_path / "i")), strict=True):
        assert after.columns == before.columns and sorted(map(tuple, after.collect())) == sorted(map(tuple, before.collect()))


def test_texts_by_key_and_written_documents(spark, tmp_path):
    docs = spark.createDataFrame([("a_1", 1, "x"), ("b 2", 2, None), (None, 3, "z")], "ident string, pages int, text string")
    wanted = spark.createDataFrame([("b 2",), ("b 2",), (None,), ("none",)], "ident string")
    assert [tuple(r) for r in readers.texts(docs, wanted, "ident").collect()] == [("b 2", 2, None)]
    folder = str(tmp_path / "out")
    readers.write_documents(docs.where("ident is not null"), folder)
    back = spark.read.schema("pages int, text string, ident string").json(folder)
    assert {(r["ident"], r["pages"], r["text"]) for r in back.collect()} == {("a_1", 1, "x"), ("b 2", 2, None)}


def test_stream_reads_new_files_once(spark, tmp_path):
    src, out, check = (str(tmp_path / x) for x in ("src", "out", "check"))
    first = spark.range(5).withColumn("x", F.lit("a"))
    first.write.parquet(src)
    assert gained(spark, src, first.schema, check, out).count() == 5
    assert gained(spark, src, first.schema, check, out).count() == 5
    first.write.mode("append").parquet(src)
    assert gained(spark, src, first.schema, check, out).count() == 10


def test_furniture(spark):
    pages = ["Registre du commerce\ncorps un\nTel : 33", "Registre du commerce\ncorps deux\nPage 2/9", "Registre du commerce\nArticle 1 : gardé\nVu l'Instruction n° 4", "autre\nInstruction n° 67/2021\n3 sur 9"]
    df = spark.createDataFrame([("d", p, i, line) for p, t in enumerate(pages) for i, line in enumerate(t.split("\n"))], "doc string, page int, line_no int, line string")
    gone = {r["line"] for r in cleaning.without_furniture(df).where("removed").collect()}
    assert gone == {"Registre du commerce", "Tel : 33", "Page 2/9", "Instruction n° 67/2021", "3 sur 9"}
