import bz2

import pytest
from pyspark.sql import functions as F

from hilada.operators import corpus, lexicon, metadata, quality, recovery, wikitext
from hilada.sources import files, sinks
from hilada.streaming import ingest

DOCUMENTS = "doc_id long, source string, text string"


def documents(spark, *texts):
    return spark.createDataFrame([(i, "ab"[i % 2], t) for i, t in enumerate(texts)], DOCUMENTS)


def test_ranks_are_continuous_whatever_the_ties(spark):
    freq = lexicon.frequencies(documents(spark, "uno dos tres dos", "dos tres uno uno", None, ""))
    rows = lexicon.ranked(freq).orderBy("source", "ranking").collect()
    assert [(r.source, r.word, r.frequency, r.ranking, r.cumulative_frequency) for r in rows] == [("a", "dos", 2, 1, 2), ("a", "tres", 1, 2, 3), ("a", "uno", 1, 3, 4), ("b", "uno", 2, 1, 2), ("b", "dos", 1, 2, 3), ("b", "tres", 1, 3, 4)]
    assert [r.token for r in rows if r.source == "a"] == [536, 537, 538] and lexicon.rises(lexicon.ranked(freq)).count() == 0


def test_vocabulary_limits(spark):
    with pytest.raises(ValueError):
        lexicon.top(lexicon.frequencies(documents(spark, "uno")), 70_000)
    assert lexicon.clamped(0) == 1 and lexicon.clamped(10**6) == 65_000
    assert lexicon.top(lexicon.frequencies(documents(spark, "uno dos")), 500).count() == 2


def test_empty_corpus(spark):
    empty = spark.createDataFrame([], DOCUMENTS)
    assert lexicon.versions(lexicon.frequencies(empty)).count() == 0 and corpus.ingested(empty).count() == 0 and quality.measures(empty).count() == 0


def test_repeated_line_ratio_counts_all_lines_of_runs(spark):
    text = "\n".join(["repetida"] * 3 + ["doble.."] * 2 + ["x", "otra línea"])
    row = quality.measures(spark.createDataFrame([(text,)], "text string")).first()
    assert row.repeated_line_ratio == 3 / 7 and row.non_empty_line_count == 7


def test_scores_follow_the_profile(spark):
    text = ("palabra " * 20 + ".\n") * 60
    rows = spark.createDataFrame([(text, "novela"), (text, "obra_dramatica"), (None, None)], "text string, document_type string")
    got = {r.document_type: r for r in quality.by_profile(rows).collect()}
    assert got["novela"].score == 85 and got["novela"].warnings == ["repeated_lines"] and got["obra_dramatica"].score == 100
    assert got[None].errors == ["few_words", "few_characters"] and got[None].profile == "default"
    assert quality.deep_merge({"a": {"b": 1, "c": 2}}, {"a": {"b": 3}}) == {"a": {"b": 3, "c": 2}}


def test_duplicates_keep_the_first(spark):
    got = {r.doc_id: r.kept for r in corpus.exact_duplicates(documents(spark, "x", "y", "x", None, None)).collect()}
    assert got == {0: True, 1: True, 2: False, 3: True, 4: True}


def test_upsert_keeps_columns_of_old_rows(spark):
    old, new = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, v string, made int"), spark.createDataFrame([(2, "c", 99), (3, "d", 30)], "k int, v string, made int")
    assert sorted(map(tuple, corpus.upserted(old, new, "k", ("made",)).collect())) == [(1, "a", 10), (2, "c", 20), (3, "d", 30)]


def test_cap_comes_after_the_anti_join(spark):
    incoming, known = spark.createDataFrame([(i,) for i in range(5)], "k int"), spark.createDataFrame([(0,), (1,)], "k int")
    assert [r.k for r in corpus.first_new(incoming, known, "k", "k", 2).collect()] == [2, 3] and corpus.first_new(incoming, known, "k", "k", 0).count() == 3


def test_mapping_needs_single_candidates(spark):
    raw = spark.createDataFrame([("f1", "Uno  dos"), ("f2", "otro")], "file string, text string")
    found = spark.createDataFrame([("d1", "uno dos"), ("d2", "OTRO"), ("d3", "otro ")], "document string, text string")
    likely = {r.file: r.document for r in recovery.by_likeness(raw, found).collect()}
    assert likely == {"f1": "d1", "f2": None}
    merged = recovery.merged_mapping(recovery.by_hash(raw, found), recovery.by_likeness(raw, found))
    assert {r.file: r.status for r in merged.collect()} == {"f1": "RECOVERED", "f2": "UNMATCHED"} and recovery.repeated_documents(merged).count() == 0


def test_checksums(spark):
    listing = spark.createDataFrame([("ABC  *a.bz2\n\ndef b.bz2\n",)], "listing string")
    sums = metadata.file_sums(listing)
    names = spark.createDataFrame([("a.bz2",), ("c.bz2",)], "filename string")
    assert {r.filename: r.md5 for r in recovery.with_checksums(names, sums, sums).collect()} == {"a.bz2": "abc", "c.bz2": None}


def test_oai_records(spark):
    xml = '<record><header><identifier>i1</identifier></header><dc:title>A &amp; B</dc:title><dc:title>C</dc:title><dc:creator> X </dc:creator><dc:language>ES</dc:language></record>'
    gone = '<record><header status="deleted"><identifier>i2</identifier></header></record>'
    rows = {r.identifier: r for r in metadata.oai_records(spark.createDataFrame([(xml,), (gone,)], "xml string")).collect()}
    assert rows["i1"].title == "A & B" and rows["i1"].authors == ["X"] and rows["i1"].language == "es" and rows["i2"].deleted and rows["i2"].title is None


def test_pages(spark):
    page = "<a href=\"j?id=2\">Dos</a><script>x</script><a href=\"j?id=1\"><b>Uno</b></a><a href=\"j?id=2\">Otra</a> 20240101 <a href=\"20240102/\">s</a><a href=\"20231231/\">s</a>"
    df = spark.createDataFrame([(1, page)], "k int, html string")
    assert {(r.id, r.label) for r in metadata.linked_ids(df, "k", "html", ["id=(\\d+)"]).collect()} == {("1", "Uno"), ("2", "Dos")}
    assert df.select(metadata.visible_text(F.col("html"))).first()[0] == "Dos Uno Otra 20240101 s s" and df.select(metadata.newest_snapshot(F.col("html"))).first()[0] == "20240102"
    src = spark.createDataFrame([('<script src="/a.js"></script><script src="//x.example/jquery.js"></script><script src="https://o.example/b.js"></script>',)], "h string")
    assert src.select(metadata.script_sources(F.col("h"), "x.example", ("jquery",))).first()[0] == ["https://x.example/a.js"]
    assert spark.createDataFrame([(["https://x.example/1", "https://x.example/art/2"],)], "i array<string>").select(metadata.article_address(F.col("i"))).first()[0].endswith("/art/2")
    ids = spark.createDataFrame([(["doi:1", "http://x.example/a?script=sci_arttext&pid=S1", "https://x.example/a.PDF"],)], "i array<string>")
    got = ids.select(metadata.pdf_address(F.col("i")), metadata.article_address(F.col("i")), metadata.candidate_pdf(metadata.article_address(F.col("i")))).first()
    assert tuple(got) == ("https://x.example/a.PDF", "http://x.example/a?script=sci_arttext&pid=S1", "http://x.example/a?script=sci_pdf&pid=S1")


@pytest.mark.parametrize(
    ("wiki", "text"),
    [
        ("x {| a {| b |} c |} y", "x\ny"), ("x {| a", "x {| a"), ("'''Sol''' es [[estrella|una estrella]] [[Luna#Cara]] [[Archivo:a.jpg|x]]", "Sol es una estrella Luna"),
        ("a{{siglo|XV}} {{lang|en|text}} {{unidad|3|km}} {{Ficha|x=1}} {{cita libro|y}} {{otra|solo}} {{otra|a|b}}", "asiglo XV text 3 km solo"), ("{{a|{{b|dentro}}}}", "dentro"),
        ("== T ==\n* uno<ref>n</ref> [http://a.b c d] <!-- no --> &amp;\n\n#: dos", "T\nuno c d &\ndos"), ("", ""),
    ],
)
def test_wikitext(wiki, text):
    assert wikitext.plain(wiki) == text


def test_wikitext_columns(spark):
    c = F.col("t")
    values = ["{{fecha|31|enero|2005}}", "{{Fecha|1 de setiembre de 2010}}", "{{fecha|32|enero|2005}}", None]
    got = [spark.createDataFrame([(v,)], "t string").select(wikitext.publication_date(c)).first()[0] for v in values]
    assert got == ["2005-01-31", "2010-09-01", None, None]
    row = spark.createDataFrame([(None,), ("[[a]] '''b'''",)], "t string").select(wikitext.cleaned("t").alias("c")).select("c.*").collect()
    assert row[0].text is None and row[1].text == "a b" and row[1].original_characters == 13


def test_dump_scan(spark, tmp_path):
    page = "<page><title>{}</title><ns>{}</ns><id>{}</id>{}<revision><id>9</id><text>{}</text></revision></page>"
    pages = [page.format("A", 0, 1, "", "Hola [[mundo]]\n {{x}}"), page.format("B", 1, 2, "", "x"), page.format("C", 0, 3, '<redirect title="A"/>', "x"), page.format("D", 0, 4, "", ""), page.format("E", 0, 5, "", "#REDIRECCIÓN [[A]]"), page.format("F", 0, 6, "", "{{Ficha}}")]
    (tmp_path / "d.xml.bz2").write_bytes(bz2.compress(("<mediawiki>" + "\n".join(pages) + "</mediawiki>").encode()))
    rows = {r.page_id: (r.outcome, r.plain) for r in wikitext.scanned(files.xml_pages(spark, str(tmp_path / "d.xml.bz2"))).collect()}
    scan = files.xml_pages(spark, str(tmp_path / "d.xml.bz2"))
    assert {r.outcome: r.pages for r in wikitext.outcomes(wikitext.scanned(scan)).collect()} == {"article": 1, "other namespace": 1, "redirect": 2, "blank": 1, "empty": 1}
    assert {r.ns: (r.pages, r.redirects) for r in wikitext.namespaces(scan).collect()} == {0: (5, 2), 1: (1, 0)}
    assert rows == {1: ("article", "Hola mundo"), 2: ("other namespace", None), 3: ("redirect", None), 4: ("blank", None), 5: ("redirect", None), 6: ("empty", "")}


def test_categories(spark):
    pages = spark.createDataFrame([("[[Categoría:Cine de México]] [[Categoría:Arte|x]]",), ("[[categoria:Arte]]",), (None,)], "text string")
    assert [tuple(r) for r in wikitext.top_categories(pages, 2).collect()] == [("Arte", 2), ("Cine de México", 1)]
    names = wikitext.categories(F.col("text"))
    assert [tuple(r) for r in pages.limit(1).select(wikitext.countries(names), wikitext.countries_mentioned(names)).collect()] == [([], ["MX"])]


def test_text_files(spark, tmp_path):
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "a.TXT").write_bytes("año\r\n".encode())
    (tmp_path / "b.txt").write_bytes("año".encode("cp1252"))
    (tmp_path / "c.dat").write_bytes(b"x")
    assert sorted(r.text for r in files.read_files(spark, str(tmp_path), "txt").collect()) == ["año", "año\n"]
    with pytest.raises(ValueError):
        files.read_files(spark, str(tmp_path), "doc")
    pdf = spark.createDataFrame([(bytearray(b"%PDF-1.4"), 8), (bytearray(b"<html>"), 6)], "content binary, length long")
    assert [r.accepted for r in files.pdf_downloads(pdf).collect()] == [True, False]


def test_csv_and_json(spark, tmp_path):
    (tmp_path / "t.csv").write_bytes("﻿Ranking,Palabra\n1,uno\n".encode())
    assert files.csv_table(spark, str(tmp_path / "t.csv"), ["Ranking"]).first()[0] == "1"
    with pytest.raises(ValueError):
        files.csv_table(spark, str(tmp_path / "t.csv"), ["Otra"])
    (tmp_path / "j.jsonl").write_text('{"a": 1}\n\n{"a": 2, "b": 3}\n')
    assert files.json_lines(spark, str(tmp_path / "j.jsonl"), "a int").count() == 2


def test_sinks(spark, tmp_path):
    ranked = lexicon.ranked(lexicon.frequencies(documents(spark, "uno uno dos")))
    row = sinks.version_rows(ranked).orderBy("Ranking").first()
    assert row.FrecuenciaRelativa == "0.6666666667" and row.Porcentaje == "66.666667" and row.Token == 536
    sinks.write_csv(sinks.frequency_rows(ranked), str(tmp_path / "csv"), "Ranking")
    assert spark.read.option("header", "true").csv(str(tmp_path / "csv")).count() == 2
    path = sinks.replace_checked(ranked.select("word"), str(tmp_path / "t"), 2, ("word",))
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(ValueError):
        sinks.replace_checked(ranked.select("word"), str(tmp_path / "t"), 3)
    with pytest.raises(ValueError):
        sinks.replace_checked(ranked.select("source"), str(tmp_path / "t"), keys=("source",))
    sinks.append_audits(ranked.select("word"), str(tmp_path / "a"))
    sinks.append_audits(ranked.select("word"), str(tmp_path / "a"))
    assert spark.read.parquet(str(tmp_path / "a")).count() == 4
    sinks.write_stage(documents(spark, "x", "y").withColumnRenamed("source", "source_code"), str(tmp_path), "cleaned")
    assert spark.read.parquet(str(tmp_path / "cleaned")).where("source_code = 'a'").count() == 1
    sinks.write_reports(documents(spark, "x"), str(tmp_path / "r"))
    assert '"doc_id":0' in spark.read.text(str(tmp_path / "r")).first()[0]


def test_stream_takes_each_text_once(spark, tmp_path):
    schema = "doc_id long, source string, text string, arrived timestamp"
    rows = spark.createDataFrame([(1, "a", "hola mundo"), (2, "a", "hola mundo"), (3, "b", "otro")], DOCUMENTS).withColumn("arrived", F.current_timestamp())
    rows.select(*(c.split()[0] for c in schema.split(", "))).write.parquet(str(tmp_path / "in"))
    stream = ingest.canonical(ingest.distinct_texts(ingest.landing(spark, str(tmp_path / "in"))))
    for _ in range(2):
        ingest.write(stream, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).select("canonical").distinct().count() == spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_statistics_and_manifest(spark):
    one, two = documents(spark, "x", "y", "z"), documents(spark, "x", "y", "z").orderBy(F.desc("doc_id"))
    assert sorted(map(tuple, corpus.manifest(one, "1").collect())) == sorted(map(tuple, corpus.manifest(two, "1").collect()))
