import io
import tarfile

from pyspark.sql import functions as F

from inkwell.plans import ingest as plan
from inkwell.plans.render import to_markdown
from inkwell.sources import archives, jats, jsonl, listing, sinks
from inkwell.streaming.ingest import ingest_new_files

XML = """<?xml version="1.0"?><!DOCTYPE article>
<article xmlns:xlink="http://www.w3.org/1999/xlink" xmlns:ali="http://www.niso.org/schemas/ali/1.0/" article-type="research-article"><!-- note -->
<front><journal-meta><journal-id journal-id-type="nlm-ta">J Ab</journal-id><journal-title>Journal&nbsp;A</journal-title><issn pub-type="ppub">1-1</issn><issn pub-type="epub">2-2</issn></journal-meta>
<article-meta><article-id pub-id-type="pmc">PMC1</article-id><article-id pub-id-type="doi"> 10.1/x </article-id>
<title-group><article-title>On <italic>Yersinia</italic> diabetes</article-title></title-group>
<contrib-group><contrib contrib-type="author"><name><surname>Bell</surname><given-names>Anna</given-names></name></contrib><contrib contrib-type="editor"><name><surname>Ed</surname><given-names>X</given-names></name></contrib><contrib contrib-type="author"><collab>G</collab></contrib></contrib-group>
<pub-date pub-type="ppub"><year>1999</year></pub-date><pub-date pub-type="epub"><month>Jan</month><year>2001</year></pub-date>
<permissions><license><ali:license_ref>https://creativecommons.org/licenses/by/4.0/</ali:license_ref></license></permissions>
<abstract><p>Short ( 1 , 2 ). Two.</p><sec><title>Aim</title><p>Aim text.</p></sec></abstract></article-meta></front>
<body><p>Lead .</p><sec><title>Methods</title><p> </p><p>We did <b>it</b>. Twice!</p><sec><p>Untitled below.</p></sec><sec><title>Deep</title><p>Deep text</p></sec>
<fig><label>Fig 1</label><caption><p>A  curve</p></caption></fig>
<table-wrap><label>Table 1</label><caption>Cap</caption><table><tr><th colspan="2">A</th><th>B</th></tr><tr><td rowspan="2">1</td><td>2</td><td></td></tr><tr><td>NA</td><td>3</td></tr><tr><td></td><td></td><td></td></tr></table></table-wrap>
<table-wrap><label>Gone</label></table-wrap></sec><sec><title>Methods</title><p>More.</p></sec></body>
<back><ref-list><ref><name><surname>Ray</surname><given-names>C</given-names></name><name><surname>Ito</surname></name><article-title>T one
   two <i>x</i></article-title><source>J</source><year>1997</year><fpage>1</fpage><lpage>9</lpage><pub-id pub-id-type="pmid">7</pub-id></ref><ref><label>2</label><note>Loose words</note></ref></ref-list></back></article>"""


def frame(spark, *contents):
    return spark.createDataFrame([("a", f"d/m{i}.xml", c if c is None else bytearray(c.encode())) for i, c in enumerate(contents)], "archive string, member string, content binary")


def test_parse(spark, rows_of):
    parsed = jats.parse_articles(frame(spark, XML)).cache()
    m = jats.metadata(parsed).first()
    assert (m.pmc_id, m.pmid, m.doi, m.title, m.authors, m.year, m.month) == ("PMC1", None, "10.1/x", "On Yersinia diabetes", ["Anna Bell"], 2001, None)
    assert (m.license, m.journal, m.journal_abbrev, m.issn) == ("CC BY 4.0", "Journal A", "J Ab", "2-2")
    rows = [(r.section, r.paragraph, r.sentence, r.text) for r in jats.text_rows(parsed).orderBy("pos", "sentence").collect()]
    assert rows == [
        ("Body", 1, 1, "Lead."),
        ("Abstract", 0, 0, ""), ("Abstract", 1, 1, "Short [1, 2]."), ("Abstract", 1, 2, "Two."), ("Abstract; Aim", 1, 1, "Aim text."),
        ("Methods", 2, 1, "We did it."), ("Methods", 2, 2, "Twice!"), ("Methods", 0, 0, "**Fig 1:** *A curve*"), ("Methods", 0, 0, "TABLE_PLACEHOLDER:Table 1"), ("Methods", 0, 0, "TABLE_PLACEHOLDER:Gone"),
        ("Methods", 1, 1, "Untitled below."), ("Deep", 1, 1, "Deep text"), ("Methods", 1, 1, "More."),
    ]
    t = jats.table_rows(parsed).first()
    assert (t.label, t.caption, t.header, t.rows) == ("Table 1", "Cap", ["A", "A.1", "B"], [["1", "2", None], ["1", None, "3"]])
    refs = rows_of(jats.reference_rows(parsed))
    assert refs[0] == (1, "7", "Ray C", "1997", "T one two", "J", None, "1-9", None)
    assert refs[1][2] == "2Loose words"
    full = jats.text_rows(jats.parse_articles(frame(spark, XML), full_path=True)).select("section").distinct()
    assert ("Methods; Deep",) in rows_of(full)


def test_grid_spans():
    assert jats.grid([[("a", 1, 3), ("b", 2, 1)], [("c", 1, 2), ("d", 1, 1)], [("e", 1, 1)]]) == [["a", "b", "b"], ["a", "c", "d"], ["a", "c", "e"]]


def test_markdown(spark):
    out = to_markdown(jats.parse_articles(frame(spark, XML))).first().markdown
    assert out.startswith("---\ntitle: On Yersinia diabetes\nauthors:\n- Anna Bell\njournal: Journal A\nyear: 2001\npmcid: PMC1\ndoi: 10.1/x\nlicense: CC BY 4.0\n---\n\n# On Yersinia diabetes\n\n## Body\n\nLead.\n\n## Abstract\n\n")
    assert "### Aim\n\nAim text." in out and "## Methods\n\nWe did it. Twice!\n\n**Fig 1:** *A curve*\n\n**Table 1**\n\n| A | A.1 | B |" in out
    assert out.count("## Methods") == 1 and "Gone" not in out
    assert out.endswith("## References\n\n1. Ray C. **T one two**. *J* (1997) 1-9. PMID: 7\n\n2. 2Loose words")


def test_errors_are_rows(spark, rows_of):
    saved, counts = plan.ingest(frame(spark, XML, XML[:500], None, XML.replace("research-article", "letter"), "<article/>"))
    assert rows_of(counts) == [(None, "error", 2), (None, "filtered", 2), (None, "saved", 1), ("a", "error", 2), ("a", "filtered", 2), ("a", "saved", 1)]
    assert saved.count() == 1


def make_archive(path, members):
    with tarfile.open(path, "w:gz") as archive:
        for name, content in members.items():
            info = tarfile.TarInfo(name)
            info.size = len(content)
            archive.addfile(info, io.BytesIO(content))


def test_archives_and_sinks(spark, rows_of, tmp_path):
    make_archive(tmp_path / "b.tar.gz", {"x/1.xml": XML.encode(), "x/readme.txt": b"no", "y/1.xml": XML.encode()})
    make_archive(tmp_path / "a.tar.gz", {"2.xml": b"<broken"})
    (tmp_path / "c.tar.gz").write_bytes(b"not an archive")
    (tmp_path / "other.zip").write_bytes(b"")
    rows = archives.read_archives(spark, str(tmp_path))
    assert rows_of(rows.select("archive", "member")) == [("a.tar.gz", "2.xml"), ("b.tar.gz", "x/1.xml"), ("b.tar.gz", "y/1.xml"), ("c.tar.gz", "<ReadError>")]
    named = archives.fetch_archives(spark, [str(tmp_path / "b.tar.gz"), str(tmp_path / "none.tar.gz")], "inkwell.sources.archives:open_local", suffix=".txt")
    assert rows_of(named.select("archive", "member")) == [("b.tar.gz", "x/readme.txt"), ("none.tar.gz", "<FileNotFoundError>")]
    saved, counts = plan.ingest(rows)
    assert (None, "error", 2) in rows_of(counts) and (None, "saved", 2) in rows_of(counts)
    folder = tmp_path / "md"
    sinks.write_markdown_files(saved, str(folder))
    assert len(list(folder.glob("*.md"))) == 2  # members of one stem keep apart
    sinks.write_single(saved.limit(1), str(tmp_path / "one.md"))
    assert (tmp_path / "one.md").read_text().startswith("---")
    sinks.write_splits(spark.createDataFrame([(1, "test"), (2, None)], "n int, split string"), str(tmp_path / "s"))
    assert rows_of(spark.read.parquet(str(tmp_path / "s")).select("n", "split")) == [(1, "test"), (2, "train")]


def test_stream_takes_only_new_files(spark, rows_of, tmp_path):
    source, target, check = tmp_path / "in", tmp_path / "out", tmp_path / "check"
    source.mkdir()
    (source / "1.xml").write_text(XML)
    for _ in range(2):
        ingest_new_files(spark, str(source), str(target), str(check)).awaitTermination(120)
    assert spark.read.parquet(str(target)).count() == 1
    (source / "2.xml").write_text("<broken")
    ingest_new_files(spark, str(source), str(target), str(check)).awaitTermination(120)
    assert rows_of(spark.read.parquet(str(target)).select("member", "status")) == [("1.xml", "saved"), ("2.xml", "error")]


def test_windows_on_a_stream(spark, rows_of, tmp_path):
    from inkwell.streaming.ingest import windowed_counts

    events = spark.createDataFrame([("2026-01-01 00:10:00", "a"), ("2026-01-01 00:50:00", "a"), ("2026-01-01 01:10:00", "b"), ("2026-01-01 09:00:00", "a"), ("2026-01-01 00:20:00", "late")], "ts string, kind string").select(F.to_timestamp("ts").alias("ts"), "kind")
    batch = rows_of(windowed_counts(events, "ts", "kind").select(F.hour("start"), "kind", "n"))
    assert batch == [(0, "a", 2), (0, "late", 1), (1, "b", 1), (9, "a", 1)]
    events.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = windowed_counts(spark.readStream.schema(events.schema).parquet(str(tmp_path / "in")), "ts", "kind")
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", check).trigger(availableNow=True).start().awaitTermination(120)
    # Windows that the watermark has passed are out, the last one is still open.
    assert rows_of(spark.read.parquet(out).select(F.hour("start"), "kind", "n")) == [(0, "a", 2), (0, "late", 1), (1, "b", 1)]


def test_cache_lines_and_listing(spark, rows_of, tmp_path):
    from inkwell.schemas import EMBED_CACHE

    lines = [(1, '{"hash": "a", "embedding": [1.0]}'), (2, '{"hash": "a", "embedding": [2.0]}'), (3, '{"hash": "b", "emb'), (4, '{"hash": "c"}'), (5, "")]
    df = spark.createDataFrame(lines, "pos int, value string")
    assert rows_of(jsonl.parse_cache(df, EMBED_CACHE)) == [("a", [2.0])]
    jsonl.append_cache(spark.createDataFrame([("k", [0.5])], EMBED_CACHE), str(tmp_path / "c"))
    assert rows_of(jsonl.read_cache(spark, str(tmp_path / "c"), EMBED_CACHE)) == [("k", [0.5])]
    pages = spark.createDataFrame([('<a HREF="b.tar.gz">b</a> <a href="a.tar.gz">', ), ('<a href="b.tar.gz"> <a href="c.txt">', )], "html string")
    assert [r.name for r in listing.list_archives(pages, "html").collect()] == ["a.tar.gz", "b.tar.gz"]
    assert [r.name for r in listing.list_archives(pages, "html", skip=1).collect()] == ["b.tar.gz"]
    both = spark.createDataFrame([("<x><article a='1'>p\n</article><ARTICLE>q</ARTICLE></x>",)], "t string")
    assert both.select(F.size(jats.split_articles(F.col("t")))).first()[0] == 2


def test_api_and_sql(spark, rows_of):
    from inkwell import api

    df = frame(spark, XML, "<broken")
    assert rows_of(api.to_metadata(df, "member").select("member", "pmc_id")) == [("d/m0.xml", "PMC1")]
    assert api.to_reference(df, "member").count() == 2 and api.to_table(df).count() == 1 and api.to_text(df, "member").count() == 13
    assert api.to_markdown(df, "member", include_metadata=False, include_references=False).filter("member like '%0.xml'").first().markdown.startswith("## Body")
    api.register(spark)
    spark.createDataFrame([(1, XML), (2, "<broken")], "n int, x string").createOrReplaceTempView("articles")
    got = spark.sql("select n, article_type, size(refs) as r, error is null as ok, count_words('a b') as w from articles, lateral parse_article(x)")
    assert rows_of(got) == [(1, "research-article", 2, True, 2), (2, None, 0, False, 2)]
