import json
from datetime import datetime, timezone

from pyspark.sql import functions as F

from vectorloom.functions import fields
from vectorloom.operators import checkpoint
from vectorloom.operators.export import split_parts, write_jsonl, write_parts
from vectorloom.sources.feeds import atom_records, fetch, record_lines, rss_records, scan_atom, scan_rss
from vectorloom.sources.lines import head_lines, scan_lines
from vectorloom.sources.testset import read_test_set

ATOM = """<?xml version="1.0" encoding="UTF-8"?>
<feed xmlns="http://www.w3.org/2005/Atom" xmlns:arxiv="http://arxiv.org/schemas/atom">
  <title>results</title><id>http://arxiv.org/api/x</id>
  <entry>
    <id>http://arxiv.org/abs/2301.12345</id>
    <title>
      Full &amp; Title </title>
    <summary>  The summary.
    </summary>
    <published>2023-01-15T10:00:00Z</published>
    <author><name> Alice A </name></author><author><name>Bob B</name></author><author><affiliation>x</affiliation></author>
    <category term="cs.CL"/><category term="cs.AI" scheme="s"/><category scheme="s"/>
    <arxiv:doi> 10.1/x </arxiv:doi><arxiv:journal_ref>J 1</arxiv:journal_ref>
  </entry>
  <entry><id>http://arxiv.org/abs/quant-ph/0202022</id><title>Minimal</title><summary>S</summary></entry>
  <entry><title>No id</title><summary>S</summary></entry>
  <entry><id>http://example.com/other</id><title>Foreign</title></entry>
</feed>
"""
RSS1 = """<?xml version="1.0"?>
<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns="http://purl.org/rss/1.0/" xmlns:dc="http://purl.org/dc/elements/1.1/">
<item><title>One</title><link> http://arxiv.org/abs/1 </link><description>&lt;p&gt;A &lt;b&gt;bold&lt;/b&gt; text&lt;/p&gt;</description><dc:creator>A B, , C D ,</dc:creator></item>
<item><title>Bad</title><link>http://example.com/</link><description>x</description></item>
<item><title>Two</title><link>http://arxiv.org/abs/2</link></item>
<item><title>Three</title><link>http://arxiv.org/abs/3</link><description>x</description></item>
</rdf:RDF>
"""
RSS2 = """<?xml version="1.0"?>
<rss version="2.0" xmlns:dc="http://purl.org/dc/elements/1.1/"><channel><title>t</title><link>http://arxiv.org/abs/channel</link>
<item><title>Four</title><link>http://arxiv.org/abs/4</link><description>plain</description><dc:creator>E F</dc:creator></item>
</channel></rss>
"""


def test_atom(spark, tmp_path):
    (tmp_path / "f.xml").write_text(ATOM)
    full, minimal = atom_records(scan_atom(spark, str(tmp_path))).orderBy("id").collect()
    assert (full.id, full.title, full.abstract) == ("2301.12345", "Full & Title", "The summary.")
    assert full.authors == ["Alice A", "Bob B"] and full.categories == ["cs.CL", "cs.AI"]
    assert (full.doi, full["journal-ref"], full.published) == ("10.1/x", "J 1", "2023-01-15T10:00:00Z")
    assert minimal.id == "quant-ph/0202022" and minimal.authors == [] and minimal.categories == []
    assert minimal.doi is None and minimal["journal-ref"] is None and minimal.published is None


def test_empty_feed(spark, tmp_path):
    (tmp_path / "f.xml").write_text('<feed xmlns="http://www.w3.org/2005/Atom"><title>x</title></feed>')
    assert atom_records(scan_atom(spark, str(tmp_path))).count() == 0


def test_rss_both_dialects_and_cap(spark, tmp_path):
    (tmp_path / "a.xml").write_text(RSS1)
    (tmp_path / "b.xml").write_text(RSS2)
    items = scan_rss(spark, str(tmp_path))
    rows = {r.id: r for r in rss_records(items, "cs.CL", max_papers=2).collect()}
    assert sorted(rows) == ["1", "2", "4"], "two usable items of the first feed, one of the second"
    assert rows["1"].abstract == "A bold text" and rows["1"].authors == ["A B", "C D"]
    assert rows["2"].abstract == "" and rows["2"].authors == []
    assert rows["4"].categories == ["cs.CL"] and rows["4"].doi is None and rows["4"].published is None
    assert rss_records(items, "cs", None).count() == 4


def test_record_lines_keep_nulls_and_unicode(spark, tmp_path):
    (tmp_path / "f.xml").write_text(ATOM.replace("Minimal", "Médaille"))
    lines = [json.loads(r.value) for r in record_lines(atom_records(scan_atom(spark, str(tmp_path)))).collect()]
    minimal = next(x for x in lines if x["id"].startswith("quant"))
    assert minimal["title"] == "Médaille" and minimal["doi"] is None and "journal-ref" in minimal


def papers(spark):
    rows = [(str(i), datetime(2023, 1, 1 + i, 8), "cs.CL" if i % 2 else "math") for i in range(6)]
    return spark.createDataFrame(rows, "id string, published timestamp, category string")


def test_date_range(spark):
    df = papers(spark)

    def ids(**days):
        return [r.id for r in df.where(fields.submitted_between(F.col("published"), **days)).orderBy("id").collect()]

    assert ids(low="20230102", high="20230104") == ["1", "2", "3"]
    assert ids(low="20230105") == ["4", "5"]
    assert ids(high="20230101") == ["0"]
    assert len(ids()) == 6


def test_predicates(spark):
    df = spark.createDataFrame([(["cs.CL"], "On Machine Learning", None)], "c array<string>, t string, a string")
    row = df.select(
        fields.has_tag(F.col("c"), "cs.CL"), fields.mentions("machine learning", F.col("t"), F.col("a")),
        fields.any_tag(F.col("c"), ["x", "cs.CL"]), fields.mentions("vision", F.col("t"), F.col("a")),
    ).first()
    assert list(row) == [True, True, True, False]


def test_fetch_pages(spark):
    pages = fetch(papers(spark), since="20230102", page_size=2, max_total=3)
    assert [(r.id, r.page) for r in pages.orderBy("published").collect()] == [("1", 0), ("2", 0), ("3", 1)]
    since = F.lit(datetime(2023, 1, 3, 12, tzinfo=timezone.utc))
    newest = {r.page: r.newest for r in checkpoint.pages_newest(pages, since).collect()}
    assert newest == {0: datetime(2023, 1, 3, 12), 1: datetime(2023, 1, 4, 8)}
    assert fetch(papers(spark), since="20240101").count() == 0
    only = fetch(papers(spark), where=fields.mentions("cs", F.col("category")))
    assert only.count() == 3


def test_checkpoints(spark):
    since, start = (F.lit(datetime(2023, 1, d, tzinfo=timezone.utc)) for d in (2, 9))
    df = papers(spark)
    row = checkpoint.next_checkpoint(df, since, start).first()
    assert row.rows == 6 and row.checkpoint == datetime(2023, 1, 6, 8, 0, 1)
    assert checkpoint.next_checkpoint(df.limit(0), since, start).first().checkpoint == datetime(2023, 1, 9)
    old = df.where("id = '0'")
    assert checkpoint.next_checkpoint(old, since, start).first().checkpoint == datetime(2023, 1, 2, 0, 0, 1)
    values = spark.createDataFrame([("2023-01-05T00:00:00+00:00",), ("not-a-date",), (None,)], "v string")
    got = [r.c for r in values.select(checkpoint.parse_checkpoint(F.col("v"), start).alias("c")).collect()]
    assert got == [datetime(2023, 1, 5), datetime(2023, 1, 8), datetime(2023, 1, 8)]


def write_lines(folder, files):
    folder.mkdir()
    for name, lines in files.items():
        (folder / name).write_text("\n".join(lines) + "\n")
    return str(folder)


def parts_of(spark, path, n):
    rows = split_parts(scan_lines(spark, path), n).orderBy("line_index").collect()
    assert [r.line_index for r in rows] == list(range(len(rows)))
    return [(r.value, r.part) for r in rows]


def test_split_parts(spark, tmp_path):
    path = write_lines(tmp_path / "in", {"b.jsonl": list("defgh"), "a.jsonl": list("abc")})
    got = parts_of(spark, path, 3)
    assert "".join(v for v, _ in got) == "abcdefgh"
    assert [p for _, p in got] == [1, 1, 2, 2, 3, 3, 3, 3]
    assert {p for _, p in parts_of(spark, path, 20)} == {20}


def test_split_over_many_blocks(spark, tmp_path):
    names = {f"{c}.jsonl": [f"{c}{i:05d}" for i in range(2000)] for c in "ab"}
    path = write_lines(tmp_path / "in", names)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = parts_of(spark, path, 4)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [v for v, _ in got] == sorted(v for v, _ in got) and len(got) == 4000
    assert [sum(p == n for _, p in got) for n in (1, 2, 3, 4)] == [1000] * 4


def test_write_parts(spark, tmp_path):
    path = write_lines(tmp_path / "in", {"a.jsonl": list("abcde")})
    out = str(tmp_path / "out")
    write_parts(scan_lines(spark, path), out, 2)
    rows = spark.read.text(out).collect()
    assert sorted((r.part, r.value) for r in rows) == [(1, "a"), (1, "b"), (2, "c"), (2, "d"), (2, "e")]


def test_head_and_jsonl(spark, tmp_path):
    path = write_lines(tmp_path / "in", {"b.jsonl": list("def"), "a.jsonl": list("abc")})
    assert [r.value for r in head_lines(scan_lines(spark, path), 4).collect()] == list("abcd")
    out = str(tmp_path / "out")
    assert write_jsonl(spark.createDataFrame([("é", None)], "a string, b string"), out) == 1
    assert spark.read.text(out).first().value == '{"a":"é","b":null}'


def test_test_set(spark, tmp_path):
    cases = [{"arxiv_id": f"0704.000{i}", "abstract": "A", "query": "Q\nq"} for i in (1, 2)]
    (tmp_path / "t.json").write_text(json.dumps(cases, indent=2))
    rows = read_test_set(spark, str(tmp_path / "t.json")).orderBy("arxiv_id").collect()
    assert [r.arxiv_id for r in rows] == ["0704.0001", "0704.0002"] and rows[0].query == "Q\nq"
