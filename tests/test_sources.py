import io
import zipfile
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from docketry.sources import docx, files, marc, ranges

GOOD = """<record xmlns="http://www.loc.gov/MARC21/slim"><controlfield tag="001"> 42 </controlfield>
<datafield tag="191" ind1=" " ind2=" "><subfield code="a">A/RES/1</subfield><subfield code="b">A/</subfield></datafield>
<datafield tag="245" ind1="1" ind2="0"><subfield code="a">Peace :</subfield><subfield code="b">resolution /</subfield></datafield>
<datafield tag="269" ind1=" " ind2=" "><subfield code="a">1999-12-05</subfield></datafield>
<datafield tag="041" ind1=" " ind2=" "><subfield code="a">engfre</subfield></datafield>
<datafield tag="650" ind1=" " ind2=" "><subfield code="a">LAW</subfield></datafield><datafield tag="650" ind1=" " ind2=" "><subfield code="a">PEACE</subfield></datafield>
<datafield tag="710" ind1=" " ind2=" "><subfield code="a">UN</subfield><subfield code="9">ga</subfield></datafield><datafield tag="710" ind1=" " ind2=" "><subfield code="9">x</subfield></datafield>
<datafield tag="856" ind1=" " ind2=" "><subfield code="u">http://x/a.pdf</subfield><subfield code="y">English</subfield><subfield code="s">12</subfield></datafield>
<datafield tag="993" ind1="2" ind2=" "><subfield code="a">A/2</subfield></datafield></record>"""


def test_marc(spark, tmp_path):
    (tmp_path / "r.xml").write_text("<collection>" + GOOD + "<record><controlfield tag='001'>x9</controlfield></record>" + "<record><controlfield tag='001'>7</controlfield><oops></record>"
                                    + "<marc:record><marc:controlfield tag='001'>8</marc:controlfield></marc:record></collection>")
    split = marc.read_records(spark, str(tmp_path))
    assert split.count() == 4
    out = {r.recid: r for r in marc.parse(split).collect()}
    assert set(out) <= {42, 7, 8} and {42, 8} <= set(out)
    r = out[42]
    assert (r.document_symbol, r.title, r.date_publication, r.languages, r.subjects) == ("A/RES/1", "Peace resolution", date(1999, 12, 5), ["eng", "fre"], ["LAW", "PEACE"])
    assert [tuple(x) for x in r.corporate_authors] == [("UN", "ga")] and [tuple(x) for x in r.files] == [("http://x/a.pdf", "English", "12", None)]
    assert [tuple(x) for x in r.related_documents] == [("A/2", "2")] and r.display_title == "Peace" and r.symbol_normalized == "A/RES/1"
    assert out[8].title is None and out[8].subjects == []


def test_ranges(spark):
    def fetch(start, end):
        have = [i for i in range(start, end) if i % 3]
        return "<c>" + "".join(f"<record><controlfield tag='001'>{i}</controlfield></record>" for i in have[:10]) + "</c>"

    out = ranges.read_ranges(spark, fetch, 0, 100, width=40, cap=10, pause=0.0)
    got = sorted(r.recid for r in marc.parse(marc.split_records(out)).collect())
    assert got == [i for i in range(100) if i % 3]
    waits = []
    answers = iter([ValueError("x"), "", "ok"])

    def flaky(a, b):
        x = next(answers)
        if isinstance(x, Exception):
            raise x
        return x

    assert ranges.fetched(flaky, 0, 1, sleep=waits.append) == "ok" and waits == [5.0, 10.0]
    with pytest.raises(ValueError):
        ranges.fetched(lambda a, b: "", 0, 1, sleep=lambda s: None)
    assert ranges.frontier(1000) == (800, 6000) and ranges.extended(5900, 6000) == 11000 and ranges.extended(None, 6000) == 6000


def test_manifest_and_formats(spark, tmp_path):
    (tmp_path / "m.txt").write_text("# head\nb/1\n a/1 # note\n\nB/1\n")
    got = files.manifest(spark, str(tmp_path / "m.txt"), trailing_comments=True, ordered=True).orderBy("ordinal").collect()
    assert [r.symbol for r in got] == ["B/1", "A/1"]
    (tmp_path / "e.txt").write_text("")
    assert files.manifest(spark, str(tmp_path / "e.txt")).count() == 0
    assert files.symbols_of("# c\na\nA\n b ") == ["A", "B"]
    heads = {"docx": b"PK\x03\x04x", "doc": bytes.fromhex("D0CF11E0A1B11AE1"), "wpd": b"\xffWPC", "pdf": b"%PDF-1.4", "html": b"  <!doctype", "unknown": b"\x00\x01"}
    df = spark.createDataFrame([(k, bytearray(v)) for k, v in heads.items()], "k string, c binary")
    assert all(r.k == r.f for r in df.select("k", files.file_format(F.col("c")).alias("f")).collect())
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "a.json").write_text('{"s": 1}')
    (tmp_path / "j" / "_skip.json").write_text('{"s": 2}')
    assert [r.s for r in files.json_folder(spark, str(tmp_path / "j")).collect()] == [1]


W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships" xmlns:mc="http://schemas.openxmlformats.org/markup-compatibility/2006"'


def word(text, props=""):
    return f"<w:r><w:rPr>{props}</w:rPr><w:t>{text}</w:t></w:r>"


def make_docx():
    body = (
        f"<w:p><w:pPr><w:pStyle w:val='H1'/><w:jc w:val='center'/></w:pPr>{word('Title', '<w:b/>')}</w:p>"
        f"<w:p><w:pPr><w:numPr><w:ilvl w:val='0'/><w:numId w:val='3'/></w:numPr></w:pPr>{word('Recalls', '<w:i/>')}{word(' the past')}<w:del>{word('gone')}</w:del><w:footnoteReference w:id='2'/></w:p>"
        f"<w:tbl><w:tr><w:tc><w:p>{word('c1')}</w:p></w:tc><w:tc><w:p>{word('c2')}</w:p></w:tc></w:tr></w:tbl>"
        f"<w:sdt><w:sdtContent><w:p><w:hyperlink r:id='L'>{word('link')}</w:hyperlink></w:p></w:sdtContent></w:sdt><w:p/>"
        f"<w:p><w:r><mc:AlternateContent><mc:Choice><w:txbxContent><w:p>{word('boxed')}</w:p></w:txbxContent></mc:Choice><mc:Fallback><w:txbxContent><w:p>{word('boxed')}</w:p></w:txbxContent></mc:Fallback></mc:AlternateContent></w:r>{word('around')}</w:p>"
    )
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {W}><w:body>{body}</w:body></w:document>")
        z.writestr("word/footnotes.xml", f"<w:footnotes {W}><w:footnote w:id='0' w:type='separator'/><w:footnote w:id='2'><w:p>{word('A note')}</w:p></w:footnote></w:footnotes>")
        z.writestr("word/numbering.xml", f"<w:numbering {W}><w:abstractNum w:abstractNumId='9'><w:lvl w:ilvl='0'><w:numFmt w:val='decimal'/><w:lvlText w:val='%1.'/></w:lvl></w:abstractNum><w:num w:numId='3'><w:abstractNumId w:val='9'/></w:num></w:numbering>")
        z.writestr("word/_rels/document.xml.rels", "<Relationships xmlns='http://schemas.openxmlformats.org/package/2006/relationships'><Relationship Id='L' Target='http://x.example'/></Relationships>")
    return out.getvalue()


def test_docx(spark, tmp_path):
    (tmp_path / "a.docx").write_bytes(make_docx())
    (tmp_path / "bad.docx").write_bytes(b"PK\x03\x04 not a file")
    arch = files.archive(spark, str(tmp_path))
    assert {r.format for r in arch.collect()} == {"docx"}
    rows = docx.extract(arch).orderBy("doc", "position").collect()
    a = [r for r in rows if r.doc.endswith("a.docx")]
    assert [(r.kind, r.text) for r in a] == [
        ("paragraph", "Title"), ("paragraph", "Recalls the past"), ("table_cell", "c1"), ("table_cell", "c2"), ("paragraph", "link"), ("empty", ""),
        ("paragraph", "around"), ("paragraph", "boxed"), ("footnote", "A note"),
    ]
    assert a[0].style_id == "H1" and a[0].props.bold and a[0].props.alignment == "center"
    assert a[1].numbering.lvl_text == "%1." and a[1].props.lead_italic_text == "Recalls" and a[1].footnote_ref.note_ids == [2]
    assert a[3].table_cell.col == 1 and a[4].hyperlinks[0].url == "http://x.example" and a[7].props.textbox and a[8].footnote_ref.note_id == 2
    assert [r.kind for r in rows if r.doc.endswith("bad.docx")] == ["error"]
    counts = docx.census(arch)
    assert counts.where("construct = 'tbl'").first().n == 1
    assert {r.construct: r.documents for r in docx.presence(counts).collect()}["footnoteReference"] == 1


def test_streams(spark, tmp_path):
    from docketry.operators.usage import rate_windows
    from docketry.streaming import counters

    rows = [(i, f"key:{i % 3}", datetime(2024, 1, 1, 0, i // 20, i % 60)) for i in range(60)]
    events = spark.createDataFrame(rows, "event_id int, caller string, ts timestamp")
    src = str(tmp_path / "in")
    events.repartition(3).write.parquet(src)
    stream = counters.minute_counts(counters.read_stream(spark, src, "event_id int, caller string, ts timestamp", 1))
    q = stream.writeStream.format("memory").queryName("minute").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    key = lambda r: (r.caller, r.window_start, r["count"])
    assert sorted(map(key, spark.table("minute").collect())) == sorted(map(key, rate_windows(events).collect()))
    target = str(tmp_path / "table")
    for run in ("c1", "c2"):  # the second run repeats every batch
        counters.upsert_stream(
            counters.read_stream(spark, src, "event_id int, caller string, ts timestamp", 1), target, ["caller"], [F.desc("event_id")], str(tmp_path / run)
        ).awaitTermination()
    assert spark.read.parquet(target).count() == 3
