"""XML by utterances against the reader of whole files."""

import pytest
from pyspark.sql import functions as F

from utterlake.sources import talkbank_xml, xml_splits
from tests.test_sources import XML

HEAD = '<?xml version="1.0"?>\n<CHAT xmlns="http://www.talkbank.org/ns/talkbank" PID="P{n}" Corpus="B &amp; C"><Participants><participant id="CHI" role="Target_Child"/></Participants>\n'


def long_file(n, utterances):
    said = "".join(f'<comment type="x">c{i}</comment>\n<u who="CHI" uID="u{i}">' + "".join(f"<w>w{i}é{j}</w>" for j in range(i % 5)) + '<t type="p"/></u>\n' for i in range(utterances))
    return HEAD.format(n=n) + said + '<u who="MOT" uID="last"/></CHAT>\n'


@pytest.fixture
def root(tmp_path):
    (tmp_path / "sub").mkdir()
    files = {
        "sub/a.xml": XML, "b.xml": long_file(1, 3000), "c.xml": long_file(2, 0), "d.xml": long_file(3, 700),
        "none.xml": HEAD.format(n=4) + "</CHAT>", "cut.xml": long_file(5, 40)[:-60], "cut2.xml": long_file(6, 3)[:260], "bad.xml": long_file(7, 5).replace("<w>w2é1</w>", "<w>"), "root.xml": "<CHAT>", "empty.xml": "",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    return f"file://{tmp_path}"


@pytest.mark.parametrize("size", ["19997", "128m"])
def test_equals_reader_of_whole_files(spark, root, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "0" if size != "128m" else "4m")
    try:
        rows, docs = xml_splits.read(spark, root), talkbank_xml.read(spark, root)
        got, want = xml_splits.utterances(rows, "PID"), talkbank_xml.utterances(docs, attribute="PID")
        assert got.schema.simpleString() == want.schema.simpleString()
        assert got.count() == want.count() and not got.exceptAll(want).take(1)
        same = lambda d: sorted((r.path, r.attributes, r.participants, r.error is None) for r in d.select("path", "attributes", "participants", "error").collect())
        assert [repr(r) for r in same(xml_splits.documents(rows))] == [repr(r) for r in same(docs)]
        splits = rows.where("path LIKE '%/b.xml'").select("block").distinct().count()
        assert (splits == 1) == (size == "128m") and (size == "128m" or splits > 10)
        words = lambda d: talkbank_xml.words(d, "CHI", relation=True, attribute="PID")
        assert not words(got).exceptAll(words(docs)).take(1) and words(got).count() == words(docs).count() > 3000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_no_files_with_utterances(spark, tmp_path):
    (tmp_path / "x.xml").write_text("")
    rows = xml_splits.read(spark, f"file://{tmp_path}")
    assert xml_splits.utterances(rows).count() == 0 and xml_splits.documents(rows).count() == 0
