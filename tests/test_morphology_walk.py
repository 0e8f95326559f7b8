"""Word, morphology and affix tables come from one walk of each document."""

from utterlake.operators import morphology
from utterlake.sources import talkbank_xml as X

WORD = '<w>dogs<mor type="mor"><mw><pos><c>n</c></pos><stem>dog</stem><mk type="sfx">PL</mk></mw><gra type="gra" index="1" head="0" relation="LINK"/></mor></w>'
DOCUMENT = f'<CHAT xmlns="{X.NS[1:-1]}"><u who="A">{WORD * 50}</u></CHAT>'


def test_three_tables_of_one_walk(spark):
    files = spark.createDataFrame([("t", DOCUMENT)], "path string, text string")
    w, mor, mk = morphology.trio(files)
    assert (w.count(), mor.count(), mk.count()) == (50, 50, 50)
    assert not any("MapInPandas" in t._jdf.queryExecution().toString() for t in (w, mor, mk))
