"""What reading XML costs: calls a word, and tasks."""

import sys
import xml.etree.ElementTree as ET

from utterlake.plans.transcripts import as_xml
from utterlake.sources import talkbank_xml as X

WORD = '<w>dogs<mor type="mor"><mw><pos><c>n</c></pos><stem>dog</stem><mk type="sfx">PL</mk></mw><gra type="gra" index="1" head="0" relation="LINK"/></mor></w>'
DOCUMENT = f'<CHAT xmlns="{X.NS[1:-1]}" PID="p"><Participants/><u who="A">{WORD * 50}</u></CHAT>'


def test_a_word_is_walked_once():
    u = next(ET.fromstring(DOCUMENT).iter(f"{X.NS}u"))
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        found = X.utterance(u)["tokens"]
    finally:
        sys.setprofile(None)
    assert calls < 60 * 50
    want = {"gloss": "dogs", "pos": "n", "stem": "dog", "suffix": "PL", "num_morphemes": 2, "relation": "1|0|LINK", "stem_form": "dog-PL", "clitic": "", "english": "", "prefix": "", "replacement": ""}
    assert len(found) == 50 and want.items() <= found[0].items()


def test_documents_are_dealt_to_more_tasks_than_cores(spark):
    rows = spark.range(200).selectExpr("id AS conv_id", "'user' AS role", "1L AS order", "array('a') AS tokens")
    docs = X.parsed(as_xml(rows))
    assert docs.rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism and docs.count() == 200
