import json

import pytest
from pyspark.sql import functions as F

from utterlake.operators import build, morphology
from utterlake.sources import chat_json, chat_text, tables, talkbank_xml

XML = """<?xml version="1.0"?><CHAT xmlns="http://www.talkbank.org/ns/talkbank" PID="P1" Lang="eng" Date="1962-10-08" Corpus="Brown">
<Participants><participant id="CHI" name="Adam" role="Target_Child" age="P2Y03M04D" sex="male"/><participant id="MOT" role="Mother"/></Participants>
<u who="CHI" uID="u0"><w>ice<wk type="cmp"/>cream<mor type="mor"><mw><pos><c>n</c><s>prop</s></pos><stem>icecream</stem><mk type="sfx">PL</mk></mw><gra type="gra" index="1" head="0" relation="ROOT"/></mor></w>
<w type="omission">the</w>
<w>gonna<replacement><w>going<mor type="mor"><mw><mpfx>re</mpfx><pos><c>part</c></pos><stem>go</stem><mk type="sfx">PRESP</mk></mw></mor></w><w>to<mor type="mor"><mw><pos><c>inf</c></pos><stem>to</stem></mw></mor></w></replacement></w>
<w>don't<mor type="mor"><mw><pos><c>aux</c></pos><stem>do</stem></mw><menx>do</menx><mor-post><mw><pos><c>neg</c></pos><stem>not</stem></mw></mor-post></mor></w>
<t type="p"/><media start="1.5" end="2.5" unit="s"/><a type="action" flavor="x">waves</a></u>
<u who="MOT" uID="u1"><w>(be)cause</w><w>a<shortening>bou</shortening>t</w><t type="q"/></u></CHAT>"""


@pytest.fixture(scope="module")
def xml_docs(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("xml")
    (root / "sub").mkdir()
    (root / "sub" / "a.xml").write_text(XML)
    (root / "bad.xml").write_text("<CHAT>")
    (root / "note.txt").write_text("no transcript")
    return talkbank_xml.read(spark, str(root)).cache()


def test_xml_tokens(xml_docs):
    assert {r.error is None for r in xml_docs.collect()} == {True, False} and xml_docs.count() == 2
    rows = talkbank_xml.utterances(xml_docs).orderBy("utterance_order").collect()
    assert [(r.who, r.terminator) for r in rows] == [("CHI", "p"), ("MOT", "q")]
    t = rows[0].tokens
    assert [x.gloss for x in t] == ["ice+cream", "gonna", "don't"] and [x.token_order for x in t] == [1, 2, 3]
    assert (t[0].pos, t[0].stem, t[0].suffix, t[0].num_morphemes, t[0].relation) == ("n:prop", "icecream", "PL", 2, "1|0|ROOT")
    assert (t[1].replacement, t[1].stem, t[1].pos, t[1].prefix, t[1].num_morphemes) == ("going to", "go to", "part inf", "re", 4)
    assert (t[2].clitic, t[2].english, t[2].num_morphemes, t[2].stem_form) == ("neg not ", "do", 2, "do not")
    assert rows[0].media.end == 2.5 and rows[0].annotations[0].text == "waves"
    assert [x.gloss for x in rows[1].tokens] == ["(be)cause", "about"]


def test_xml_getters(xml_docs):
    assert talkbank_xml.corpus(xml_docs).where("attributes['PID'] = 'P1'").count() == 1
    assert {r.code: r.attributes.get("age") for r in talkbank_xml.participants(xml_docs).collect()} == {"CHI": "P2Y03M04D", "MOT": None}
    words = lambda **o: [r.word for r in talkbank_xml.words(xml_docs, "CHI", **o).orderBy("token_order").collect()]
    assert words() == ["ice+cream", "gonna", "don't"] and words(replace=True)[1] == "going to" and words(stem=True)[0] == "icecream-PL"
    assert [r.tag for r in talkbank_xml.tagged_words(xml_docs, ["MOT"]).collect()] == [None, None]
    assert talkbank_xml.sents(xml_docs, "MOT").first().words == ["(be)cause", "about"]
    assert talkbank_xml.tagged_sents(xml_docs, "CHI").first().words[0].pos == "n:prop"


def test_browser_path(spark):
    df = spark.createDataFrame([("/x/childes/data-xml/Eng-USA/Brown/a.xml",), ("/x/Eng-USA/Brown/a.xml",), ("b.xml",)], "p string")
    assert [r[0] for r in df.select(talkbank_xml.browser_path(F.col("p"))).collect()] == ["Eng-USA/Brown/a.cha", "Eng-USA/Brown/a.cha", "b.cha"]


def test_word_mor_affix_rows(spark):
    w, mor, mk = morphology.trio(spark.createDataFrame([("t1", XML), ("t2", XML)], "path string, text string"))
    first = w.where("transcript = 't1'").orderBy("id").collect()
    assert [r.gloss for r in first] == ["ice+cream", "the", "gonna", "don't", "(be)cause", "a(bou)t"] and first[2].replacement == "going_to" and first[0].has_compound and first[5].has_shortening
    m = mor.where("transcript = 't2'").orderBy("id").collect()
    assert [(r.stem, r.clitic_type, r.w_fk) for r in m] == [("icecream", None, 0), ("go", None, 2), ("to", None, 2), ("do", None, 3), ("not", "post", 3)]
    assert [(r.affix, r.affix_type, r.mor_fk) for r in mk.where("transcript = 't1'").orderBy("id").collect()] == [("PL", "sfx", 0), ("re", "prefix", 1), ("PRESP", "sfx", 1)]


def word(text, **more):
    return {"type": "word", "cleaned_text": text, **more}


def mor(pos, lemma, *features, clitics=()):
    return {"main": {"pos": pos, "lemma": lemma, "features": list(features)}, "post_clitics": [{"pos": p, "lemma": x, "features": []} for p, x in clitics]}


def line(speaker, content, tiers=(), alignments=None, terminator="period", bullet=None):
    main = {"speaker": speaker, "content": {"content": content, "terminator": {"type": terminator} if terminator else None}, "bullet": bullet}
    return {"line_type": "utterance", "main": main, "dependent_tiers": list(tiers), "alignments": alignments}


CONTENT = [
    {"type": "replaced_word", "word": {"cleaned_text": "gonna"}, "replacement": {"words": [{"cleaned_text": "going"}, {"cleaned_text": "to"}]}},
    {"type": "separator", "kind": "comma"},
    {"type": "retrace", "content": {"content": [word("I")]}},
    word("um", category="filler"),
    word("xxx", untranscribed="unintelligible"),
    {"type": "group", "content": {"content": [word("it's")]}},
    {"type": "novelty", "content": {"content": [word("home")]}},
]
MOR = [mor("part", "go", "PRESP"), mor("inf", "to"), mor("cm", "cm"), mor("pro", "it", clitics=[("cop", "be")]), mor("n", "home")]
ALIGN = {
    "mor": {"pairs": [{"source_index": i, "target_index": i} for i in range(5)] + [{"source_index": 9, "target_index": 0}]},
    "gra": {"pairs": [{"mor_chunk_index": c, "gra_index": g} for c, g in ((0, 0), (1, 1), (3, 2), (5, 3))]},
    "units": {"main_mor": [0] * 5},
}
GRA = [{"index": i, "head": 0, "relation": r} for i, r in enumerate(("A", "B", "C", "D"), 1)]


def document(pid="P1", people=None, lines=()):
    people = people or {"CHI": {"name": "Adam", "role": "Target_Child", "id": {"age": "2;03.04", "sex": "male", "language": ["eng", "spa"]}}, "MOT": {"role": "Mother", "id": {}}}
    head = [{"line_type": "header", "header": h} for h in ({"type": "pid", "pid": pid}, {"type": "languages", "codes": ["eng"]}, {"type": "date", "date": "08-OCT-1962"})]
    return json.dumps({"participants": people, "lines": [*head, *lines]})


def said(spark, *lines):
    """The utterances of a document with these lines."""
    return chat_json.parsed(spark.createDataFrame([("p", document(lines=lines))], "path string, text string")).first().utterances


def test_content_walk(spark):
    deep = word("deep")
    for _ in range(320):
        deep = {"type": "group", "content": {"content": [word("before"), deep] if _ % 100 == 0 else [deep]}}
    odd = [{"type": "retrace", "content": {"content": [{"type": "separator", "kind": "tag"}, {"type": "quotation", "content": {"content": [word("in")]}}]}}, {"type": "group"}, {"type": "odd", "content": None}, {"kind": "none"}, {"type": "word", "raw_text": "raw"}, {"type": "word"}]
    u, v, w = said(spark, line("CHI", CONTENT, [{"type": "Mor", "data": {"items": MOR}}], ALIGN), line("CHI", [deep]), line("MOT", odd))
    assert [t.gloss for t in u.tokens] == ["gonna", "I", "xxx", "it's", "home"] and u.tokens[0].replacement == "going to"
    assert u.unknown == ["novelty"] and not u.slot_mismatch  # the units are those that ALIGN counts: two of gonna, one separator, it's, home
    assert [t.gloss for t in v.tokens] == ["before"] * 4 + ["deep"]
    assert [t.gloss for t in w.tokens] == ["in", "raw", ""] and w.unknown == ["None", "odd"]


def test_alignment(spark):
    tiers = [{"type": "Mor", "data": {"items": MOR}}, {"type": "Gra", "data": {"relations": GRA}}, {"type": "UserDefined", "data": {"label": "xpho", "content": "a b c d e"}}, {"type": "Mod", "data": {"items": ["x", ["y", "z"]]}}]
    u, bad = said(spark, line("CHI", CONTENT, tiers, ALIGN), line("CHI", CONTENT, [{"type": "Mor", "data": {"items": MOR}}], ALIGN | {"units": {"main_mor": [0]}}))
    t = u.tokens
    assert (t[0].stem, t[0].pos, t[0].num_morphemes, t[0].gra_relation) == ("go to", "part inf", 3, "A")
    assert t[1].stem == "" and t[1].num_morphemes is None
    assert t[3].clitic == "cop be" and t[3].gra_relation == "C" and t[4].gra_relation == "D"
    assert [x.actual_phonology for x in t] == list("abcde") and {x.model_phonology for x in t} == {""} and u.model == ["x", "y z"]
    assert [(m.type, m.lemma, m.features) for m in t[0].morphemes + t[3].morphemes] == [("stem", "go", ["PRESP"]), ("stem", "to", []), ("stem", "it", []), ("clitic", "be", [])]
    assert bad.slot_mismatch and all(x.stem == "" for x in bad.tokens)


def test_alignment_out_of_order(spark):
    """Pairs in any order, with holes and repeats: a token has its items in the pairs' order, a chunk its last relation."""
    words = [word(w) for w in "abcd"]
    items = [mor("n", x) for x in ("w", "x", "y", "z")]
    pairs = [{"source_index": s, "target_index": t} for s, t in ((3, 0), (1, 3), (None, 2), (1, 1), (0, None), (0, 9), (7, 1))]
    links = [{"mor_chunk_index": c, "gra_index": g} for c, g in ((3, 1), (0, 0), (3, 2), (1, 8), (None, 0))]
    tiers = [{"type": "Gra", "data": {"relations": GRA}}, {"type": "Mor", "data": {"items": items[:1]}}, {"type": "Mor", "data": {"items": items}}, {"type": "Ort", "data": {"segments": [{"type": "text", "text": "o"}, {"type": "x", "text": "-"}, {"type": "text", "text": "p"}]}}, {"type": "Spa", "data": "$INI"}]
    u, v = said(spark, line("CHI", words, tiers, {"mor": {"pairs": pairs}, "gra": {"pairs": links}}), line("CHI", words, [{"type": "Ort", "data": {"content": {"segments": [{"type": "text", "text": "q"}]}}}, {"type": "Pho", "data": "s"}, {"type": "Pho", "data": {"items": [["a", ["b", ["c"]]], "d", 1, "e"]}}], {"mor": {"pairs": pairs}}))
    assert [x.stem for x in u.tokens] == ["", "z x", "", "w"] and [x.gra_relation for x in u.tokens] == [None, "C", None, "A"]
    assert (u.ort, u.spa, v.ort, v.spa) == ("o p", "$INI", "q", None) and v.actual == ["a b c", "d", "1", "e"] == [x.actual_phonology for x in v.tokens]


def test_documents_that_cannot_be_read(spark):
    texts = {"a": None, "b": "", "c": "{", "d": "[1]", "e": '{"lines": 3}', "f": "{}", "g": '{"lines": null, "participants": null}', "h": '{"lines": [{"line_type": "utterance"}]}'}
    rows = {r.path: r for r in chat_json.parsed(spark.createDataFrame(list(texts.items()), "path string, text string")).collect()}
    assert {p for p, r in rows.items() if r.error} == set("abcde") and all(r.participants == [] for r in rows.values())
    assert [len(rows[p].utterances) for p in texts] == [0] * 7 + [1] and rows["h"].utterances[0].tokens == []


def test_no_python_reads_documents(spark):
    plan = chat_json.parsed(spark.createDataFrame([("p", "{}")], "path string, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


@pytest.fixture(scope="module")
def release(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("json")
    two = {"CHI": {"name": "A", "role": "Target_Child", "id": {"age": "3;00.00"}}, "SIB": {"name": "B", "role": "Target_Child", "id": {}}}
    adam = {"CHI": {"name": "Adam", "role": "Target_Child", "id": {"age": "2;06.00", "sex": "male"}}, "MOT": {"role": "Mother", "id": {}}}
    (root / "a.json").write_text(document(lines=[line("CHI", CONTENT, [{"type": "Mor", "data": {"items": MOR}}], ALIGN, bullet={"start_ms": 1500, "end_ms": 2500}), line("XXX", [word("hello")], terminator=None), line("MOT", [])]))
    (root / "b.json").write_text(document(pid="P1", lines=[line("CHI", [word("copy")])]))
    (root / "c.json").write_text(document(pid=None, people=adam, lines=[line("CHI", [word("Dog"), word("dog")]), line("CHI", [word("dog")])]))
    (root / "d.json").write_text(document(pid=None, people=two, lines=[line("CHI", [word("two")])]))
    (root / "e.json").write_text("{")
    docs = chat_json.read(spark, str(root)).withColumns({"collection_name": F.lit("Eng"), "corpus_name": F.lit("Brown")})
    corpora = spark.createDataFrame([("Eng", "Brown", "bank")], "collection_name string, corpus_name string, data_source string")
    return {k: v.cache() for k, v in build.release(docs, corpora).items()}


def test_release_transcripts(release):
    t = release["transcript"].orderBy("filename").collect()
    assert [r.filename.rsplit("/", 1)[1] for r in t] == ["a.json", "c.json", "d.json"]
    assert str(t[0].date) == "1962-10-08" and t[0].target_child_name == "Adam" and t[0].target_child_age == pytest.approx(825.8125) and t[2].target_child_id is None
    assert t[0].target_child_id == t[1].target_child_id


def test_release_participants(release):
    p = {(r.code, r.name, r.role): r for r in release["participant"].collect()}
    adam = p["CHI", "Adam", "Target_Child"]
    assert adam.min_age == pytest.approx(825.8125) and adam.max_age == pytest.approx(913.125) and adam.language == "eng spa"
    assert p["XXX", None, None].target_child_id == adam.id and adam.target_child_id == adam.id
    assert len([r for r in release["participant"].collect() if r.code == "MOT"]) == 1


def test_release_utterances(release):
    u = release["utterance"].orderBy("id").collect()
    assert u[0].gloss == "gonna I xxx it's home" and u[0].num_tokens == 5 and u[0].num_morphemes == 6 and (u[0].media_start, u[0].media_unit) == (1.5, "s")
    assert (u[1].type, u[1].speaker_role, u[2].num_tokens, u[2].num_morphemes) == ("missing CA terminator", None, 0, None)
    t = release["token"]
    assert t.count() == 10 and t.select("id").distinct().count() == 10 and t.where("corpus_name = 'Brown'").count() == 10
    m = release["token_morpheme"].orderBy("id").collect()
    assert [(x.type, x.lemma, x.features) for x in m] == [("stem", "go", '["PRESP"]'), ("stem", "to", "[]"), ("stem", "it", "[]"), ("clitic", "be", "[]"), ("stem", "home", "[]")]


def test_release_summaries(release):
    rows = {(r.transcript_id, r.speaker_role): r for r in release["transcript_by_speaker"].collect()}
    ids = [r.id for r in release["transcript"].orderBy("filename").collect()]
    assert (rows[ids[1], "Target_Child"].num_types, rows[ids[1], "Target_Child"].num_tokens, rows[ids[1], "Target_Child"].mlu_w) == (1, 3, 1.5)
    silent = rows[ids[1], "Mother"]
    assert (silent.num_utterances, silent.mlu_w, silent.num_tokens, silent.mtld) == (0, None, 0, None)
    assert {(r.gloss, r["count"]) for r in release["token_frequency"].where(f"transcript_id = {ids[1]}").collect()} == {("Dog", 1), ("dog", 2)}


def test_release_roundtrip(spark, release, tmp_path):
    from utterlake.api import Release

    for name, df in release.items():
        tables.write_table(df, f"file://{tmp_path}", "2026.1", name)
    tables.write_table(build.admin(spark, "2026.1", "2026-02-01"), f"file://{tmp_path}", "2026.1", "admin")
    tables.write_table(release["token"].limit(0), f"file://{tmp_path}", "empty", "token")
    r = Release(spark, f"file://{tmp_path}", "2026.1")
    assert r.tokens("d%").count() == 2 and r.tokens(role="Target_Child", age=(0, 28)).count() == 5
    assert r.sql("SELECT count(*) AS n FROM utterance WHERE speaker_code = :who", who="CHI").first().n == 4
    assert str(r.table("admin").first().date) == "2026-02-01"
    assert r.collections().first().name == "Eng" and r.speaker_statistics(role="Mother").count() == 2
    assert Release(spark, f"file://{tmp_path}", "empty").table("token").count() == 0
    counts = spark.createDataFrame([("token", 10), ("utterance", 5)], "name string, rows long")
    assert [x.ok for x in tables.reconcile_counts(counts, {"token": r.table("token"), "utterance": r.table("utterance")}).orderBy("name").collect()] == [True, False]


CHAT = "@Begin\n@PID:\t11312/a-1\n@Participants:\tCHI Adam Target_Child, MOT\n\tMother\n@ID:\teng|Brown|CHI|2;03.04|male|||Target_Child|||\n@Date:\t08-OCT-1962\n*CHI:\tI <want> [//] need um dog@f [= pet] .\n%mor:\tpro|I v|need n|dog .\n%act:\tx\n%act:\ty\n*MOT:\tdunno [: don't know] .\n%mor:\taux|do neg|not v|know .\n*MOT:\ta .\n%mor:\tdet|a n|b n|c .\n@End\n"


def test_chat_text(spark, tmp_path):
    (tmp_path / "a.cha").write_text(CHAT)
    u = chat_text.utterances(chat_text.read(spark, str(tmp_path))).orderBy("utt_number").collect()
    assert [r.speaker for r in u] == ["CHI", "MOT", "MOT"] and u[0].age == "2;03.04" and u[0].corpus == "Brown" and u[0].tiers["act"] == "y" and u[0].date == "08-OCT-1962"
    assert u[1].gloss == "don't know ."
    rows = chat_text.word_rows(chat_text.utterances(chat_text.read(spark, str(tmp_path))))
    got = [(r.utt_number, r.gloss, r.mor, r.at_tags) for r in rows.orderBy("utt_number", "word_order").collect()]
    assert (0, "dog", "n|dog", "f") in got and (0, "um", "EXC", "NA") not in got[:1] and all(g[0] != 2 for g in got)
    assert chat_text.pids(spark, str(tmp_path)).first().pid == "11312/a-1" and chat_text.child_names(spark, str(tmp_path)).first().name == "Adam"


def test_catalogues_and_logs(spark, tmp_path):
    (tmp_path / "r.tsv").write_text("bank\tcorpus_path\tn_cha\tvalid\tinvalid\nphon\tb\t3\t3\t0\nchildes\ta\t0\t0\t0\nchildes\tz\tNA\t1\t0\nchildes\tc\t2\t2\t0\n")
    assert [r.corpus_path for r in tables.catalogue(spark, str(tmp_path / "r.tsv")).collect()] == ["c", "b"]
    (tmp_path / "log").write_text("Saving to: ‘x/a.zip’\nSaving to: ‘x/index.html’\nother\n")
    assert [r.file for r in tables.saved_files(spark, str(tmp_path / "log")).collect()] == ["x/a.zip"]
    (tmp_path / "c" / "d").mkdir(parents=True)
    (tmp_path / "c" / "d" / "x.zip_placeholder").write_text("")
    assert tables.corpus_roots(spark, str(tmp_path / "c")).first().name == "d"
    (tmp_path / "1.csv").write_text("a,b\n1,NA\n")
    (tmp_path / "2.csv").write_text("a,b\n2,x\n")
    assert sorted((r.a, r.b, r.file[-5:]) for r in tables.tagged_csv(spark, f"{tmp_path}/[12].csv").collect()) == [(1, None, "1.csv"), (2, "x", "2.csv")]
    listing = spark.createDataFrame([("id", "bigint", 1), ("t", "longtext", 2)], "column_name string, data_type string, ordinal_position int")
    assert tables.export_schema(listing).simpleString() == "struct<id:bigint,t:string>"
    with pytest.raises(ValueError):
        tables.export_schema(spark.createDataFrame([("x", "geometry", 1)], "column_name string, data_type string, ordinal_position int"))
    done = []
    build_ = lambda n: lambda: done.append(n) or spark.range(n)
    base = f"file://{tmp_path}/shards"
    tables.build_once(spark, base, {"a": build_(2)})
    assert {(r.shard, r.rows) for r in tables.build_once(spark, base, {"a": build_(5), "b": build_(3)}).collect()} == {("a", 2), ("b", 3)} and done == [2, 3]


def test_external_parser(spark):
    files = spark.createDataFrame([("a", "x"), ("b", "y")], "path string, text string")
    assert [r.text for r in chat_json.run_parser(files, ["cat"]).collect()] == ["x", "y"]
    assert chat_json.run_parser(files, ["sh", "-c", "echo no >&2; exit 3"]).first().error == "no\n"


def test_retry_waits_longer_each_time(monkeypatch):
    waits, calls = [], []
    monkeypatch.setattr(tables.time, "sleep", waits.append)

    def call(fails, message="Deadlock found"):
        calls.append(1)
        if len(calls) <= fails:
            raise RuntimeError(message)
        return len(calls)

    assert tables.retry(lambda: call(3), wait=0.5) == 4 and waits == [0.5, 1.0, 1.5]
    calls.clear()
    with pytest.raises(RuntimeError, match="Deadlock"):
        tables.retry(lambda: call(9), attempts=2)
    calls.clear()
    with pytest.raises(RuntimeError, match="other"):
        tables.retry(lambda: call(1, "other"))
    assert len(calls) == 1


def test_export_resumes(spark, tmp_path):
    out = f"file://{tmp_path}/x"
    df = spark.range(3, 103).withColumn("v", F.col("id") * 2)
    assert tables.export_parts(df, out, rows=30, stop_after=2) == {"rows": 60, "parts": 2, "done": False}
    (tmp_path / "x" / "part-00002").mkdir()  # a part that was renamed just before its call died
    (tmp_path / "x" / "_new-part-00003").mkdir()
    assert tables.export_parts(df, out, rows=30) == {"rows": 100, "parts": 4, "done": True}
    assert tables.export_parts(df.limit(0), out) == {"rows": 100, "parts": 4, "done": True}  # done: nothing is read
    assert sorted(r.id for r in tables.exported(spark, out).collect()) == list(range(3, 103))
    assert not [p.name for p in (tmp_path / "x").iterdir() if p.name.startswith("_") and p.name != "_done.json"]
    files = tables.Files(spark, out)
    with files.lock(), pytest.raises(BlockingIOError):
        tables.export_parts(df, out)
    none = f"file://{tmp_path}/none"
    assert tables.export_parts(df.limit(0), none) == {"rows": 0, "parts": 1, "done": True}
    assert tables.exported(spark, none).columns == ["id", "v"] and tables.exported(spark, none).count() == 0


def test_natural_join_needs_a_common_column(spark):
    a = spark.createDataFrame([(1, 2, "x")], "k int, m int, a string")
    assert tables.natural_join(a, spark.createDataFrame([(2, 1, "y"), (2, 9, "z")], "m int, k int, b string")).collect() == [(1, 2, "x", "y")]
    with pytest.raises(ValueError):
        tables.natural_join(a, spark.createDataFrame([(1,)], "other int"))


def test_merged_trees(spark):
    rows = [("one", 1, "Dutch/A/x"), ("one", 1, "Eng/B/y"), ("two", 2, "Dutch/A/x"), ("two", 2, "Eng/B/z"), ("two", 2, "DutchAfrikaans/A/x")]
    got = sorted(map(tuple, tables.merge_trees(spark.createDataFrame(rows, "bank string, place int, path string")).collect()))
    assert got == [("DutchAfrikaans/A/x", "two", "DutchAfrikaans/A/x"), ("Eng/B/y", "one", "Eng/B/y"), ("Eng/B/z", "two", "Eng/B/z")]


def test_columns_completed_later(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "id int, v string")
    got = tables.update_columns(df, spark.createDataFrame([(1, None, 5), (7, "x", 6)], "id int, v string, n int"), ["id"])
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, None, 5), (2, "b", None), (None, "c", None)], key=str)


def test_database_roundtrip(spark):
    """Rows written to and read from a database over JDBC, by ranges of the key, overwritten and appended to."""
    url, driver = "jdbc:derby:memory:roundtrip;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    df = spark.range(1, 2501).withColumn("gloss", F.concat(F.lit("w"), F.col("id") % 7))
    tables.write_jdbc(df.limit(5), url, "token", "overwrite", driver)
    tables.write_jdbc(df, url, "token", "overwrite", driver)
    tables.write_jdbc(df.withColumn("id", F.col("id") + 2500), url, "token", "append", driver)
    back = tables.jdbc(spark, url, "token", lower=1, upper=5001, partitions=4, key='"id"', properties=driver)
    assert back.rdd.getNumPartitions() == 4 and back.count() == 5000
    assert [r.id for r in tables.page(back, "id", 4990, 3).collect()] == [4991, 4992, 4993]


def test_all_tables_of_a_database_dropped(spark, tmp_path):
    """Views and other databases stay."""
    for name in ("going", "staying"):
        spark.sql(f"CREATE DATABASE {name} LOCATION 'file://{tmp_path}/{name}'")
    for name in ("going.first", "going.second_one", "staying.first"):
        spark.range(3).write.saveAsTable(name)
    spark.range(1).createOrReplaceTempView("seen")
    try:
        assert sorted(tables.drop_all(spark, "going")) == ["first", "second_one"]
        assert all(t.isTemporary for t in spark.catalog.listTables("going")) and tables.drop_all(spark, "going") == []
        assert spark.table("staying.first").count() == 3 and spark.table("seen").count() == 1
    finally:
        for name in ("going", "staying"):
            spark.sql(f"DROP DATABASE {name} CASCADE")


def test_csv_is_one_file(spark, tmp_path):
    rows = spark.range(100).selectExpr("id", "concat('a,', id, '\"') AS text").repartition(5)
    for _ in range(2):  # the second replaces the first
        tables.write_csv(rows, f"{tmp_path}/out")
    assert len(list((tmp_path / "out").glob("*.csv"))) == 1
    back = spark.read.schema("id long, text string").option("header", True).option("escape", "\\").csv(f"{tmp_path}/out")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))


def test_files_are_replaced_in_one_step(spark, tmp_path):
    files = tables.Files(spark, f"file://{tmp_path}/a b")
    files.remove, removed = (lambda name="": removed.append(name)), []
    for text in ("one", "", "drei é"):
        files.write("x.json", text)
        assert files.read("x.json") == text and files.listed() == ["x.json"]
    assert removed == []  # there is no moment without the file
