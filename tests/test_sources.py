import json

from evimap.operators import explore
from evimap.sources import files, landing
from pyspark.sql import functions as F

STUDY = {"protocolSection": {
    "identificationModule": {"nctId": "NCT00000001", "briefTitle": " A  trial "}, "statusModule": {"overallStatus": "COMPLETED", "startDateStruct": {"date": "2020-01"}},
    "designModule": {"studyType": "INTERVENTIONAL", "phases": ["PHASE2", "PHASE3"], "designInfo": {"masking": "DOUBLE", "maskingInfo": {"maskingSubjects": ["A", "B"]}}, "enrollmentInfo": {"count": 20, "type": "ACTUAL"}},
    "conditionsModule": {"conditions": ["Shock"], "keywords": None}, "contactsLocationsModule": {"locations": [{"country": "Spain"}, {"country": "France"}, {"country": "Spain"}, {"country": None}]},
    "armsInterventionsModule": {"armGroups": [{"label": "P", "type": "PLACEBO_COMPARATOR"}, {"label": "Usual care", "type": "OTHER"}, {"label": "Drug", "interventionNames": ["Drug: X"]}]},
    "outcomesModule": {"primaryOutcomes": [{"measure": "MAP at 6 h (mmHg)"}], "secondaryOutcomes": [{"measure": "Death"}], "otherOutcomes": [{"measure": "lactate", "description": "MAP kinase"}]},
}, "hasResults": True}
ARTICLES = """<PubmedArticleSet>
<PubmedArticle><MedlineCitation><PMID Version="1">11</PMID><Article><Journal><JournalIssue><PubDate><Year>2020</Year><Month>Mar</Month></PubDate></JournalIssue><Title>J</Title></Journal>
<ArticleTitle>Effect of <i>early</i> lactate care</ArticleTitle><Abstract><AbstractText Label="AIM">To <b>see</b>.</AbstractText><AbstractText Label="RESULTS">MAP rose.</AbstractText></Abstract>
<DataBankList><DataBank><DataBankName>ClinicalTrials.gov</DataBankName><AccessionNumberList><AccessionNumber>NCT00000001</AccessionNumber><AccessionNumber>bad</AccessionNumber><AccessionNumber>NCT00000002</AccessionNumber></AccessionNumberList></DataBank></DataBankList></Article>
<MeshHeadingList>MESH</MeshHeadingList></MedlineCitation><PubmedData><ArticleIdList><ArticleId IdType="pubmed">11</ArticleId><ArticleId IdType="doi">10.1/x</ArticleId></ArticleIdList></PubmedData></PubmedArticle>
<PubmedArticle><MedlineCitation><PMID></PMID><Article><ArticleTitle>none</ArticleTitle></Article></MedlineCitation></PubmedArticle>
</PubmedArticleSet>""".replace("MESH", "".join(f'<MeshHeading><DescriptorName UI="D{i}" MajorTopicYN="N">Term {i}</DescriptorName></MeshHeading>' for i in range(12)) + '<MeshHeading><DescriptorName UI="D99" MajorTopicYN="N">Shock</DescriptorName><QualifierName UI="Q1" MajorTopicYN="Y">therapy</QualifierName><QualifierName UI="Q2" MajorTopicYN="N">blood</QualifierName></MeshHeading>')


def test_studies(spark, tmp_path):
    (tmp_path / "s.json").write_text("\n".join([json.dumps(STUDY), json.dumps({"protocolSection": {"identificationModule": {"nctId": "bad"}}})]))
    docs = landing.read_studies(spark, str(tmp_path))
    s = landing.study_fields(docs).collect()
    assert len(s) == 1 and (s[0].brief_title, s[0].phase, s[0].masking, s[0].countries, s[0].enrollment_count, s[0].has_results, s[0].keywords) == ("A trial", "PHASE2; PHASE3", "DOUBLE", ["France", "Spain"], 20, True, [])
    assert [(r.arm_label, r.comparator_type, r.arm_role, r.is_placebo_arm) for r in landing.arms(docs).collect()] == [("P", "placebo", "control", True), ("Usual care", "usual_care", "control", False), ("Drug", "experimental", "experimental", False)]
    found = landing.outcomes(docs)
    assert [(r.place, r.outcome_type, r.measure) for r in found.orderBy("place").collect()] == [(0, "primary", "MAP at 6 h (mmHg)"), (1, "secondary", "Death"), (2, "other", "lactate")]
    assert sorted((r.outcome_type, r.keyword) for r in landing.outcome_mentions(found).collect()) == [("other", "lactate"), ("primary", "MAP")]


def test_articles(spark, tmp_path):
    (tmp_path / "a.xml").write_text(ARTICLES)
    docs = landing.read_articles(spark, str(tmp_path))
    rows = landing.articles(docs)
    a = rows.collect()
    assert len(a) == 1 and a[0].title == "Effect of early lactate care" and a[0].abstract == "AIM: To see. RESULTS: MAP rose."
    assert (a[0].pub_date, a[0].doi, a[0].nct_ids, len(a[0].mesh_terms)) == ("2020-03", "10.1/x", ["NCT00000001", "NCT00000002"], 13)
    study = landing.article_studies(rows).first()
    assert (study.nct_id, study.trial_id, len(study.conditions)) == ("NCT00000001", "PMID:11", 10)
    assert sorted(r.keyword for r in landing.article_mentions(rows).collect()) == ["MAP", "lactate"]
    mesh = landing.article_mesh(docs).where("descriptor_ui = 'D99'").orderBy("qualifier_ui").collect()
    assert [(r.qualifier_ui, r.is_major_topic) for r in mesh] == [("Q1", 1), ("Q2", 0)] and landing.article_mesh(docs).count() == 14


def test_signs_in_article_text(spark, tmp_path):
    text = "<i>MAP</i> &lt; 65 mmHg and <sup>1</sup>HR &gt; 100 &amp; lactate &#60;b&#x3E; &amp;lt; &#946; a&lt;b&gt;c"
    want = "MAP < 65 mmHg and 1HR > 100 & lactate <b> &lt; β a<b>c"
    one = f"<PubmedArticle Status='x'>\n<MedlineCitation><PMID Version='1'>%s</PMID><Article><Journal><Title>A &amp; B</Title></Journal><ArticleTitle>{text}</ArticleTitle><Abstract><AbstractText Label='X &lt; Y'>{text}</AbstractText><AbstractText>{text}\n</AbstractText></Abstract></Article><MeshHeadingList><MeshHeading><DescriptorName UI='D1' MajorTopicYN='Y'>p &lt; q</DescriptorName></MeshHeading></MeshHeadingList></MedlineCitation><PubmedData><ArticleIdList><ArticleId IdType='doi'>10.1/a&lt;1::b&gt;3</ArticleId></ArticleIdList></PubmedData></PubmedArticle>\n"
    (tmp_path / "a.xml").write_text(f"<?xml version='1.0'?>\n<PubmedArticleSet>\n{one % 1}{one % 2}</PubmedArticleSet>\n", encoding="utf-8")
    (tmp_path / "b.xml").write_text(f"<PubmedArticleSet>{one % 3}</PubmedArticleSet>", encoding="utf-8")
    docs = landing.read_articles(spark, str(tmp_path))
    rows = landing.articles(docs)
    got = rows.orderBy("pmid").collect()
    assert [r.pmid for r in got] == ["1", "2", "3"]
    assert all((r.title, r.abstract, r.journal, r.doi, r.mesh_terms) == (want, f"X < Y: {want} {want}", "A & B", "10.1/a<1::b>3", ["p < q"]) for r in got)
    assert {r.keyword for r in landing.article_mentions(rows).collect()} == {"MAP", "HR", "lactate"} - ({"HR"} if "1HR" in want else set())
    assert landing.article_mesh(docs).first().descriptor_name == "p < q"


def test_secondary_landings(spark):
    read = lambda doc, schema: spark.createDataFrame([(json.dumps(doc),)], "j string").select(F.from_json("j", schema).alias("x")).select("x.*")
    alex = read({"results": [{"doi": "https://doi.org/10.1/a", "cited_by_count": 3, "referenced_works_count": 2}, {"doi": None}]}, "results array<struct<doi: string, cited_by_count: int, referenced_works_count: int>>")
    assert [tuple(r) for r in landing.openalex_citations(alex).collect()] == [("10.1/a", 3, 2, "openalex")]
    ref = read({"message": {"DOI": "10.1/b", "is-referenced-by-count": 5, "references-count": 1}}, "message struct<DOI: string, `is-referenced-by-count`: int, `references-count`: int>")
    assert landing.crossref_citations(ref).first().cited_by_count == 5
    edges = lambda x: spark.createDataFrame(x, "citing string, cited string")
    assert landing.citation_edges(edges([("a", "b"), ("", "b")]), edges([("b", "c")])).count() == 2
    pay = read({"doi": "d", "is_oa": True, "oa_status": "gold", "best_oa_location": {"url_for_pdf": "", "url": "u"}}, "doi string, is_oa boolean, oa_status string, best_oa_location struct<url_for_pdf: string, url: string, license: string>")
    assert tuple(landing.unpaywall_access(pay).first()) == ("d", 1, "gold", "u", "", "unpaywall")
    notes = read({"pmid": "1", "pmcid": "PMC1", "annotations": [{"type": "Gene", "exact": "x", "tags": [{"name": "", "uri": "http://x/y/Z9/"}, {"name": "n", "uri": "u"}]}]}, "pmid string, pmcid string, annotations array<struct<type: string, prefix: string, exact: string, postfix: string, tags: array<struct<name: string, uri: string>>>>")
    assert [r.ann_name for r in landing.europmc_annotations(notes).collect()] == ["Z9", "n"]
    assert landing.phases()[0] == ["europmc", "europmc_annotations", "openfda", "pubmed_mesh"]


def test_files(spark, tmp_path):
    (tmp_path / "in.csv").write_text('﻿id,text\n1,"a ""q"", b\nc"\n2,\n', encoding="utf-8")
    df = files.read_csv(spark, str(tmp_path / "in.csv"), ["id", "text"])
    assert [tuple(r) for r in df.collect()] == [("1", 'a "q", b\nc'), ("2", None)]
    files.write_csv(spark.createDataFrame([("=1", None, "x")], "a string, b string, c string"), str(tmp_path / "out"), ["a", "b"])
    assert [tuple(r) for r in files.read_csv(spark, str(tmp_path / "out"), ["a", "b"]).collect()] == [("'=1", None)]
    for label, n in (("broad", 3), ("placebo", 1), ("broad", 2)):
        files.write_map(spark.range(n), str(tmp_path / "map"), label)
    assert [files.read_map(spark, str(tmp_path / "map"), x).count() for x in ("broad", "placebo")] == [2, 1]
    explore.export(spark.createDataFrame([("=x", 1)], "a string, n int"), ["a", "n"], str(tmp_path / "t"), "tsv")
    assert spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "t")).first().a == "'=x"
    trials = spark.createDataFrame([(" nct00000001", "", "d"), ("x", "a", "b")], "nct_id string, a string, b string")
    assert [tuple(r) for r in files.load_trials(trials, "nct_id", ["a", "b"]).collect()] == [("NCT00000001", "d")]
