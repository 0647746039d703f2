"""Landed documents of study registries and literature services as flat tables.

A parser takes a DataFrame of landed documents and gives rows; ``PARSERS``
names them with the keys of their table and what happens on a conflict.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from evimap.functions import defaults as D
from evimap.functions import rules as R
from evimap.functions import text as T
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_DATE = "struct<date: string>"
_OUTCOMES = "array<struct<measure: string, timeFrame: string, description: string>>"
STUDY_SCHEMA = f"""
protocolSection struct<
  identificationModule: struct<nctId: string, briefTitle: string, officialTitle: string>,
  statusModule: struct<overallStatus: string, startDateStruct: {_DATE}, completionDateStruct: {_DATE}, lastUpdatePostDateStruct: {_DATE}, resultsFirstPostDateStruct: {_DATE}>,
  designModule: struct<studyType: string, phases: array<string>, phase: string,
    designInfo: struct<allocation: string, primaryPurpose: string, interventionModel: string, masking: string,
      maskingInfo: struct<masking: string, maskingDescription: string, maskingSubjects: array<string>>>,
    enrollmentInfo: struct<count: bigint, type: string>>,
  conditionsModule: struct<conditions: array<string>, keywords: array<string>>,
  armsInterventionsModule: struct<armGroups: array<struct<label: string, description: string, type: string, armGroupType: string, interventionNames: array<string>>>>,
  outcomesModule: struct<primaryOutcomes: {_OUTCOMES}, secondaryOutcomes: {_OUTCOMES}, otherOutcomes: {_OUTCOMES}>,
  contactsLocationsModule: struct<locations: array<struct<country: string>>>>,
hasResults boolean, query_name string
"""
ARTICLE_SCHEMA = """
MedlineCitation struct<PMID: string,
  Article: struct<ArticleTitle: string, Abstract: string,
    Journal: struct<Title: string, JournalIssue: struct<PubDate: struct<Year: string, Month: string, Day: string, MedlineDate: string>>>,
    DataBankList: struct<DataBank: array<struct<DataBankName: string, AccessionNumberList: struct<AccessionNumber: array<string>>>>>>,
  MeshHeadingList: struct<MeshHeading: array<struct<DescriptorName: struct<_VALUE: string, _UI: string, _MajorTopicYN: string>, QualifierName: array<struct<_VALUE: string, _UI: string, _MajorTopicYN: string>>>>>>,
PubmedData struct<ArticleIdList: struct<ArticleId: array<struct<_VALUE: string, _IdType: string>>>>
"""


def _list(c: Column) -> Column:
    return F.filter(F.transform(F.coalesce(c, F.array().cast("array<string>")), T.normal_space), lambda x: x != "")


def read_studies(spark: SparkSession, path: str) -> DataFrame:
    """Nested study documents, one JSON document a line."""
    return spark.read.schema(STUDY_SCHEMA).json(path)


def study_fields(docs: DataFrame) -> DataFrame:
    """One flat row for each study."""
    p, s = "protocolSection.", T.normal_space
    design = p + "designModule."
    phases = _list(F.col(design + "phases"))
    masking = F.coalesce(T.blank_to_null(F.col(design + "designInfo.maskingInfo.masking")), F.col(design + "designInfo.masking"))
    countries = F.array_sort(F.array_distinct(_list(F.transform(p + "contactsLocationsModule.locations", lambda x: x["country"]))))
    plain = {
        "nct_id": p + "identificationModule.nctId", "brief_title": p + "identificationModule.briefTitle", "official_title": p + "identificationModule.officialTitle",
        "overall_status": p + "statusModule.overallStatus", "study_type": design + "studyType", "allocation": design + "designInfo.allocation",
        "primary_purpose": design + "designInfo.primaryPurpose", "intervention_model": design + "designInfo.interventionModel",
        "masking_description": design + "designInfo.maskingInfo.maskingDescription", "start_date": p + "statusModule.startDateStruct.date",
        "completion_date": p + "statusModule.completionDateStruct.date", "last_update_posted": p + "statusModule.lastUpdatePostDateStruct.date",
        "results_first_posted": p + "statusModule.resultsFirstPostDateStruct.date", "enrollment_type": design + "enrollmentInfo.type",
    }
    return docs.select(
        *(s(F.col(c)).alias(n) for n, c in plain.items()), s(masking).alias("masking"), _list(F.col(design + "designInfo.maskingInfo.maskingSubjects")).alias("masking_subjects"),
        F.when(F.size(phases) > 0, F.array_join(phases, "; ")).otherwise(s(F.col(design + "phase"))).alias("phase"), F.coalesce("hasResults", F.lit(False)).alias("has_results"),
        F.col(design + "enrollmentInfo.count").cast("int").alias("enrollment_count"), _list(F.col(p + "conditionsModule.conditions")).alias("conditions"),
        _list(F.col(p + "conditionsModule.keywords")).alias("keywords"), countries.alias("countries"), F.col("query_name"),
    ).where(T.is_nct_id(F.col("nct_id")))


def arms(docs: DataFrame) -> DataFrame:
    """One row for each arm: type by declaration, else by words; every type but experimental is a control."""
    s = T.normal_space
    known = docs.withColumn("nct_id", s(F.col("protocolSection.identificationModule.nctId"))).where(T.is_nct_id(F.col("nct_id")))
    rows = known.select("nct_id", F.explode("protocolSection.armsInterventionsModule.armGroups").alias("a"), "query_name")
    # what is used more than once is a column of its own, so that it is made once an arm
    own = rows.select("nct_id", "query_name", s(F.col("a.label")).alias("arm_label"), s(F.col("a.description")).alias("arm_description"), _list(F.col("a.interventionNames")).alias("names"), F.upper(s(F.coalesce(T.blank_to_null(F.col("a.type")), F.col("a.armGroupType")))).alias("declared"))
    own = own.withColumn("text", F.concat_ws(" ", "arm_label", "arm_description", F.array_join("names", " ")))
    table = lambda i: F.create_map(*(F.lit(x) for k, v in D.DECLARED_ARMS.items() for x in (k, v[i])))[F.col("declared")]
    own = own.withColumn("comparator_type", F.coalesce(table(0), R.classify_arm(F.col("text"))))
    return own.select(
        "nct_id", "arm_label", "arm_description", F.array_join("names", "; ").alias("intervention_names"), F.coalesce(table(1), R.is_placebo(F.col("text"))).alias("is_placebo_arm"), "comparator_type",
        F.when(F.col("comparator_type") == "experimental", "experimental").otherwise("control").alias("arm_role"), "query_name",
    )


def outcomes(docs: DataFrame) -> DataFrame:
    """One row for each outcome in document order, tagged primary, secondary or other."""
    o, s = "protocolSection.outcomesModule.", T.normal_space
    none = F.array().cast("array<struct<kind: string, measure: string, timeFrame: string, description: string>>")
    tagged = lambda c, k: F.coalesce(F.transform(o + c, lambda x: F.struct(F.lit(k).alias("kind"), x["measure"].alias("measure"), x["timeFrame"].alias("timeFrame"), x["description"].alias("description"))), none)
    every = F.concat(tagged("primaryOutcomes", "primary"), tagged("secondaryOutcomes", "secondary"), tagged("otherOutcomes", "other"))
    rows = docs.select(s(F.col("protocolSection.identificationModule.nctId")).alias("nct_id"), F.posexplode(every).alias("place", "x"), "query_name")
    return rows.select("nct_id", "place", F.col("x.kind").alias("outcome_type"), s(F.col("x.measure")).alias("measure"), s(F.col("x.timeFrame")).alias("time_frame"), s(F.col("x.description")).alias("description"), "query_name").where(T.is_nct_id(F.col("nct_id")))


def outcome_mentions(found: DataFrame, keywords=D.KEYWORDS) -> DataFrame:
    """Keywords in measure and description of outcomes."""
    text = F.concat_ws(" ", "measure", "description")
    return found.withColumn("keyword", F.explode(R.matches(text, keywords))).withColumn("matched_text", F.substring(text, 1, 500)).drop("time_frame", "description", "place")


# References to the three signs that would pass for markup once the parser has decoded them.
_SIGNS = {"<": "&(?:lt|#0*60|#x0*3[cC]);", ">": "&(?:gt|#0*62|#x0*3[eE]);", "&": "&(?:amp|#0*38|#x0*26);"}
_END = "</PubmedArticle>"


def _decoded(c: Column) -> Column:
    for sign, pattern in _SIGNS.items():
        c = F.regexp_replace(c, pattern, sign)
    return c


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """Article records of XML files, which are split between records as lines are.

    The XML parser decodes references inside mixed content, where ``&lt;`` and a
    tag then look the same; so the three signs stay escaped here, in every
    field, and ``articles`` and ``article_mesh`` decode them after the tags are gone.
    """
    text = spark.read.option("lineSep", _END).text(path)
    record = F.regexp_substr("value", F.lit(r"(?s)<PubmedArticle(?=[\s>]).*"))
    kept = F.regexp_replace(F.concat(record, F.lit(_END)), f"&(?={'|'.join(x[1:] for x in _SIGNS.values())})", "&amp;")
    return text.select(F.from_xml(kept, ARTICLE_SCHEMA).alias("x")).where("x is not null").select("x.*")


def articles(docs: DataFrame) -> DataFrame:
    """pmid, title, abstract, journal, pub_date, doi, pmcid, nct_ids, mesh_terms; articles without a numeric id are dropped.

    Title and abstract are the text of their nodes in order: inline tags go, the
    text around and inside them stays, and so do the signs < > & of the text;
    labelled abstract parts read ``LABEL: text``.
    """
    c = F.col("MedlineCitation")
    a, date = c["Article"], c["Article"]["Journal"]["JournalIssue"]["PubDate"]
    plain = lambda x: T.normal_space(_decoded(F.regexp_replace(F.coalesce(x, F.lit("")), r"<[^>]*>", "")))
    labelled = F.regexp_replace(F.coalesce(a["Abstract"], F.lit("")), r'<AbstractText[^>]*Label="([^"]*)"[^>]*>', " $1: ")
    ids = F.coalesce(F.col("PubmedData.ArticleIdList.ArticleId"), F.array().cast("array<struct<_VALUE: string, _IdType: string>>"))
    of = lambda k: _decoded(F.coalesce(F.try_element_at(F.filter(ids, lambda x: x["_IdType"] == k), F.lit(1))["_VALUE"], F.lit("")))
    banks = F.coalesce(F.flatten(F.transform(a["DataBankList"]["DataBank"], lambda b: b["AccessionNumberList"]["AccessionNumber"])), F.array().cast("array<string>"))
    mesh = F.transform(c["MeshHeadingList"]["MeshHeading"], lambda m: _decoded(m["DescriptorName"]["_VALUE"]))
    out = docs.select(
        F.trim(c["PMID"]).alias("pmid"), plain(a["ArticleTitle"]).alias("title"), plain(F.regexp_replace(labelled, "</AbstractText>", " ")).alias("abstract"), plain(a["Journal"]["Title"]).alias("journal"),
        T.partial_date(date["Year"], date["Month"], date["Day"], date["MedlineDate"]).alias("pub_date"), of("doi").alias("doi"), of("pmc").alias("pmcid"),
        F.array_distinct(F.filter(banks, T.is_nct_id)).alias("nct_ids"), _list(mesh).alias("mesh_terms"),
    )
    return out.where(F.col("pmid").rlike("^[0-9]+$"))


def article_studies(rows: DataFrame, registry: str = "PubMed") -> DataFrame:
    """Articles as studies; the first linked trial id stands for the study."""
    first = F.try_element_at("nct_ids", F.lit(1))
    own = F.concat(F.lit("PMID:"), F.col("pmid"))
    return rows.select(
        F.coalesce(first, own).alias("nct_id"), own.alias("trial_id"), F.col("title").alias("brief_title"), F.lit("INTERVENTIONAL").alias("study_type"), F.lit("RANDOMIZED").alias("allocation"),
        F.col("pub_date").alias("start_date"), F.slice("mesh_terms", 1, 10).alias("conditions"), F.lit(registry).alias("source_registry"), F.lit(registry.lower()).alias("data_sources"),
    )


def article_mentions(rows: DataFrame, keywords=D.KEYWORDS) -> DataFrame:
    text = F.concat_ws(" ", "title", "abstract")
    study = F.coalesce(F.try_element_at("nct_ids", F.lit(1)), F.concat(F.lit("PMID:"), F.col("pmid")))
    return rows.select(study.alias("nct_id"), F.lit("inferred").alias("outcome_type"), F.substring("title", 1, 200).alias("measure"), F.explode(R.matches(text, keywords)).alias("keyword"), F.substring(text, 1, 500).alias("matched_text"))


def article_mesh(docs: DataFrame) -> DataFrame:
    """Heading by qualifier, or the heading alone."""
    rows = docs.select(F.trim("MedlineCitation.PMID").alias("pmid"), F.explode("MedlineCitation.MeshHeadingList.MeshHeading").alias("m"))
    rows = rows.select("pmid", F.col("m.DescriptorName").alias("d"), F.explode_outer("m.QualifierName").alias("q"))
    major = F.coalesce(F.col("q._MajorTopicYN"), F.col("d._MajorTopicYN")) == "Y"
    return rows.select("pmid", F.coalesce("d._UI", F.lit("")).alias("descriptor_ui"), _decoded(F.col("d._VALUE")).alias("descriptor_name"), F.coalesce("q._UI", F.lit("")).alias("qualifier_ui"), _decoded(F.coalesce("q._VALUE", F.lit(""))).alias("qualifier_name"), F.coalesce(major, F.lit(False)).cast("int").alias("is_major_topic"))


def europmc_publications(docs: DataFrame) -> DataFrame:
    """nct_id, resultList.result[] to publications."""
    r = docs.select("nct_id", F.explode("resultList.result").alias("r"))
    return r.select("nct_id", F.col("r.pmid").alias("pmid"), F.col("r.pmcid").alias("pmcid"), F.col("r.doi").alias("doi"), F.col("r.title").alias("title"), F.col("r.journalTitle").alias("journal"), F.col("r.firstPublicationDate").alias("pub_date"), F.col("r.pubType").alias("pub_type"), F.lit("europmc").alias("source"))


def europmc_annotations(docs: DataFrame) -> DataFrame:
    """One row for each tag of each annotation of articles with a PMC id; a blank name comes from its URI."""
    rows = docs.where(F.col("pmcid").rlike("^PMC")).select("pmid", "pmcid", F.explode("annotations").alias("a"))
    rows = rows.select("*", F.explode("a.tags").alias("t"))
    name = F.coalesce(T.blank_to_null(F.col("t.name")), F.element_at(F.split(F.rtrim("t.uri", F.lit("/")), "/"), -1))
    return rows.select("pmid", "pmcid", F.col("a.type").alias("ann_type"), name.alias("ann_name"), F.col("t.uri").alias("ann_uri"), F.col("a.prefix").alias("prefix"), F.col("a.exact").alias("exact"), F.col("a.postfix").alias("suffix"), F.lit("europmc").alias("source"))


def openalex_citations(docs: DataFrame) -> DataFrame:
    r = docs.select(F.explode("results").alias("r"))
    return r.select(F.regexp_replace("r.doi", "^https://doi.org/", "").alias("doi"), F.col("r.cited_by_count").cast("long").alias("cited_by_count"), F.col("r.referenced_works_count").cast("long").alias("references_count"), F.lit("openalex").alias("source")).where(T.blank_to_null(F.col("doi")).isNotNull())


def crossref_citations(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("message.DOI").alias("doi"), F.col("message.is-referenced-by-count").cast("long").alias("cited_by_count"), F.col("message.references-count").cast("long").alias("references_count"), F.lit("crossref").alias("source")).where(T.blank_to_null(F.col("doi")).isNotNull())


def citation_edges(incoming: DataFrame, outgoing: DataFrame) -> DataFrame:
    """Edges of both directions; those with a blank end are dropped."""
    side = lambda df, d: df.select(F.regexp_replace("citing", "^coci => ", "").alias("citing_doi"), F.regexp_replace("cited", "^coci => ", "").alias("cited_doi"), F.lit(d).alias("direction"), F.lit("opencitations").alias("source"))
    both = side(incoming, "incoming").unionByName(side(outgoing, "outgoing"))
    return both.where(T.blank_to_null(F.col("citing_doi")).isNotNull() & T.blank_to_null(F.col("cited_doi")).isNotNull())


def unpaywall_access(docs: DataFrame) -> DataFrame:
    best = F.coalesce(T.blank_to_null(F.col("best_oa_location.url_for_pdf")), F.col("best_oa_location.url"), F.lit(""))
    return docs.select("doi", F.coalesce("is_oa", F.lit(False)).cast("int").alias("is_oa"), F.coalesce("oa_status", F.lit("")).alias("oa_status"), best.alias("best_oa_url"), F.coalesce("best_oa_location.license", F.lit("")).alias("license"), F.lit("unpaywall").alias("source"))


def openfda_signals(docs: DataFrame) -> DataFrame:
    r = docs.select("nct_id", "drug_name", F.explode("results").alias("r"))
    return r.select("nct_id", "drug_name", F.col("r.term").alias("reaction"), F.lit(None).cast("long").alias("serious_count"), F.col("r.count").cast("long").alias("total_count"), F.lit("openfda").alias("source"))


@dataclass(frozen=True)
class Parser:
    phase: int
    parse: Callable[[DataFrame], DataFrame]
    unique: tuple[tuple[str, ...], ...]
    on_conflict: str  # ignore: the first wins; replace: the last wins


PARSERS: dict[str, Parser] = {
    "europmc": Parser(1, europmc_publications, (("nct_id", "pmid"), ("nct_id", "doi")), "ignore"),
    "europmc_annotations": Parser(1, europmc_annotations, (("pmid", "pmcid", "ann_type", "ann_name", "exact"),), "ignore"),
    "pubmed_mesh": Parser(1, article_mesh, (("pmid", "descriptor_ui", "qualifier_ui"),), "ignore"),
    "openfda": Parser(1, openfda_signals, (("nct_id", "drug_name", "reaction"),), "replace"),
    "openalex": Parser(2, openalex_citations, (("doi", "source"),), "replace"),
    "crossref": Parser(2, crossref_citations, (("doi", "source"),), "replace"),
    "unpaywall": Parser(2, unpaywall_access, (("doi",),), "replace"),
}


def register(name: str, parser: Parser) -> None:
    PARSERS[name] = parser


def phases() -> list[list[str]]:
    """Parser names in the order in which their tables are to be written."""
    return [sorted(n for n, p in PARSERS.items() if p.phase == k) for k in sorted({p.phase for p in PARSERS.values()})]
