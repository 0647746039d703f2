import pytest

from evimap.functions import defaults as D
from evimap.functions import rules as R
from evimap.functions import text as T
from pyspark.sql import functions as F


def one(spark, text, expr):
    return spark.createDataFrame([(text,)], "t string").select(expr(F.col("t")).alias("x")).first().x


def each(spark, texts, expr):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", expr(F.col("t")).alias("x"))
    return [r.x for r in rows.orderBy("i").collect()]


def test_imaging_vetoes_perfusion(spark):
    vetoed = ["cerebral perfusion monitoring", "myocardial perfusion scan", "myocardial perfusion imaging", "myocardial perfusion study", "myocardial perfusion scintigraphy", "myocardial perfusion SPECT", "myocardial perfusion pet", "perfusion scan results", "PERFUSION IMAGING technique"]
    kept = ["cerebral perfusion pressure", "myocardial perfusion", "perfusion deficit", "perfusion injury", "perfusion reserve"]
    assert each(spark, vetoed + kept, lambda c: R.token_in("perfusion", R.ready(c))) == [False] * 9 + [True] * 5


def test_ratio_vetoes_hr(spark):
    vetoed = ["HR=0.85", "HR 0.72", "HR (95% CI 0.5)", "HR=1.5 (95%", "HR 1.23", "hazard ratio HR", "adjusted HR", "HR; 95% CI", "HR=1.23"]
    assert each(spark, [*vetoed, "heart rate HR 80 bpm", None], lambda c: R.token_in("HR", R.ready(c))) == [False] * 9 + [True, False]


@pytest.mark.parametrize(("token", "text", "found"), [("map", "pressure (MAP)", True), ("ef", "EF-value", True), ("cvp", "MAP,CVP", True), ("hr", "[HR]", True), ("ef", "LVEF", False), ("do2", "DO2I", False), ("hr", "HR: high", False), ("perfusion", "hypoperfusion", False), ("perfusion", "Perfusion.", True), ("e/e' ratio", "the E/e’ ratio fell", True), ("naïve", "naïve α-test", True)])
def test_tokens(spark, token, text, found):
    assert one(spark, text, lambda c: R.token_in(token, R.ready(c))) is found


def test_categories_in_order(spark):
    texts = ["vasopressor-free days", "stroke volume variation", "zzz", "", "Heart rate"]
    assert each(spark, texts, lambda c: R.category(c, F.lit(""))) == ["Vasopressor-free days", "Stroke Volume", "Unmapped", "Unmapped", "Heart Rate"]
    assert one(spark, "zzz", lambda c: R.category(c, F.lit("change in lactate"))) == "Lactate"
    assert one(spark, "heart rate", lambda c: R.category(c, F.lit("and MAP"))) == "Heart Rate"


def test_every_default_keyword_has_a_category(spark):
    names = each(spark, D.KEYWORDS, lambda c: R.category(c, F.lit("")))
    assert "Unmapped" not in names and len(D.KEYWORDS) == 105 and len(D.CATEGORIES) == 35 and len(D.UNITS) == 23 and len(D.CATEGORY_UNITS) == 22


def test_units(spark):
    got = each(spark, ["30 seconds", "5sec", "5.5 seconds", "0.5sec", "seconds", "sec", "dP/dt in mmHg/s", "MAP (mm Hg)", "ml/min/m2", "mL/min", "50% reduction in SOFA", "Percent change in CO", "50% of patients", "ejection fraction %", "EF 50%", None], lambda c: R.unit(c)["normal"])
    assert got == ["s", "s", "s", "s", "", "", "mmHg/s", "mmHg", "mL/min/m2", "mL/min", "", "", "", "%", "%", ""]
    assert one(spark, "x", lambda c: R.fallback_unit(F.lit(""), F.lit("MAP"))) == "mmHg" and one(spark, "x", lambda c: R.fallback_unit(F.lit("s"), F.lit("MAP"))) == "s"


def test_formula_guard(spark):
    assert each(spark, ["=CMD()", "+1+1", "@SUM(A1)", "line1\n=CMD()", "normal text", "", None, "-0.5 mmHg"], T.formula_safe) == ["'=CMD()", "'+1+1", "'@SUM(A1)", "'line1\n=CMD()", "normal text", "", None, "-0.5 mmHg"]


def test_small_text_functions(spark):
    assert each(spark, [" a   b\t\nc ", None], T.normal_space) == ["a b c", ""]
    assert each(spark, ["a; b ;; c", "", None], T.split_list) == [["a", "b", "c"], [], []]
    assert each(spark, ["12", " 7 ", "x", "", None, "1.5"], T.lenient_int) == [12, 7, 0, 0, 0, 0]
    assert one(spark, 'Dopamine 5 mg (IV) Injection', T.drug_name) == "dopamine"
    assert each(spark, ["2020-01", "20x0", None], T.partial_year) == [2020, None, None]
    date = lambda *p: spark.range(1).select(T.partial_date(*(F.lit(x).cast("string") for x in p)).alias("x")).first().x
    assert [date("2020", "Mar", "5", ""), date("2020", "3", None, ""), date("2020", None, None, ""), date(None, None, None, "2019 Spring")] == ["2020-03-05", "2020-03", "2020", "2019 Spring"]
    assert each(spark, ["PHASE2", "NA", None, "PHASE1; PHASE2"], T.clean_phase) == ["Phase2", "Not Stated", "Not Stated", "Phase1; Phase2"]
    ids = ["NCT01234567", "PMID:5", "ISRCTN1", "LBCTR-a-1", "NCT1", "x", None]
    assert each(spark, ids, T.is_trial_id) == [True, True, True, True, False, False, False]
    pct = spark.createDataFrame([(None, 1.0), (0.0, 0.0), (0.0, 2.0), (10.0, 12.0)], "a double, b double").select(T.pct_change(F.col("a"), F.col("b")).alias("p"), T.drift_severity(T.pct_change(F.col("a"), F.col("b"))).alias("s"))
    assert [tuple(r) for r in pct.collect()] == [(None, "none"), (0.0, "none"), (100.0, "major"), (20.0, "major")]


def test_matches_and_phrases(spark):
    found = each(spark, ["Mean arterial pressure (MAP) and lactate clearance", "MAP kinase", "nothing", None], lambda c: R.matches(c))
    assert found == [["mean arterial pressure", "MAP", "lactate", "lactate clearance"], [], [], []]
    groups = [["septic shock", "ARDS"], ["placebo"]]
    assert each(spark, ["Septic shock vs placebo", "ards", "hards placebo", None], lambda c: R.phrase_query(c, groups)) == [True, False, False, False]
