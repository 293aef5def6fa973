"""All findings with their insights, labels and orders (sf0.001)."""

from conftest import SF_SMALL
from pyspark.sql import functions as F

from shopcast.functions.labels import ASSORTMENT, in_order, labelled
from shopcast.plans import questions as Q
from shopcast.plans.context import build_context
from shopcast.plans.findings import QUESTION_TEXT, run_all
from shopcast.sources.sinks import write_findings


def test_every_question_has_tables_and_an_insight(spark, tmp_path):
    found = run_all(build_context(spark, SF_SMALL))
    assert [f.key for f in found] == list(QUESTION_TEXT) and all(f.tables and len(f.insight) > 20 for f in found)
    tables = {k: t for f in found for k, t in f.tables.items()}
    assert set(tables) == set(Q.QUESTIONS)
    labels = [r.uplift_quartile for r in tables["q06_quartiles"].collect()]
    assert labels == [x for x in Q.QUARTILE_LABELS if x in labels]
    assert {r.AssortmentLabel for r in tables["q09_assortment"].collect()} <= set(ASSORTMENT.values())
    index = write_findings(spark, found, str(tmp_path / "f"))
    assert index.count() == 14 and spark.read.parquet(str(tmp_path / "f/q05/q05_promo")).count() == tables["q05_promo"].count()


def test_labels_and_orders(spark):
    df = spark.createDataFrame([("b", "late"), ("x", "early"), (None, "mid")], "code string, phase string")
    assert [r[0] for r in df.select(labelled(F.col("code"), ASSORTMENT)).collect()] == ["b (extra)", "x", None]
    assert [r.phase for r in in_order(df, "phase", ["early", "mid", "late"]).collect()] == ["early", "mid", "late"]


def test_stores_without_attributes_make_no_group(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "StoreType string, x int")
    assert Q.known(df, "StoreType").count() == 1
