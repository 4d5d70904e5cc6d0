"""The candidate chain beside its queries: reviews, report projections, and what moves."""

from pyspark.sql import functions as F

from leksika.operators import candidates as K
from leksika.plans import candidates as plans

REVIEW = "run_id string, stable_key string, review_id string, type string, review_status string, selected_authority string, release_blocking boolean, official string"


def test_reviews_settle_or_block(spark):
    rows = [
        ("r", "settled", "1", "lexical_conflict", "approved", "official", False, "x"),
        ("r", "settled by a blocking one", "1", "lexical_conflict", "approved", "official", True, "x"),
        ("r", "another blocks", "1", "lexical_conflict", "approved", "official", False, "x"), ("r", "another blocks", "2", "other", "pending", None, False, None),
        ("r", "evidence wins", "1", "lexical_conflict", "approved", "evidence", False, "x"), ("r", "rejected", "1", "lexical_conflict", "rejected", "official", None, "x"),
        ("r", "first of two", "2", "lexical_conflict", "approved", "official", False, "late"), ("r", "first of two", "1", "lexical_conflict", "approved", "official", False, "early"),
        ("r", "second of two blocks", "2", "lexical_conflict", "approved", "official", True, "late"), ("r", "second of two blocks", "1", "lexical_conflict", "approved", "official", False, "early"),
    ]
    found = {r.stable_key: (r.settled.official if r.settled else None, r.blocked) for r in K.judged_reviews(spark.createDataFrame(rows, REVIEW)).collect()}
    assert found == {
        "settled": ("x", False), "settled by a blocking one": ("x", False), "another blocks": ("x", True), "evidence wins": (None, False), "rejected": (None, True),
        "first of two": ("early", False), "second of two blocks": ("early", True),
    }


def test_report_projections_part_the_outcomes(spark, sf):
    rows = plans.altered(plans.outcomes_of(spark, sf), "outcome")
    joins, out = K.accepted_joins(rows), K.exclusions(rows)
    assert joins.columns == list(K.ACCEPTED) and joins.count() + out.count() == rows.count()
    assert {r.reason for r in out.select("reason").distinct().collect()} == {"conflict", "quarantined"}


def test_each_side_moves_once(spark, sf):
    """All links are resolved by one join: beside the outcomes' own, an exchange for the sides, what is asked of them, what is found, reviews and runs."""
    plan = plans.chain(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert 1 <= plan.count("Exchange hashpartitioning(kind") <= 2  # a small side of asks is broadcast
    assert "CartesianProduct" not in plan and "BatchEvalPython" not in plan


def test_run_without_documents_and_empty_tables(spark):
    says = "run_id string, document string, says map<string,string>"
    assert [tuple(r)[-1] for r in K.run_lineage(spark.createDataFrame([("r", "status", {"run_id": "r"})], says)).collect()] == ["run_fingerprint_missing"]
    assert K.run_lineage(spark.createDataFrame([], says)).count() == 0


def test_payload_has_members_only(spark, sf):
    rows = plans.chain(spark, sf)
    members = rows.where("member")
    assert K.payload(rows).count() == members.count() > 0
    assert members.where(F.col("reason").isNotNull()).count() == 0 and rows.where("not member and reason is null").count() == 0
