"""Numbers pinned for the sf0.01 fixture (values from the DuckDB oracle run), the
default periods, and the truth document round trip (A9 / A10)."""

import json
import tempfile

import pytest

from kpilens.plans.kpi import KPI
from kpilens.plans.report import read_truth_document, truth_document, write_truth_document

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def k(spark):
    return KPI(spark, SF)


def test_pinned_numbers_last_month(k):
    p = k.point("2001-07")
    assert p.revenue == pytest.approx(43630620.39, abs=0.005)
    assert p.net_revenue == pytest.approx(29248926.85, abs=0.005)
    assert p["orders"] == 204 and p["items"] == 821
    assert round(p.aov, 6) == 213875.590147
    assert round(p.margin, 6) == 0.982116
    assert round(p.mom, 6) == 0.174759


def test_default_period_and_previous_period(k):
    assert len(k.months()) == 79
    assert k.last_complete_months(1) == ["2001-07"]
    assert k.last_complete_months(3) == ["2001-05", "2001-06", "2001-07"]
    assert k.previous_period(["2001-05", "2001-06", "2001-07"]) == ["2001-02", "2001-03", "2001-04"]
    assert "2001-08" not in k.months()                    # today's month is never complete


def test_unusual_rule_and_window_baseline(k):
    assert round(k.zscore("2001-07"), 6) == 1.303458 and not k.is_unusual("2001-07")
    assert round(k.zscore("2001-07", before="2001-05"), 6) == 1.310409


def test_drivers_of_the_month_pair(k):
    d = k.find_drivers(["2001-06"], ["2001-07"]).orderBy("driver_rank").collect()
    assert len(d) == 12 and (d[0].dimension, d[0].segment) == ("acq_source", "AUTOMOBILE")


def test_unknown_month_fails_loudly(k):
    with pytest.raises(ValueError, match="not a complete month: 2001-08"):
        k.point("2001-08")


def test_truth_document_round_trip(spark):
    doc = truth_document(spark, SF)
    out = tempfile.mkdtemp(prefix="kpilens-truth-")
    write_truth_document(doc, out + "/doc")
    back = read_truth_document(spark, out + "/doc")
    t = json.loads(doc.collect()[0].truth_json)
    assert back.select("last_month.period").collect()[0][0] == "2001-07"
    assert t["known_wrong_answers"]["revenue_last_month_fanout"] == pytest.approx(210486770.38)
    assert t["last_month"]["headline"]["orders"] == 204


def test_frozen_truth_loses_no_field(spark):
    """Read back with the explicit schema, the document says what was written, field by field."""
    from pyspark.sql import functions as F

    from kpilens.plans.report import frozen_truth
    written = json.loads(truth_document(spark, SF).first().truth_json)
    back = frozen_truth(spark, SF)
    read = json.loads(back.select(F.to_json(F.struct(*back.columns))).first()[0])
    assert read == written
    assert frozen_truth(spark, SF).inputFiles() == back.inputFiles()          # computed once


def test_graders_read_the_frozen_truth(spark):
    """No grading query computes the truth anew: its plan scans the document and the answers only."""
    from kpilens.plans.registry import queries
    files = queries()["outcomes"](spark, SF).inputFiles()
    assert files and all("kpilens-truth-" in f or f.endswith("conversations.parquet") for f in files)
