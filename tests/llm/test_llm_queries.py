import os

import pytest

DATA = os.environ.get("CHRONOFOLD_TESTDATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")

from chronofold.llm import queries as Q  # noqa: E402


@pytest.mark.parametrize("name", sorted(Q.llm_queries()))
def test_runs_over_the_tables(spark, name):
    assert Q.llm_queries()[name](spark, DATA).count() > 0


def test_nothing_else_imports_the_subpackage():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for folder, _, files in os.walk(os.path.join(root, "chronofold")):
        if os.sep + "llm" in folder:
            continue
        for f in files:
            if f.endswith(".py"):
                text = open(os.path.join(folder, f), encoding="utf-8").read()
                assert "chronofold.llm" not in text and "from .llm" not in text and "from ..llm" not in text, f


def test_spellings_of_one_notice_are_mostly_linked(spark):
    from pyspark.sql import functions as F

    from chronofold.runtime import table

    n = table(spark, DATA, "notice").select("notice_key", F.col("declarant_name_raw").alias("a"))
    e = table(spark, DATA, "notice_event").select("notice_key", F.col("declarant_name_raw").alias("b"))
    both = n.join(e, "notice_key").where("a is not null and b is not null and a <> b").select(F.least("a", "b").alias("name_a"), F.greatest("a", "b").alias("name_b")).distinct()
    found = both.join(Q.p1_found(spark, DATA), ["name_a", "name_b"], "left_semi").count()
    assert found >= 0.9 * both.count()
