"""Stored facts: written once for a state of the given tables, and read by what is built on them."""

import re
import shutil

import pytest

from __spark_entry__ import queries
from tollgauge.plans import marts
from tollgauge.plans.inputs import Tables

SF = "/root/testdata/sf0.001"


def scans(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return re.findall(r"Relation \[", plan)


def test_a_stored_table_is_built_once_per_state(spark, tmp_path):
    folder = str(tmp_path / "data")
    shutil.copytree(SF, folder)
    t, built = Tables(spark, folder), []

    def build():
        built.append(1)
        return t("nation").select("n_name", "n_regionkey")

    first = marts.stored(t, "nations", build)
    assert marts.stored(Tables(spark, folder), "nations", build).count() == first.count() == 25 and len(built) == 1
    by_region = marts.stored(t, "by_region", lambda: t("nation").selectExpr("n_name", "cast(n_regionkey as string) as r"), ("r",))
    again = marts.stored(t, "by_region", lambda: None, ("r",))
    assert by_region.schema["r"].dataType == again.schema["r"].dataType and again.count() == 25
    before = marts.fingerprint(t)
    t("region").limit(2).toPandas().to_parquet(f"{folder}/region.parquet")
    assert marts.fingerprint(t) != before
    marts.stored(t, "nations", build)
    assert len(built) == 2


@pytest.mark.parametrize(("name", "most"), [("verdict", 5), ("board_rank", 1), ("verify_receipts", 4), ("light_counts", 1),
                                           ("catalog", 5), ("search_box", 2)])
def test_queries_read_marts_instead_of_deriving_facts(spark, name, most):
    df = queries()[name](spark, SF)
    assert len(scans(df)) <= most, df._jdf.queryExecution().optimizedPlan().toString()[:3000]
