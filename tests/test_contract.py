import os
import subprocess

import __spark_entry__ as contract
from conftest import ROOT, SMALL
from tidewell.plans import all_oracles, all_queries


def test_entry(spark):
    assert contract.entry(spark).columns == ["p_brand", "avg_price"]


def test_every_query_has_its_sql():
    assert set(all_queries()) == set(all_oracles())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_cheap_queries_run(spark):
    queries = contract.queries()
    for name in ("row_count", "nested_avg", "text_match_scan", "cdc_apply", "log_counts"):
        assert queries[name](spark, SMALL).count() > 0, name


def test_sources_avoid_what_does_not_scale():
    banned = ("localCheckpoint", "toPandas(", "crossJoin", ".collect()")
    for folder, _, files in os.walk(os.path.join(ROOT, "tidewell")):
        for name in files:
            if name.endswith(".py"):
                text = open(os.path.join(folder, name)).read()
                assert not [b for b in banned if b in text], name


def test_repository_holds_no_data():
    listed = subprocess.run(
        ["git", "-C", ROOT, "ls-files"], capture_output=True, text=True, check=False).stdout
    assert not [f for f in listed.splitlines() if f.endswith((".parquet", ".csv", ".zip"))]
