"""What the plans must and must not contain."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

from loglathe import fixtures
from loglathe.operators import enrich
from loglathe.operators.normalize import outcomes, parse_known
from loglathe.plans import queries
from loglathe.plans.batch import EventStore, ingest_lines
from loglathe.sources import dimensions, files

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


def plan_of(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def nodes(plan, name):
    return re.findall(rf"^\(\d+\) {name}", plan, re.M)


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    import tempfile
    built = EventStore(spark, tempfile.mkdtemp(prefix="loglathe-test-", dir="/tmp"))
    lines = files.clean_lines(fixtures.log_lines(spark, SF_DIR))
    ingest_lines(built, lines, ingested_at=fixtures.CLOCK)
    return built


def test_parsing_neither_shuffles_nor_leaves_the_jvm(store):
    from loglathe.operators.normalize import NormalizeOptions
    plan = plan_of(parse_known(store.raw(), NormalizeOptions()))
    assert not nodes(plan, "Exchange") and "Python" not in plan
    # One scan of the raw table, without the columns that parsing does not need.
    assert len(nodes(plan, "Scan parquet")) == 1


def test_normalisation_is_one_scan_and_no_shuffle(store):
    plan = plan_of(outcomes(store.raw()))
    assert len(nodes(plan, "Scan parquet")) == 1
    assert not nodes(plan, "Exchange") and "Python" not in plan
    assert len(nodes(plan, "BroadcastHashJoin")) == 1


def test_a_filter_does_not_repeat_the_parsing(store):
    plan = plan_of(outcomes(store.raw()).filter(F.col("action") == "deny"))
    filters = [part for part in plan.split("\n\n") if re.match(r"\(\d+\) Filter", part)]
    assert filters and all("parseJson" not in part for part in filters)
    by_source = plan_of(outcomes(store.raw()).filter(F.col("source_name") == "json.log"))
    assert "EqualTo(source_name,json.log)" in by_source


def test_filters_reach_the_stored_table(store):
    plan = plan_of(queries.filter_events(store.events(), "json", "deny", ordered=False))
    partition_filters = re.search(r"PartitionFilters: (.*)", plan).group(1)
    assert "status" in partition_filters and "source_format" in partition_filters
    assert "EqualTo(action,deny)" in plan
    head = plan_of(queries.headline(queries.filter_events(
        store.events(), action="deny", ordered=False)))
    assert re.search(r"ReadSchema: struct<action:string>", head)


def test_country_lookup_shuffles_no_events(spark, store):
    plan = plan_of(enrich.enriched_events(
        store.events(), dimensions.geo_ranges(spark), dimensions.known_bad_ips(spark)))
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "SortMergeJoin" not in plan
    # One join per prefix length of the bundled table, and one for the known-bad list.
    assert len(nodes(plan, "BroadcastHashJoin")) == 7


def test_text_lines_are_tokenised_once(spark, monkeypatch):
    from loglathe.operators import templates
    from loglathe.plans.registry import QUERIES

    mined, mine = [], templates.mine_leaves
    monkeypatch.setattr(templates, "mine_leaves", lambda lines, *rest: mined.append(lines) or mine(lines, *rest))
    rows = QUERIES["template_table_text"](spark, SF_DIR).agg(F.sum("n_lines")).first()[0]
    plan = plan_of(mined[0])
    # Mining reads its lines several times, so they come from a stored table.
    assert "split(" not in plan and not nodes(plan, "Generate") and len(nodes(plan, "Scan parquet")) == 1
    assert rows == fixtures.document_lines(spark, SF_DIR).count()
