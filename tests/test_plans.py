"""Plan properties the scale design relies on, checked on the physical plans."""

import contextlib
import io

import pytest

from flowdex.plans import catalog
from tests.conftest import SF_SMALL

STREAMS = {"feed_to_index", "feed_to_index_plain", "histogram_stream", "log_report_stream", "mail_accepted", "mail_polls", "mail_rejects",
           "mail_stream", "report_to_index"}
BATCH = sorted(set(catalog.QUERIES) - STREAMS)


def plan(spark, name):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        catalog.QUERIES[name](spark, SF_SMALL).explain()
    return buf.getvalue()


def test_column_filter_reaches_the_reader(spark):
    assert "PushedFilters: [In(source" in plan(spark, "topic_list")


def test_per_batch_top_k_limits_before_the_shuffle(spark):
    text = plan(spark, "log_report_by_batch")
    assert "WindowGroupLimit" in text and "Partial" in text


def test_json_parsed_once_in_the_report(spark):
    assert plan(spark, "log_filter").count("from_json(") == 1


def test_histogram_scan_has_no_inferred_parse_filter(spark):
    scans = [ln for ln in plan(spark, "histogram_enrich").splitlines() if "FileScan" in ln]
    assert scans and all("element_at" not in ln for ln in scans)


@pytest.mark.parametrize("name", BATCH)
def test_no_cartesian_or_nested_loop(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
