"""Registered queries against their SQL, at the smallest scale.

``SPARKZONE_ALL=0`` runs only some of them.
"""

from __future__ import annotations

import os

import pytest

from sparkzone.queries import QUERIES, SQL

from .oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
SAMPLE = (
    "vehicle_emission_summary",
    "temperature_trends_chunked",
    "climate_country_year",
    "text_features",
    "quarantine_event",
    "weather_summary",
    "row_fingerprint_diff",
    "page_route",
    "vector_topk",
    "image_trusted_catalogue",
    "pending_work",
)

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.mark.parametrize("name", SAMPLE if os.environ.get("SPARKZONE_ALL") == "0" else list(SQL))
def test_query_agrees_with_its_sql(spark, name):
    assert compare(QUERIES[name](spark, FOLDER), connect(FOLDER), SQL[name]) is None


def test_contract():
    import __spark_entry__ as contract

    assert set(contract.oracle_sql()) <= set(contract.queries()) and len(contract.queries()) > 100
