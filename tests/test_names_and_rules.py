from __future__ import annotations

import pytest

from sparkzone import logicaldate
from sparkzone.functions import names
from sparkzone.plans.purposes import DOCUMENTS, STRUCTURED, kind_of
from sparkzone.plans.rules import TWEETS, VEHICLES, rules_for


def test_headers():
    assert names.header_names(["\ufeffEngine Size(L)", "CO2 Emissions(g/km)", "2020 Total", "!!", "Year"]) == [
        "engine_sizel", "co2_emissionsg_km", "col_2020_total", "column_4", "year",
    ]


def test_colliding_headers_are_numbered():
    assert names.header_names(["ID", "id", "Tweet ID"]) == ["id", "id_2", "id_3"]


def test_table_and_topic_names():
    assert names.table_name("s3a://b/structured/global_warming_dataset_delta_1779580800000/") == "global_warming_dataset"
    assert names.table_name("/x/Tweets_20260524t101500") == "tweets"
    assert names.table_name("/x/_staging") is None and names.table_name("/x/.hidden/") is None
    assert names.topic_table("weather-barcelona") == "weather_barcelona"
    assert names.document_key(" Datetime First! é") == "datetime_first"


def test_candidates():
    assert names.pick_column(["a", "engine_sizel"], ("engine_size_l", "engine_sizel")) == "engine_sizel"
    assert names.pick_column(["a"], ("b",), required=False) is None
    with pytest.raises(KeyError):
        names.pick_column(["a"], ("b",))


def test_repeated_headers_take_the_next_free_name():
    assert names.header_names(["id", "id", "id_2", "ID"]) == ["id", "id_3", "id_2", "id_4"]


def test_rules():
    assert rules_for("natural_disaster_tweets_v2") is TWEETS
    assert rules_for("co2_emission_by_vehicles") is VEHICLES
    assert not rules_for("orders").whole_row_duplicates
    # The known text table names columns its rules do not expect; that is reported, not fatal.
    assert TWEETS.missing_expected(["id", "tweet_text", "disaster_type", "hashtags", "emojis"]) == ["text", "label"]
    assert TWEETS.sort_keys_for(["x", "id"]) == ["id"] and rules_for("t").sort_keys_for(["x", "y"]) == ["x"]


def test_logical_dates():
    assert logicaldate.iso("2026-05-24T10:00:00Z") == "2026-05-24T10:00:00+00:00"
    assert logicaldate.epoch_millis("2026-05-24T00:00:00") == "1779580800000"
    assert logicaldate.hive_partition("2026-05-24") == "year=2026/month=05/day=24"
    with pytest.raises(ValueError):
        logicaldate.parse(None)


def test_asset_purposes():
    assert [kind_of(n) for n in ("dim_x", "fact_x", "mart_x", "bridge_x", "image_vector", "counts")] == [
        "dimension", "fact", "mart", "bridge", "embedding", "metric",
    ]
    assert STRUCTURED.domain_of("dim_year") == "climate_environment" and STRUCTURED.domain_of("dim_vehicle") == "vehicle_emissions"
    assert STRUCTURED.use_of("fact_tweet_features") == "natural disaster classifier" and STRUCTURED.domain_of("dim_new") == "shared_analytics"
    assert DOCUMENTS.domain_of("dim_sensor") == "barcelona_air_quality" and DOCUMENTS.domain_of("dim_country") == "barcelona_environment"
