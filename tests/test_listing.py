from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from orderloom.operators import listing, usage, versions

SCHEMA = "asset_path array<string>, changed_reasons array<string>, location string, repository string"


@pytest.fixture
def nodes(spark):
    return spark.createDataFrame(
        [
            (["A", "z"], ["NEW"], "loc", "__repository__"),
            (["A", "b"], ["TAGS", "CODE_VERSION"], "loc", "__repository__"),
            (["A", "none"], None, "loc", "__repository__"),
            (["A", "tags"], ["TAGS"], "loc", "__repository__"),
            (["c"], ["NEW"], "loc", "repo"),
            (["d"], ["NEW"], "loc/repo", "__repository__"),
        ],
        SCHEMA,
    )


def test_reasons_select_rows(nodes):
    assert [r[2] for r in rows(listing.changed_assets(nodes))] == ["A/b", "A/z", "c", "d"]
    assert [r[2] for r in rows(listing.changed_assets(nodes, " tags , removed"))] == ["A/b", "A/tags"]
    with pytest.raises(ValueError, match="OTHER"):
        listing.changed_assets(nodes, "NEW,other")


def test_renderings(nodes):
    changed = listing.changed_assets(nodes)
    assert rows(listing.changed_counts(changed)) == [("loc", "__repository__", 2), ("loc", "repo", 1), ("loc/repo", "__repository__", 1)]
    lines = [r[0] for r in listing.render_lines(changed).collect()]
    assert lines == ["loc\t__repository__\tA/b", "loc\t__repository__\tA/z", "loc\trepo\tc", "loc/repo\t__repository__\td"]
    # Two groups share the name loc/repo: the later one stands.
    assert rows(listing.render_json(changed)) == [("loc", 0, '"A/b"'), ("loc", 1, '"A/z"'), ("loc/repo", 0, '"d"')]
    commands = listing.render_commands(changed, "nightly").where("location = 'loc' and repository = '__repository__'")
    whole = " ".join(r["part"] for r in commands.orderBy("position").collect())
    assert whole == "launch --location loc --job nightly --asset-key 'key:\"A/b\"' --asset-key 'key:\"A/z\"'"


def test_a_large_group_has_the_same_form(spark):
    nodes = spark.range(5000).select(
        F.array(F.lit("k"), F.lpad((F.col("id") * 37 % 5000).cast("string"), 4, "0")).alias("asset_path"),
        F.array(F.lit("NEW")).alias("changed_reasons"),
        F.when(F.col("id") % 10 < 9, "hot").otherwise("cold").alias("location"),
        F.lit("r").alias("repository"),
    )
    keys = listing.render_json(listing.changed_assets(nodes)).where("name = 'hot/r'").orderBy("position").collect()
    assert [k["position"] for k in keys] == list(range(4500))
    whole = [k["element"] for k in keys]
    assert whole == sorted(whole) and len(set(whole)) == 4500


def test_nested_documents(spark, nodes):
    documents = spark.createDataFrame(
        [
            ('[{"assetKey":{"path":["A","z"]},"changedReasons":["NEW"],"repository":{"name":"r","location":{"name":"l"}}},'
             '{"assetKey":{"path":["q"]},"changedReasons":[]}]',),
            ("no document",),
            (None,),
        ],
        "document string",
    )
    assert rows(listing.from_documents(documents)) == [(["A", "z"], ["NEW"], "l", "r"), (["q"], [], None, None)]
    assert rows(listing.changed_totals(nodes)) == [(6, 4, 3)]


def test_keys_and_kinds(spark):
    df = spark.createDataFrame(
        [("CLEANED/a.sql", "a"), ("models/sources.yml", "raw"), ("MARKETING/company_perf.sql", "company_perf")], "path string, name string"
    )
    overrides = {"models/sources.yml": "RAW_DATA", "MARKETING/company_perf.sql": "ANALYTICS"}
    keys = {tuple(r[0]) for r in df.select(listing.table_key("path", "name", overrides)).collect()}
    assert keys == {("CLEANED", "a"), ("RAW_DATA", "raw"), ("ANALYTICS", "company_perf")}
    parts = spark.createDataFrame([(["db", "analytics", "T"],)], "p array<string>")
    assert parts.select(listing.upstream_key("p")).first()[0] == ["ANALYTICS", "T"]
    kinds = spark.createDataFrame([("SNOWFLAKE_PROD",), ("DUCKDB",), (None,)], "t string")
    assert [r[0] for r in kinds.select(listing.storage_kind(F.col("t"))).collect()] == ["SNOWFLAKE", "DUCKDB", "DUCKDB"]


def test_only_known_keys_with_new_content_changed(spark):
    now = versions.content_hashes(spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, t string"), "k", ["t"])
    before = versions.content_hashes(spark.createDataFrame([(1, "a"), (2, "x")], "k int, t string"), "k", ["t"])
    assert [r["k"] for r in versions.changed_by_hash(now, before, "k").collect()] == [2]


def test_usage_leaves_out_the_last_minutes(spark):
    text = "select 1 /* tool_opaque_id[[[model.x.y:run-7]]] */"
    data = [(text, datetime(2024, 1, 1, 9, 5), 1.0), (text, datetime(2024, 1, 1, 9, 59), 2.0), (text, datetime(2024, 1, 1, 11, 15), 4.0), ("select 2", datetime(2024, 1, 1, 9), 8.0)]
    history = spark.createDataFrame(data, "query_text string, start_time timestamp_ntz, credits double")
    assert rows(usage.usage_hourly(history, "2024-01-01 12:00:00")) == [("model.x.y", datetime(2024, 1, 1, 9), 2, 3.0)]
