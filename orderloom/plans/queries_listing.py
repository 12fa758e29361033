"""Queries over listings of changed tables and content versions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.operators import listing, versions
from orderloom.plans.registry import over, query
from orderloom.session import materialise, scratch_path
from orderloom.sources.ledger import VersionLedger
from orderloom.sources.order_views import OrderViews
from orderloom.sources.tables import TableStore

def changed(spark, folder):
    return listing.changed_assets(OrderViews(spark, folder).listing())


@query("changed_assets", over("changed", then="select * from changed"))
def changed_assets(spark, folder):
    return changed(spark, folder)


@query("changed_assets_counts", over("changed", then="""
    select location, repository, count(*) as n_changed from changed group by 1, 2"""))
def changed_assets_counts(spark, folder):
    return listing.changed_counts(changed(spark, folder))


@query("changed_assets_lines", over("changed", then="""
    select location || chr(9) || repository || chr(9) || asset_key as line from changed"""))
def changed_assets_lines(spark, folder):
    return listing.render_lines(changed(spark, folder))


_NUMBERED = """
    numbered as (select *, row_number() over (partition by location, repository order by asset_key) - 1 as position
                 from changed)"""


@query("changed_assets_json", over("changed", extra=_NUMBERED, then="""
    select case when repository = '__repository__' then location else location || '/' || repository end as name,
           position, '"' || asset_key || '"' as element from numbered"""))
def changed_assets_json(spark, folder):
    return listing.render_json(changed(spark, folder))


@query("changed_assets_json_collisions", over("changed", then="""
    select name, row_number() over (partition by name order by asset_key) - 1 as position,
           '"' || asset_key || '"' as element
    from (select location || '/de' as name, asset_key from changed where repository = '__repository__'
          union all
          select location || '/' || repository, asset_key from changed
          where repository not in ('__repository__', 'de') or repository = 'de' and location not in (
              select location from changed where repository = '__repository__'))"""))
def changed_assets_json_collisions(spark, folder):
    """The whole locations are called as the German ones are; of two groups of one name the later stands."""
    whole = F.col("repository") == listing.WHOLE_LOCATION
    named = F.when(whole, F.concat("location", F.lit("/de"))).otherwise(F.col("location"))
    return listing.render_json(changed(spark, folder).withColumn("location", named))


@query("changed_assets_commands", over("changed", extra=_NUMBERED, then="""
    select location, repository, position,
           case when position = 0 then 'launch --location ' || location || ' --job nightly ' else '' end
           || '--asset-key ''key:"' || asset_key || '"''' as part from numbered"""))
def changed_assets_commands(spark, folder):
    return listing.render_commands(changed(spark, folder), job="nightly")


@query("changed_assets_nested", over("changed", then="""
    select (select count(*) from documents) as n_listed, (select count(*) from changed) as n_changed,
           (select count(*) from (select distinct location, repository from changed)) as n_groups"""))
def changed_assets_nested(spark, folder):
    """The totals of the listing read from nested documents, one for each asset."""
    flat = OrderViews(spark, folder).listing()
    place = F.struct(F.col("repository").alias("name"), F.struct(F.col("location").alias("name")).alias("location"))
    node = F.struct(
        F.struct(F.col("asset_path").alias("path")).alias("assetKey"),
        F.col("changed_reasons").alias("changedReasons"),
        place.alias("repository"),
    )
    documents = flat.select(F.to_json(F.array(node)).alias("document"))
    return listing.changed_totals(listing.from_documents(documents))


@query("changed_by_hash", """
    select doc_id, sha1(text) as content_hash, sha1(text || '.') as previous_hash
    from documents join labels using (doc_id) where quality = 0""")
def changed_by_hash(spark, folder):
    """Labelled documents were seen before; of these, the text of the poor ones had one more full stop."""
    v = OrderViews(spark, folder)
    docs = v.table("documents").select("doc_id", "text")
    now = versions.content_hashes(docs, "doc_id", ["text"])
    longer = versions.content_hashes(docs.withColumn("text", F.concat("text", F.lit("."))), "doc_id", ["text"])
    seen = v.table("labels").select("doc_id", "quality")
    poor = longer.join(seen.where(F.col("quality") == 0), "doc_id").drop("quality")
    good = now.join(seen.where(F.col("quality") != 0), "doc_id").drop("quality")
    return versions.changed_by_hash(now, poor.unionByName(good), "doc_id")


@query("asset_key_normalise", """
    select page_id,
           case when path = 'thther.example.org/en/685' then 'RAW_DATA' else split_part(path, '/', 1) end
           || '/' || page_id as table_key,
           upper(split_part(path, '/', 2)) || '/' || split_part(path, '/', 3) as upstream_key
    from (select page_id, regexp_replace(url, '^https?://', '') as path from pages)""")
def asset_key_normalise(spark, folder):
    pages = OrderViews(spark, folder).table("pages").select(
        "page_id", F.regexp_replace("url", "^https?://", "").alias("path"), F.col("page_id").cast("string").alias("name")
    )
    own = listing.table_key("path", "name", {"thther.example.org/en/685": "RAW_DATA"})
    parts = pages.withColumn("parts", F.split("path", "/"))
    return parts.select(
        "page_id",
        F.array_join(own, "/").alias("table_key"),
        F.array_join(listing.upstream_key("parts"), "/").alias("upstream_key"),
    )


@query("storage_kinds", """
    select p_partkey, case when target like 'PROMO%' then 'PROMO' else target end as kind
    from (select p_partkey, p_type || '_' || p_brand as target from part)""")
def storage_kinds(spark, folder):
    parts = OrderViews(spark, folder).table("part")
    target = F.concat_ws("_", "p_type", "p_brand")
    return parts.select("p_partkey", listing.storage_kind(target, "PROMO").alias("kind"))


@query("changed_assets_document", over("changed", extra="""
    named as (select *, case when repository = '__repository__' then location else location || '/' || repository end as name
              from changed),
    numbered as (
        select name, asset_key, row_number() over w - 1 as spot, lag(name) over w as before, lead(name) over w as after
        from named window w as (order by location, repository, asset_key)),
    lines as (
        select spot, list_filter([
            case when before is null then '{' end,
            case when before is distinct from name then '  "' || name || '": [' end,
            '    "' || asset_key || '"' || case when after is distinct from name then '' else ',' end,
            case when after is distinct from name then case when after is null then '  ]' else '  ],' end end,
            case when after is null then '}' end], lambda x: x is not null) as parts
        from numbered)""", then="""
    select spot * 5 + generate_subscripts(parts, 1) - 1 as line_no, unnest(parts) as line from lines"""))
def changed_assets_document(spark, folder):
    """The changed assets as the lines of one JSON object."""
    return listing.json_document_lines(changed(spark, folder))


@query("changed_assets_rejected", """
    select doc_id, text from documents where doc_id % 7 in (1, 3) union all select doc_id, null from documents where doc_id % 7 = 5""")
def changed_assets_rejected(spark, folder):
    """Of listing documents, plain texts and NULLs, those that are no listing."""
    docs = OrderViews(spark, folder).table("documents").select("doc_id", "text")
    kind = F.col("doc_id") % 7
    good = F.to_json(F.array(F.struct(F.struct(F.array("text").alias("path")).alias("assetKey"))))
    text = F.when(kind.isin(1, 3), F.col("text")).when(kind != 5, good)
    return listing.rejected_documents(docs.select("doc_id", text.alias("text")), "text")


@query("stored_versions", """
    select 1 as run, doc_id, doc_id % 2 = 0 as rebuilt from documents where false
    union all select 2, doc_id, doc_id % 2 = 0 from documents where doc_id % 3 <> 0 and doc_id % 5 = 0
    union all select 3, doc_id, true from documents
              where doc_id % 3 <> 0 and (doc_id % 5 = 0 and doc_id % 2 <> 0 or doc_id % 7 = 0)""")
def stored_versions(spark, folder):
    """Three runs over a stored ledger of content hashes.

    Two documents in three are built first. Then every fifth changes and the even ones of these are
    rebuilt; then every seventh changes too, and the odd ones are still due.
    """
    store = TableStore(spark, scratch_path(spark, "versions"))
    docs = OrderViews(spark, folder).table("documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    changes = [F.lit(False), F.col("doc_id") % 5 == 0, F.col("doc_id") % 7 == 0]
    text, found = F.col("text"), []
    for run, change in enumerate(changes, 1):
        ledger = VersionLedger(store, "ledger.documents", "doc_id", buckets=8)
        text = F.when(change, F.concat(text, F.lit("!"))).otherwise(text)
        now = versions.content_hashes(docs.withColumn("text", text), "doc_id", ["text"])
        due = ledger.due(now).select(F.lit(run).alias("run"), "doc_id", "content_hash")
        due = materialise(due.withColumn("rebuilt", (F.col("doc_id") % 2 == 0) | F.lit(run == 3)), "due")
        ledger.record(now.where("doc_id % 3 != 0") if run == 1 else due.where("rebuilt"))
        ledger.close()
        found.append(due.select("run", "doc_id", "rebuilt"))
    return reduce(DataFrame.unionByName, found)
