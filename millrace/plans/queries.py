"""Every operator as a query over whole test tables. The SQL that each must equal is in oracles.py."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.json_text import value_at, value_or
from millrace.functions.routing import (
    known_platforms,
    platform_host,
    region_host,
    region_of,
)
from millrace.functions.urls import URL_FORMATS, fill
from millrace.operators import batching, drift, landing, rates, retries
from millrace.operators.audit import Batch, with_audit
from millrace.operators.latest import latest_per_key
from millrace.operators.merge import insert_only_merge
from millrace.operators.overlaps import overlapping_runs
from millrace.operators.paging import before_first_empty, next_pages
from millrace.operators.pending import distinct_keys, pending_keys
from millrace.operators.responses import with_action
from millrace.operators.runlog import batch_counters
from millrace.operators.validate import known_text, missing_keys, unknown_keys
from millrace.plans import completeness, datasets, samples
from millrace.plans.health import LAYERS, declare_layers, listed_schemas, roundtrip
from millrace.plans.ingest import Run, ingest, ingest_all
from millrace.session import scratch_schema, shared_dir, stage, staged_path
from millrace.sources.landed import read_response_log, read_table, torn_lines
from millrace.sources.responses import scan_responses
from millrace.sources.tables import append, ensure_table, merge_into

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

BATCH = Batch("batch-0001", datetime(2024, 1, 1, tzinfo=timezone.utc))
HOST = ".api.example.com"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# Pending keys


@query
def anti_pending(spark: SparkSession, sf: str) -> DataFrame:
    return pending_keys(
        read_table(spark, sf, "orders").withColumnRenamed("o_orderkey", "order_key"),
        read_table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "order_key"),
        "order_key",
    )


@query
def anti_pending_filtered(spark: SparkSession, sf: str) -> DataFrame:
    orders = read_table(spark, sf, "orders")
    done = orders.where("o_orderstatus = 'F' AND o_orderdate < TIMESTAMP_NTZ'1998-01-01'")
    return pending_keys(orders, done, "o_custkey", where=F.col("o_orderstatus") == "O")


@query
def anti_null_keys(spark: SparkSession, sf: str) -> DataFrame:
    orders = read_table(spark, sf, "orders")
    customer = read_table(spark, sf, "customer")
    keys = orders.select(F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("key"))
    landed = customer.select(
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey")).alias("key")
    )
    return pending_keys(keys, landed, "key")


@query
def distinct_keys_filtered(spark: SparkSession, sf: str) -> DataFrame:
    urgent = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    return distinct_keys(read_table(spark, sf, "orders"), "o_custkey", where=urgent)


# Insert-only merge


def _event_merge(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """All events with other values, against those that a run in mid-month had landed."""
    events = read_table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "ts")
    landed = events.where("ts < TIMESTAMP_NTZ'2024-01-16'")
    return events.withColumn("value", F.col("value") + 1000), landed


@query
def merge_single_key(spark: SparkSession, sf: str) -> DataFrame:
    source, target = _event_merge(spark, sf)
    return insert_only_merge(source, target, ["event_id"]).merged.drop("ts")


def _line_merge(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    lines = read_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"
    )
    landed = lines.where("l_shipdate < TIMESTAMP_NTZ'1998-01-01'")
    return lines.withColumn("l_quantity", F.col("l_quantity") + 1000), landed


@query
def merge_two_key(spark: SparkSession, sf: str) -> DataFrame:
    source, target = _line_merge(spark, sf)
    return insert_only_merge(source, target, ["l_orderkey", "l_linenumber"]).merged.drop("l_shipdate")


@query
def merge_two_key_deduped(spark: SparkSession, sf: str) -> DataFrame:
    source, target = _line_merge(spark, sf)
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity"]
    merge = insert_only_merge(source, target, ["l_orderkey", "l_linenumber"], dedupe_by=order)
    return merge.inserts.drop("l_shipdate")


@query
def merge_three_key(spark: SparkSession, sf: str) -> DataFrame:
    events = read_table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", F.to_date("ts").cast("string").alias("day"), "value"
    )
    landed = events.where("value < 50")
    return insert_only_merge(events, landed, ["user_id", "event_type", "day"]).inserts


@query
def merge_metrics(spark: SparkSession, sf: str) -> DataFrame:
    source, landed = _event_merge(spark, sf)
    with scratch_schema(spark) as schema:
        table = f"{schema}.events"
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in source.schema)
        ensure_table(spark, table, columns)
        append(landed, table)
        counts = [merge_into(source, table, ["event_id"]) for _ in range(2)]
    return spark.createDataFrame([counts], "first_run BIGINT, re_run BIGINT")


# Landing


@query
def land_paged_array(spark: SparkSession, sf: str) -> DataFrame:
    pages = samples.event_pages(read_table(spark, sf, "events"))
    entry = "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE"
    rows = landing.land_paged_array(pages, entry)
    # props is no field of the entry; it survives in the element's text
    return rows.withColumn("props", value_at(F.col("_raw_json"), "props")).drop("_raw_json")


@query
def land_id_array(spark: SparkSession, sf: str) -> DataFrame:
    return landing.land_id_array(samples.event_id_lists(read_table(spark, sf, "events")), "id")


@query
def land_document(spark: SparkSession, sf: str) -> DataFrame:
    documents = samples.event_documents(read_table(spark, sf, "events"))
    fields = {"kind": ("info.type", "string"), "created": ("info.created", "bigint")}
    rows = landing.land_document(documents, "doc_key", "requested", "metadata.id", fields)
    return rows.drop("requested", "body")


@query
def land_opaque_document(spark: SparkSession, sf: str) -> DataFrame:
    documents = read_table(spark, sf, "documents").select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("key"), "text"
    )
    rows = landing.land_opaque_document(documents, "doc_key", "key", body="text")
    return rows.select("doc_key", F.length("text").alias("chars"), F.md5("text").alias("digest"))


def _damaged_bodies(spark: SparkSession, sf: str) -> DataFrame:
    """Bodies of which errors are cut off and signups are no object."""
    cut = F.expr("substring(props, 1, length(props) - 1)")
    kind = F.col("event_type")
    body = F.when(kind == "error", cut).when(kind == "signup", "[1, 2]").otherwise(F.col("props"))
    return read_table(spark, sf, "events").select("event_id", body.alias("body"))


@query
def reject_documents(spark: SparkSession, sf: str) -> DataFrame:
    fields = {"k": ("k", "bigint")}
    rows = landing.parse_document(_damaged_bodies(spark, sf), "doc_key", "event_id", fields=fields)
    return rows.where("_malformed").select("event_id", "body")


@query
def reject_arrays(spark: SparkSession, sf: str) -> DataFrame:
    checked = landing.check_arrays(_damaged_bodies(spark, sf))
    return checked.where("_malformed").select("event_id", "body")


@query
def json_extract(spark: SparkSession, sf: str) -> DataFrame:
    events = read_table(spark, sf, "events")
    return events.select("event_id", value_at(F.col("props"), "k", "bigint").alias("k"))


@query
def json_default(spark: SparkSession, sf: str) -> DataFrame:
    user = F.col("user_id").cast("string")
    props = F.col("props")
    return read_table(spark, sf, "events").select(
        "event_id",
        value_or(props, "k", user).alias("found"),
        value_or(props, "missing.key", user).alias("fallback"),
    )


@query
def paged_until_empty(spark: SparkSession, sf: str) -> DataFrame:
    """A user's days are pages of purchases; the first day without one ends them."""
    pages = (
        read_table(spark, sf, "events")
        .groupBy("user_id", F.date_diff("ts", F.lit("2023-12-31")).alias("page"))
        .agg(F.count_if(F.col("event_type") == "purchase").alias("n_items"))
    )
    return before_first_empty(pages, ["user_id"], "page", pages.where("n_items = 0"))


@query
def plan_next_pages(spark: SparkSession, sf: str) -> DataFrame:
    """A user's days are pages of events; a day without a purchase ends them."""
    pages = (
        read_table(spark, sf, "events")
        .groupBy("user_id", F.date_diff("ts", F.lit("2023-12-31")).alias("page"))
        .agg((F.count_if(F.col("event_type") == "purchase") == 0).alias("_empty"))
    )
    # few users have bought on each of their days; most of a user's pages are looked at in halves
    halves = pages.withColumn("half", F.col("page") % 16)
    return next_pages(halves, ["user_id", "half"], "page", "_empty")


@query
def reject_elements(spark: SparkSession, sf: str) -> DataFrame:
    """Errors are put into their page as a number, signups as null, and views as a text."""
    kind, event_id = F.col("event_type"), F.col("event_id").cast("string")
    element = (
        F.when(kind == "error", event_id)
        .when(kind == "signup", "null")
        .when(kind == "view", F.concat(F.lit('"v'), event_id, F.lit('"')))
        .otherwise(F.concat(F.lit('{"event_id":'), event_id, F.lit("}")))
    )
    items = F.transform(F.sort_array(F.collect_list(F.struct("event_id", element.alias("x")))), lambda e: e["x"])
    pages = read_table(spark, sf, "events").groupBy(samples.block_of("event_id").alias("page")).agg(
        F.concat(F.lit("["), F.array_join(items, ","), F.lit("]")).alias("body")
    )
    parsed = landing.parse_paged_array(pages, "event_id BIGINT")
    return parsed.where("_is_element AND _bad_element").select("page", "_pos", "_raw_json")


@query
def reject_log_lines(spark: SparkSession, sf: str) -> DataFrame:
    """A response log of which the lines of errors are cut off."""
    events = read_table(spark, sf, "events")
    row = F.to_json(F.struct(F.lit("d").alias("dataset"), F.col("event_id").cast("string").alias("key")))
    cut = F.substring(row, F.lit(1), F.length(row) - 2)
    line = F.when(F.col("event_type") == "error", cut).otherwise(row)
    path = f"{shared_dir(spark)}/millrace-logs/{uuid.uuid4().hex}"
    events.select(line.alias("value")).write.text(path)
    return torn_lines(read_response_log(spark, path))


@query
def audit_columns(spark: SparkSession, sf: str) -> DataFrame:
    orders = read_table(spark, sf, "orders").select("o_orderkey")
    return with_audit(orders, BATCH, region="KR", tier="CHALLENGER", page=1)


@query
def source_url(spark: SparkSession, sf: str) -> DataFrame:
    lists = fill(
        URL_FORMATS["match_ids"],
        host="asia" + HOST, key=F.col("o_custkey"), queue_id=420, start=0, count=20,
    )
    one = fill(URL_FORMATS["match_raw"], host="asia" + HOST, key=F.col("o_orderkey"))
    return read_table(spark, sf, "orders").select(
        "o_orderkey", lists.alias("list_url"), one.alias("document_url")
    )


# Routing and validation


@query
def routing_join(spark: SparkSession, sf: str) -> DataFrame:
    """Hosts by a routing table that lies in files: Spark broadcasts it by its size."""
    nation = read_table(spark, sf, "nation")
    region = read_table(spark, sf, "region")
    customer = read_table(spark, sf, "customer")
    routes = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return customer.join(routes, customer.c_nationkey == routes.n_nationkey).select(
        "c_custkey",
        platform_host(F.col("n_name"), HOST).alias("platform_host"),
        F.concat(F.lower("r_name"), F.lit(HOST)).alias("region_host"),
    )


def _platforms(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with a platform in lower case by nation; there are more nations than platforms."""
    codes = F.array(*[F.lit(code.lower()) for code in known_platforms()])
    known = F.get(codes, F.col("c_nationkey"))
    other = F.concat(F.lit("xx"), F.col("c_nationkey").cast("string"))
    customer = read_table(spark, sf, "customer")
    return customer.select("c_custkey", F.coalesce(known, other).alias("platform"))


@query
def routing_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Hosts by the fixed platform table: a projection."""
    platform = F.col("platform")
    return _platforms(spark, sf).select(
        "c_custkey",
        platform_host(platform, HOST).alias("platform_host"),
        F.coalesce(region_host(platform, HOST), F.lit("unknown")).alias("region_host"),
    )


@query
def routing_rejects(spark: SparkSession, sf: str) -> DataFrame:
    rows = _platforms(spark, sf).where(region_of(F.col("platform")).isNull())
    return rows.groupBy(F.upper("platform").alias("platform")).agg(F.count("*").alias("customers"))


@query
def routing_invalid(spark: SparkSession, sf: str) -> DataFrame:
    """Event types other than the known two, in upper case."""
    events = read_table(spark, sf, "events")
    known = events.where("event_type IN ('click', 'view')")
    return unknown_keys(events, known, "event_type")


@query
def known_keys_text(spark: SparkSession, sf: str) -> DataFrame:
    return known_text(read_table(spark, sf, "customer"), "c_mktsegment")


@query
def required_missing(spark: SparkSession, sf: str) -> DataFrame:
    required = read_table(spark, sf, "orders").withColumnRenamed("o_custkey", "key")
    listed = read_table(spark, sf, "customer").where("c_acctbal >= 0")
    return missing_keys(required, listed.withColumnRenamed("c_custkey", "key"), "key")


# Latest rows, responses, rates, run log


@query
def topk_latest(spark: SparkSession, sf: str) -> DataFrame:
    events = read_table(spark, sf, "events").select("user_id", "event_id", "event_type", "ts")
    bought = F.col("event_type") == "purchase"
    return latest_per_key(events, ["user_id"], "ts", "event_id", count=20, where=bought)


@query
def topk_latest_offset(spark: SparkSession, sf: str) -> DataFrame:
    events = read_table(spark, sf, "events").select("user_id", "event_id", "ts")
    return latest_per_key(events, ["user_id"], "ts", "event_id", count=20, start=10)


@query
def response_actions(spark: SparkSession, sf: str) -> DataFrame:
    log = samples.event_responses(read_table(spark, sf, "events"))
    return with_action(log).select("event_id", "status", "action", "wait_s")


def _user_actions(spark: SparkSession, sf: str) -> DataFrame:
    """Events as logged responses; each user stands for one request."""
    events = read_table(spark, sf, "events")
    log = with_action(samples.event_responses(events))
    return log.join(events.select("event_id", "user_id"), "event_id")


@query
def retry_plan(spark: SparkSession, sf: str) -> DataFrame:
    return retries.retry_plan(_user_actions(spark, sf), ["user_id"], "ts", "event_id", max_attempts=2)


@query
def retry_runs(spark: SparkSession, sf: str) -> DataFrame:
    return retries.retry_runs(_user_actions(spark, sf), ["user_id"], "ts", "event_id")


@query
def player_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """The first stage that lacks a key of each player, over tables that each lack some."""
    with scratch_schema(spark) as schema:
        run = Run("kr", "challenger", bronze=schema)
        samples.partly_landed(spark, sf, run)
        return stage(completeness.player_gaps(spark, run))


@query
def request_batches(spark: SparkSession, sf: str) -> DataFrame:
    """When to ask for each order, under both limits."""
    orders = read_table(spark, sf, "orders").select(F.col("o_orderkey").alias("key"))
    return batching.request_batches(orders, ["key"])


@query
def run_overlaps(spark: SparkSession, sf: str) -> DataFrame:
    """Events as runs of a dataset, their kind, that last as many seconds as their value."""
    lasts = F.make_dt_interval(secs=F.floor("value").cast("decimal(18,6)"))
    events = read_table(spark, sf, "events").select(
        "event_id", F.col("event_type").alias("dataset"), F.col("ts").alias("run_start"), (F.col("ts") + lasts).alias("run_end")
    )
    found = overlapping_runs(events, "dataset", "run_start", "run_end", "event_id")
    return found.select("event_id", "dataset", "n_running", "n_overlaps")


@query
def schema_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Paths and kinds of event bodies against a declared schema."""
    declared = T.StructType.fromDDL(
        "metadata struct<id: string, region: string>, info struct<created: bigint, value: double>"
    )
    bodies = samples.drifting_documents(read_table(spark, sf, "events"))
    return drift.drift_report(drift.path_counts(bodies), declared)


@query
def response_source(spark: SparkSession, sf: str) -> DataFrame:
    """One dataset, two fetch batches and one region of a log of JSON lines, by pushed filters."""
    run, path = Run("kr", "challenger"), staged_path(spark)
    log = samples.match_responses(spark, sf, run)
    log.write.partitionBy("dataset", "batch_id").json(path)
    asked = scan_responses(spark, path, "match_raw", ["fetch-2", "fetch-9"], "KR")
    return asked.select("dataset", "batch_id", "region", "key", "ts", "status", "body")


@query
def rate_audit(spark: SparkSession, sf: str) -> DataFrame:
    events = read_table(spark, sf, "events").select("event_id", "user_id", "ts")
    return rates.rate_audit(events, ["user_id"], "ts", {3600: 1, 86400: 5})


@query
def run_log(spark: SparkSession, sf: str) -> DataFrame:
    """Days stand for batches."""
    log = with_action(samples.event_responses(read_table(spark, sf, "events")))
    log = log.withColumn("batch_id", F.to_date("ts").cast("string"))
    return batch_counters(log, ["batch_id"], "ts", ["event_id"])


# Tables, catalog and whole runs


@query
def table_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    with scratch_schema(spark) as schema:
        count = roundtrip(spark, f"{schema}.smoke_test", read_table(spark, sf, "orders"))
    return spark.createDataFrame([(count,)], "cnt BIGINT")


@query
def catalog_check(spark: SparkSession, sf: str) -> DataFrame:
    """The layer schemas are declared and listed; one can hold the orders, and the others a row."""
    orders = read_table(spark, sf, "orders")
    with scratch_schema(spark) as scratch:
        prefix = f"{scratch}_"
        names = [prefix + layer for layer in LAYERS]
        try:
            declare_layers(spark, prefix, f"{shared_dir(spark)}/millrace-schemas")
            listed = {r[0] for r in listed_schemas(spark).where(F.col("name").isin(names)).collect()}
            rows = [
                (layer, name in listed, roundtrip(spark, f"{name}.smoke_test", rows_))
                for layer, name, rows_ in zip(LAYERS, names, (orders, None, None))
            ]
        finally:
            for name in names:
                spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")
    return spark.createDataFrame(rows, "layer STRING, listed BOOLEAN, cnt BIGINT")


@query
def ingest_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """All six datasets, twice on the same responses: the second run finds nothing new."""
    with scratch_schema(spark) as schema:
        runs = [Run("kr", "challenger", bronze=schema, fetched=("fetch-1",)) for _ in range(2)]
        log = f"{schema}.responses"
        responses = samples.player_responses(spark, sf, runs[0], "fetch-1")
        responses.write.partitionBy("dataset", "batch_id").saveAsTable(log)
        first, second = (ingest_all(spark, spark.table(log), run) for run in runs)
    rows = [(name, first[name]["new_rows"], second[name]["new_rows"]) for name in first]
    return spark.createDataFrame(rows, "dataset STRING, first_run BIGINT, second_run BIGINT")


def _landed(spark: SparkSession, table: str) -> DataFrame:
    """A table's rows, copied out of the scratch schema before it is dropped."""
    return stage(spark.table(table))


@query
def ingest_match_raw(spark: SparkSession, sf: str) -> DataFrame:
    """The landed rows, from a log with repeated answers, another region and another fetch batch."""
    with scratch_schema(spark) as schema:
        run = Run("kr", "challenger", bronze=schema, fetched=("fetch-1",), batch=BATCH, host_suffix=HOST)
        samples.listed_matches(spark, sf, run)
        log = f"{schema}.responses"
        samples.match_responses(spark, sf, run).write.partitionBy("dataset", "batch_id").saveAsTable(log)
        ingest(spark, datasets.MATCH_RAW, spark.table(log), run)
        return _landed(spark, run.table("match_raw"))


@query
def ingest_league_entries(spark: SparkSession, sf: str) -> DataFrame:
    """The landed rows of two listings, of which the first one wins, with junk among the elements."""
    with scratch_schema(spark) as schema:
        run = Run("kr", "challenger", bronze=schema, batch=BATCH, host_suffix=HOST)
        log = f"{schema}.responses"
        samples.listings(spark, sf, run).write.partitionBy("dataset", "batch_id").saveAsTable(log)
        ingest(spark, datasets.LEAGUE_ENTRIES, spark.table(log), run)
        rows = _landed(spark, run.table("league_entries"))
    return rows.select("puuid", "leaguePoints", "_region", "_tier", "_page", "_batch_id", "_ingested_at", "_source_url")


@query
def ingest_run_log(spark: SparkSession, sf: str) -> DataFrame:
    """The run log of three runs, of which one gets nothing but 429s."""
    with scratch_schema(spark) as schema:
        samples.listed_players(spark, sf, schema)
        log = f"{schema}.responses"
        samples.profile_responses(spark, sf).write.partitionBy("dataset", "batch_id").saveAsTable(log)
        for fetched in (("fetch-0",), ("fetch-1", "fetch-2"), ("fetch-3",)):
            batch = Batch("+".join(fetched), BATCH.ingested_at)
            run = Run("kr", "challenger", bronze=schema, fetched=fetched, batch=batch)
            ingest(spark, datasets.SUMMONER, spark.table(log), run)
        return _landed(spark, f"{schema}.ingestion_log").drop("run_start", "run_end")
