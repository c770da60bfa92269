"""Landed responses made by Spark from the test tables, in the shapes that the ingest jobs take.

Arrays are packed in groups with a bound of their own: a hundred ids of a unique key, or the newest
twenty per player. No group grows with the data.
"""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.routing import DEFAULT_MATCH_COUNT
from millrace.functions.timing import epoch_millis
from millrace.operators.latest import latest_per_key
from millrace.plans import datasets
from millrace.plans.ingest import Run
from millrace.schemas import LEAGUE_ENTRIES, MATCH_IDS, RESPONSE_LOG
from millrace.sources.landed import read_table
from millrace.sources.tables import append, ensure_table

PAGE = 100


def block_of(column: str) -> Column:
    """Number of the hundred that a unique id falls into."""
    return F.expr(f"{column} div {PAGE}")


def event_pages(events: DataFrame) -> DataFrame:
    """(page, body): each hundred events as a JSON array of objects."""
    item = F.struct("event_id", "user_id", "event_type", "value", "props")
    return events.groupBy(block_of("event_id").alias("page")).agg(
        F.to_json(F.sort_array(F.collect_list(item))).alias("body")
    )


def event_id_lists(events: DataFrame) -> DataFrame:
    """(user_id, body): a user's event ids within each hundred as a JSON array of strings."""
    ids = F.collect_list(F.col("event_id").cast("string"))
    by_block = events.groupBy("user_id", block_of("event_id").alias("block"))
    return by_block.agg(F.to_json(ids).alias("body")).drop("block")


def event_documents(events: DataFrame) -> DataFrame:
    """(event_id, requested, body): one object each; errors lack their id and signups all of info."""
    kind = F.col("event_type")
    metadata = F.struct(F.when(kind != "error", F.col("event_id").cast("string")).alias("id"))
    created = epoch_millis(events, "ts").alias("created")
    info = F.when(kind != "signup", F.struct(kind.alias("type"), created))
    return events.select(
        "event_id",
        F.concat(F.lit("req_"), F.col("event_id").cast("string")).alias("requested"),
        F.to_json(F.struct(metadata.alias("metadata"), info.alias("info"))).alias("body"),
    )


def drifting_documents(events: DataFrame) -> DataFrame:
    """(event_id, body): one object each; its members and their types differ by kind of event, errors are torn."""
    kind = F.col("event_type")
    metadata = F.struct(F.col("event_id").cast("string").alias("id")).alias("metadata")
    info = F.struct(F.col("event_id").alias("created"), "value").alias("info")
    texts = F.struct(F.col("event_id").alias("created"), F.col("value").cast("string").alias("value")).alias("info")
    lines = F.array(F.struct("user_id", kind.alias("a.b")), F.struct("user_id", F.lit(None).cast("string").alias("a.b"))).alias("lines")
    body = (
        F.when(kind == "view", F.to_json(F.struct(metadata, texts)))
        .when(kind == "signup", F.to_json(F.struct(metadata)))
        .when(kind == "error", F.lit('{"metadata":'))
        .when(kind == "purchase", F.to_json(F.struct(metadata, info, lines)))
        .otherwise(F.to_json(F.struct(metadata, info)))
    )
    return events.select("event_id", body.alias("body"))


def event_responses(events: DataFrame) -> DataFrame:
    """Events as a response log: the kind of event stands for the status."""
    kind = F.col("event_type")
    wait = F.get_json_object("props", "$.k").cast("int")
    return events.select(
        "event_id",
        "ts",
        F.when(kind == "error", 429)
        .when(kind == "signup", 404)
        .when(kind == "view", 500)
        .otherwise(200)
        .alias("status"),
        F.when(F.col("value") < 20, "application")
        .when(F.col("value") < 40, "method")
        .alias("rate_limit_type"),
        F.when(wait < 50, wait).alias("retry_after"),
    )


def player_responses(spark: SparkSession, folder: str, run: Run, fetch: str) -> DataFrame:
    """A response log of all six datasets: customers stand for players, orders for matches.

    Every order has a document, whether or not it is among the newest of its customer.
    """
    customer = read_table(spark, folder, "customer")
    orders = read_table(spark, folder, "orders")
    player = F.col("c_custkey").cast("string")
    match = F.col("o_orderkey").cast("string")

    entry = F.struct(
        F.col("c_custkey"),
        F.col("c_name").alias("summonerId"),
        F.lit("RANKED_SOLO_5x5").alias("queueType"),
        F.col("c_mktsegment").alias("rank"),
        F.col("c_nationkey").cast("bigint").alias("wins"),
        (F.col("c_acctbal") < 0).alias("inactive"),
        player.alias("puuid"),
    )
    pages = customer.groupBy((block_of("c_custkey") + 1).alias("page")).agg(
        F.to_json(F.sort_array(F.collect_list(entry))).alias("body")
    )
    end = customer.agg((F.max(block_of("c_custkey")) + 2).alias("page"))
    pages = pages.unionByName(end.withColumn("body", F.lit("[]")))

    newest = latest_per_key(orders, ["o_custkey"], "o_orderdate", "o_orderkey", DEFAULT_MATCH_COUNT)
    id_lists = newest.groupBy(F.col("o_custkey").cast("string").alias("key")).agg(
        F.to_json(F.collect_list(match)).alias("body")
    )
    info = F.struct(
        F.lit(run.region).alias("platformId"), epoch_millis(orders, "o_orderdate").alias("gameCreation")
    )
    document = F.struct(F.struct(match.alias("matchId")).alias("metadata"), info.alias("info"))
    matches = orders.select(match.alias("key"), F.to_json(document).alias("body"))
    timelines = orders.select(match.alias("key"), F.to_json(F.struct(*orders.columns)).alias("body"))
    profile = F.struct(player.alias("puuid"), F.col("c_name").alias("name"))
    players = customer.select(player.alias("key"), F.to_json(profile).alias("body"))

    bodies = {
        datasets.LEAGUE_ENTRIES: pages,
        datasets.MATCH_IDS: id_lists,
        datasets.MATCH_RAW: matches,
        datasets.MATCH_TIMELINE: timelines,
        datasets.SUMMONER: players,
        datasets.ACCOUNT: players,
    }
    logs = [rows.withColumn("dataset", F.lit(d.name)) for d, rows in bodies.items()]
    constants = {
        "batch_id": F.lit(fetch),
        "region": F.lit(run.region),
        "tier": F.lit(run.tier),
        "division": F.lit(run.division),
        "status": F.lit(200),
        "rate_limit_type": F.lit(None).cast("string"),
        "retry_after": F.lit(None).cast("int"),
        "ts": F.lit("2024-01-01").cast("timestamp"),
    }
    return reduce(partial(DataFrame.unionByName, allowMissingColumns=True), logs).withColumns(constants)


def _as_log(rows: DataFrame, dataset: str) -> DataFrame:
    """Rows with some columns of a response log, filled up to one."""
    filled = {"dataset": F.lit(dataset), "tier": F.lit("CHALLENGER"), "division": F.lit("I")}
    for column in (c.strip().split() for c in RESPONSE_LOG.split(",")):
        name, kind = column
        if name not in rows.columns and name not in filled:
            filled[name] = F.lit(None).cast(kind)
    return rows.withColumns(filled)


def listed_matches(spark: SparkSession, folder: str, run: Run) -> None:
    """The finished orders, and every hundredth by its key, are listed as matches."""
    orders = read_table(spark, folder, "orders").where("o_orderstatus = 'F' OR o_orderkey % 100 = 0")
    ensure_table(spark, run.table("match_ids"), MATCH_IDS)
    append(
        orders.selectExpr(
            "CAST(o_custkey AS STRING) AS puuid", "CAST(o_orderkey AS STRING) AS match_id",
            "'KR' AS _region", "'CHALLENGER' AS _tier", "'b' AS _batch_id", "o_orderdate AS _ingested_at",
        ),
        run.table("match_ids"),
    )


def match_responses(spark: SparkSession, folder: str, run: Run) -> DataFrame:
    """Every order is answered; some twice, some to another region, some by another fetch batch."""
    key, at = F.col("o_orderkey").cast("string"), F.col("o_orderdate").cast("timestamp")
    orders = read_table(spark, folder, "orders")

    def body(price: Column) -> Column:
        info = F.struct(F.lit("KR").alias("platformId"), price.cast("bigint").alias("gameCreation"))
        return F.to_json(F.struct(F.struct(key.alias("matchId")).alias("metadata"), info.alias("info")))

    answers = orders.select(
        F.when(F.col("o_orderkey") % 11 == 0, "fetch-2").otherwise("fetch-1").alias("batch_id"),
        F.when(F.col("o_orderkey") % 7 == 0, "JP1").otherwise("KR").alias("region"),
        key.alias("key"), at.alias("ts"), F.lit(200).alias("status"), body(F.col("o_totalprice")).alias("body"),
    )
    late = answers.where("key % 3 = 0").withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 HOUR"))
    late = late.withColumn("body", F.replace("body", F.lit('"KR"'), F.lit('"late"')))
    exact = answers.where("key % 5 = 0")
    return _as_log(answers.unionByName(late).unionByName(exact), "match_raw")


def listings(spark: SparkSession, folder: str, run: Run) -> DataFrame:
    """Two listings of customers by hundreds: the later one has all of them, with other points.

    Each page of the first has junk at its end; pages behind an empty one are not to be landed.
    """
    customer = read_table(spark, folder, "customer")

    def listing(rows: DataFrame, fetch: str, at: str, points: int, junk: str) -> DataFrame:
        entry = F.struct(F.col("c_custkey").cast("string").alias("puuid"), (F.col("c_nationkey") + points).alias("leaguePoints"))
        text = F.array_join(F.transform(F.sort_array(F.collect_list(entry)), lambda e: F.to_json(e)), ",")
        pages = rows.groupBy((block_of("c_custkey") + 1).alias("page")).agg(
            F.concat(F.lit("["), text, F.lit(junk + "]")).alias("body")
        )
        end = rows.agg((F.max(block_of("c_custkey")) + 2).alias("page")).withColumn("body", F.lit("[]"))
        behind = end.select((F.col("page") + 1).alias("page"), F.lit('[{"puuid":"behind"}]').alias("body"))
        return pages.unionByName(end).unionByName(behind).select(
            "page", "body", F.lit(fetch).alias("batch_id"), F.lit(at).cast("timestamp").alias("ts")
        )

    first = listing(customer.where("c_acctbal >= 0"), "fetch-b", "2024-01-01", 0, ',"junk",null,7')
    second = listing(customer, "fetch-a", "2024-01-02", 1000, "")
    both = first.unionByName(second).withColumns({"region": F.lit(run.region), "status": F.lit(200)})
    return _as_log(both, "league_entries")


def listed_players(spark: SparkSession, folder: str, schema: str) -> None:
    """All customers are listed as players."""
    table = f"{schema}.league_entries"
    ensure_table(spark, table, LEAGUE_ENTRIES)
    nulls = {name: F.lit(None).cast(kind) for name, kind in spark.table(table).dtypes}
    given = {"puuid": F.col("c_custkey").cast("string"), "_region": F.lit("KR"), "_tier": F.lit("CHALLENGER")}
    append(read_table(spark, folder, "customer").select(*[c.alias(n) for n, c in {**nulls, **given}.items()]), table)


def profile_responses(spark: SparkSession, folder: str) -> DataFrame:
    """Customers of three market segments get good answers, after 429s, 404s or bad bodies; one none."""
    segment, place = F.col("c_mktsegment"), F.col("c_nationkey") % 3
    customer = read_table(spark, folder, "customer")
    key = F.col("c_custkey").cast("string")
    rows = customer.select(
        F.when(segment == "MACHINERY", "fetch-3").otherwise(F.concat(F.lit("fetch-"), place.cast("string"))).alias("batch_id"),
        F.lit("KR").alias("region"),
        key.alias("key"),
        F.lit("2024-01-01").cast("timestamp").alias("ts"),
        F.when(segment == "BUILDING", 404).when(segment.isin("MACHINERY", "FURNITURE"), 429).otherwise(200).alias("status"),
        F.when(segment == "HOUSEHOLD", "oops").otherwise(F.to_json(F.struct(key.alias("puuid")))).alias("body"),
    )
    again = rows.where("status = 429 AND batch_id <> 'fetch-3'").withColumns(
        {"status": F.lit(200), "ts": F.lit("2024-01-02").cast("timestamp")}
    )
    return _as_log(rows.unionByName(again), "summoner_raw")


def partly_landed(spark: SparkSession, folder: str, run: Run) -> None:
    """Tables of all six datasets: customers are players, orders matches; each table lacks some keys."""
    customer, orders = read_table(spark, folder, "customer"), read_table(spark, folder, "orders")
    player = {"puuid": F.col("c_custkey").cast("string")}
    scope = {"_region": F.lit(run.region), "_tier": F.lit(run.tier)}
    match = {"match_id": F.col("o_orderkey").cast("string")}
    rows = {
        datasets.LEAGUE_ENTRIES: (customer, {**player, **scope}),
        datasets.MATCH_IDS: (orders.where("o_custkey % 10 <> 0"), {"puuid": F.col("o_custkey").cast("string"), **match}),
        datasets.MATCH_RAW: (orders.where("o_orderkey % 3 <> 0"), match),
        datasets.MATCH_TIMELINE: (orders.where("o_orderkey % 5 <> 0"), match),
        datasets.SUMMONER: (customer.where("c_custkey % 4 <> 0"), player),
        datasets.ACCOUNT: (customer.where("c_acctbal >= 0"), player),
    }
    for dataset, (found, given) in rows.items():
        table = run.table(dataset.name)
        ensure_table(spark, table, dataset.columns)
        nulls = {name: F.lit(None).cast(kind) for name, kind in spark.table(table).dtypes}
        append(found.select(*[c.alias(n) for n, c in {**nulls, **given}.items()]), table)
