"""Ingest jobs: plan the requests, then land their responses into the bronze tables.

A fetcher of the user's choice stands between the two: it takes the rows of `plan_requests` and
lands a response log (schemas.RESPONSE_LOG). Keys and rows stay in Spark on both sides.

A run lands the responses to its own requests: those of its region and tier, and of the fetch batches
that it names, so that a log partitioned by dataset and batch is read in part only.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass, field
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions.routing import (
    DEFAULT_MATCH_COUNT,
    HOST_SUFFIX,
    PLATFORM_TO_REGION,
    RANKED_QUEUE,
    RANKED_QUEUE_ID,
    run_parameters,
)
from millrace.functions.urls import URL_FORMATS, fill
from millrace.operators.audit import Batch, utc_now, with_audit
from millrace.operators.paging import before_first_empty, next_pages
from millrace.operators.pending import distinct_keys, pending_keys
from millrace.operators.responses import with_action
from millrace.operators.runlog import batch_counters
from millrace.plans import datasets
from millrace.plans.datasets import Dataset
from millrace.session import stage, staging
from millrace.sources.landed import torn_lines
from millrace.sources.tables import ensure_table, insert_counted, merge_into, scan


@dataclass(frozen=True)
class Run:
    """Parameters of one run. `bronze` is the schema of the tables, with a catalog if there is one."""

    region: str = "KR"
    tier: str = "CHALLENGER"
    bronze: str = "bronze"
    division: str = "I"
    match_start: int = 0
    match_count: int = DEFAULT_MATCH_COUNT
    host_suffix: str = HOST_SUFFIX
    reject_null_keys: bool = False
    fetched: tuple[str, ...] | None = None  # fetch batches to land; None: all that the log holds
    batch: Batch = field(default_factory=Batch)

    def __post_init__(self) -> None:
        region, tier = run_parameters(self.region, self.tier)
        object.__setattr__(self, "region", region)
        object.__setattr__(self, "tier", tier)

    def table(self, name: str) -> str:
        return f"{self.bronze}.{name}"

    def host(self, regional: bool) -> str:
        place = PLATFORM_TO_REGION[self.region] if regional else self.region.lower()
        return place + self.host_suffix


def source_url(dataset: Dataset, run: Run, key: Column | None = None, page: Column | int = 1) -> Column:
    return fill(
        URL_FORMATS[dataset.name],
        host=run.host(dataset.regional),
        key=key if key is not None else "",
        page=page,
        queue=RANKED_QUEUE,
        queue_id=RANKED_QUEUE_ID,
        tier=run.tier,
        division=run.division,
        start=run.match_start,
        count=run.match_count,
    )


def plan_requests(
    spark: SparkSession, dataset: Dataset, run: Run, log: DataFrame | None = None
) -> DataFrame:
    """(key, _source_url) still to be asked for; a NULL key cannot be asked for, see `null_keys`.

    For a paged listing, (batch_id, page, _source_url): the page after the last one in `log` of each
    of the run's fetch batches that has not ended, or page 1 where there is none.
    """
    if dataset.keys_from is None:
        if log is None:
            raise ValueError(f"{dataset.name} is a paged listing: its next page depends on the log")
        return _next_pages(spark, dataset, run, log)
    key = dataset.key
    return _keys(spark, dataset, run).where(F.col(key).isNotNull()).select(
        F.col(key).alias("key"), source_url(dataset, run, F.col(key)).alias("_source_url")
    )


def _next_pages(spark: SparkSession, dataset: Dataset, run: Run, log: DataFrame) -> DataFrame:
    answers = dataset.parse(with_action(own_responses(log, dataset, run)).where("action = 'parse'"))
    following = next_pages(answers, ["batch_id"], "page", "_empty")
    batches = [(b,) for b in run.fetched] if run.fetched is not None else [(None,)]
    begun = answers.select("batch_id").distinct()
    if run.fetched is None:  # page 1 only if nothing has landed yet
        begun = begun.select(F.lit(None).cast("string").alias("batch_id")).distinct()
    asked = spark.createDataFrame(batches, "batch_id string")
    fresh = asked.join(begun, asked["batch_id"].eqNullSafe(begun["batch_id"]), "left_anti")
    pages = following.unionByName(fresh.withColumn("page", F.lit(1).cast("bigint")))
    return pages.withColumn("_source_url", source_url(dataset, run, page=F.col("page")))


def null_keys(spark: SparkSession, dataset: Dataset, run: Run) -> int:
    """Listed rows without a key, for which no request can be planned."""
    listed = scan(spark, run.table(dataset.keys_from))
    return listed.where(F.col(dataset.key).isNull()).where(_scope(dataset, run)).count()


def _scope(dataset: Dataset, run: Run) -> Column:
    if not dataset.keys_scoped:
        return F.lit(True)
    return (F.col("_region") == run.region) & (F.col("_tier") == run.tier)


def _keys(spark: SparkSession, dataset: Dataset, run: Run) -> DataFrame:
    listed = scan(spark, run.table(dataset.keys_from))
    where = _scope(dataset, run)
    if dataset.once:
        landed = ensure_table(spark, run.table(dataset.name), dataset.columns)
        return pending_keys(listed, landed, dataset.key, where)
    return distinct_keys(listed, dataset.key, where)


def own_responses(log: DataFrame, dataset: Dataset, run: Run) -> DataFrame:
    """The log's responses to the run's requests for the dataset."""
    own = (F.col("dataset") == dataset.name) & (F.col("region") == run.region) & (F.col("tier") == run.tier)
    if dataset.keys_from is None:
        own &= F.col("division") == run.division
    if run.fetched is not None:
        own &= F.col("batch_id").isin(*run.fetched)
    return log.where(own)


def ingest(
    spark: SparkSession, dataset: Dataset, log: DataFrame, run: Run, listed: Callable[[], object] | None = None
) -> dict[str, int]:
    """Land the run's responses for the dataset and merge the new rows into its table; append to the log.

    Returns requests_made, count_429, new_rows, rejected (malformed bodies and elements), failures
    (responses that say no for good), unanswered (requests that got nothing but 429s) and key_mismatch
    (documents that name another key than was asked for, which stays pending).
    `listed`, if given, returns once the table that lists the keys is as it is to be read. The bodies are
    looked at and counted before.
    """
    started = utc_now()
    responses = with_action(own_responses(log, dataset, run))
    ensure_table(spark, run.table(dataset.name), dataset.columns)
    view, land = (_elements, _land_arrays) if dataset.explode else (_facts, _land_documents)
    request = ["page" if dataset.keys_from is None else "key", "_fetch"]
    with staging(spark):
        staged, actions = view(dataset, responses)
        retried = not staged.where("status = 429").isEmpty()
        counted = batch_counters(actions, [], "ts", request, retried).first().asDict()
        if listed is not None:
            listed()
        landed = land(spark, dataset, responses, staged, run)
    counters = {**{c: counted[c] for c in COUNTERS}, **landed}
    _append_run_log(spark, dataset.name, run, started, counters, counted["status"])
    return counters


COUNTERS = ("requests_made", "count_429", "rejected", "failures", "unanswered")


def _fetch() -> Column:
    return F.coalesce("batch_id", F.lit("")).alias("_fetch")


def _facts(dataset: Dataset, responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Narrow facts of documents, staged in one pass over the bodies, and the same as rows to be counted."""
    parsed = dataset.parse(_identified(responses))
    facts = stage(
        parsed.select(
            "key", "ts", "status", "action", "_malformed", dataset.key, "_id", *_fields(dataset, responses),
            (F.col(dataset.key) != F.col("key")).alias("_stray"), _fetch(),
        )
    )
    return facts, facts.withColumn("_rejects", F.col("_malformed").cast("int"))


def _identified(responses: DataFrame) -> DataFrame:
    return responses.withColumn("_id", F.xxhash64("key", "ts", "batch_id", "body"))


def _fields(dataset: Dataset, responses: DataFrame) -> list[str]:
    """What else the parse finds in a document."""
    known = {*responses.columns, dataset.key, "_malformed"}
    return [c for c in dataset.parse(responses).columns if c not in known]


def _land_documents(spark, dataset: Dataset, responses: DataFrame, facts: DataFrame, run: Run) -> dict:
    """One row per requested key: the first good response by time, fetch batch and content.

    On the staged facts it is settled which responses to land: asked for, first of their key, and of a
    key that the table lacks. A second pass over the bodies takes exactly those, by a positive join, so
    that a log that grows meanwhile adds nothing; what the first pass found in them is not parsed again.
    """
    own, fields = dataset.key, _fields(dataset, responses)
    good = facts.where("action = 'parse' AND NOT _malformed")
    keys = _keys(spark, dataset, run).withColumnRenamed(own, "key")
    if not scan(spark, run.table(dataset.name)).isEmpty():  # else all that is listed is asked for
        keys = stage(keys)  # mostly few, or none: facts are then not shuffled
    place = F.struct("ts", "_fetch", "_id", own, "key", *fields)
    # The join leaves the rows by key and in its order, as the aggregate needs them.
    first = good.join(keys, "key", "left_semi").groupBy("key").agg(
        F.min(place).alias("_first"), F.count(F.lit(1)).alias("n")
    )
    chosen = stage(first.select("_first.*", "n"))
    mismatched = good.where("_stray").count()
    if mismatched:
        chosen = _first_of_each(chosen, own, _known(spark, dataset, run))
    if not dataset.once:  # else the keys are such that the table lacks
        chosen = chosen.join(_known(spark, dataset, run), own, "left_anti")
    counters = {"new_rows": 0, "key_mismatch": mismatched}
    if not chosen.isEmpty():
        answers = _identified(responses).where("action = 'parse'").select("key", "_id", F.col("body").alias("raw_json"))
        chosen = chosen.select("key", "_id", "n", own, *fields)
        rows = answers.join(chosen.where("n = 1"), ["key", "_id"])
        several = chosen.where("n > 1")
        if not several.isEmpty():  # of a key with several answers, the chosen one may have copies
            rows = rows.unionByName(answers.join(several, ["key", "_id"]).dropDuplicates(["key", "_id"]))
        counters["new_rows"] = insert_counted(_with_audit(dataset, rows, run), run.table(dataset.name))
    return counters


def _known(spark: SparkSession, dataset: Dataset, run: Run) -> DataFrame:
    return distinct_keys(scan(spark, run.table(dataset.name)), dataset.key)


def _first_of_each(chosen: DataFrame, own: str, known: DataFrame) -> DataFrame:
    """One document per key that it names, where some name another key than was asked for.

    Only the keys named by those are looked at: the first of several documents lands, if the key is not
    `known`. All others were asked for by the key that they name.
    """
    named = stage(chosen.where(F.col(own) != F.col("key")).select(own).distinct())
    place = F.struct(*[c for c in chosen.columns if c != "n"], "n")
    first = chosen.join(named, own, "left_semi").groupBy(own).agg(F.min(place).alias("_first")).select("_first.*")
    lacking = first.join(known.join(named, own, "left_semi"), own, "left_anti")
    rest = chosen.join(named, own, "left_anti")
    return stage(rest.unionByName(lacking))


def _elements(dataset: Dataset, responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All elements as rows, staged in one pass over the bodies, and what of them is to be counted."""
    columns = ["key", "page", "ts", "status", "action", "_malformed", "_empty", "body"]
    flat = stage(dataset.explode(dataset.parse(responses).select(*columns, _fetch())))
    bad = F.col("_malformed") | (F.col("_is_element") & F.col("_bad_element"))
    first = ~F.col("_is_element") | (F.col("_pos") == 0)
    return flat, flat.select(
        "key", "page", "ts", "status", "action", "_malformed", "_fetch",
        bad.cast("int").alias("_rejects"), first.alias("_response"),
    )


def _land_arrays(spark, dataset: Dataset, responses: DataFrame, flat: DataFrame, run: Run) -> dict:
    """Elements as rows, which `_elements` has staged."""
    parsed = flat.where("action = 'parse' AND NOT _malformed")
    rows = parsed.where("_is_element AND NOT _bad_element")
    if dataset.keys_from is None:
        rows = before_first_empty(rows, ["_fetch"], "page", parsed.where("_empty").select("_fetch", "page"))
        rows = _of_first_listing(rows, flat).withColumnRenamed("page", "_page")
        new_rows = merge_into(
            _with_audit(dataset, rows, run),
            run.table(dataset.name),
            list(dataset.merge_on),
            reject_null_keys=run.reject_null_keys,
        )
    else:
        keys, on = _keys(spark, dataset, run), list(dataset.merge_on)
        rows = rows.withColumnRenamed("key", dataset.key)
        new_rows = merge_into(
            _with_audit(dataset, rows, run),
            run.table(dataset.name),
            on,
            reject_null_keys=run.reject_null_keys,
            # of the new rows only: a run that repeats another has few of them, or none
            then=lambda new: new.join(keys, dataset.key, "left_semi").dropDuplicates(on),
        )
    return {"new_rows": new_rows, "key_mismatch": 0}


def _of_first_listing(rows: DataFrame, flat: DataFrame) -> DataFrame:
    """A key's rows of the first listing that has it, as if listings had been landed one by one.

    Listings are in the order of their first response, then of their fetch batch. Copies within one
    listing stay, and so do rows without a key.
    """
    begins = stage(flat.groupBy("_fetch").agg(F.min("ts").alias("_begin")))
    keyed_rows = rows.where("puuid IS NOT NULL")
    first = keyed_rows.join(begins, "_fetch").groupBy("puuid").agg(
        F.min(F.struct("_begin", "_fetch")).alias("_first")
    )
    first = first.select("puuid", F.col("_first._fetch").alias("_fetch"))
    kept = keyed_rows.join(first, ["puuid", "_fetch"], "left_semi").select(*rows.columns)
    return kept.unionByName(rows.where("puuid IS NULL"))


def _with_audit(dataset: Dataset, rows: DataFrame, run: Run) -> DataFrame:
    extra = {"region": run.region, "tier": run.tier}
    if dataset.keys_from is None:
        extra["source_url"] = source_url(dataset, run, page=F.col("_page"))
    elif "key" in rows.columns:
        extra["source_url"] = source_url(dataset, run, F.col("key"))
    return with_audit(rows, run.batch, **extra)


# One writer at a time: the run log is a Parquet table, and datasets of one run end at the same time.
_run_log = Lock()


def _append_run_log(spark, dataset: str, run: Run, started, counters: dict[str, int], status: str) -> None:
    row = {
        "batch_id": run.batch.batch_id,
        "dataset": dataset,
        "run_start": started,
        "run_end": utc_now(),
        "status": status,
        **{c: counters[c] for c in ("requests_made", "count_429", "new_rows", "rejected")},
    }
    table = run.table("ingestion_log")
    values = ", ".join(f":{name}" for name in row)
    with _run_log:
        ensure_table(spark, table, schemas.INGESTION_LOG)
        spark.sql(f"INSERT INTO {table} ({', '.join(row)}) VALUES ({values})", args=row)


def ingest_all(spark: SparkSession, log: DataFrame, run: Run) -> dict[str, dict[str, int]]:
    """All six datasets of one response log, side by side.

    Each looks at its responses at once, but waits for the dataset that lists its keys before it lands any;
    if that one fails, so does it. Lines of the log that could not be read belong to no dataset; they get
    a row of their own in the run log, under the name `response_log`.
    """
    started, torn = utc_now(), torn_lines(log).count()
    if torn:
        counters = {"requests_made": 0, "count_429": 0, "new_rows": 0, "rejected": torn}
        _append_run_log(spark, "response_log", run, started, counters, "FAILED")
    landed: dict[str, Future] = {}
    with ThreadPoolExecutor(len(datasets.DATASETS)) as threads:
        for d in datasets.DATASETS:
            listed = landed[d.keys_from].result if d.keys_from else None
            job = inheritable_thread_target(spark)(ingest)  # in the caller's job group and pool
            landed[d.name] = threads.submit(job, spark, d, log, run, listed)
    return {name: counters.result() for name, counters in landed.items()}
