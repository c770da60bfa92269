"""A query for each operator, over its whole table. The SQL of those that SQL can express is in oracles.py."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    decontaminate,
    embedding_dedup,
    language,
    licenses,
    line_dedup,
    prefix_trie,
    sentencepiece_bpe,
    shards,
    simhash,
    token_counts,
    tool_linking,
    toxicity,
    turn_repair,
)
from millrace.llm.rows import row_key
from millrace.session import stage
from millrace.sources.landed import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
MODEL = "piece_bpe_32k.model"
COUNT_MODEL = "byte_bpe_50k.json"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path(name: str = MODEL) -> str:
    """Where an installed public tokenizer lies."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "documents").select("doc_id", "text")


def _held_out(folds: int, fold: int, doc_id: str = "doc_id") -> Column:
    """Whether the crc32 of the id as text falls into the fold; a NULL id is in none."""
    remainder = F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds
    return F.coalesce(remainder == fold, F.lit(False))


@query
def op1_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    docs = _documents(spark, sf)
    index = decontaminate.build_index(docs, read_table(spark, sf, "benchmark"))
    found = stage(decontaminate.contamination(index))
    near = decontaminate.near_matches(index).groupBy("k1", "k2").agg(
        F.count_distinct("item_id").alias("n_near")
    )
    k1, k2 = row_key("doc_id", "text")
    rows = docs.select(
        "doc_id", k1.alias("k1"), k2.alias("k2"), decontaminate.count_words(F.col("text")).alias("n_words")
    )
    rows = rows.join(found, ["k1", "k2"], "left").join(stage(near), ["k1", "k2"], "left")
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    return rows.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
    )


@query
def op2_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.license_report(_documents(spark, sf), licenses.known_licenses(spark))


@query
def op3_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    model = sentencepiece_bpe.read_model(tokenizer_path())
    return sentencepiece_bpe.digests(sentencepiece_bpe.encode_and_decode(_documents(spark, sf), model))


@query
def op4_shard(spark: SparkSession, sf: str) -> DataFrame:
    text = F.col("text")
    rows = _documents(spark, sf).select(
        "doc_id",
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        shards.row_size(text).alias("size"),
        shards.text_group(text).alias("_group"),
    )
    placed = shards.assign_shards(rows, 24, group=F.col("_group"), size=F.col("size"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op5_embedding_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read_table(spark, sf, "embeddings"))


@query
def op6_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = _documents(spark, sf)
    machine = toxicity.fit(docs, read_table(spark, sf, "labels"), ~_held_out(5, 0))
    return toxicity.score(docs, machine).select(
        "doc_id", _held_out(5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query
def op7_simhash_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(stage(simhash.fingerprints(_documents(spark, sf))))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


@query
def op8_tool_linking(spark: SparkSession, sf: str) -> DataFrame:
    return tool_linking.format_chat(read_table(spark, sf, "conversations"))


@query
def op9_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").select("doc_id", "text", "lang")
    prototypes = language.learn(docs.where(~_held_out(4, 2)))
    return language.predict(docs.drop("lang"), prototypes).select(
        "doc_id", _held_out(4, 2).alias("held_out"), "lang_pred", "score"
    )


@query
def op10_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = line_dedup.drop_repeated_lines(_documents(spark, sf), counters=("n_lines", "n_dropped"))
    kept = F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    return found.select("doc_id", "n_lines", "n_dropped", kept)


@query
def op11_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    docs = _documents(spark, sf).withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    spec = token_counts.read_tokenizer(tokenizer_path(COUNT_MODEL))
    counted = token_counts.count_tokens(docs, spec)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


def damaged(rows: DataFrame) -> DataFrame:
    """`conversations` with a fault put into rows by the crc32 of `conv_id:turn`; rows to drop are `gone`."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(part("text"), "[.!?]", "")).otherwise(part("text"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(part("role")).alias("role"),
        text.alias("text"),
        (fault == 0).alias("gone"),
        F.explode(F.array_repeat(F.lit(0), F.when(fault == 3, 2).otherwise(1))).alias("copy"),
    )


@query
def op12_turn_repair(spark: SparkSession, sf: str) -> DataFrame:
    rows = damaged(read_table(spark, sf, "conversations").select("conv_id", "turn", "role", "text"))
    packed = stage(turn_repair.pack_turns(rows, gone=F.col("gone")))
    return turn_repair.report(turn_repair.repair(packed))


def rebuilt(packed: DataFrame) -> DataFrame:
    """The runs of `pack_conversations` with each conversation's first turns taken from the one at its hundred.

    The first h turns come from conversation c - c % 100, as far as it has them; h is the crc32 of c, modulo 6.
    """
    turn = F.posexplode(F.arrays_zip("ids", "chars")).alias("pos", "turn")
    heads = packed.where("conv_id % 100 = 0 AND first < 5").select(F.col("conv_id").alias("base"), "first", turn)
    place = F.col("first") + F.col("pos")
    heads = heads.where(place < 5).select("base", F.struct(place.alias("place"), "turn.ids", "turn.chars").alias("turn"))
    heads = stage(heads.groupBy("base").agg(F.sort_array(F.collect_list("turn")).alias("head")))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).cast("int")
    base = F.col("conv_id") - F.col("conv_id") % 100
    rows = packed.withColumns({"h": h, "base": base}).join(heads, "base", "left")
    head = F.slice(F.coalesce("head", F.array().cast(heads.schema["head"].dataType)), 1, F.col("h"))
    skipped = F.greatest(F.col("h") - F.col("first"), F.lit(0)).cast("int")
    rest = lambda c: F.slice(c, skipped + 1, F.size(c))
    at_start = F.col("start")
    before = F.size("head") + F.greatest(F.col("first") - F.col("h"), F.lit(0))
    return rows.withColumn("head", head).select(
        "conv_id",
        "seg",
        "start",
        F.when(at_start, 0).otherwise(before).cast("long").alias("first"),
        F.when(at_start, F.concat("head.ids", rest("ids"))).otherwise(rest("ids")).alias("ids"),
        F.when(at_start, F.concat("head.chars", rest("chars"))).otherwise(rest("chars")).alias("chars"),
    )


@query
def op13_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    rows = read_table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    return prefix_trie.trie(rebuilt(prefix_trie.pack_conversations(rows)))
