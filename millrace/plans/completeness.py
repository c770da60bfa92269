"""How far each player's data has come along the six datasets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.chain import chain_gaps
from millrace.plans import datasets
from millrace.plans.ingest import Run
from millrace.sources.tables import ensure_table


def player_gaps(spark: SparkSession, run: Run) -> DataFrame:
    """`chain_gaps` of the run's players (root: puuid).

    A player's matches are those listed for them; a match's timeline can be asked for when its document has landed.
    """
    table = {d.name: ensure_table(spark, run.table(d.name), d.columns) for d in datasets.DATASETS}
    own = table["league_entries"].where((F.col("_region") == run.region) & (F.col("_tier") == run.tier))
    players = own.select(F.col("puuid").alias("root")).where("root IS NOT NULL").distinct()
    listed = table["match_ids"].select(F.col("puuid").alias("root"), F.col("match_id").alias("key"))
    listed = listed.join(players, "root", "left_semi").where("key IS NOT NULL").distinct()
    documents = table["match_raw"].select(F.col("match_id").alias("key")).distinct()
    wanted, landed, depends = [], [], []
    for dataset in datasets.DATASETS:
        if dataset.keys_from is None:
            continue
        keys = {
            "league_entries": players.withColumn("key", F.col("root")),
            "match_ids": listed,
            "match_raw": listed.join(documents, "key", "left_semi").select("root", "key"),
        }[dataset.keys_from]
        name = F.lit(dataset.name).alias("dataset")
        wanted.append(keys.select("root", name, "key"))
        landed.append(table[dataset.name].select(name, F.col(dataset.key).alias("key")))
        depends.append((dataset.name, dataset.keys_from))
    return chain_gaps(reduce(DataFrame.unionByName, wanted), reduce(DataFrame.unionByName, landed), depends)
