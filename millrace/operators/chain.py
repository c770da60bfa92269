"""Completeness along a chain of datasets whose keys come from one another."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def descent(spark: SparkSession, depends: list[tuple[str, str]]) -> DataFrame:
    """(dataset, depth, n_below) from (dataset, parent): its distance from a dataset without parent, and how many follow from it.

    Recursive SQL over the few datasets, never over their keys; a cycle raises.
    """
    parents = dict(depends)
    for dataset in parents:
        seen = {dataset}
        while (dataset := parents.get(dataset)) is not None:
            if dataset in seen:
                raise ValueError(f"{dataset} depends on itself")
            seen.add(dataset)
    edges = spark.createDataFrame(depends, "dataset string, parent string")
    return spark.sql(
        """
        WITH RECURSIVE below(dataset, descendant, depth) AS (
            SELECT parent, dataset, 1 FROM {edges}
            UNION ALL
            SELECT b.dataset, e.dataset, b.depth + 1 FROM below b JOIN {edges} e ON e.parent = b.descendant
        ),
        named AS (SELECT dataset FROM {edges} UNION SELECT parent FROM {edges})
        SELECT n.dataset, coalesce(u.depth, 0) AS depth, coalesce(d.n_below, 0) AS n_below
        FROM named n
        LEFT JOIN (SELECT descendant, max(depth) AS depth FROM below GROUP BY descendant) u ON u.descendant = n.dataset
        LEFT JOIN (SELECT dataset, count(DISTINCT descendant) AS n_below FROM below GROUP BY dataset) d
            ON d.dataset = n.dataset
        """,
        edges=edges,
    )


def chain_gaps(wanted: DataFrame, landed: DataFrame, depends: list[tuple[str, str]]) -> DataFrame:
    """(root, first_stage, n_first, n_missing, n_waiting): roots that lack some key, and where they lack it first.

    `wanted` has (root, dataset, key), the keys that a dataset should have for a root; `landed` has (dataset,
    key). The first stage is the nearest to the chain's begin, of equally near ones the first by name; `n_first`
    of its keys are missing, `n_missing` of all stages. A missing key keeps one answer of every dataset
    that follows from it waiting: `n_waiting`. NULL keys can't be asked for and are left out; a NULL root is a
    root. A key counts once for a root, however often it is wanted.

    Keys are made distinct in the map tasks; a key wanted for many roots is a hot key of the anti join only
    by its roots, and AQE splits it. What follows is one sum per (root, dataset).
    """
    wanted = wanted.where("key IS NOT NULL").select("root", "dataset", "key").distinct()
    missing = wanted.join(landed.select("dataset", "key").distinct(), ["dataset", "key"], "left_anti")
    per_stage = missing.groupBy("root", "dataset").agg(F.count(F.lit(1)).alias("n"))
    placed = per_stage.join(descent(wanted.sparkSession, depends), "dataset")
    first = F.min(F.struct("depth", "dataset", "n"))
    return placed.groupBy("root").agg(
        first["dataset"].alias("first_stage"),
        first["n"].alias("n_first"),
        F.sum("n").alias("n_missing"),
        F.sum(F.col("n") * F.col("n_below")).alias("n_waiting"),
    )
