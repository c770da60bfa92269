"""Turn landed response bodies into typed rows. Every function is a projection: no shuffle.

The body text is kept exactly as received. A body of the wrong shape lands no row; it is flagged by
the `parse_*` and `check_arrays` functions, so nothing is lost without notice.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.json_text import listing_size, nested_text_schema


def land_paged_array(pages: DataFrame, entry: str, body: str = "body") -> DataFrame:
    """One row per object of an array, with the fields of the DDL string `entry`.

    Missing fields are NULL and further fields are dropped, but `_raw_json` holds the whole element
    and `_pos` its place in the array. The other columns of `pages` are kept. Elements that are no
    object are left out; `parse_paged_array` has them.
    """
    parsed = parse_paged_array(pages, entry, body).where("_is_element AND NOT _bad_element")
    return parsed.drop("_is_element", "_bad_element")


def parse_paged_array(pages: DataFrame, entry: str, body: str = "body") -> DataFrame:
    """All elements of `land_paged_array`, and one row for a page without any.

    `_is_element` tells the two apart; `_bad_element` marks elements that are no object.
    """
    kept = [c for c in pages.columns if c != body]
    elements = F.posexplode_outer(F.from_json(body, "array<string>")).alias("_pos", "_raw_json")
    return (
        pages.select(*kept, elements)
        .withColumn("_entry", F.from_json("_raw_json", entry))
        .select(
            *kept,
            "_entry.*",
            "_raw_json",
            F.col("_pos").cast("bigint").alias("_pos"),
            F.col("_pos").isNotNull().alias("_is_element"),
            (~is_object(F.col("_raw_json"))).alias("_bad_element"),
        )
    )


def land_id_array(responses: DataFrame, name: str, body: str = "body") -> DataFrame:
    """One row per id of an array of strings; an empty array yields none, and a null is no id."""
    parsed = parse_id_array(responses, name, body)
    return parsed.where("_is_element AND NOT _bad_element").drop("_is_element", "_bad_element", "_pos")


def parse_id_array(responses: DataFrame, name: str, body: str = "body") -> DataFrame:
    """All elements of `land_id_array`, and one row for a response without any; nulls are marked."""
    kept = [c for c in responses.columns if c != body]
    ids = F.posexplode_outer(F.from_json(body, "array<string>")).alias("_pos", name)
    return responses.select(*kept, ids).withColumns({
        "_is_element": F.col("_pos").isNotNull(),
        "_bad_element": F.col(name).isNull(),
    })


def is_object(element: Column) -> Column:
    return F.coalesce(element.rlike(r"^\s*\{"), F.lit(False))


def parse_document(
    responses: DataFrame,
    key: str,
    requested: str,
    key_path: str | None = None,
    fields: Mapping[str, tuple[str, str]] | None = None,
    body: str = "body",
) -> DataFrame:
    """All documents: `key` from `key_path`, or the requested key where the path is missing.

    `fields` maps a new column to (path, type). All paths come from one parse of the body, which
    also fills `_malformed`.
    """
    fields = fields or {}
    paths = [p for p, _ in fields.values()] + ([key_path] if key_path else [])
    shape = nested_text_schema(paths or ["_none"]).add("_corrupt", "string")
    document = F.from_json(body, shape, {"columnNameOfCorruptRecord": "_corrupt"})
    # A generated column: a filter on it is not pushed below, where it would parse once more.
    parsed = responses.select("*", F.explode_outer(F.array(document)).alias("_doc"))
    found = F.col(f"_doc.{key_path}") if key_path else F.lit(None)
    columns = {name: F.col(f"_doc.{p}").try_cast(t) for name, (p, t) in fields.items()}
    columns[key] = F.coalesce(found, F.col(requested))
    columns["_malformed"] = F.expr("_doc IS NULL OR _doc._corrupt IS NOT NULL")
    return parsed.withColumns(columns).drop("_doc")


def parse_opaque_document(
    responses: DataFrame, key: str, requested: str, body: str = "body"
) -> DataFrame:
    """All documents under the requested key; only a blank body is `_malformed`."""
    return responses.withColumns({key: F.col(requested), "_malformed": ~has_text(F.col(body))})


def land_document(responses: DataFrame, key: str, requested: str, *args, **kwargs) -> DataFrame:
    """The well-formed documents of `parse_document`."""
    return well_formed(parse_document(responses, key, requested, *args, **kwargs))


def land_opaque_document(responses: DataFrame, key: str, requested: str, body: str = "body") -> DataFrame:
    """One row per document, keyed by the requested key; the body is not looked into."""
    return well_formed(parse_opaque_document(responses, key, requested, body))


def well_formed(parsed: DataFrame) -> DataFrame:
    return parsed.where("NOT _malformed").drop("_malformed")


def check_arrays(responses: DataFrame, body: str = "body") -> DataFrame:
    """Add `_malformed` (no array at all) and `_empty` (the answer that ends paging)."""
    size = listing_size(F.col(body))
    return responses.withColumns({"_malformed": size.isNull(), "_empty": size.eqNullSafe(0)})


def has_text(body: Column) -> Column:
    return F.coalesce(body.rlike(r"\S"), F.lit(False))
