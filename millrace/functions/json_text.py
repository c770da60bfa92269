"""JSON kept as text: paths, defaults and shape checks as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def value_at(body: Column, path: str, to: str = "string") -> Column:
    """The scalar at `path` ('a.b.c'); NULL where any parent is missing."""
    return F.get_json_object(body, f"$.{path}").try_cast(to)


def value_or(body: Column, path: str, default: Column, keep_null: bool = False) -> Column:
    """The text at `path`, or `default` where it is absent.

    An explicit JSON null counts as absent. With keep_null it stays NULL instead, which costs a
    second look at the body.
    """
    found = F.coalesce(F.get_json_object(body, f"$.{path}"), default)
    if not keep_null:
        return found
    explicit = F.is_variant_null(F.try_variant_get(F.try_parse_json(body), f"$.{path}", "variant"))
    return F.when(F.coalesce(explicit, F.lit(False)), F.lit(None)).otherwise(found)


def listing_size(body: Column) -> Column:
    """Elements of a JSON array; 0 also for an empty object or JSON null; NULL for all else."""
    empty = F.when(body.rlike(r"^\s*(null|\{\s*\})\s*$"), 0)
    return F.coalesce(F.json_array_length(body), empty)


def nested_text_schema(paths: list[str]) -> T.StructType:
    """A struct holding every dotted path as text. Text leaves accept any JSON scalar."""
    tree: dict = {}
    for path in paths:
        node = tree
        for name in path.split("."):
            node = node.setdefault(name, {})

    def struct(node: dict) -> T.StructType:
        fields = [T.StructField(k, struct(v) if v else T.StringType()) for k, v in node.items()]
        return T.StructType(fields)

    return struct(tree)
