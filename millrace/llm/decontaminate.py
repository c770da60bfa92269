"""Benchmark decontamination by a positional inverted index of the training documents.

DataFrame operations only. Steps:

1. Documents and items are cut into words: runs of letters, digits and all non-ASCII characters,
   with A-Z in lower case.
2. The index holds a posting (document, position, term) for each word of a document that is a word
   of some item; other words can never be asked for. It is staged in the shared folder.
3. Items are cut into windows of `window` consecutive words (a shorter item is one window). For each
   window the postings of its rarest word give places where the item may lie (position minus
   offset); they are intersected with the postings of its second rarest word, shifted by its offset.
4. The places left are held against the postings of all words of the item. Runs of as many
   consecutive matches as a window has words are occurrences.

`phrase_matches` returns the words of occurrences, `near_matches` documents that have an item's
rarest words close together in any order.

A NULL or empty text has no words, and an item without words matches nothing. Rows of documents that
are repeated, or share a NULL id, are indexed once and answered alike. Items are told apart by id;
several texts of one id, or of the id NULL (written as an empty string), are one item. Of equally rare
words the first in the window, or in the order of bytes, is asked for first, which changes no result.
Texts of any length are indexed whole. Other columns stay, whatever their names. Empty tables, of
documents or items, match nothing.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.rows import fold, row_key, with_key
from millrace.session import stage

WINDOW = 10
NEAR_TERMS, NEAR_WORDS = 3, 10
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
DOC = ["k1", "k2"]
PLACE = [*DOC, "item", "shift"]


class Index(NamedTuple):
    """`items` (item, item_id, offset, term, n_words); `postings` (k1, k2, pos, term).

    `terms` (term, word, n): n is the number of postings, 0 for a word that no document has.
    """

    items: DataFrame
    postings: DataFrame
    terms: DataFrame


def words(text: Column) -> Column:
    """The words of a text. Cut at what lies between them: `regexp_extract_all` copies the text at each word."""
    return F.array_remove(F.split(fold(text), BETWEEN_WORDS, -1), "")


def count_words(text: Column) -> Column:
    return F.coalesce(F.size(words(text)), F.lit(0)).cast("long")


def distinct_texts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(k1, k2, text): each row once, so that repeated rows have no postings of their own.

    Only rows that are repeated are brought together, most of them in the map tasks; the others stay where
    they are.
    """
    keyed = docs.select(*[c.alias(n) for c, n in zip(row_key(doc_id, text), DOC)], F.col(text).alias("text"))
    repeated = stage(keyed.groupBy(*DOC).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*DOC))
    once = keyed.join(repeated, DOC, "left_semi").groupBy(*DOC).agg(F.first("text").alias("text"))
    return keyed.join(repeated, DOC, "left_anti").unionByName(once)


def build_index(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    item_text: str = "text",
    item_id: str = "item_id",
) -> Index:
    """The staged index of `docs` for the words of `items`.

    The list of terms is joined by its real size: Spark broadcasts it below its threshold, and
    sorts and merges beyond it, where AQE splits the postings of a frequent word.
    """
    listed = items.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item_id"), words(F.col(item_text)).alias("words")
    ).distinct()
    listed = stage(listed.where(F.size("words") > 0).withColumn("item", F.monotonically_increasing_id()))
    placed = listed.select(
        "item", "item_id", F.size("words").alias("n_words"), F.posexplode("words").alias("offset", "word")
    )
    terms = stage(placed.select("word").distinct().withColumn("term", F.monotonically_increasing_id()))
    texts = distinct_texts(docs, text, doc_id)
    found = texts.select(*DOC, F.posexplode(words(F.col("text"))).alias("pos", "word"))
    postings = stage(found.join(terms, "word").select(*DOC, "pos", "term"))
    counts = postings.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    counts = stage(terms.join(counts, "term", "left").withColumn("n", F.coalesce("n", F.lit(0))))
    return Index(stage(placed.join(terms, "word").drop("word")), postings, counts)


def _rare_words(index: Index, window: int) -> DataFrame:
    """The two rarest words of each window, the same pair once per item: term_1, offset_1, term_2, ...

    A window with a word that no document has is left out. A window of one word has no second.
    """
    listed = index.items.join(index.terms, "term")
    listed = listed.groupBy("item", "n_words").agg(
        F.sort_array(F.collect_list(F.struct("offset", "n", "term"))).alias("_words")
    )
    start = F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.col("n_words") - window + 1)))
    cut = listed.select("item", "_words", start.alias("_start")).select(
        "item", F.slice("_words", F.col("_start"), F.lit(window)).alias("_words")
    )
    by_count = F.transform("_words", lambda w: F.struct(w["n"].alias("n"), w["offset"].alias("offset"), w["term"].alias("term")))
    cut = cut.select("item", F.sort_array(by_count).alias("_words"))
    one, two = F.get("_words", F.lit(0)), F.get("_words", F.lit(1))
    pairs = cut.where(one["n"] > 0).select(
        "item",
        one["term"].alias("term_1"),
        one["offset"].alias("offset_1"),
        two["term"].alias("term_2"),
        two["offset"].alias("offset_2"),
    )
    return pairs.distinct()


def places(index: Index, window: int = WINDOW) -> DataFrame:
    """(k1, k2, item, shift): where the two rarest words of one of the item's windows stand.

    `shift` is the document position of the item's first word; it may be negative, as a window need
    not be the item's first.
    """
    rare = stage(_rare_words(index, window))
    firsts = index.postings.join(rare, F.col("term") == F.col("term_1"))
    firsts = firsts.withColumn("shift", F.col("pos") - F.col("offset_1"))
    alone = firsts.where("term_2 IS NULL").select(*PLACE)
    pairs = firsts.where("term_2 IS NOT NULL").select(
        *PLACE, F.col("term_2").alias("term"), (F.col("shift") + F.col("offset_2")).alias("pos")
    )
    seconds = index.postings.join(rare.select(F.col("term_2").alias("term")).distinct(), "term", "left_semi")
    met = pairs.join(seconds, [*DOC, "term", "pos"], "left_semi").select(*PLACE)
    return met.unionByName(alone).distinct()


def phrase_matches(index: Index, window: int = WINDOW) -> DataFrame:
    """(k1, k2, item, item_id, positions): the document positions inside an item's occurrences.

    One row per place where the item, or a part of it of at least a window, stands.
    """
    found = stage(places(index, window))
    whole = found.join(index.items, "item")
    whole = whole.withColumn("pos", F.col("shift") + F.col("offset")).where("pos >= 0")
    candidates = index.postings.join(found.select(*DOC).distinct(), DOC, "left_semi")
    hits = whole.join(candidates, [*DOC, "pos", "term"], "left_semi")
    offsets = hits.groupBy(*PLACE, "item_id", "n_words").agg(
        F.sort_array(F.collect_set("offset")).alias("_offsets"),
        F.least(F.max("n_words"), F.lit(window)).alias("_length"),
    )
    full = F.filter(
        "_offsets",
        lambda at, i: F.get("_offsets", i + F.col("_length") - 1) == at + F.col("_length") - 1,
    )
    starts = offsets.select(*DOC, "item", "item_id", "shift", "_length", full.alias("_starts"))
    covered = F.transform(
        "_starts",
        lambda at: F.sequence(F.col("shift") + at, F.col("shift") + at + F.col("_length") - 1),
    )
    positions = F.array_distinct(F.flatten(covered)).alias("positions")
    return starts.where(F.size("_starts") > 0).select(*DOC, "item", "item_id", positions)


def near_matches(index: Index, terms: int = NEAR_TERMS, within: int = NEAR_WORDS) -> DataFrame:
    """(k1, k2, item, item_id): documents with the item's `terms` rarest words near each other.

    Near: each of them at most `within` words from one occurrence of the rarest. Of equally rare words
    the first in the order of bytes goes first. An item of fewer distinct words is asked for with all
    it has; one of whose words no document has any is not found.
    """
    once = index.items.select("item", "item_id", "term").distinct().join(index.terms, "term")
    listed = once.groupBy("item", "item_id").agg(
        F.sort_array(F.collect_list(F.struct("n", "word", "term"))).alias("_words")
    )
    rare = stage(listed.where(F.col("_words")[0]["n"] > 0).select(
        "item", "item_id", *[F.get("_words", F.lit(i))["term"].alias(f"term_{i}") for i in range(terms)]
    ))
    found = index.postings.join(rare, F.col("term") == F.col("term_0")).drop("term", "term_0")
    for i in range(1, terms):
        block = F.expr(f"pos div {within + 1}")
        asked = rare.select(F.col(f"term_{i}").alias("term")).where("term IS NOT NULL").distinct()
        others = index.postings.join(asked, "term", "left_semi").select(
            *DOC, F.col("term").alias(f"term_{i}"), F.col("pos").alias("_pos"), block.alias("_block")
        )
        around = F.explode(F.sequence(block - 1, block + 1))
        asking = found.where(F.col(f"term_{i}").isNotNull()).withColumn("_block", around)
        met = asking.join(others, [*DOC, f"term_{i}", "_block"])
        met = met.where(F.abs(F.col("_pos") - F.col("pos")) <= within).drop("_pos", "_block", f"term_{i}").distinct()
        none = found.where(F.col(f"term_{i}").isNull()).drop(f"term_{i}")
        found = met.unionByName(none)
    return found.select(*DOC, "item", "item_id").distinct()


def contamination(index: Index, window: int = WINDOW) -> DataFrame:
    """(k1, k2, n_hit, item_ids): words inside occurrences, and sorted ids, of documents with any."""
    found = stage(phrase_matches(index, window))
    hit = found.select(*DOC, F.explode("positions").alias("pos")).distinct()
    hit = hit.groupBy(*DOC).agg(F.count(F.lit(1)).alias("n_hit"))
    ids = found.groupBy(*DOC).agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    return hit.join(ids, DOC)


def drop_contaminated(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """`docs` without the rows in which a window of some item occurs."""
    found = stage(contamination(build_index(docs, items, text, doc_id), window).select(*DOC))
    keyed, keys = with_key(docs, doc_id, text)
    return keyed.join(found.toDF(*keys), keys, "left_anti").drop(*keys)
