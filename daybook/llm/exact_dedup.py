"""Exact deduplication by a 128-bit content hash, with a comparison of bytes.

Texts are equal when they are identical after every run of ASCII white space has become
one space. Rows are grouped by the MD5 of that form; the row with the smallest id stays.
Inside groups of more than one row the bytes themselves are compared with those of the
row that stays, and rows that differ (a hash collision) are grouped anew by their bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import SLICE_ROWS, slices_for, staged, whole_rows, with_group_totals, without
from daybook.operators.joins import broadcast_when_small

WHITE_SPACE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE, " ")


def content_hash(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     hashed=content_hash) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    * Null text counts as empty. Empty texts equal each other, not a text of one space.
    * Null ids come after all others; among rows with the same id, one that stays is picked.
    * A repeated row is a row of its own: it counts in ``group_size`` and at most one stays.
    * No rows in, no rows out. Other columns of the input are ignored.
    * Texts of any length are read whole; a hot group is dealt over many tasks.
    """
    norm = normalised(F.col(text_col))
    texts = docs.select(F.col(id_col).alias("id"), norm.alias("norm")).withColumn(
        "hash", hashed(F.col("norm"))
    )
    keys = staged(
        texts.select(
            "id", "hash", F.unhex(F.sha2(F.col("norm").cast("binary"), 256)).alias("sha"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "exact-keys",
    )
    slices = slices_for(keys.count())
    # A null id sorts behind every other.
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), "row")
    totals = {"first": ("min", order), "size": ("sum", F.lit(1).cast("long"))}
    grouped = with_group_totals(keys, ["hash"], totals, ["row"], slices)

    odd = staged(_collisions(texts, keys, slices), "exact-collisions")
    again = with_group_totals(
        keys.join(odd, ["hash", "sha"], "left_semi"), ["hash", "sha"],
        {"own_first": ("min", order), "own_size": ("sum", F.lit(1).cast("long"))}, ["row"], slices,
    ).select("row", "own_first", "own_size")
    strays = again.join(grouped, "row").groupBy("hash").agg(F.count(F.lit(1)).alias("strays"))
    return (
        grouped.join(again, "row", "left").join(strays, "hash", "left")
        .select(
            F.col("id").alias(id_col),
            F.coalesce("own_first", "first").alias("first"),
            F.coalesce("own_size", F.col("size") - F.coalesce("strays", F.lit(0))).alias("group_size"),
            "row", F.lower(F.hex("sha")).alias("text_sha256"),
        )
        .select(
            id_col, F.col("first.id").alias("keep_id"), "group_size",
            (F.col("row") == F.col("first.row")).alias("kept"), "text_sha256",
        )
    )


def _collisions(texts: DataFrame, keys: DataFrame, slices: int) -> DataFrame:
    """Hash and SHA-256 of texts that differ in their bytes from the one that stays.

    Normally empty. Only texts of groups of more than one row are moved: the others are left
    out beforehand where the list of the groups' hashes is small. Members of a hot group are
    dealt over slices by their place, and meet a copy of the first member's text in each
    slice, so no task compares a whole hot group, whatever its ids are.
    """
    order = F.struct(F.col("id").isNull().alias("none"), "id", "row", "sha")
    groups = staged(
        keys.groupBy("hash").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select("hash", "first", (F.col("n") > SLICE_ROWS).alias("hot")),
        "exact-groups",
    )
    hashes, hot = broadcast_when_small(groups.select("hash"), groups.where("hot").select("hash", "hot"))
    own = texts.join(hashes, "hash", "left_semi").withColumn("_place", F.monotonically_increasing_id())
    slot = F.when(F.col("hot"), F.pmod("_place", F.lit(slices))).otherwise(0).cast("int")
    members = staged(
        own.join(hot, "hash", "left").withColumn("_slice", slot).drop("hot", "_place"), "exact-members"
    )
    every = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(slices - 1))).otherwise(F.array(F.lit(0)))
    sha = F.unhex(F.sha2(F.col("norm").cast("binary"), 256))
    kept = (
        members.join(groups.select("hash", "first").hint("merge"), "hash")
        .where(F.col("id").eqNullSafe(F.col("first.id"))).where(sha == F.col("first.sha"))
        .groupBy("hash").agg(F.min("norm").alias("kept_norm"))
        .join(groups.select("hash", F.explode(every).alias("_slice")), "hash")
    )
    return (
        members.join(kept.hint("merge"), ["hash", "_slice"])
        .where(F.col("norm") != F.col("kept_norm")).select("hash", sha.alias("sha")).distinct()
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns; see :func:`exact_duplicates`.

    Of rows that repeat both the id and the text, null ids included, one stays. A null text
    counts as empty. Without documents there are no rows. Names of other columns do not matter.
    """
    found = exact_duplicates(docs, id_col, text_col)
    states = staged(
        found.groupBy(F.col(id_col).alias("id"), F.unhex("text_sha256").alias("sha")).agg(
            F.max("kept").alias("stays"), F.count(F.lit(1)).alias("n")
        ).where("not stays or n > 1"),
        "exact-states",
    )
    sha = F.unhex(F.sha2(normalised(F.col(text_col)).cast("binary"), 256))
    keys = {"id": F.col(id_col), "sha": sha}
    single = without(docs, states.select("id", "sha"), **keys)
    again, = broadcast_when_small(states.where("stays").select("id", "sha"))
    again = again.select(F.col("id").alias("_id"), F.col("sha").alias("_sha"))
    same = [F.col("id").eqNullSafe(F.col("_id")), F.col("sha") == F.col("_sha")]
    repeated = whole_rows(docs, **keys).join(again, same, "left_semi").dropDuplicates(["id", "sha"])
    return single.unionByName(repeated.select("_row.*"))
