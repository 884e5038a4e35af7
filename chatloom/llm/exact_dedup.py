"""Exact dedup by progressive refinement, in DataFrame functions only.

Rows are equal when their texts agree after deleting blanks (``BLANKS``).  Three
levels split the rows further and further: the length of the blank-free text,
then a hash of its first ``PREFIX`` characters, then SHA-256 of all of it.  Only
rows whose (length, prefix hash) occurs twice reach the third level.  Which
those are travels as a set of at most ``BUCKETS`` hash buckets, the one thing
that is broadcast, so its size is bounded whatever the corpus holds; a bucket
shared by chance costs one needless hash and changes no result.

Groups are counted by partial aggregation before any shuffle, so a group with a
third of all rows sends one row per task.  The join that tells each row its
group is a plain equi-join of two written tables, whose skewed partitions
adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.llm.shared import apart, at, cut, positional, quoted, renamed, texts

#: The characters of [\x20\x09-\x0D].
BLANKS = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
PREFIX = 64
BUCKETS = 1 << 16


def without_blanks(text: Column) -> Column:
    for blank in BLANKS:
        text = F.replace(text, F.lit(blank), F.lit(""))
    return text


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the most code points in its original text stays,
    then the smallest id, nulls last; of rows repeated with one id, one stays.
    Null texts count as empty and equal each other.  text_sha256 is null where no
    other row shares length and prefix, unless ``digest`` asks for it everywhere.
    An empty table gives an empty result; other columns are ignored.
    """
    rows = texts(docs, id_col, text_col).withColumn("_norm", without_blanks(F.col("_text")))
    rows = rows.select("_id", "_norm", F.char_length("_text").alias("_points"), F.octet_length("_norm").alias("_len"), F.xxhash64(F.substring("_norm", 1, PREFIX)).alias("_head"))
    bucket = F.pmod(F.xxhash64("_len", "_head"), F.lit(BUCKETS)).cast("int")

    keys = cut(rows.select("_len", "_head"), "dedup-keys")
    lengths = cut(keys.groupBy("_len").count().filter("count > 1").select("_len"), "dedup-lengths")
    heads = keys.join(lengths, "_len", "left_semi").groupBy("_len", "_head").count().filter("count > 1")
    buckets = cut(heads.select(bucket.alias("_bucket")).distinct(), "dedup-buckets")

    hit = F.col("_hit").isNotNull()
    hashed = rows.withColumn("_bucket", bucket).join(F.broadcast(buckets.select("_bucket", F.lit(1).alias("_hit"))), "_bucket", "left")
    sha = F.sha2(F.col("_norm"), 256)
    hashed = hashed.select("_id", "_points", "_hit", F.monotonically_increasing_id().alias("_row"), (sha if digest else F.when(hit, sha)).alias("_sha"))
    hashed = cut(hashed, "dedup-hashes")

    best = F.min(F.struct((-F.col("_points")).alias("p"), F.col("_id").isNull().alias("n"), F.col("_id").alias("id"), F.col("_row").alias("row")))
    groups = hashed.filter(hit).groupBy("_sha").agg(best.alias("best"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    groups = cut(groups.select(F.col("_sha").alias("_group"), F.col("best.id").alias("_keep"), F.col("best.row").alias("_keep_row"), "size"), "dedup-groups")
    grouped = F.col("_group").isNotNull()
    return hashed.join(groups, F.col("_sha") == F.col("_group"), "left").select(
        F.col("_id").alias(id_col),
        F.when(grouped, F.col("_keep")).otherwise(F.col("_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        F.when(grouped, F.col("_row") == F.col("_keep_row")).otherwise(F.lit(True)).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, the one ``exact_dedup`` keeps; columns as they were.

    Nulls, empty texts, ties, repeated rows and an empty table are as there.  Only
    rows that lose, and the few that share a bit of the bitmap with one, are hashed
    again and joined.
    """
    found = exact_dedup(docs, id_col, text_col).filter("text_sha256 is not null")
    found = cut(found.select(F.col(quoted(id_col)).alias("_keep"), "kept", F.col("text_sha256").alias("_its")), "dedup-decisions")
    each = found.groupBy("_keep", "_its").agg(F.max("kept").alias("stays"), F.count(F.lit(1)).alias("rows")).filter("not stays or rows > 1")
    each = cut(each, "dedup-touched")
    own, key, text = positional(docs), at(docs, id_col), at(docs, text_col)
    untouched, others = apart(own, key, each.select("_keep"))
    others = others.withColumn("_sha", F.sha2(without_blanks(F.coalesce(text, F.lit(""))), 256))
    gone = each.filter("not stays")
    stay = others.join(gone, others[key].eqNullSafe(gone["_keep"]) & (others["_sha"] == gone["_its"]), "left_anti")
    if each.filter("stays").take(1):
        stay = stay.dropDuplicates([key, "_sha"])
    return renamed(untouched.unionByName(stay.drop("_sha")), docs)
