"""Exact de-duplication through an extendible-hash index on shared files.

Texts are equal when they are identical after lower-casing A to Z.  One scan
gives each row a fingerprint (64-bit hash, SHA-256, row mark), written to the
shared folder.  The index over the hashes is extendible:

- *directory*: a bucket is a prefix of the hash, as long as its local depth.
  Buckets with more entries than ``capacity`` split, which doubles the
  directory where they lie; a bucket of one hash value cannot split and chains
  its entries instead.  The directory is counted level by level in Spark and
  stays a table.
- *owners*: a bucket is a range of hash values; tasks own ranges, so the index
  files hold sorted, disjoint ranges and a lookup reads the files it needs.
- *chains*: texts whose hash occurs more than once are brought together, equal
  copies of a task folded before the exchange, and compared byte by byte.
  Unequal texts of one hash become links of a chain, each an entry of its own.

Everything is a DataFrame expression.  An entry counts its copies and names the
row that stays, so a group of copies of any size is one row per task when it is
shuffled.

Defined cases: a null text counts as empty, and empty texts are copies of each
other; of equal texts the row with the largest id stays (null ids are smallest;
of rows that repeat this id, the last by row mark stays, so exactly one of a
group does); an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import col, staged, unstage
from ledgerline.session import scratch_path

CAPACITY = 1 << 14        # entries of a bucket before it splits
HASH_BITS = 64
BROADCAST_KEYS = 1 << 18  # repeated hashes that are sent to every task; more of them are not
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """A to Z in lower case, nothing else changed; null as empty."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def hashed(text: Column, bits: int = HASH_BITS) -> Column:
    """64-bit hash of which only the leading ``bits`` vary."""
    h = F.xxhash64(text)
    return h if bits == 64 else F.shiftleft(F.shiftright(h, 64 - bits), 64 - bits)


def slot(h: Column, depth: int) -> Column:
    """The leading ``depth`` bits of a hash."""
    return F.lit(0).cast("bigint") if depth == 0 else F.shiftrightunsigned(h, 64 - depth)


def directory(keys: DataFrame, entries: int, capacity: int = CAPACITY) -> DataFrame:
    """(depth, slot, n) of the buckets of the hashes ``keys`` (h, n): those that hold ``capacity`` entries or cannot split.

    Each round counts a level of slots at once and sums it up to all levels
    above; buckets still overfull there go into the next round.
    """
    spark = keys.sparkSession
    found: list[DataFrame] = []
    top, todo = 0, keys
    while True:
        depth = min(HASH_BITS, max(top + (8 if top else 0), ceil(log2(max(1, entries / capacity)))) + 4)
        counts = todo.groupBy(slot(F.col("h"), depth).alias("at")).agg(F.sum("n").alias("n"))
        levels = counts.select(F.explode(F.sequence(F.lit(top), F.lit(depth))).alias("depth"), "at", "n")
        # shifts take their distance from a column, which the functions API does not
        above = F.expr(f"case when depth = {depth} then at else shiftright(at, {depth} - depth) end")
        nodes, path = staged(levels.groupBy("depth", above.alias("slot")).agg(F.sum("n").alias("n")), "directory")
        over = nodes.where(F.col("n") > capacity)
        parents = over.select((F.col("depth") + 1).alias("depth"), F.col("slot").alias("parent"))
        fits = nodes.where((F.col("n") <= capacity) | (F.col("depth") == HASH_BITS))
        split = fits.where(F.col("depth") > top).withColumn("parent", F.shiftright("slot", 1)) \
            .join(parents, ["depth", "parent"], "left_semi").select("depth", "slot", "n")
        # in later rounds the top level was overfull in the round before
        found.append(split.unionByName(fits.where(F.col("depth") == top)) if top == 0 else split)
        open_ = over.where(F.col("depth") == depth).select(F.col("slot").alias("open"))
        if depth == HASH_BITS or open_.isEmpty():
            break
        todo = todo.join(open_, slot(F.col("h"), depth) == F.col("open"), "left_semi")
        top = depth
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def with_bucket(rows: DataFrame, buckets: DataFrame, shallow: int) -> DataFrame:
    """``rows`` with the bucket of their hash: its least hash, in unsigned order from the smallest long up.

    A directory slot of the shallowest bucket's depth lists the buckets within it.
    """
    wide = buckets.select(
        F.expr(f"shiftrightunsigned(slot, depth - {shallow})").alias("at"),
        F.expr("case when depth = 0 then 0L else shiftleft(slot, 64 - depth) end").alias("low"), "depth")
    held = rows.withColumn("at", slot(F.col("h"), shallow)).join(wide, "at")
    inside = F.expr("depth = 0 or shiftrightunsigned(h, 64 - depth) = shiftrightunsigned(low, 64 - depth)")
    return held.where(inside).drop("at").withColumn("bucket", F.col("low").bitwiseXOR(F.lit(-(1 << 63)))).drop("low")


def fingerprints(docs: DataFrame, id_col: str, text_col: str, bits: int) -> DataFrame:
    """(row, doc_id, h, sha): row marks are fixed once this is written."""
    text = docs.select(F.monotonically_increasing_id().alias("row"), col(id_col).cast("bigint").alias("doc_id"),
                       normalised(col(text_col)).alias("text"))
    return text.select("row", "doc_id", hashed(F.col("text"), bits).alias("h"), F.sha2("text", 256).alias("sha"))


def chains(docs: DataFrame, repeated: DataFrame, n_repeated: int, text_col: str, bits: int) -> DataFrame:
    """(h, sha, chain) of the unequal texts that share a hash, compared byte by byte.

    Grouping by the text compares its bytes; a task sends one copy of each
    text.  Two unequal texts of one hash and one SHA-256 would raise.
    """
    text = docs.select(normalised(col(text_col)).alias("text")).withColumn("h", hashed(F.col("text"), bits))
    if n_repeated <= BROADCAST_KEYS:  # 8 bytes each; beyond, all texts meet their equals
        text = text.join(F.broadcast(repeated.select("h")), "h", "left_semi")
    different = text.groupBy("h", "text").agg(F.lit(1).alias("one")).select("h", F.sha2("text", 256).alias("sha"))
    linked = different.groupBy("h", "sha").agg(F.count(F.lit(1)).alias("texts"))
    order = Window.partitionBy("h").orderBy("sha")
    linked = linked.withColumn("chain", F.row_number().over(order)).withColumn("links", F.count(F.lit(1)).over(Window.partitionBy("h")))
    broken = F.raise_error(F.lit("two unequal texts have the same SHA-256")).cast("int")
    return linked.where("links > 1 or texts > 1").select("h", "sha", F.when(F.col("texts") > 1, broken).otherwise(F.col("chain")).alias("chain"))


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                bits: int = HASH_BITS) -> tuple[DataFrame, DataFrame, list[str]]:
    """(rows with their chain, index entries, staged folders that the rows read).

    Entries (bucket, depth, h, chain, keep_id, keep_row, group_size, sha) are
    on shared files, sorted by bucket and hash; files hold disjoint ranges.
    """
    spark = docs.sparkSession
    rows, rows_path = staged(fingerprints(docs, id_col, text_col, bits), "fingerprints")
    keys, keys_path = staged(rows.groupBy("h").agg(F.count(F.lit(1)).alias("copies")), "hashes")
    repeated = keys.where("copies > 1")
    entries, n_repeated = keys.agg(F.count(F.lit(1)), F.count(F.when(F.col("copies") > 1, 1))).first()
    links, links_path = staged(chains(docs, repeated, n_repeated, text_col, bits), "chains")
    marked = rows.join(links, ["h", "sha"], "left").withColumn("chain", F.coalesce("chain", F.lit(0)))
    # hashes that occur once are entries as they are; the others fold their copies, by task first
    single = F.struct(F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"))
    grouped = marked.groupBy("h", "chain").agg(F.max(single).alias("keep"), F.count(F.lit(1)).alias("group_size"))
    grouped = grouped.select("h", "chain", "keep.keep_id", "keep.keep_row", "group_size")
    # a chained hash holds several entries, which count as such
    held = keys.select("h", F.lit(1).cast("bigint").alias("n"))
    extra = links.groupBy("h").agg((F.count(F.lit(1)) - 1).alias("n"))
    buckets, buckets_path = staged(directory(held.unionByName(extra), entries, capacity), "buckets")
    facts = buckets.agg(F.count(F.lit(1)), F.coalesce(F.min("depth"), F.lit(0))).first()
    placed = with_bucket(grouped, buckets, facts[1])
    path = scratch_path(spark, "hash-index")
    owners = max(1, min(facts[0], int(spark.conf.get("spark.sql.shuffle.partitions"))))
    placed.repartitionByRange(owners, "bucket").sortWithinPartitions("bucket", "h", "chain").write.parquet(path)
    unstage(spark, keys_path, buckets_path)
    return marked, spark.read.schema(placed.schema).parquet(path), [rows_path, links_path, path]


def lookup(index: DataFrame, docs: DataFrame, text_col: str = "text", bits: int = HASH_BITS) -> DataFrame:
    """``docs`` whose text's hash is in the index, with the entries (keep_id, group_size) that it may equal."""
    probe = docs.withColumn("h", hashed(normalised(col(text_col)), bits))
    return probe.join(index.select("h", "keep_id", "group_size"), "h").drop("h")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
          bits: int = HASH_BITS) -> DataFrame:
    """Every row's id, the id that stays of its equals, their number, whether this row is it, and the text's SHA-256."""
    rows, index, _ = build_index(docs, id_col, text_col, capacity, bits)
    entries = index.select("h", "chain", "keep_id", "keep_row", "group_size")
    return rows.join(entries, ["h", "chain"]).select(
        F.col("doc_id").alias(id_col), "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        F.col("sha").alias("text_sha256"))
