"""Shards by a two-pass external shuffle, with DataFrame functions alone.

1. A seeded hash of a row's id, its text's checksum and its place in the input scatters rows uniformly over buckets of about
   `bucket_bytes`; Spark's exchange writes them out by bucket.
2. Each bucket, which fits in memory by its size, is shuffled as a whole (Spark's shuffle() of an array is a seeded
   Fisher-Yates) and written with every row's place in it. Buckets are taken one at a time.
Buckets one after the other are a random order of all rows. Counts and sums by bucket, a table of one row for each bucket
(and shard), say where a bucket begins, so a row's shard and slot need no further shuffle of texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evispark.llm import shared

LAWS = ("bytes", "rows", "key")
BUCKET_BYTES = 64 << 20
#: Offsets are broadcast up to so many rows (16 MB); beyond, Spark joins them as it sees fit.
BROADCAST_ROWS = 500_000
#: Lists are gathered from sorted rows, one bucket after the other, not all buckets of a task at once.
OBJECT_HASH = "spark.sql.execution.useObjectHashAggregateExec"


def key_shard(key: Column, shards: int, seed: int) -> Column:
    """The shard with the highest hash of key and shard: with one shard more, rows move only into the new one."""
    each = [F.struct(F.xxhash64(F.lit(seed), F.lit(s), key.isNull(), key).alias("hash"), F.lit(s).alias("shard")) for s in range(shards)]
    return F.greatest(*each)["shard"] if shards > 1 else F.lit(0)


def size_of(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def shuffled(docs: DataFrame, seed: int, bucket_bytes: int, inner: dict[str, Column], id_col: str, text_col: str) -> DataFrame:
    """A written table (bucket, place, size, doc, *inner) of all rows: both passes. doc is the whole row, place its number in
    the bucket; inner may be windows by bucket, which need no further exchange."""
    spark = docs.sparkSession
    text = F.col(f"`{text_col}`")
    total = docs.agg(F.sum(size_of(text))).first()[0] or 0
    buckets = max(-(-total // bucket_bytes), shared.partitions(spark))
    mark = F.xxhash64(F.lit(seed), F.col(f"`{id_col}`").isNull(), F.col(f"`{id_col}`"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")), F.monotonically_increasing_id())
    marked = docs.select(mark.alias("mark"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))
    scattered = marked.withColumn("bucket", F.pmod("mark", F.lit(buckets))).repartition("bucket").sortWithinPartitions("bucket", "mark")
    lists = scattered.groupBy("bucket").agg(F.collect_list("doc").alias("docs"))
    mixed = lists.select("bucket", F.posexplode(F.shuffle("docs", F.lit(seed))).alias("place", "doc"))
    rows = mixed.select("bucket", F.col("place").cast("long").alias("place"), size_of(F.col("doc").getField(text_col)).alias("size"), "doc")
    for name, value in inner.items():
        rows = rows.withColumn(name, value)
    with shared.setting(spark, OBJECT_HASH, "false"):
        return shared.written(rows, "shuffled")


def sharded(docs: DataFrame, shards: int = 8, law: str = "rows", seed: int = 13, bucket_bytes: int = BUCKET_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, size, law, shard, slot, grown_shard) of every row, in random order within and over shards.

    law `rows`: counts of shards are at most one apart. `bytes`: the order is cut where the sum of sizes passes each shard's
    share, so sizes differ by about one row's. `key`: id and number of shards decide; grown_shard is the one with one shard
    more. size is the text's UTF-8 bytes plus 1; slot counts from 0 in each shard without gaps.

    Null texts have a size of 1, null ids are ids like others, repeated rows are placed each, a text of over bucket_bytes only
    makes its own bucket larger. Columns are fields of doc, so their names can't clash. An empty table gives no rows. The same
    files, seed and sizes give the same order again; an input that is no table should be written first.
    """
    if law not in LAWS or shards < 1:
        raise ValueError(f"law is one of {LAWS}, and shards at least 1")
    grown = F.lit(None).cast("int")
    if law == "rows":
        rows = shuffled(docs, seed, bucket_bytes, {}, id_col, text_col)
        at = _since(rows, {"_rows": F.count("*")}, ["bucket"]).withColumn("_at", F.col("_rows") + F.col("place"))
        shard, slot = F.pmod("_at", F.lit(shards)), F.expr(f"_at div {shards}L")
    elif law == "bytes":
        before = F.expr("sum(size) over (partition by bucket order by place rows unbounded preceding) - size")
        rows = shuffled(docs, seed, bucket_bytes, {"_before": before}, id_col, text_col)
        total = rows.agg(F.sum("size")).first()[0] or 1
        at = _since(rows, {"_rows": F.count("*"), "_bytes": F.sum("size")}, ["bucket"])
        at = at.withColumn("_at", F.expr(f"cast((_bytes + _before) * {shards}BD div {total}BD as long)"))
        first = dict(map(tuple, at.groupBy("_at").agg(F.min(F.col("_rows") + F.col("place"))).collect()))  # a row for each shard
        starts = F.create_map(*(F.lit(x) for pair in sorted(first.items()) for x in pair)) if first else F.create_map(F.lit(0), F.lit(0))
        shard, slot = F.col("_at"), F.col("_rows") + F.col("place") - starts[F.col("_at")]
    else:
        key = F.col("doc").getField(id_col)
        inner = {"_shard": key_shard(key, shards, seed), "_in": F.expr("row_number() over (partition by bucket, _shard order by place) - 1").cast("long")}
        rows = shuffled(docs, seed, bucket_bytes, inner, id_col, text_col)
        at = _since(rows, {"_rows": F.count("*")}, ["bucket", "_shard"])
        shard, slot, grown = F.col("_shard"), F.col("_rows") + F.col("_in"), key_shard(key, shards + 1, seed)
    return at.select("doc", "size", F.lit(law).alias("law"), shard.cast("int").alias("shard"), slot.cast("long").alias("slot"), grown.alias("grown_shard"))


def _since(rows: DataFrame, sums: dict[str, Column], keys: list[str]) -> DataFrame:
    """Rows with the sums over all earlier buckets (of their shard): from a table of one row for each bucket and shard."""
    counts = rows.groupBy(*keys).agg(*(F.coalesce(x, F.lit(0)).alias(c) for c, x in sums.items()))
    by = "".join(f"partition by {c} " for c in keys[1:])
    earlier = [F.expr(f"sum({c}) over ({by}order by bucket rows unbounded preceding) - {c}").cast("long").alias(c) for c in sums]
    starts = shared.written(counts.select(*keys, *earlier), "bucket_starts")
    small = starts.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(starts) if small else starts, keys)


def write_shards(rows: DataFrame, path: str) -> None:
    """Write sharded() rows as Parquet below path/shard=N: files of one task follow each other by slot. Columns slot, doc."""
    ranged = rows.select("shard", "slot", "doc").repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ranged.write.partitionBy("shard").parquet(path)
