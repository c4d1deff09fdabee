"""Nested documents, their manifest, rank shards, stage rows, digests and upload decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.functions import json_values


def nested(parent: DataFrame, key: str, children: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Each parent row with an array of structs per child table, ordered by the named columns; no children give an empty array.

    A child is grouped once by the key, so an array holds the children of one parent.
    """
    out = parent
    for name, (child, order) in children.items():
        rest = [c for c in child.columns if c != key]
        first = [c for c in order if c in rest] + [c for c in rest if c not in order]
        rows = child.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*first))).alias(name))
        kind = rows.schema[name].dataType
        out = out.join(rows, key, "left").withColumn(name, F.coalesce(name, F.array().cast(kind)))
    return out


def as_json(df: DataFrame, key: str) -> DataFrame:
    """(key, document, sha256, bytes): each row as one JSON object that keeps nulls."""
    whole = F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"})
    return df.select(key, whole.alias("document")).select("*", F.sha2("document", 256).alias("sha256"), F.octet_length("document").cast("bigint").alias("bytes"))


def write_documents(documents: DataFrame, folder: str, shards: Column) -> None:
    """JSON lines in one folder per shard; a file per document would be one per row."""
    documents.select(shards.alias("shard"), "document").write.partitionBy("shard").text(folder)


def manifest(documents: DataFrame) -> DataFrame:
    """Count, total, least, mean and greatest size, and the projected size of a million documents."""
    b = F.col("bytes")
    return documents.agg(
        F.count("*").alias("n"), F.coalesce(F.sum(b), F.lit(0)).alias("total"), F.min(b).alias("least"), F.round(F.avg(b), 2).alias("mean"), F.max(b).alias("greatest"), F.round(F.avg(b) * 1000000, 0).alias("per_million")
    )


def ranked(df: DataFrame, key: str, folder: str) -> DataFrame:
    """``df`` with ``rank``, the place of its row in the order of ``key`` from 0, without gathering the rows in one task.

    Rows are dealt by ranges of the key and written, so that ranges stay what they are; a rank is the count of rows in earlier
    ranges plus the place within the range.  ``key`` is unique.
    """
    spark = df.sparkSession
    df.repartitionByRange(key).withColumn("_range", F.spark_partition_id()).write.parquet(folder)
    dealt = spark.read.parquet(folder)
    counts = dealt.groupBy("_range").agg(F.count("*").alias("_n"))
    before = counts.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(key)) - 1
    return dealt.join(F.broadcast(before), "_range").withColumn("rank", F.col("_before") + place).drop("_range", "_before")


def shard_index(with_rank: DataFrame, key: str, size: int) -> DataFrame:
    """(shard, first_key, last_key, n) of shards of ``size`` rows in order of the key."""
    return with_rank.groupBy(F.floor(F.col("rank") / size).cast("bigint").alias("shard")).agg(F.min(key).alias("first_key"), F.max(key).alias("last_key"), F.count("*").alias("n"))


def stage_rows(df: DataFrame, table: str, key: str, payload: Column) -> DataFrame:
    """Stage rows: table, key, canonical payload without NUL characters and its hash; a null payload stays null."""
    clean = F.replace(payload, F.lit("\\u0000"), F.lit("�"))
    return df.select(F.lit(table).alias("table_name"), F.col(key).cast("string").alias("source_record_key"), json_values.canonical_json(clean).alias("values_json")).withColumn("source_record_hash", F.sha2("values_json", 256))


def digest(files: DataFrame, path: str = "path", sha: str = "sha256", size: str = "bytes", groups: int = 256) -> DataFrame:
    """One digest over all files: lines of path, hash and size, sorted within groups by the hash of the path, then the groups' digests in order.

    A group holds about one ``groups``-th of the files; raise it with their number.
    """
    line = F.concat_ws("|", path, sha, F.col(size).cast("string"))
    group = F.pmod(F.crc32(path), F.lit(groups))
    parts = files.groupBy(group.alias("g")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "\n"), 256).alias("d"), F.count("*").alias("n"))
    folded = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("g", "d"))), lambda x: x["d"]), "\n")
    return parts.agg(F.sha2(folded, 256).alias("digest"), F.sum("n").alias("n"))


def upload_decision(known: DataFrame, local: DataFrame, key: str, cid: str = "cid", force: bool = False) -> DataFrame:
    """(key, decision): new, forced, unverifiable (known without an id), changed or skip; keys that are not local are left out."""
    k = known.select(key, F.col(cid).alias("_known"), F.lit(True).alias("_there"))
    decision = F.when(F.col("_there").isNull(), "new").when(F.lit(force), "forced").when(F.col("_known").isNull() | F.col(cid).isNull(), "unverifiable").when(F.col("_known") != F.col(cid), "changed").otherwise("skip")
    return local.join(k, key, "left").select(key, decision.alias("decision"))


def conflicting_ids(checkpoint: DataFrame, key: str, cid: str = "cid") -> DataFrame:
    """Keys of a checkpoint with more than one id."""
    return checkpoint.groupBy(key).agg(F.countDistinct(cid).alias("n")).where("n > 1")


def snapshot(rows: DataFrame, order: str) -> DataFrame:
    """One JSON array of few rows, ordered and with their nulls, for a published snapshot."""
    return rows.agg(F.to_json(F.sort_array(F.collect_list(F.struct(order, *[c for c in rows.columns if c != order]))), {"ignoreNullFields": "false"}).alias("snapshot"))
