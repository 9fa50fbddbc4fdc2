"""Index of stored keys, so that a micro-batch opens only the files that may hold its keys.

Small recent batches keep their keys as they are; there are at most ``fan`` of them.  Merged batches deal
their keys into parts by hash, each with a Bloom filter: a key belongs to one block of 32,768 bits of its
part's filter and sets HASHES bits there.  A lookup joins the batch's keys with just those blocks and
then opens only parts in which some key has all its bits set.  Filters take BITS bits per stored key,
a fortieth of the keys themselves; a part is opened without need for about one key in a hundred.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.sources.batches import FAN, BatchTable, covers

PART_KEYS = 1_000_000
BITS, HASHES = 12, 6
BLOCK_BITS = 8 * 4096

FILTERS = "entry string, part int, block int, bits binary"


def _place(key: Column, parts: Column, blocks: Column) -> tuple[Column, Column]:
    return F.pmod(F.xxhash64(key), parts).cast("int"), F.pmod(F.xxhash64(key, F.lit(HASHES)), blocks).cast("int")


def _bits(key: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(k)), F.lit(BLOCK_BITS)).cast("int") for k in range(HASHES)]


def _is_set(bits: Column, at: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.expr("1").bitwiseAND(F.call_function("shiftright", byte, at % 8)) == 1


class KeyIndex(BatchTable):
    """Keys of stored micro-batches, column ``key``."""

    def __init__(self, path: str, key: str = "tx_id", fan: int = FAN, part_keys: int = PART_KEYS) -> None:
        super().__init__(path, f"{key} string", fan, lambda stats: {"keys": sum(s["keys"] for s in stats)})
        self.key, self.part_keys = key, part_keys

    def _write_merged(self, rows: DataFrame, path: str, files: int) -> dict:
        n = rows.count()
        parts = -(-n // self.part_keys) or 1
        blocks = -(-(-(-n // parts) * BITS) // BLOCK_BITS) or 1
        part, block = _place(F.col(self.key), F.lit(parts), F.lit(blocks))
        rows = rows.withColumn("part", part)
        rows.repartition(parts, "part").sortWithinPartitions("part", self.key).write.partitionBy("part").parquet(path)
        entry = path.rsplit("/", 1)[1]
        filters = (
            rows.select("part", block.alias("block"), F.explode(F.array(*_bits(F.col(self.key)))).alias("bit"))
            .groupBy("part", "block").agg(F.bitmap_construct_agg(F.col("bit").cast("long")).alias("bits"))
            .select(F.lit(entry).alias("entry"), "part", "block", "bits")
        )
        # sorted, so that the rows a lookup needs lie in few row groups
        filters.coalesce(max(1, parts // 64)).sortWithinPartitions("part", "block").write.parquet(f"{path}/_filters")
        return {"parts": parts, "blocks": blocks}

    def paths(self, spark: SparkSession, keys: DataFrame, run: str | None = None, batch_id: int | None = None) -> list[str]:
        """Folders that may hold some of the keys, without those of the batch itself."""
        entries = self.entries(spark)
        own = [e for e in entries if run is not None and not e["tier"] and covers(e, run, batch_id)]
        recent = [f"{self.path}/{e['name']}" for e in entries if not e["tier"] and e not in own]
        merged = [e for e in entries if e["tier"]]
        if not merged:
            return recent
        filters = spark.read.schema(FILTERS).parquet(*[f"{self.path}/{e['name']}/_filters" for e in merged])
        each = F.explode(F.array(*[F.struct(F.lit(e["name"]).alias("entry"), F.lit(e["parts"]).alias("parts"), F.lit(e["blocks"]).alias("blocks"))
                                   for e in merged]))
        probes = keys.filter(F.col(self.key).isNotNull()).select(F.col(self.key).alias("key"), each.alias("e"))
        part, block = _place(F.col("key"), F.col("e.parts"), F.col("e.blocks"))
        probes = probes.select("key", F.col("e.entry").alias("entry"), part.alias("part"), block.alias("block"))
        hit = probes.join(filters, ["entry", "part", "block"])
        for at in _bits(F.col("key")):
            hit = hit.filter(_is_set(F.col("bits"), at))
        # at most one row per part of the index
        found = hit.select("entry", "part").distinct().collect()
        return recent + [f"{self.path}/{r['entry']}/part={r['part']}" for r in found]

    def absent(self, rows: DataFrame, run: str | None = None, batch_id: int | None = None) -> DataFrame:
        """The rows whose key is not stored, or only by the batch itself."""
        spark = rows.sparkSession
        paths = self.paths(spark, rows.select(self.key), run, batch_id)
        if not paths:
            return rows
        stored = spark.read.schema(f"{self.key} string").option("recursiveFileLookup", "true").parquet(*paths)
        return rows.join(stored, self.key, "left_anti")
