"""Sharding by a permutation-filled lookup table.

Each shard prefers the slots of a prime-sized table in an order of its own, offset + k * skip; shards
take turns claiming the next slot they prefer and that is still free, until the table is full, so each
gets nearly the same number of slots, and a shard more or less moves few others.  A row's slot is its
key's digest modulo the prime, its shard the slot's; the table, whose size is a parameter and not a
property of the data, is broadcast, so placement is one lookup and no row moves.

The table is filled from shard names alone, before any data is read.

Defined results: a null key has slot and shard null; equal keys, repeated rows too, have the same
shard; other columns stay as they are, except that `slot` and `shard` are replaced.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLOTS = 4_099


def digest(text: str) -> int:
    """The first 15 hexadecimal digits of MD5: 60 bits, as SQL functions give them too."""
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def lookup_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """The shard number that owns each slot."""
    if slots < 2 or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"{slots} slots: a prime is needed")
    if not 0 < len(shards) <= slots or len(set(shards)) < len(shards):
        raise ValueError("shards need distinct names, and no more of them than slots")
    offset = [digest(f"offset {s}") % slots for s in shards]
    skip = [digest(f"skip {s}") % (slots - 1) + 1 for s in shards]
    tried, owner, free = [0] * len(shards), [-1] * slots, slots
    while free:
        for n in range(min(len(shards), free)):
            while True:
                slot = (offset[n] + tried[n] * skip[n]) % slots
                tried[n] += 1
                if owner[slot] < 0:
                    break
            owner[slot] = n
            free -= 1
    return owner


def assign_shards(df: DataFrame, key: str, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """df with slot and shard (the shard's name)."""
    owner = lookup_table(shards, slots)
    table = df.sparkSession.createDataFrame([(slot, shards[n]) for slot, n in enumerate(owner)], "slot long, shard string")
    place = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 15), 16, 10).cast("long") % slots
    placed = df.drop("shard").withColumn("slot", place)
    return placed.join(F.broadcast(table), "slot", "left").select(*placed.columns, "shard")
