"""Sharding by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a prime-sized table (a start and a step from hashes of its
name, so the order visits every slot). Shards take turns claiming their next free slot until the table is full; the
shares differ by one slot at most, and a shard that leaves or joins moves few other slots. A row's key is hashed to a
slot, and one join with the broadcast table (as many rows as slots, a fixed number) places it, with built-in functions only.

Defined results: a NULL key falls back to the other given columns, and to the empty text when all are NULL; equal
keys go to one shard; every row keeps its columns; an empty table stays empty.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A prime, about 250 slots for each of 64 shards.
SLOTS = 16381
MAX_SLOTS = 1_000_003


def _number(name: str, purpose: str) -> int:
    return int(hashlib.md5(f"{purpose}:{name}".encode()).hexdigest()[:15], 16)


def fill_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """The index of the shard that owns each slot."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be named, each once")
    if not len(shards) <= slots <= MAX_SLOTS or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)) or slots < 2:
        raise ValueError("the number of slots must be a prime, at least as large as the number of shards")
    start = [_number(s, "start") % slots for s in shards]
    step = [_number(s, "step") % (slots - 1) + 1 for s in shards]
    owner, asked, free = [-1] * slots, [0] * len(shards), slots
    while True:
        for n in range(len(shards)):
            while True:
                slot = (start[n] + asked[n] * step[n]) % slots
                asked[n] += 1
                if owner[slot] < 0:
                    break
            owner[slot] = n
            free -= 1
            if not free:
                return owner


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a key: the first 32 bits of its MD5, modulo the number of slots."""
    return F.pmod(F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long"), F.lit(slots))


def place(docs: DataFrame, shards: list[str], key: str = "doc_id", fallback: tuple[str, ...] = ("text",), slots: int = SLOTS) -> DataFrame:
    """The input's columns as struct ``row`` with ``slot`` and ``shard``."""
    owners = ",".join(map(str, fill_table(shards, slots)))
    table = docs.sparkSession.range(1).select(F.posexplode(F.split(F.lit(owners), ",")).alias("slot", "owner")).select(
        F.col("slot").cast("long").alias("slot"), F.element_at(F.array(*[F.lit(s) for s in shards]), F.col("owner").cast("int") + 1).alias("shard"))
    own = F.coalesce(*[F.col(c).cast("string") for c in (key, *fallback)], F.lit(""))
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), slot_of(own, slots).alias("slot"))
    return rows.join(F.broadcast(table), "slot").select("row", "slot", "shard")
