"""Placement of keys on shards by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table whose
size is prime: a start and a step, both from a hash of its name.  In turns each
shard claims its next free slot, a shard of weight w in w turns per round.  A
key goes to the shard that holds the slot of its hash.  The table has a fixed
number of rows, so it is broadcast, and placing a key takes constant time;
taking a shard away moves few keys but its own.

Null keys share the slot of the empty text.  Columns of the input named like
the added ones are replaced.  An empty table gives an empty result; no shards,
a repeated name or a weight below one is an error.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.functions.expr import fresh
from palimpsest.llm.common import hashed

#: Slots of the table; a prime well over a hundred times the usual number of shards.
SLOTS = 65537


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def fill(shards: dict[str, int], slots: int = SLOTS) -> list[str]:
    """The shard of every slot.  Depends on names and weights only, not on their order."""
    if not shards or len(shards) > slots or any(w < 1 for w in shards.values()):
        raise ValueError("give at least one shard, none lighter than 1, and no more shards than slots")
    if slots < 2 or any(slots % d == 0 for d in range(2, int(slots ** 0.5) + 1)):
        raise ValueError("the number of slots must be prime")
    names = sorted(shards)
    place = {s: _number(f"start|{s}") % slots for s in names}
    step = {s: _number(f"step|{s}") % (slots - 1) + 1 for s in names}
    owner: list[str | None] = [None] * slots
    left = slots
    while True:
        for name in names:
            for _ in range(shards[name]):
                while owner[place[name]] is not None:
                    place[name] = (place[name] + step[name]) % slots
                owner[place[name]] = name
                left -= 1
                if not left:
                    return owner


def lookup_table(spark: SparkSession, shards: dict[str, int], slots: int = SLOTS) -> DataFrame:
    return spark.createDataFrame(list(enumerate(fill(shards, slots))), "slot int, shard string")


def place(docs: DataFrame, key: str, shards: dict[str, int], slots: int = SLOTS) -> DataFrame:
    """``docs`` with the columns slot and shard.  No exchange of ``docs``."""
    table = lookup_table(docs.sparkSession, shards, slots)
    slot, shard = fresh(docs, "_slot"), fresh(docs, "_shard")
    rows = docs.withColumn(slot, (hashed(F.col(f"`{key}`")) % slots).cast("int"))
    own = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("slot", "shard")]
    return (rows.join(F.broadcast(table.withColumnsRenamed({"slot": slot, "shard": shard})), slot, "left")
            .select(*own, F.col(slot).alias("slot"), F.col(shard).alias("shard")))


def moved(docs: DataFrame, key: str, before: dict[str, int], after: dict[str, int], slots: int = SLOTS) -> DataFrame:
    """Rows whose shard changes from one set of shards to another: slot, shard, new_shard beside the key."""
    spark = docs.sparkSession
    new = lookup_table(spark, after, slots).withColumnRenamed("shard", "new_shard")
    placed = place(docs.select(key), key, before, slots)
    return placed.join(F.broadcast(new), "slot").where("shard <> new_shard").select(key, "slot", "shard", "new_shard")
