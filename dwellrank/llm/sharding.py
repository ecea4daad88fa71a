"""Sharding over fixed virtual slots.

Every record hashes into one of thousands of slots for good. Bytes and rows are added up per slot, and a
versioned map says which shard a slot lies in. Rebalancing edits that map: slots leave shards that are too
full and go to the emptiest, all others stay where they are. Only the map is ever ordered or looped over;
it has one row per slot, so its size is a parameter and does not grow with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellrank.llm.common import whole_text
from dwellrank.session import pin, scratch_path

SLOTS = 8192
ROW_BYTES = 16  # what a row costs beside its text


def record_slot(slots: int = SLOTS) -> Column:
    """Slot of a record by its id and content: copies under different ids spread over all slots."""
    return F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(slots)).cast("int")


def sized_records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32 and the virtual slot of every row; texts do not go further."""
    return docs.select(
        "doc_id",
        (F.octet_length(whole_text()).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(whole_text().cast("binary")).alias("text_crc32"),
    ).withColumn("vslot", record_slot(slots))


def slot_totals(records: DataFrame) -> DataFrame:
    """vslot, bytes and rows; combined before the shuffle, at most one row per slot."""
    return records.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))


def first_map(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """The map to start from: slots dealt out in turn, whatever they hold."""
    return spark.range(0, slots, 1, 1).select(
        F.col("id").cast("int").alias("vslot"), F.pmod("id", F.lit(shards)).cast("int").alias("shard")
    )


def rebalanced(slot_map: DataFrame, totals: DataFrame, shards: int) -> DataFrame:
    """``slot_map`` edited so that shards hold nearly the same bytes.

    Largest slots first, a shard keeps its first slot and then those that fit under the fair share; what
    does not fit is given, largest first, to the shard with the fewest bytes. The fold below runs over one array with an entry per slot.
    """
    held = slot_map.join(totals, "vslot", "left").select("vslot", "shard", F.coalesce("bytes", F.lit(0)).alias("bytes"))
    state = held.agg(
        F.sum("bytes").alias("total"),
        # Sorted by size, largest first, then by slot.
        F.array_sort(F.collect_list(F.struct((-F.col("bytes")).alias("less"), "vslot", "shard"))).alias("slots"),
    ).withColumn("over", F.expr(f"filter(slots, s -> -s.less > total / {shards})"))
    # Slots above the mean fill a shard each; the fair share is that of the others.
    state = state.withColumn(
        "mean",
        F.expr(
            f"ceil((total + aggregate(over, 0L, (a, s) -> a + s.less)) / greatest({shards} - size(over), 1))"
        ),
    )
    empty = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda _: F.lit(0).cast("bigint"))

    def added(loads: Column, shard: Column, size: Column) -> Column:
        return F.transform(loads, lambda x, i: F.when(i == shard, x + size).otherwise(x))

    def keep_or_release(acc: Column, slot: Column) -> Column:
        size = -slot["less"]
        own = (slot["shard"] >= 0) & (slot["shard"] < shards)
        load = F.get(acc["loads"], slot["shard"])
        fits = own & ((load == 0) | (load + size <= F.coalesce(acc["mean"], F.lit(0))))
        return F.struct(
            F.when(fits, added(acc["loads"], slot["shard"], size)).otherwise(acc["loads"]).alias("loads"),
            acc["mean"].alias("mean"),
            F.when(fits, acc["loose"]).otherwise(F.concat(acc["loose"], F.array(slot))).alias("loose"),
        )

    def give_away(acc: Column, slot: Column) -> Column:
        size = -slot["less"]
        target = (F.array_position(acc["loads"], F.array_min(acc["loads"])) - 1).cast("int")
        return F.struct(
            added(acc["loads"], target, size).alias("loads"),
            F.concat(
                acc["moved"], F.array(F.struct(slot["vslot"].alias("vslot"), target.alias("shard")))
            ).alias("moved"),
        )

    nothing = F.filter("slots", lambda s: F.lit(False))
    kept = state.withColumn(
        "kept",
        F.aggregate(
            "slots",
            F.struct(empty.alias("loads"), F.col("mean").alias("mean"), nothing.alias("loose")),
            keep_or_release,
        ),
    )
    no_moves = F.transform(nothing, lambda s: F.struct(s["vslot"].alias("vslot"), s["shard"].alias("shard")))
    moved = kept.withColumn(
        "moved",
        F.aggregate(
            "kept.loose",
            F.struct(F.col("kept.loads").alias("loads"), no_moves.alias("moved")),
            give_away,
            lambda acc: acc["moved"],
        ),
    )
    edits = moved.select(F.explode("moved").alias("m")).select("m.vslot", F.col("m.shard").alias("to"))
    return slot_map.join(edits, "vslot", "left").select("vslot", F.coalesce("to", "shard").alias("shard"))


def store_map(slot_map: DataFrame, path: str, version: int) -> DataFrame:
    """Write one version of the map, a folder of its own, and read it back; a rerun replaces it."""
    slot_map.coalesce(1).write.mode("overwrite").parquet(f"{path}/version={version}")
    return load_map(slot_map.sparkSession, path, version)


def load_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema("vslot int, shard int").parquet(f"{path}/version={version}")


def assign(docs: DataFrame, shards: int, path: str | None = None, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, vslot, shard and the place of the row in its shard, ``position``.

    Sizes are UTF-8 bytes of the text (null: none) plus 16, and shards get nearly the same bytes: the map
    is built in turn as version 1 and edited into version 2 by the bytes found, both stored at ``path``
    (default: the shared scratch folder). Positions are gapless from 0 in each shard, in order of slot,
    doc_id, size and checksum; rows equal in all three take neighbouring places in any order. A null
    doc_id is an id of its own. An empty table gives no rows. The only shuffles of all rows move four
    numbers per row; a row goes with its slot, which holds about one row in ``slots`` of any large
    table. One record larger than the mean fills a shard of its own.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "slot-map")
    records = pin(sized_records(docs, slots), "sized")
    totals = pin(slot_totals(records), "slot-totals")
    first = store_map(first_map(spark, shards, slots), path, 1)
    placed = store_map(rebalanced(first, totals, shards), path, 2).join(totals, "vslot")
    # Rows in the slots of the same shard before this one: a window over one row per slot.
    before = placed.selectExpr(
        "vslot", "shard",
        "sum(rows) over (partition by shard order by vslot rows between unbounded preceding and current row) - rows as before",
    )
    numbered = records.selectExpr(
        "*", "row_number() over (partition by vslot order by doc_id, size, text_crc32) - 1 as within"
    )
    # One row per slot, and slots are a parameter: small enough to send to every executor.
    return numbered.join(F.broadcast(before), "vslot").selectExpr(
        "doc_id", "size", "text_crc32", "vslot", "shard", "before + within as position"
    )
