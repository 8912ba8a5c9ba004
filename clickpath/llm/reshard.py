"""Minimum-cost-flow resharding: move the fewest bytes from old shards into new capacities.

The old shards' sizes and the new capacities make a transport problem whose
cost is the bytes that change shard (:mod:`clickpath.llm.flow`).  Each old
shard is a sequence of blocks (hash ranges of rows); its flow to each new
shard is a run of that sequence, cut at the row nearest to the flow's byte
offset.  Offsets come from block totals plus a running sum inside each block,
so no task holds a shard.  Equal rows are counted first and travel as runs of
copies, no longer than a block; the copies of a run are placed one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickpath.llm.columns import row_digest
from clickpath.llm.flow import min_cost_transport
from clickpath.llm.storage import materialize

NEW_SHARDS = 16
OLD_SHARDS = 12
BLOCK_ROWS = 20_000
MIN_BLOCKS = 64


def byte_size(text: Column) -> Column:
    """UTF-8 bytes plus one for the line feed (null: none)."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def old_shard_of(doc_id: Column, shards: int = OLD_SHARDS) -> Column:
    """The layout to be changed, where the table does not carry one: rows by a hash of their id."""
    return F.pmod(F.xxhash64(doc_id), F.lit(shards)).cast("int")


def solve_moves(old_bytes: dict[int, int], new_shards: int) -> tuple[list[int], dict[int, list[tuple[int, int]]]]:
    """(capacities, {old shard: [(new shard, bytes), ...] in the order of its rows}).

    Capacities differ by one byte at most and add up to all bytes.  Staying
    costs nothing, moving a byte costs one, so the flow moves the fewest bytes.
    """
    total = sum(old_bytes.values())
    capacity = [total // new_shards + (j < total % new_shards) for j in range(new_shards)]
    olds = sorted(old_bytes)
    cost = [[0 if i == j else 1 for j in range(new_shards)] for i in olds]
    flow = min_cost_transport([old_bytes[i] for i in olds], capacity, cost)
    moves = {}
    for k, i in enumerate(olds):
        runs = [(j, flow[k][j]) for j in range(new_shards) if flow[k][j]]
        moves[i] = sorted(runs, key=lambda r: (r[0] != i, r[0]))
    return capacity, moves


def reshard(docs: DataFrame, old_shard: Column | None = None, new_shards: int = NEW_SHARDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, digest_a, digest_b, old_shard, shard, slot.

    Shards 0 .. new_shards-1 have sizes as near equal as rows allow; ``slot``
    counts the rows of a shard from 0 without a gap.  A null text has size 1
    and the checksum of the empty text; null ids, repeated rows and ties are
    rows like any other.  An empty table gives no rows.  Reruns agree.  The
    digests are those of :func:`clickpath.llm.columns.row_digest`.
    """
    spark = docs.sparkSession
    old_shard = old_shard_of(F.col("doc_id")) if old_shard is None else old_shard
    text = F.coalesce(F.col("text"), F.lit(""))
    identity = ["doc_id", "size", "text_crc32", "digest_a", "digest_b", "old_shard"]
    a, b = row_digest(docs)
    sized = materialize(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), byte_size(F.col("text")).alias("size"),
                    F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), a.alias("digest_a"), b.alias("digest_b"),
                    old_shard.alias("old_shard")), "sized")
    olds = {r[0]: (r[1], r[2]) for r in sized.groupBy("old_shard").agg(F.sum("size"), F.count(F.lit(1))).collect()}
    if not olds:
        return sized.select("*", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    _, moves = solve_moves({i: b for i, (b, _) in olds.items()}, new_shards)
    largest = max(n for _, n in olds.values())
    blocks = max(MIN_BLOCKS, -(-largest // BLOCK_ROWS))
    most = -(-largest // blocks)

    # equal rows as runs of at most a mean block's rows; later runs of a row go to other blocks
    runs_of = F.floor((F.col("equal") - 1) / most).cast("long")
    rows = (sized.groupBy(*identity).agg(F.count(F.lit(1)).alias("equal"))
            .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), runs_of)))
            .withColumn("copies", F.least(F.lit(most).cast("long"), F.col("equal") - F.col("part") * most))
            .withColumn("key", F.xxhash64(F.lit("block"), "doc_id", "text_crc32"))
            .withColumn("key", F.when(F.col("part") == 0, F.col("key")).otherwise(F.xxhash64("key", "part")))
            .withColumn("block", F.pmod("key", F.lit(blocks)).cast("int")).withColumn("bytes", F.col("size") * F.col("copies")))
    in_block = (Window.partitionBy("old_shard", "block").orderBy("key", "doc_id", "text_crc32", "size", "digest_a", "digest_b", "part")
                .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    totals = rows.groupBy("old_shard", "block").agg(F.sum("bytes").alias("block_bytes"), F.sum("copies").alias("n"))
    before = Window.partitionBy("old_shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("old_shard", "block", F.coalesce(F.sum("block_bytes").over(before), F.lit(0)).alias("byte_base"),
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("row_base"))
    placed = (rows.withColumn("run", F.sum("bytes").over(in_block) - F.col("bytes"))
              .withColumn("rank", F.sum("copies").over(in_block) - F.col("copies"))
              .join(totals, ["old_shard", "block"])
              .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
              .withColumn("middle", F.col("byte_base") + F.col("run") + F.col("size") * F.col("copy") + F.col("size") / 2)
              .withColumn("rank", F.col("row_base") + F.col("rank") + F.col("copy")))
    cuts, end = [], {}
    for i, runs in moves.items():
        start = 0
        for j, amount in runs:
            cuts.append((i, j, start, start + amount))
            start += amount
    # old shards x new shards rows
    cut_rows = spark.createDataFrame(cuts, "old_shard int, shard int, low long, high long")
    placed = materialize(
        placed.join(F.broadcast(cut_rows), "old_shard").where("middle >= low and middle < high")
        .select(*identity, "shard", "rank"), "placed")
    pieces = placed.groupBy("shard", "old_shard").agg(F.count(F.lit(1)).alias("n"), F.min("rank").alias("first"))
    shift = {}
    for r in sorted(pieces.collect()):
        shift[r.shard, r.old_shard] = end.get(r.shard, 0) - r["first"]
        end[r.shard] = end.get(r.shard, 0) + r.n
    shifts = spark.createDataFrame([(j, i, s) for (j, i), s in shift.items()], "shard int, old_shard int, shift long")
    return (placed.join(F.broadcast(shifts), ["shard", "old_shard"])
            .select(*identity, "shard", (F.col("rank") + F.col("shift")).alias("slot")))


def rewrite_affected(docs: DataFrame, plan: DataFrame, out: str) -> list[int]:
    """Write the new files of the shards that gain or lose a row, under ``out/shard=N``; returns their numbers.

    ``plan`` is the result of :func:`reshard` for ``docs``.  Rows meet their
    plan by digest, and equal rows are written as often as planned, so ids may
    be null or repeated.  A shard that loses all its rows gets an empty file.
    Shards that keep exactly their rows are not touched.
    """
    digests = ["digest_a", "digest_b"]
    moved = plan.where("old_shard <> shard").select(F.explode(F.array("old_shard", "shard")).alias("shard"))
    affected = sorted(r[0] for r in moved.distinct().collect())
    plan = plan.where(F.col("shard").isin(affected))
    columns = [c for c in docs.columns if c != "shard"]
    # runs of at most BLOCK_ROWS equal rows, so that no task writes all copies of one row
    runs = (plan.groupBy(*digests, F.col("shard").alias("new_shard")).agg(F.count(F.lit(1)).alias("equal"))
            .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("equal") - 1) / BLOCK_ROWS).cast("long"))))
            .withColumn("copies", F.least(F.lit(BLOCK_ROWS).cast("long"), F.col("equal") - F.col("part") * BLOCK_ROWS)))
    a, b = row_digest(docs)
    (docs.select(a.alias("digest_a"), b.alias("digest_b"), *columns).dropDuplicates(digests)
     .join(runs.select(*digests, F.struct("new_shard", "part", "copies").alias("run")), digests)
     .repartition(F.col("run.new_shard"), F.pmod(F.xxhash64("digest_a", "run.part"), F.lit(8)))
     .select(*columns, F.col("run.new_shard").alias("shard"), F.explode(F.sequence(F.lit(1).cast("long"), "run.copies")).alias("copy")).drop("copy")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(out))
    filled = {r[0] for r in plan.select("shard").distinct().collect()}
    for j in affected:
        if j not in filled:
            docs.select(*columns).limit(0).write.mode("overwrite").parquet(f"{out.rstrip('/')}/shard={j}")
    return affected
