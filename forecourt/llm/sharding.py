"""Balanced label propagation: shards of equal size that keep linked documents together.

Documents start in the shard of their id's hash.  In each round every group of
linked documents names the shard that holds most of it, and its documents elsewhere
ask to move there.  A shard admits what its quota leaves: the share of askers that
fits, picked by a hash, so no shard's askers are ever sorted in one task.  What moves is
a piece, the documents of one group that started in one shard: the rounds run on
pieces, counted before they are shuffled, so a group of any size is a few rows.

Then the shards are made exactly even: documents in the order of their labels (the
groups of a label first) are numbered through, and the numbers cut into equal runs.
A cut parts at most one group, so at most ``n_shards - 1`` groups are parted more than
the rounds parted them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecourt.llm.common import staged
from forecourt.session import drop_path

SHARDS = 24
ROUNDS = 6
SLACK = 0.1   # by how much a shard may exceed its even part during the rounds


def _unit_hash(*columns) -> F.Column:
    """A number in [0, 1) by the hash of the columns."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) / F.lit(float(1 << 30))


def propagate(pieces: DataFrame, rows: int, loads: dict[int, int], n_shards: int = SHARDS, rounds: int = ROUNDS,
              slack: float = SLACK) -> DataFrame:
    """``pieces`` (``g1, g2, origin, shard, n``) with the shards of the last round.

    ``loads`` are the rows of each shard, linked or not; it holds ``n_shards`` numbers.
    """
    now, path = staged(pieces, "shards-pieces")
    quota = rows / n_shards * (1 + slack)
    group = Window.partitionBy("g1", "g2")
    for k in range(rounds):
        # the shards that a group should fill: the one that holds most of it, more if it needs them
        # with room for it, if it has documents in such a shard
        full = F.array(*[F.lit(k > 0 and loads.get(s, 0) >= quota) for s in range(n_shards)])
        held = now.groupBy("g1", "g2", "shard").agg(F.sum("n").alias("held")).select(
            "g1", "g2", "shard", F.ceil(F.sum("held").over(group) / F.lit(max(quota, 1.0))).cast("int").alias("needs"),
            # ties by a hash, so that no shard is asked more than others
            F.row_number().over(group.orderBy(F.element_at(full, F.col("shard") + 1), F.desc("held"), F.xxhash64("g1", "shard"), "shard")).alias("place"))
        held = held.filter("place <= needs")
        at_home = held.select("g1", "g2", "shard", F.lit(True).alias("home"))
        seats = held.select("g1", "g2", F.col("place").alias("seat"), F.col("shard").alias("goal"))
        needs = held.filter("place = 1").select("g1", "g2", "needs")
        asking = (now.join(needs, ["g1", "g2"]).join(at_home, ["g1", "g2", "shard"], "left").withColumn(
            "seat", F.pmod(F.xxhash64("g1", "g2", "origin"), F.col("needs")).cast("int") + 1).join(seats, ["g1", "g2", "seat"])
            .select("g1", "g2", "origin", "shard", "n", F.when(F.col("home"), F.col("shard")).otherwise(F.col("goal")).alias("goal")))
        asking, asking_path = staged(asking, "shards-asking")
        wishes = {(r.shard, r.goal): r.n for r in asking.filter("goal <> shard").groupBy("shard", "goal")
                  .agg(F.sum("n").alias("n")).collect()}   # n_shards squared at most
        share, room = admitted(wishes, loads, quota, n_shards)
        if not wishes or not any(share):
            drop_path(now.sparkSession, asking_path)
            break

        def known(numbers: list[float]) -> F.Column:
            return F.element_at(F.array(*map(F.lit, numbers)), F.col("goal") + 1)

        goes = ((F.col("goal") != F.col("shard")) & (F.col("n") <= known(room))
                & (_unit_hash("g1", "g2", "origin", F.lit(k)) < known(share)))
        after, new_path = staged(asking.select(
            "g1", "g2", "origin", F.when(goes, F.col("goal")).otherwise(F.col("shard")).alias("shard"),
            F.col("shard").alias("was"), "n"), "shards-pieces")
        moved = after.filter("shard <> was").groupBy("was", "shard").agg(F.sum("n").alias("n")).collect()
        for m in moved:
            loads[m.was] -= m.n
            loads[m.shard] = loads.get(m.shard, 0) + m.n
        for old in (path, asking_path):
            drop_path(now.sparkSession, old)
        now, path = after.drop("was"), new_path
    return now


def admitted(wishes: dict[tuple[int, int], int], loads: dict[int, int], quota: float,
             n_shards: int) -> tuple[list[float], list[float]]:
    """For each shard the share of its askers that fits, and the rows it has room for,
    given that other shards admit the shares of theirs."""
    share, room = [1.0] * n_shards, [0.0] * n_shards
    for _ in range(30):
        for s in range(n_shards):
            leaving = sum(n * share[b] for (a, b), n in wishes.items() if a == s)
            asked = sum(n for (_, b), n in wishes.items() if b == s)
            room[s] = max(0.0, quota - loads.get(s, 0) + leaving)
            share[s] = min(1.0, room[s] / asked) if asked else 0.0
    return share, room


def numbered(df: DataFrame, *order: str, label: str = "number") -> DataFrame:
    """``df`` with the place of each row in ``order``, from 0, without gaps.

    Rows are range-partitioned and sorted within partitions; a row's place is its place
    in the partition and the rows of the partitions before.  Only the number of rows of
    each partition meets in one place.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    kept, _ = staged(sorted_rows.withColumn("__at", F.monotonically_increasing_id()), "numbered")
    part, place = F.shiftright("__at", 33), F.col("__at").bitwiseAND((1 << 33) - 1)
    sizes = kept.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("__part", F.coalesce(before, F.lit(0)).alias("__before"))
    return (kept.withColumn("__part", part).join(F.broadcast(sizes), "__part")
            .withColumn(label, place + F.col("__before")).drop("__part", "__at", "__before"))


def shard_documents(docs: DataFrame, n_shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
                    rounds: int = ROUNDS, slack: float = SLACK) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot``: every row of ``docs`` in one of
    ``n_shards`` shards whose row counts differ by one at most.

    Documents with equal texts are linked (null texts with each other).  ``size`` is
    the UTF-8 length of the text (null: 0) plus 8, ``slot`` numbers a shard's rows
    from 0.  Rows with the same id and text are rows like others; null ids start in
    the shard of the null's hash.  An empty table gives no rows.
    """
    text = F.col(text_col).cast("string")
    slim = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("g1"), F.xxhash64(F.lit(1), text).alias("g2"),
        F.pmod(F.xxhash64(F.col(id_col).cast("long")), F.lit(n_shards)).cast("int").alias("origin"))
    slim, _ = staged(slim, "shards-documents")
    loads = {r.origin: r.n for r in slim.groupBy("origin").agg(F.count("*").alias("n")).collect()}  # n_shards rows
    rows = sum(loads.values())
    pieces, _ = staged(slim.groupBy("g1", "g2", "origin").agg(F.count("*").alias("n")), "shards-groups")
    groups = pieces.groupBy("g1", "g2").agg(F.count("*").alias("parts")).filter("parts > 1").select("g1", "g2")
    parted = pieces.join(groups, ["g1", "g2"], "left_semi").withColumn("shard", F.col("origin"))
    final = propagate(parted.select("g1", "g2", "origin", "shard", "n"), rows, loads, n_shards, rounds, slack)
    labelled = slim.join(final.select("g1", "g2", "origin", "shard"), ["g1", "g2", "origin"], "left").select(
        "doc_id", "size", "text_crc32", F.coalesce("shard", "origin").alias("label"),
        F.when(F.col("shard").isNull(), 1).otherwise(0).alias("alone"), "g1", "g2")
    placed = numbered(labelled, "label", "alone", "g1", "g2", "doc_id")
    # the first (rows % n_shards) shards hold one row more
    low, more = divmod(rows, n_shards)
    number, edge = F.col("number"), more * (low + 1)
    shard = F.when(number < edge, F.floor(number / F.lit(low + 1))).otherwise(
        more + F.floor((number - edge) / F.lit(max(low, 1)))).cast("int")
    begin = F.when(shard < more, shard * (low + 1)).otherwise(edge + (shard - more) * low)
    return placed.select("doc_id", "size", "text_crc32", shard.alias("shard"), (number - begin).cast("long").alias("slot"))


def sharding(docs: DataFrame) -> DataFrame:
    return shard_documents(docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
