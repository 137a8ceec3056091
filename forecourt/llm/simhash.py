"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two 64-bit fingerprints at most ``2 * half`` bits apart have a common variant at
most ``half`` bits from either.  Every fingerprint emits all its variants; the
variants are shuffled, and fingerprints that meet on one are linked: being within
``half`` bits of the same variant they are within ``2 * half`` of each other, so
one link from each to the smallest of them says all, however many they are (at
most as many as the ball has points).

With 2,081 variants each (half = 2), emission is what costs.  Before it, a filter
without loss removes fingerprints that have no partner: of three blocks of the 64
bits, partners within 4 bits agree within 2 bits on some two blocks, so they share
a variant within 1 bit there (132 keys instead of 2,081).  Only fingerprints that
meet another one on such a key go on.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecourt.llm.common import keyed_text, map_batches, set_bits, staged, unused, with_bits
from forecourt.llm.components import connected_components

SHINGLE_WORDS = 4
HALF = 2            # half of the radius of 4 bits
SEED = 42
_BLOCKS = ((0, 22), (22, 43), (43, 64))


def fingerprint(text: str | None, shingle: int = SHINGLE_WORDS) -> int:
    """Bits set in over half of the shingles' 64-bit hashes; repeats count."""
    import xxhash

    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(b" ".join(words), SEED)
    line = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    hashes = np.fromiter((digest(line[a:b], SEED) for a, b in
                          zip(starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())),
                         dtype="<u8", count=len(words) - shingle + 1)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = hashes[at:at + (1 << 15)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << int(i) for i in np.flatnonzero(2 * ones > len(hashes)))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a long).  Null and wordless texts: zero."""
    def run(cols: dict[str, list]) -> dict[str, list]:
        return {"doc_id": cols["doc_id"], "fp": [_signed(fingerprint(t, shingle)) for t in cols["text"]]}

    return map_batches(keyed_text(docs, id_col, text_col), run, "doc_id long, fp long")


def ball_masks(half: int = HALF, bits: tuple[int, ...] = tuple(range(64))) -> list[int]:
    """Differences to all points at most ``half`` of ``bits`` away, zero included."""
    return [_signed(sum(1 << b for b in at)) for n in range(half + 1) for at in combinations(bits, n)]


def _variants(column: str, masks: list[int]) -> F.Column:
    return F.explode(F.transform(F.lit(np.array(masks, dtype=np.int64)), lambda m: F.col(column).bitwiseXOR(m)))


def _projected(fps: DataFrame) -> DataFrame:
    """``fp, key``: each fingerprint with its variants within a bit on two of the blocks.
    In a key the dropped block holds the number of the projection."""
    keys = None
    for k, (a, b) in enumerate(_BLOCKS):
        kept = tuple(i for i in range(64) if not a <= i < b)
        base = F.col("fp").bitwiseAND(F.lit(_signed(sum(1 << i for i in kept)))).bitwiseOR(F.lit(_signed(k << a)))
        part = fps.select("fp", base.alias("base")).select("fp", _variants("base", ball_masks(1, kept)).alias("key"))
        keys = part if keys is None else keys.unionAll(part)
    return keys


def _with_key(fps: DataFrame, wanted: DataFrame) -> DataFrame:
    """``fp, key`` of :func:`_projected` for the keys in ``wanted``.

    A bit map of fixed size goes to the tasks, so that nearly all other keys are left
    out before the join instead of being shuffled for it.
    """
    folded = F.col("key").bitwiseXOR(F.shiftrightunsigned("key", 22)).bitwiseXOR(F.shiftrightunsigned("key", 43))
    bits = fps.sparkSession.sparkContext.broadcast(set_bits(wanted.select(folded.alias("h"))))
    masks, tags, flips = [], [], []
    for k, (a, b) in enumerate(_BLOCKS):
        kept = tuple(i for i in range(64) if not a <= i < b)
        masks.append(sum(1 << i for i in kept))
        tags.append(k << a)
        flips.append(np.array(ball_masks(1, kept), dtype=np.int64).view(np.uint64))

    def run(cols: dict[str, list]) -> dict[str, np.ndarray]:
        fp = np.array(cols["fp"], dtype=np.int64).view(np.uint64)[:, None]
        keys = np.concatenate([(fp & np.uint64(m) | np.uint64(t)) ^ f for m, t, f in zip(masks, tags, flips)], axis=1)
        h = keys ^ keys >> np.uint64(22) ^ keys >> np.uint64(43)
        row, col = np.nonzero(with_bits(bits.value, h))
        return {"fp": fp[row, 0].view(np.int64), "key": keys[row, col].view(np.int64)}

    return map_batches(fps.select("fp"), run, "fp long, key long", rows=4096).join(wanted, "key", "left_semi")


def with_partners(fps: DataFrame) -> DataFrame:
    """``fp`` of the distinct fingerprints that meet another one on two of the
    three blocks, within one bit of each (for ``half = 2``)."""
    # two ends suffice where two meet; the rare larger meetings are joined back
    met = _projected(fps).groupBy("key").agg(F.min("fp").alias("a"), F.max("fp").alias("b"), F.count("*").alias("n"))
    met, _ = staged(met.filter("n > 1"), "simhash-met")
    ends = met.select(F.explode(F.array("a", "b")).alias("fp"))
    between = _with_key(fps, met.filter("n > 2").select("key")).select("fp")
    return ends.unionAll(between).distinct()


def ball_links(fps: DataFrame, half: int = HALF) -> DataFrame:
    """``src, dst``: each fingerprint with the smallest of those it meets on a variant."""
    points = fps.select("fp", _variants("fp", ball_masks(half)).alias("variant"))
    least = F.min("fp").over(Window.partitionBy("variant"))  # at most len(ball_masks) fingerprints each
    return points.select("fp", least.alias("least")).filter("fp <> least").distinct().select(
        F.col("fp").alias("src"), F.col("least").alias("dst"))


def _grouped(each: DataFrame) -> DataFrame:
    """``fp, first, component`` of the different fingerprints of ``each`` (``doc_id, fp``);
    ``first`` is the smallest ``doc_id`` with the fingerprint."""
    nodes, _ = staged(each.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-nodes")
    near, _ = staged(with_partners(nodes), "simhash-near")
    groups = connected_components(ball_links(near))
    return nodes.join(groups, nodes.fp == groups.node, "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE_WORDS) -> DataFrame:
    """Per row of ``docs``: ``doc_id, fingerprint`` (16 hex digits), ``component_id``.

    ``component_id`` is the smallest ``doc_id`` reachable over links of at most 4
    differing bits, the document's own included.  Copies share a fingerprint and
    are one node, whatever their number.  Texts without words have fingerprint
    zero and are linked like any other.  A null ``doc_id`` names nothing: its row
    is a node of the graph, but never the smallest (null if all are null).
    """
    each, _ = staged(fingerprints(docs, id_col, text_col, shingle), "simhash-fingerprints")
    named = _grouped(each)
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    by_fp = named.join(least, "component").select(F.col("fp").alias("of"), "component_id")
    return each.join(by_fp, each.fp == by_fp.of).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near duplicates: that of the smallest id,
    and of several rows with this id that of the smallest text (nulls first).  The row is
    chosen by group, not by id: rows that share an id, or have none, are told apart by
    their text.  A null id comes after all others."""
    group, key, h1, h2, row = (unused(docs, n) for n in ("group", "group_id", "group_h1", "group_h2", "row"))
    text = F.col(text_col).cast("string")
    marks = F.xxhash64(text), F.xxhash64(F.lit(1), text)

    def prints(cols: dict[str, list]) -> dict[str, list]:
        return {n: cols[n] for n in ("doc_id", "h1", "h2")} | {"fp": [_signed(fingerprint(t)) for t in cols["text"]]}

    each = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"),
                       marks[0].alias("h1"), marks[1].alias("h2"))
    each, _ = staged(map_batches(each, prints, "doc_id long, h1 long, h2 long, fp long"), "simhash-fingerprints")
    named, _ = staged(_grouped(each), "simhash-groups")
    least = named.groupBy("component").agg(F.min("first").alias("least"))
    of = named.join(least, "component").select(F.col("fp").alias("of"), "component", "least")
    chosen = (each.distinct().join(of, F.col("fp") == F.col("of")).filter(F.col("doc_id").eqNullSafe(F.col("least")))
              .select(F.col("component").alias(group), F.col("doc_id").alias(key), F.col("h1").alias(h1), F.col("h2").alias(h2)))
    rows = docs.join(chosen, docs[id_col].cast("long").eqNullSafe(F.col(key))
                     & (marks[0] == F.col(h1)) & (marks[1] == F.col(h2)))
    order = Window.partitionBy(group).orderBy(text_col)
    return rows.withColumn(row, F.row_number().over(order)).filter(F.col(row) == 1).select(docs.columns)
