"""Trie of the conversations' common beginnings, kept as double arrays.

A conversation is the sequence of its turns' digests.  All sequences are sorted by
range on their first turns, so that a task holds neighbours, and cut into packs of bounded
size.  A pack is a prefix shard: it numbers its turns densely, packs its trie into
BASE and CHECK arrays (:class:`DoubleArray`) and walks every sequence through them,
adding up the nodes' members.

Packs beside each other may share nodes, but only such as begin like the first or the
last sequence of a pack.  Those upper nodes come out of every pack that has them and
are merged over all packs by the digest of their path; all other nodes are final at
once.  What a shared node was counted too often below its ancestors is taken back
by sums over the ancestors 1, 2, 4, .. steps up: as many small joins as the deepest
shared node has binary digits.

A very common sequence fills several packs of its own, so no task holds a group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import staged
from forecourt.session import drop_path

RANGE_TURNS = 4        # of a sequence, by which sequences are dealt to tasks
PACK_TURNS = 100_000   # turns of different sequences, plus ids, in a pack; one sequence may be longer

_NODE = ("pack long, path binary, parent binary, shared boolean, depth long, conv_id long, parent_conv_id long, n long, "
         "words long, children long, leaves long, used long, once long, ends string, ups array<binary>, "
         "first long, ids string")


class DoubleArray:
    """A trie over sequences of the numbers 0 .. n-1 in two integer arrays.

    The child of slot ``s`` by number ``c`` is slot ``base[s] + c`` if its ``check`` is
    ``s``.  Slot 0 is the root.  A base may be negative; every slot but unused
    ones stands for one prefix.
    """

    def __init__(self, sequences: list[list[int]]):
        """``sequences`` must be sorted and different."""
        self.base, self.check, self.order = [0], [0], [0]
        self._free = 1                       # no unused slot before it
        todo = [(0, 0, len(sequences), 0)]   # slot, sequences lo..hi begin with its prefix, depth
        while todo:
            slot, lo, hi, depth = todo.pop()
            if lo < hi and len(sequences[lo]) == depth:
                lo += 1                      # the one that ends here
            groups = []
            while lo < hi:
                symbol, end = sequences[lo][depth], lo + 1
                if sequences[hi - 1][depth] == symbol:
                    end = hi
                while end < hi and sequences[end][depth] == symbol:
                    end += 1
                groups.append((symbol, lo, end))
                lo = end
            if groups:
                symbols = [g[0] for g in groups]
                base = self.base[slot] = self._room(symbols)
                for symbol, a, b in groups:
                    self.check[base + symbol] = slot
                    self.order.append(base + symbol)
                    todo.append((base + symbol, a, b, depth + 1))

    def _room(self, symbols: list[int], tries: int = 32) -> int:
        """A base that puts all ``symbols`` on unused slots: near the front, or past the end."""
        check = self.check
        while self._free < len(check) and check[self._free] >= 0:
            self._free += 1
        at = self._free
        far = at + 1024
        for _ in range(tries if len(symbols) > 1 else 1):
            while at < len(check) and check[at] >= 0:
                at += 1
            base = at - symbols[0]
            if at > far:
                base = len(check) - symbols[0]
            if all(base + c >= len(check) or check[base + c] < 0 for c in symbols):
                break
            at += 1
        else:
            base = len(check) - symbols[0]
        more = base + symbols[-1] + 1 - len(check)
        if more > 0:
            check.extend([-1] * more)
            self.base.extend([0] * more)
        return base

    def child(self, slot: int, symbol: int) -> int:
        """The child's slot, or -1."""
        at = self.base[slot] + symbol
        return at if 0 < at < len(self.check) and self.check[at] == slot else -1

    def walk(self, sequence: list[int]) -> list[int]:
        """Slots of the prefixes of ``sequence``, the root's first, as far as the trie goes."""
        slots = [0]
        for symbol in sequence:
            at = self.child(slots[-1], symbol)
            if at < 0:
                break
            slots.append(at)
        return slots


def _packed(pack: int, rows: list[tuple[tuple, tuple, list[int]]]) -> list[tuple]:
    """The nodes of one pack, and the ids of its first and last sequence.

    ``rows`` are different sequences as (digests, words, member ids), in range order.
    """
    number: dict[bytes, int] = {}
    coded = sorted((([number.setdefault(h, len(number)) for h in seq], k) for k, (seq, _, _) in enumerate(rows)))
    trie = DoubleArray([c for c, _ in coded])
    size = len(trie.check)
    n, words, depth, least = [0] * size, [0] * size, [0] * size, [None] * size
    path, ends = [b""] * size, [None] * size
    shared = bytearray(size)
    edges = {rows[0][0][:RANGE_TURNS], rows[-1][0][:RANGE_TURNS]}
    last = (rows[0][0], rows[-1][0])
    out = []
    for codes, k in coded:
        seq, counts, ids = rows[k]
        few = min(ids)
        slots = trie.walk(codes)
        for d, slot in enumerate(slots):
            if d and not depth[slot]:
                depth[slot], words[slot] = d, counts[d - 1]
                path[slot] = hashlib.md5(path[slots[d - 1]] + seq[d - 1]).digest()
            n[slot] += len(ids)
            if least[slot] is None or few < least[slot]:
                least[slot] = few
        for edge in edges:   # nodes that another pack may have too
            like = 0
            while like < min(len(edge), len(seq)) and edge[like] == seq[like]:
                like += 1
            to = len(seq) if like == RANGE_TURNS else like
            for slot in slots[:to + 1]:
                shared[slot] = 1
        ids.sort()
        if seq in last:      # its members may go on in another pack
            ends[slots[-1]] = ""
            out.append((pack, path[slots[-1]]) + (None,) * 13 + (ids[0], ",".join(map(str, ids))))
        else:
            ends[slots[-1]] = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    children, leaves, used, once = [0] * size, [0] * size, [0] * size, [0] * size
    for slot in reversed(trie.order):   # children come after their parents
        leaves[slot] += not children[slot]
        used[slot] += n[slot] * words[slot]
        once[slot] += words[slot]
        if slot:
            up = trie.check[slot]
            children[up] += 1
            leaves[up] += leaves[slot]
            used[up] += used[slot]
            once[up] += once[slot]
    none = hashlib.sha256(b"").hexdigest()
    for slot in trie.order:
        up, ups = trie.check[slot], None
        if shared[slot]:
            ups, at, steps, done = [], slot, 1, 0
            while steps <= depth[slot]:
                while done < steps:
                    at, done = trie.check[at], done + 1
                ups.append(path[at])
                steps *= 2
        out.append((pack, path[slot], path[up] if slot else None, bool(shared[slot]), depth[slot], least[slot],
                    least[up] if slot else None, n[slot], words[slot], children[slot], leaves[slot], used[slot], once[slot],
                    none if ends[slot] is None else ends[slot], ups, None, None))
    return out


def _pack_rows(sequences: DataFrame, pack_turns: int) -> DataFrame:
    schema = sequences.sparkSession.createDataFrame([], _NODE).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        want, task = to_arrow_schema(schema), TaskContext.get().partitionId() << 32
        rows: list[tuple[tuple, tuple, list[int]]] = []
        load = packs = 0

        def flush() -> Iterator[pa.RecordBatch]:
            found = _packed(task + packs, rows)
            for at in range(0, len(found), 20_000):
                cols = zip(*found[at:at + 20_000])
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, want)], schema=want)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256).to_pydict()
                for conv, turns, counts in zip(part["conv_id"], part["turns"], part["words"]):
                    turns = tuple(turns)
                    if load >= pack_turns:
                        yield from flush()
                        rows, load, packs = [], 0, packs + 1
                    if rows and rows[-1][0] == turns:
                        rows[-1][2].append(conv)
                        load += 1
                    else:
                        rows.append((turns, tuple(counts), [conv]))
                        load += len(turns) + 1
        if rows:
            yield from flush()

    return sequences.mapInArrow(run, schema)


def turn_sequences(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text") -> DataFrame:
    """``conv_id, turns (digests of role and text), words`` of every conversation, by turn.

    Null turns come first; rows with the same turn follow by role, then by digest.
    Null roles and texts are empty.  Rows without a conversation id belong to none.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    told = rows.select(F.col(id_col).cast("long").alias("conv_id"), F.struct(
        F.col(turn_col).cast("long").alias("turn"), role.alias("role"),
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("h"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words")).alias("t"))
    by_turn = told.filter("conv_id is not null").groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return by_turn.select("conv_id", F.col("t.h").alias("turns"), F.col("t.words").alias("words"))


def shared_openings(sequences: DataFrame, group: int = 20, spread: int = 4) -> DataFrame:
    """Every sequence c with its first h turns replaced by those of sequence ``c - c % group``
    (by none, if there is no such sequence), h being ``crc32(c) % spread``."""
    openings = sequences.filter(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("of"), F.slice("turns", 1, spread).alias("o_turns"), F.slice("words", 1, spread).alias("o_words"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % spread).cast("int")
    joined = sequences.withColumn("h", h).join(openings, F.col("conv_id") - F.col("conv_id") % group == F.col("of"), "left")

    def rebuilt(name: str) -> F.Column:
        kind = sequences.schema[name].dataType
        opening = F.coalesce(F.slice(f"o_{name}", F.lit(1), F.col("h")), F.array().cast(kind))
        return F.concat(opening, F.slice(name, F.col("h") + 1, F.greatest(F.size(name), F.lit(0)))).alias(name)

    return joined.select("conv_id", rebuilt("turns"), rebuilt("words"))


def _hash_in_order(chunks: DataFrame) -> DataFrame:
    """``path, ends``: digest of each path's ids, which come in chunks; a chunk at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = state = None
        for batch in batches:
            done = []
            for of, ids in zip(batch.column("path").to_pylist(), batch.column("ids").to_pylist()):
                if of == path:
                    state.update(b"," + ids.encode())
                else:
                    if state is not None:
                        done.append((path, state.hexdigest()))
                    path, state = of, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_pydict({"path": pa.array([d[0] for d in done], pa.binary()),
                                              "ends": pa.array([d[1] for d in done], pa.string())})
        if state is not None:
            yield pa.RecordBatch.from_pydict({"path": pa.array([path], pa.binary()), "ends": pa.array([state.hexdigest()], pa.string())})

    return (chunks.select("path", "first", "ids").repartition("path").sortWithinPartitions("path", "first")
            .mapInArrow(run, "path binary, ends string"))


def _fixes(merged: DataFrame) -> DataFrame:
    """``path, less_once, less_leaves``: what packs counted more than once in a shared
    node's subtree, the node itself included."""
    now, place = staged(merged.select("path", "ups", ((F.col("packs") - 1) * F.col("words")).alias("less_once"),
                                      (F.col("ends_packs") - (F.col("children") == 0).cast("long")).alias("less_leaves"))
                        .withColumn("any", (F.col("less_once") != 0) | (F.col("less_leaves") != 0)), "trie-fixes")
    deep = now.filter("any").agg(F.max(F.size("ups"))).first()[0] or 0
    for step in range(deep):
        up = F.get("ups", F.lit(step))
        sums = (now.filter(F.col("any") & up.isNotNull()).groupBy(up.alias("of"))
                .agg(F.sum("less_once").alias("o"), F.sum("less_leaves").alias("l")))
        joined = now.join(sums, F.col("path") == F.col("of"), "left").select(
            "path", "ups", (F.col("less_once") + F.coalesce("o", F.lit(0))).alias("less_once"),
            (F.col("less_leaves") + F.coalesce("l", F.lit(0))).alias("less_leaves"),
            (F.col("any") | F.col("of").isNotNull()).alias("any"))
        after, new_place = staged(joined, "trie-fixes")
        drop_path(now.sparkSession, place)
        now, place = after, new_place
    return now.select("path", "less_once", "less_leaves")


def prefix_trie(sequences: DataFrame, pack_turns: int = PACK_TURNS) -> DataFrame:
    """Every node of the trie of ``sequences`` (``conv_id, turns, words``).

    ``node_id, parent_id`` (digests of the paths), ``conv_id`` (smallest member), ``depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.  The
    turn of a node is turn number ``depth`` of conversation ``conv_id``.  No sequences, no nodes;
    otherwise the root is there, also if no sequence has a turn.
    """
    digests = F.transform(F.slice("turns", 1, RANGE_TURNS), lambda t: F.hex(t))
    keyed = sequences.select("conv_id", "turns", "words", F.array_join(digests, "").alias("begin"),
                             F.md5(F.array_join(F.transform("turns", lambda t: F.hex(t)), "")).alias("whole"))
    keyed, _ = staged(keyed, "trie-sequences")
    order = ["begin", "whole", "conv_id"]
    packed, _ = staged(_pack_rows(keyed.repartitionByRange(*order).sortWithinPartitions(*order), pack_turns), "trie-packs")

    nodes, common = packed.filter("not shared"), packed.filter("shared")
    merged = common.groupBy("path").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.sum("n").alias("n"), F.first("words").alias("words"), F.sum("children").alias("children"),
        F.sum("leaves").alias("leaves"), F.sum("used").alias("used"), F.sum("once").alias("once"),
        F.count("*").alias("packs"), F.count_if(F.col("children") == 0).alias("ends_packs"),
        F.max("ends").alias("ends"), F.min("ends").alias("open"), F.first("ups").alias("ups"))
    merged, _ = staged(merged, "trie-shared")
    none = F.sha2(F.lit(""), 256)
    closed = _hash_in_order(packed.filter("ids is not null")).withColumnsRenamed({"path": "e_path", "ends": "e_ends"})
    repeats = (merged.filter("packs > 1 and parent is not null").groupBy(F.col("parent").alias("r_path"))
               .agg(F.sum(F.col("packs") - 1).alias("twice")))
    fixes = _fixes(merged).withColumnRenamed("path", "f_path")
    ups = merged.select(F.col("path").alias("u_path"), F.col("conv_id").alias("u_conv"))
    upper = (merged.join(fixes, F.col("path") == F.col("f_path"))
             .join(repeats, F.col("path") == F.col("r_path"), "left")
             .join(closed, F.col("path") == F.col("e_path"), "left")
             .join(ups, F.col("parent") == F.col("u_path"), "left")
             .select("path", "parent", "conv_id", "depth", F.col("u_conv").alias("parent_conv_id"), F.col("n").alias("n_convs"),
                     (F.col("children") - F.coalesce("twice", F.lit(0))).alias("n_children"),
                     (F.col("leaves") - F.col("less_leaves")).alias("n_leaves"),
                     (F.col("used") - F.col("once") + F.col("less_once")).alias("saved_tokens"),
                     F.coalesce("e_ends", F.when(F.col("open") != none, F.col("open")).otherwise(F.col("ends"))).alias("ends_sha256")))

    # the smallest member of a shared parent is known after the merge; a row a pack keeps hot parents apart
    known = (common.select("pack", F.col("path").alias("p_path")).join(merged.select("path", F.col("conv_id").alias("p_conv")),
                                                                      F.col("p_path") == F.col("path"))
             .select(F.col("pack").alias("p_pack"), "p_path", "p_conv"))
    lower = (nodes.join(known, (F.col("pack") == F.col("p_pack")) & (F.col("parent") == F.col("p_path")), "left")
             .select("path", "parent", "conv_id", "depth", F.coalesce("p_conv", "parent_conv_id").alias("parent_conv_id"),
                     F.col("n").alias("n_convs"), F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
                     (F.col("used") - F.col("once")).alias("saved_tokens"), F.col("ends").alias("ends_sha256")))
    return upper.unionAll(lower).select(F.hex("path").alias("node_id"), F.hex("parent").alias("parent_id"), "conv_id", "depth",
                                        "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def conversation_trie(rows: DataFrame, pack_turns: int = PACK_TURNS) -> DataFrame:
    """:func:`prefix_trie` of ``conversations`` whose openings are shared."""
    whole, _ = staged(turn_sequences(rows), "trie-turns")
    return prefix_trie(shared_openings(whole), pack_turns).drop("node_id", "parent_id")
