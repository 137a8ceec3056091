"""Embedding near-duplicates by Euclidean p-stable hashing.

Vectors of length one with cosine c are sqrt(2 - 2c) apart.  In each of several
tables a vector's bucket is given by random projections, shifted and cut into steps
of one width; near vectors share a bucket of some table with high probability.
Vectors of a bucket are compared exactly, by cosine in double precision, as one
matrix product.  A pair that shares buckets of several tables counts in the first of
them, so no list of pairs is ever shuffled: only counts, and links from each vector to
the smallest of its set in a bucket.

Equal vectors are one node with a count.  Buckets with more than ``BLOCK`` vectors are
cut into chunks, and pairs of chunks are compared in tasks of their own.

A bucket's comparison is a matrix product in numpy over rows that Spark partitioned
and sorted by bucket; Spark's expressions have none.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import staged
from forecourt.llm.components import connected_components

COSINE = 0.95
TABLES, PROJECTIONS, WIDTH = 24, 10, 1.5
BLOCK = 2048
SEED = 20240229


@lru_cache(maxsize=8)
def _axes(dim: int, count: int, width: float) -> tuple[np.ndarray, np.ndarray]:
    """Directions and shifts, the same in every task."""
    rng = np.random.default_rng([SEED, dim])
    return rng.standard_normal((dim, count)), rng.uniform(0, width, count)


def bucket_codes(x: np.ndarray, tables: int = TABLES, projections: int = PROJECTIONS, width: float = WIDTH) -> np.ndarray:
    """The bucket (64 bits) of each row of ``x`` (length one) in each table."""
    axes, shifts = _axes(x.shape[1], tables * projections, width)
    steps = np.floor((x @ axes + shifts) / width).astype(np.int64).reshape(len(x), tables, projections).view(np.uint64)
    code = np.broadcast_to(np.arange(tables, dtype=np.uint64) + np.uint64(x.shape[1] << 32), (len(x), tables)).copy()
    for k in range(projections):
        code = (code ^ steps[:, :, k]) * np.uint64(0x9E3779B97F4A7C15)
        code ^= code >> np.uint64(29)
    return code.view(np.int64)


def _unit(rows: list) -> np.ndarray:
    x = np.array(rows, dtype=np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _coded(nodes: DataFrame, vectors: bool) -> DataFrame:
    """Each node once per table: ``bucket, table, node``, and with ``vectors`` its count,
    vector and codes."""
    more = ", n long, v array<double>, codes array<long>" if vectors else ""
    names = ["bucket", "tab", "node", "n", "v", "codes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                node, n, dims = (np.array(part.column(k).to_pylist(), dtype=np.int64) for k in range(3))
                rows = part.column(3).to_pylist()
                for dim in np.unique(dims):
                    at = np.flatnonzero(dims == dim)
                    raw = np.array([rows[k] for k in at], dtype=np.float64)
                    # one row at a time, so that a vector's codes do not depend on its neighbours
                    codes = np.vstack([bucket_codes(_unit([r])) for r in raw])
                    tables = codes.shape[1]
                    who = np.repeat(np.arange(len(at)), tables)
                    out = [pa.array(codes.ravel()), pa.array(np.tile(np.arange(tables, dtype=np.int32), len(at))),
                           pa.array(node[at][who])]
                    if vectors:
                        lists = lambda m: pa.ListArray.from_arrays(
                            pa.array(np.arange(len(who) + 1, dtype=np.int32) * m.shape[1]), pa.array(m[who].ravel()))
                        out += [pa.array(n[at][who]), lists(raw), lists(codes)]
                    yield pa.RecordBatch.from_arrays(out, names=names[:len(out)])

    return nodes.select("node", "n", F.size("v").cast("long").alias("dim"), "v").mapInArrow(
        run, "bucket long, tab int, node long" + more)


def _labels(i: np.ndarray, j: np.ndarray, size: int) -> np.ndarray:
    """For each of ``size`` things the smallest it is tied to by the pairs ``i, j``."""
    label = np.arange(size)
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compare(part: dict[str, np.ndarray], cosine: float) -> tuple[list, list]:
    """Counts and links in one bucket, or between two chunks of one."""
    chunk, other = part["chunk"], part["other"]
    x = part["v"] / np.linalg.norm(part["v"], axis=1, keepdims=True)
    a, b = np.flatnonzero(chunk <= other), np.flatnonzero(chunk >= other)
    i, j = np.nonzero(x[a] @ x[b].T >= cosine - 1e-9)
    i, j = a[i], b[j]
    same = chunk[0] == other[0]
    keep = i < j if same else np.ones(len(i), dtype=bool)
    i, j = i[keep], j[keep]
    keep = np.einsum("ij,ij->i", x[i], x[j]) >= cosine
    i, j = i[keep], j[keep]
    if not len(i):
        return [], []
    label = _labels(i, j, len(x))
    linked = np.flatnonzero(label != np.arange(len(x)))
    # the pair's own table is the first in which both have the same bucket
    first = np.concatenate([(part["codes"][i[k:k + 4096]] == part["codes"][j[k:k + 4096]]).argmax(axis=1)
                            for k in range(0, len(i), 4096)])
    own = first == part["tab"][0]
    count = np.bincount(i[own], part["n"][j[own]], len(x)) + np.bincount(j[own], part["n"][i[own]], len(x))
    node, has = part["node"], np.flatnonzero(count)
    return ([(node[k], int(count[k]), node[k]) for k in has],
            [(node[k], 0, node[label[k]]) for k in linked])


def _bucket_links(rows: DataFrame, cosine: float) -> DataFrame:
    """``node, n, other``: counts of a node's links (with itself as ``other``) and links to
    another node (with a count of 0), from rows sorted by bucket and chunks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush() -> list:
            whole = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            col = {k: whole.column(k).combine_chunks() for k in whole.schema.names}
            plain = {k: col[k].to_numpy(zero_copy_only=False) for k in ("bucket", "tab", "node", "n", "chunk", "other")}
            low, high = np.minimum(plain["chunk"], plain["other"]), np.maximum(plain["chunk"], plain["other"])
            change = np.flatnonzero((np.diff(plain["bucket"]) != 0) | (np.diff(low) != 0) | (np.diff(high) != 0)) + 1
            out = []
            offsets = col["v"].offsets.to_numpy()
            v, codes = col["v"].flatten().to_numpy(), col["codes"].flatten().to_numpy()
            tables = len(codes) // max(len(whole), 1)
            for s, e in zip([0, *change.tolist()], [*change.tolist(), len(whole)]):
                if e - s > 1:
                    part = {k: a[s:e] for k, a in plain.items()}
                    part["v"] = v[offsets[s]:offsets[e]].reshape(e - s, -1)
                    part["codes"] = codes[s * tables:e * tables].reshape(e - s, tables)
                    counts, links = _compare(part, cosine)
                    out += counts + links
            return out

        def keys(batch: pa.RecordBatch) -> np.ndarray:
            chunk, other = (batch.column(batch.schema.get_field_index(k)).to_numpy() for k in ("chunk", "other"))
            return np.stack((batch.column(0).to_numpy(), np.minimum(chunk, other), np.maximum(chunk, other)), axis=1)

        def given(found: list) -> pa.RecordBatch:
            cols = list(zip(*found)) if found else [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["node", "n", "other"])

        last = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            key = keys(batch)
            if held and (key[0] != last).any():
                yield given(flush())
            last = key[-1]
            before = np.flatnonzero((key != last).any(axis=1))
            at = int(before[-1]) + 1 if len(before) else 0
            if at:
                held.append(batch.slice(0, at))
                yield given(flush())
            held.append(batch.slice(at))
        if held:
            yield given(flush())

    return rows.mapInArrow(run, "node long, n long, other long")


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                 cosine: float = COSINE) -> DataFrame:
    """Per row: ``vec_id, n_links, component_id, kept``.

    ``n_links`` counts the other rows that were found with a cosine of at least
    ``cosine``; ``component_id`` is the smallest id reachable over links, the row's own
    included; ``kept`` says whether that is the row's.  Vectors that are null, empty, zero
    or hold null or non-finite numbers link with nothing; vectors of different lengths
    do not link.  Rows of the same vector link with each other.  A null id is never
    the smallest one.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.col(vector_col).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    # beyond this length squares overflow or vanish; brought near one by the largest number
    top = F.array_max(F.transform("v", lambda e: F.abs(e)))
    fit = F.col("v").isNotNull() & ~bad & (top > 0)
    scaled = F.transform("v", lambda e: e / top + 0.0)
    rows = rows.select("vec_id", F.when(F.coalesce(fit, F.lit(False)), F.when(
        (top > 1e100) | (top < 1e-100), scaled).otherwise(F.transform("v", lambda e: e + 0.0))).alias("v"))
    rows, _ = staged(rows.withColumn("h", F.xxhash64("v")), "vectors-rows")
    nodes = rows.filter("v is not null").groupBy("h", "v").agg(F.count("*").alias("n"), F.min("vec_id").alias("first"))
    nodes, _ = staged(nodes.withColumn("node", F.monotonically_increasing_id()), "vectors-nodes")
    sizes = _coded(nodes, False).groupBy("bucket").agg(F.count("*").alias("size"))
    sizes, _ = staged(sizes.filter("size > 1"), "vectors-buckets")
    chunks = F.ceil(F.col("size") / F.lit(BLOCK)).cast("int")
    mine = F.when(chunks > 1, F.pmod(F.xxhash64("node"), chunks).cast("int")).otherwise(0)
    full = _coded(nodes, True).join(sizes, "bucket").select(
        "bucket", "tab", "node", "n", "v", "codes", mine.alias("chunk"), F.explode(F.sequence(F.lit(0), chunks - 1)).alias("other"))
    low, high = F.least("chunk", "other"), F.greatest("chunk", "other")
    dealt = full.withColumns({"low": low, "high": high}).repartition("bucket", "low", "high").sortWithinPartitions(
        "bucket", "low", "high").drop("low", "high")
    found, _ = staged(_bucket_links(dealt, cosine).groupBy("node", "other").agg(F.sum("n").alias("n")), "vectors-links")
    groups = connected_components(found.filter("node <> other"), "node", "other")
    counts = found.filter("node = other").select(F.col("node").alias("counted"), F.col("n").alias("links"))
    named = nodes.join(groups.withColumnRenamed("node", "member"), F.col("node") == F.col("member"), "left").select(
        "h", "v", "n", "node", "first", F.coalesce("component", "node").alias("component"))
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    known = named.join(least, "component").join(counts, F.col("node") == F.col("counted"), "left").select(
        F.col("h").alias("kh"), F.col("v").alias("kv"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    out = rows.join(known, (rows.h == known.kh) & (rows.v == known.kv), "left")
    component = F.when(F.col("v").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
