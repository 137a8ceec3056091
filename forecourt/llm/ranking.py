"""Ranked lexical search by an Aho-Corasick scan of the documents.

The terms of all items make one automaton, each term guarded by a blank at either
end; in a text whose other characters are blanks the automaton's hits are exactly
the occurrences of terms, and it counts them in one pass over the text.  There is
no index of the documents: a document's terms that no item holds are only counted.

The scan leaves the counts of each document (a few bytes a term).  Totals and
document frequencies are aggregated from them; then each task scores its documents
against all items and keeps the best of each item, and only those are shuffled.

Items are taken in blocks of bounded size, one scan a block, so what tasks are sent
is bounded whatever the number of items.  An item is never split.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from forecourt.llm.common import keyed_text, map_batches, staged

TOP = 20
BLOCK_BYTES = 8 << 20   # of different terms, summed over the items of a block
BLOCK_ITEMS = 2048

# ASCII letters and digits make terms, A-Z in lower case; so do all bytes of other characters.
_GUARDED = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128
                 else 32 for b in range(256))


def guarded(text: str | None) -> bytes:
    """The text with blanks for all that is in no term, and one at either end."""
    return b" " + text.encode().translate(_GUARDED) + b" " if text else b" "


@lru_cache(maxsize=2)
def _automaton(terms: tuple[str, ...]):
    """Automaton over ``terms``; a hit gives the term's number.  Kept by the worker."""
    import ahocorasick

    made = ahocorasick.Automaton()
    for i, term in enumerate(terms):
        made.add_word(f" {term} ", i)
    made.make_automaton()
    return made


def _counted(texts: list[str | None], terms: tuple[str, ...]) -> dict[str, list]:
    """Per text: number of all its terms, and numbers and counts of those in ``terms``."""
    made = _automaton(terms) if terms else None
    out: dict[str, list] = {"n": [], "ids": [], "tfs": []}
    for text in texts:
        line = guarded(text)
        out["n"].append(len(line.split()))
        found = Counter(i for _, i in made.iter(line.decode())) if made else {}
        out["ids"].append(list(found))
        out["tfs"].append(list(found.values()))
    return out


def term_counts(docs: DataFrame, terms: tuple[str, ...]) -> DataFrame:
    """``doc_id, tie, n, ids, tfs`` of every row: its number of terms, and for those
    of ``terms`` that occur in it their numbers and counts."""
    sent = docs.sparkSession.sparkContext.broadcast(terms)

    def run(cols: dict[str, list]) -> dict[str, list]:
        return {"doc_id": cols["doc_id"], "tie": cols["tie"], **_counted(cols["text"], sent.value)}

    return map_batches(docs, run, "doc_id long, tie long, n long, ids array<int>, tfs array<int>")


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item_id, term, times``: the terms of each item; rows that share an id are one item."""
    rows = items.select(F.col(id_col).cast("string").alias("item_id"), F.col(text_col).cast("string").alias("text"))

    def cut(cols: dict[str, list]) -> dict[str, list]:
        found = [(item, term.decode(), n) for item, text in zip(cols["item_id"], cols["text"])
                 for term, n in Counter(guarded(text).split()).items()]
        return {name: [f[k] for f in found] for k, name in enumerate(("item_id", "term", "times"))}

    return (map_batches(rows, cut, "item_id string, term string, times long")
            .groupBy("item_id", "term").agg(F.sum("times").alias("times")))


def blocks(terms: DataFrame, block_bytes: int = BLOCK_BYTES, block_items: int = BLOCK_ITEMS) -> tuple[DataFrame, int]:
    """``terms`` with the number of its item's ``block``, and how many blocks there are."""
    load = terms.groupBy("item_id").agg(F.sum(F.octet_length("term") + 16).alias("load"))
    total, items = load.agg(F.sum("load"), F.count("*")).first()
    n = max(1, math.ceil((total or 0) / block_bytes), math.ceil(items / block_items))
    return terms.withColumn("block", F.pmod(F.xxhash64(F.lit(1), "item_id"), F.lit(n))), n


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _best(counts: DataFrame, items: list, held: list[tuple[int, int, int]], weights: np.ndarray,
          n_docs: int, n_terms: int, top: int) -> DataFrame:
    """``item, score, doc_id, tie``: of each task the rows that may be among an item's ``top``.

    ``held`` lists (term, item, times), all of them numbers.
    """
    order = sorted(held)
    of_term = np.array([h[0] for h in order], dtype=np.int64)
    starts = np.searchsorted(of_term, np.arange(len(weights) + 1))
    sent = counts.sparkSession.sparkContext.broadcast(
        (starts, np.array([h[1] for h in order], dtype=np.int64), np.array([h[2] for h in order], dtype=np.int64), weights))
    n_items = len(items)
    schema = StructType([StructField("item", counts.schema["n"].dataType), StructField("score", counts.schema["n"].dataType),
                         counts.schema["doc_id"], counts.schema["tie"]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        starts, of_item, times, weights = sent.value
        best: list[list[tuple]] = [[] for _ in range(n_items)]   # (-score, no id, id, tie), the best at the front
        least = np.ones(n_items, dtype=np.int64)                # a score below it is not among the best
        row = np.zeros(n_items, dtype=np.int64)
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("doc_id", "tie", "n")]
            ids, tfs = batch.column("ids"), batch.column("tfs")
            at = ids.offsets.to_numpy()
            all_ids, all_tfs = (c.values.to_numpy(zero_copy_only=False) for c in (ids, tfs))
            for k, (doc, tie, n) in enumerate(zip(*cols)):
                mine = all_ids[at[k]:at[k + 1]]
                if not len(mine):
                    continue
                tf = all_tfs[at[k]:at[k + 1]].astype(np.int64)
                m = 75 + 25 * n * n_docs // n_terms
                worth = weights[mine] * (1_000_000_000 * tf // (1000 * tf + 12 * m))
                first, size = starts[mine], starts[mine + 1] - starts[mine]
                # positions first[0] .. first[0]+size[0]-1, first[1] .., one after another
                spots = np.repeat(first - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
                row[:] = 0
                np.add.at(row, of_item[spots], np.repeat(worth, size) * times[spots])
                for i in np.flatnonzero(row >= least).tolist():
                    mine_best = best[i]
                    mine_best.append((-int(row[i]), doc is None, doc or 0, tie))
                    if len(mine_best) >= 4 * top:
                        mine_best.sort()
                        del mine_best[top:]
                        least[i] = -mine_best[-1][0]
        kept = [(i, -s, None if none else doc, tie) for i, b in enumerate(best) for s, none, doc, tie in sorted(b)[:top]]
        want = to_arrow_schema(schema)
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in kept], type=f.type) for c, f in enumerate(want)], schema=want)

    return counts.mapInArrow(run, schema)


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES,
           block_items: int = BLOCK_ITEMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` rows of ``docs`` with the highest
    scores above 0 for each item.

    Equal scores rank by ascending ``doc_id``, a null id after all others; rows that
    share an id, or have none, are ranked apart, by a hash of their text.  Items that share an
    ``item_id`` (null is one) are one item with the terms of all.  Null and empty texts
    have no terms; items without terms, and an empty table on either side, give no rows.
    """
    spark = docs.sparkSession
    docs = keyed_text(docs, id_col, text_col).withColumn("tie", F.xxhash64("text"))
    dealt, n_blocks = blocks(staged(item_terms(items, item_col, item_text_col), "ranking-terms")[0], block_bytes, block_items)
    kind = items.schema[item_col].dataType
    found = None
    for block in range(n_blocks):
        rows = dealt.filter(F.col("block") == block).collect()   # bounded: see blocks()
        if not rows:
            continue
        terms = tuple(sorted({r.term for r in rows}))
        ids = sorted({r.item_id for r in rows}, key=lambda x: (x is None, x))
        number, place = {t: i for i, t in enumerate(terms)}, {x: i for i, x in enumerate(ids)}
        counts, _ = staged(term_counts(docs, terms), "ranking-counts")
        n_docs, n_terms = counts.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
        if not n_terms:
            break   # no document has a term
        weights = np.zeros(len(terms), dtype=np.int64)
        for r in counts.select(F.explode("ids").alias("term")).groupBy("term").count().collect():   # a row a term of the block
            weights[r.term] = weight(n_docs, r["count"])
        held = [(number[r.term], place[r.item_id], r.times) for r in rows]
        names = spark.createDataFrame(list(enumerate(ids)), "item long, item_id string")
        part = _best(counts, ids, held, weights, n_docs, n_terms, top).join(F.broadcast(names), "item").drop("item")
        found = part if found is None else found.unionAll(part)
    if found is None:
        return spark.createDataFrame([], StructType([StructField("item_id", kind)])).select(
            "item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "tie")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .select(F.col("item_id").cast(kind).alias("item_id"), F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
