"""Benchmark decontamination by a prefix-filtered set join.

A window is ``width`` consecutive words of a benchmark item (an item of fewer,
but not none, is one window).  A document contains a window if the window's words
stand in it side by side.  For full containment the prefix that must be joined
is one token: the window's rarest word, rarity being the number of documents with
the word, counted over the whole corpus.  A joined word fixes where the window
would begin and end (positional and length bound); the words there are compared.

Documents are read twice, once for the rarity of benchmark words, once for the
places of prefix words; neither pass shuffles documents.  What tasks are sent is a
bit map of fixed size, whatever the benchmark's: it only decides which words may
matter, the join decides which do.  A place is shuffled with the words around it,
so it is verified without the document.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecourt.llm.common import keyed_text, map_batches, set_bits, staged, unused, with_bit

WIDTH = 10

# ASCII letters and digits make words, A-Z in lower case; so do all bytes of other characters.
_TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128
                  else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_TO_WORDS).split() if text else []


def _bit_map(words: DataFrame) -> bytes:
    return set_bits(words.select(F.crc32(F.col("word").cast("binary")).alias("h")))


def _marked(words: Iterable[bytes], bits: bytes) -> set[bytes]:
    """Those of ``words`` whose bit is set: all that matter, and few others."""
    return {w for w in words if with_bit(bits, zlib.crc32(w))}


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                      width: int = WIDTH) -> DataFrame:
    """``item_id, words (array), window (text)`` of every window, repeats in an item once."""
    rows = benchmark.select(F.col(id_col).cast("string").alias("item_id"),
                            F.col(text_col).cast("string").alias("text"))

    def cut(cols: dict[str, list]) -> dict[str, list]:
        ids, windows = [], []
        for item, text in zip(cols["item_id"], cols["text"]):
            words = words_of(text)
            ends = range(min(width, len(words)), len(words) + 1) if words else ()
            for window in {b" ".join(words[max(0, e - width):e]) for e in ends}:
                ids.append(item)
                windows.append(window.decode())
        return {"item_id": ids, "window": windows}

    return map_batches(rows, cut, "item_id string, window string").distinct()


def document_frequency(docs: DataFrame, words: DataFrame) -> DataFrame:
    """``word, n_docs`` over all of ``docs`` for the words of ``words`` that occur."""
    sent = docs.sparkSession.sparkContext.broadcast(_bit_map(words))

    def count(cols: dict[str, list]) -> dict[str, list]:
        found: Counter = Counter()
        for text in cols["text"]:
            found.update(_marked(set(words_of(text)), sent.value))
        return {"word": [w.decode() for w in found], "n": list(found.values())}

    return (map_batches(docs.select("text"), count, "word string, n long", rows=1024)
            .groupBy("word").agg(F.sum("n").alias("n_docs")).join(words.select("word"), "word", "left_semi"))


def prefix_windows(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """``window, n_words, word, place`` for each distinct window: its rarest word
    (ties: the smaller word, then the first place) and the word's place in it.
    Windows with a word that no document has are left out: they occur nowhere."""
    texts = windows.select("window").distinct()
    each = texts.select("window", F.posexplode(F.split("window", " ")).alias("place", "word"))
    counts = document_frequency(docs, each.select("word").distinct())
    least = (each.join(counts, "word", "left").groupBy("window")
             .agg(F.min(F.struct("n_docs", "word", "place")).alias("first"),
                  F.count("*").alias("n_words"), F.count("n_docs").alias("n_known")))
    return (least.filter("n_words = n_known")
            .select("window", F.col("n_words").cast("int").alias("n_words"),
                    F.col("first.word").alias("word"), F.col("first.place").alias("place")))


def window_places(docs: DataFrame, windows: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc_id, start, n_words, window``: every place where a window occurs."""
    prefixes, _ = staged(prefix_windows(docs, windows), "decontaminate-prefixes")
    sent = docs.sparkSession.sparkContext.broadcast(_bit_map(prefixes))

    def places(cols: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"doc_id": [], "at": [], "word": [], "before": [], "around": []}
        for doc, text in zip(cols["doc_id"], cols["text"]):
            words = words_of(text)
            rare = _marked(set(words), sent.value)
            if rare:
                for at, w in enumerate(words):
                    if w in rare:
                        first = max(0, at - width + 1)
                        out["doc_id"].append(doc)
                        out["at"].append(at)
                        out["word"].append(w.decode())
                        out["before"].append(at - first)
                        out["around"].append(b" ".join(words[first:at + width]).decode())
        return out

    found = map_batches(docs, places, "doc_id long, at long, word string, before int, around string")
    begin = F.col("before") - F.col("place")
    near = F.split("around", " ")
    return (found.join(prefixes, "word")
            .filter((begin >= 0) & (begin + F.col("n_words") <= F.size(near)))
            .filter(F.concat_ws(" ", F.slice(near, begin + 1, F.col("n_words"))) == F.col("window"))
            .select("doc_id", (F.col("at") - F.col("place")).alias("start"), "n_words", "window"))


def word_counts(docs: DataFrame) -> DataFrame:
    """``doc_id, of, n_words``"""
    return map_batches(docs, lambda c: {"doc_id": c["doc_id"], "of": c["of"], "n_words": [len(words_of(t)) for t in c["text"]]},
                       "doc_id long, of long, n_words long", rows=1024)


def covered_words(places: DataFrame) -> DataFrame:
    """``doc_id, n_hit``: words inside any place, each counted once."""
    order = Window.partitionBy("doc_id").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    spans = places.groupBy("doc_id", "start").agg(F.max(F.col("start") + F.col("n_words")).alias("end"))
    spans = spans.withColumn("from", F.greatest("start", F.coalesce(F.max("end").over(order), F.lit(0))))
    return spans.groupBy("doc_id").agg(
        F.sum(F.greatest(F.col("end") - F.col("from"), F.lit(0))).cast("long").alias("n_hit"))


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.

    ``n_hit`` counts the words inside any occurrence of a window, ``n_items`` the
    items with an occurring window; ``items_sha256`` is the digest of their ids,
    sorted as text and joined by commas.  Null and empty texts have no words;
    items without words have no window.  Rows that share a ``doc_id``, or have none,
    are told apart by their text.  An empty benchmark leaves every document clean.
    """
    docs = keyed_text(docs, id_col, text_col).withColumn("of", F.xxhash64("doc_id", "text"))
    texts = docs.select(F.col("of").alias("doc_id"), "text").dropna(subset=["text"])
    windows, _ = staged(benchmark_windows(benchmark, item_col, item_text_col, width), "decontaminate-windows")
    places, _ = staged(window_places(texts, windows, width).distinct(), "decontaminate-places")
    items = (places.select("doc_id", "window").distinct().join(windows, "window")
             .groupBy(F.col("doc_id").alias("of")).agg(F.sort_array(F.collect_set("item_id")).alias("items"))
             .select("of", F.size("items").cast("long").alias("n_items"),
                     F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256")))
    hit = covered_words(places).withColumnRenamed("doc_id", "of")
    return (word_counts(docs).join(hit, "of", "left").join(items, "of", "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
                    F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
                    (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated")))


def keep_clean(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, id_col: str = "doc_id",
               text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text holds a window of ``benchmark``.

    Rows without an id are told apart by their text, as rows that share an id are.
    """
    key = F.xxhash64(F.col(text_col).cast("string"))
    texts = docs.select(key.alias("doc_id"), F.col(text_col).cast("string").alias("text")).filter("text is not null")
    windows, _ = staged(benchmark_windows(benchmark, item_col, item_text_col, width), "decontaminate-windows")
    name = unused(docs, "hit")
    hit = window_places(texts, windows, width).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(hit, key == F.col(name), "left_anti")
