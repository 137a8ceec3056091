"""Line dedup by a deletion-neighbourhood join, for an edit bound of one character.

Two lines within one edit have a common variant: the line itself or the line
without one character.  Lines emit the hashes of all their variants, equal
variants are joined, the edit distance of what meets is verified, and the earliest
line stays.

* A substitution leaves the same rest behind at the same place: all lines with an
  equal (variant, place) are within one edit of each other, so a link from each to
  the earliest of them says all.
* An insertion leaves the shorter line whole: lines that meet a whole line on its
  own hash are linked to it, or it to the earliest of them.

So links grow with the lines, however many meet.  A line of n characters has n + 1
variants, which is why lines without a partner are removed first, without loss:
within one edit, either the first or the second half of two lines is equal.  Exact
repeats are one line throughout and are never joined with each other.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecourt.llm.common import map_batches, set_bits, staged, unused, with_bit

NEAR_CHARS = 16       # shorter lines are only compared for equality
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def variant_hashes(line: str) -> tuple[int, np.ndarray]:
    """Hash of ``line``, and of ``line`` without each of its characters, in linear
    time: a sum of weighted characters, from which one is taken out."""
    chars = _mixed(np.frombuffer(line.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
                   + np.uint64(1))
    n = len(chars)
    powers = np.ones(n, dtype=np.uint64)
    if n > 1:
        powers[1:] = np.multiply.accumulate(np.full(n - 1, _BASE))
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(chars * powers, dtype=np.uint64)))
    whole = sums[n:n + 1]
    without = sums[:n] + (whole - sums[1:]) * _INVERSE
    return (int(_mixed(whole + np.uint64(n)).view(np.int64)[0]),
            _mixed(without + np.uint64(max(n - 1, 0))).view(np.int64))


def lines_of(docs: DataFrame) -> DataFrame:
    """``doc_id, of, line_no, line`` of every line that is not blank; ``of`` is the
    text's hash, so that rows which only share an id stay apart."""
    return (docs.select("doc_id", F.xxhash64("text").alias("of"),
                        F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
            .filter(F.trim("line") != ""))


def _half_keys(line: F.Column) -> F.Column:
    """Hashes of the first and the second half.  Lines of n and n - 1 characters
    must agree on what a half is, so both of n's and of (n - 1)'s halves are keys."""
    n = F.length(line)

    def prefix(size: F.Column) -> F.Column:
        return F.xxhash64(F.lit(0), size, F.substr(line, F.lit(1), size))

    def suffix(size: F.Column) -> F.Column:
        return F.xxhash64(F.lit(1), size, F.substr(line, n - size + 1))

    half, less = F.floor(n / 2).cast("int"), F.floor((n - 1) / 2).cast("int")
    return F.array_distinct(F.array(prefix(half), prefix(less), suffix(n - half), suffix(n - 1 - less)))


def distinct_lines(docs: DataFrame, near_chars: int) -> DataFrame:
    """``h1, h2, first, halves``: each different line by two hashes, its earliest
    occurrence (smallest doc_id, then line) and, if long enough, its half keys."""
    keyed = lines_of(docs).select(
        F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"),
        F.struct("doc_id", "of", "line_no").alias("at"),
        F.when(F.length("line") >= near_chars, _half_keys(F.col("line"))).alias("halves"))
    return keyed.groupBy("h1", "h2").agg(F.min("at").alias("first"), F.first("halves").alias("halves"))


def _with_partners(lines: DataFrame) -> DataFrame:
    """``h1, h2, first`` of the lines that share a half with another line."""
    keys = lines.select("h1", "h2", "first", F.explode("halves").alias("key"))
    one = F.struct("h1", "h2", "first")
    met = keys.groupBy("key").agg(F.min(one).alias("a"), F.max(one).alias("b"), F.count("*").alias("n"))
    met, _ = staged(met.filter("n > 1"), "lines-met")
    ends = met.select(F.explode(F.array("a", "b")).alias("x")).select("x.*")
    between = keys.join(met.filter("n > 2").select("key"), "key", "left_semi").select("h1", "h2", "first")
    return ends.unionAll(between).distinct()


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` with the ``line`` of each; documents are read once more, and only
    lines whose bit is set in a bit map of fixed size leave the task."""
    bits = docs.sparkSession.sparkContext.broadcast(set_bits(wanted.select(F.col("h1").alias("h"))))

    def pick(cols: dict[str, list]) -> dict[str, list]:
        import xxhash

        found: dict[bytes, tuple[int, int]] = {}
        for text in cols["text"]:
            for line in text.encode().split(b"\n") if text else ():
                if line not in found:
                    h = xxhash.xxh64_intdigest(line, 42)
                    if with_bit(bits.value, h):
                        found[line] = h
        h1 = np.array(list(found.values()), dtype=np.uint64).view(np.int64)
        return {"h1": h1, "line": [x.decode() for x in found]}

    some = map_batches(docs.select("text"), pick, "h1 long, line string")
    some = some.select("h1", F.xxhash64(F.lit(1), "line").alias("h2"), "line").distinct()
    return wanted.join(some, ["h1", "h2"])


def _links(lines: DataFrame) -> DataFrame:
    """``late, early``: a line and an earlier one that it meets on a variant."""
    def emit(cols: dict[str, list]) -> dict[str, list]:
        row, place, key = [], [], []
        for i, line in enumerate(cols["line"]):
            whole, without = variant_hashes(line)
            row.append(np.full(len(without) + 1, i))
            place.append(np.arange(-1, len(without)))
            key.append(np.concatenate(([whole], without)))
        row = np.concatenate(row).astype(np.int64) if row else np.zeros(0, dtype=np.int64)
        return {"place": np.concatenate(place).astype(np.int32) if place else [],
                "key": np.concatenate(key) if key else [],
                **{n: np.array(cols[n], dtype=np.int64)[row] for n in ("h1", "h2")},
                "first": [cols["first"][i] for i in row]}

    points = map_batches(lines, emit, "key long, place int, h1 long, h2 long, "
                         "first struct<doc_id: long, of: long, line_no: int>", rows=64)
    me = F.struct("first", "h1", "h2")
    points = points.select("key", "place", me.alias("me"))
    same_place, same_key = Window.partitionBy("key", "place"), Window.partitionBy("key")
    met = points.select(
        "me", "place", F.min("me").over(same_place).alias("twin"),
        F.min(F.when(F.col("place") == -1, F.col("me"))).over(same_key).alias("whole"),
        F.min(F.when(F.col("place") != -1, F.col("me"))).over(same_key).alias("part"))
    early = F.explode(F.array(F.when(F.col("place") != -1, F.col("twin")),
                              F.when(F.col("place") == -1, F.col("part")).otherwise(F.col("whole"))))
    return (met.filter("twin < me or whole < me or (place = -1 and part < me)")
            .select(F.col("me").alias("late"), early.alias("early")).filter("early < late").distinct())


def near_repeats(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """``h1, h2`` of the lines within one edit of an earlier different line."""
    wanted, _ = staged(_with_partners(lines), "lines-wanted")
    texts, _ = staged(_texts(docs, wanted), "lines-texts")
    links = _links(texts)
    text = texts.select("h1", "h2", "line")
    both = (links.select("late.h1", "late.h2", F.col("early.h1").alias("e1"), F.col("early.h2").alias("e2"))
            .join(text, ["h1", "h2"])
            .join(text.select(F.col("h1").alias("e1"), F.col("h2").alias("e2"), F.col("line").alias("other")),
                  ["e1", "e2"]))
    return both.filter(F.levenshtein("line", "other", 1) >= 0).select("h1", "h2").distinct()


def kept_lines(docs: DataFrame, near_chars: int = NEAR_CHARS) -> DataFrame:
    """``doc_id, of, kept`` (line numbers, sorted) of documents that keep a line:
    the earliest of each different line without an earlier one within one edit."""
    lines, _ = staged(distinct_lines(docs, near_chars), "lines-distinct")
    stay = lines.select("h1", "h2", "first").join(near_repeats(docs, lines), ["h1", "h2"], "left_anti")
    return stay.groupBy("first.doc_id", "first.of").agg(F.sort_array(F.collect_list("first.line_no")).alias("kept"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                near_chars: int = NEAR_CHARS) -> DataFrame:
    """``docs`` with ``text_col`` reduced to the lines that stay.

    A line goes if the same line, or one within one inserted, deleted or replaced
    character, occurs earlier: in a document with a smaller id, or before it in the
    same document.  Lines of fewer than ``near_chars`` characters are compared for
    equality only.  Blank lines repeat nothing and always stay.  Every row stays,
    with an empty text if all its lines go; null texts stay null.  Null ids come
    before all others.  Rows with the same id and text are one document; rows that
    only share the id are ordered by a hash of the text.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    key, of, stay = unused(docs, "kept_id"), unused(docs, "kept_of"), unused(docs, "kept_lines")
    kept = kept_lines(slim, near_chars).select(
        F.col("doc_id").alias(key), F.col("of").alias(of), F.col("kept").alias(stay))
    text = F.col(text_col).cast("string")
    joined = docs.join(kept, F.col(id_col).cast("long").eqNullSafe(F.col(key)) & (F.xxhash64(text) == F.col(of)), "left")
    left = F.filter(F.split(text, "\n"), lambda line, i: (F.trim(line) == "")
                    | F.array_contains(F.coalesce(stay, F.array().cast("array<int>")), i.cast("int")))
    return joined.withColumn(text_col, F.array_join(left, "\n")).select(docs.columns)


def line_digest(docs: DataFrame) -> DataFrame:
    """Per document: lines that are not blank, those that stay, and the text left."""
    both = docs.select("doc_id", "text", F.col("text").alias("before"))

    def filled(text: str) -> F.Column:
        return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.trim(x) != "")).cast("long")

    return dedup_lines(both).select(
        "doc_id", filled("before").alias("n_lines"), filled("text").alias("n_kept"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
