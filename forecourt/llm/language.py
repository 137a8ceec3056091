"""Language identification by string kernels.

Two texts are compared by the byte n-grams of 1 to 4 bytes (a blended spectrum) that
occur in both: kernel(x, y) = |G(x) & G(y)| / sqrt(|G(x)| |G(y)|), G being the set of the n-grams of
a text, as far as they are among the ``MAX_GRAMS`` most common of the landmarks.  Landmarks are texts of the labelled
sample (Nystroem): a text's feature vector is its kernel values with all landmarks,
times the inverse root of the landmarks' own kernel matrix.  One ridge regression a language
against the rest, on these features, gives its value.

The kernel with a landmark is a scalar product of presence vectors, so the matrix of presence
vectors of a batch of texts times one matrix (landmarks, whitening and regression weights
multiplied out beforehand) gives the values of all languages at once.  That
product is all that scoring does, in tasks over Arrow batches, without a shuffle.

What is learnt comes from a bounded sample of labelled rows (``FIT_ROWS``, ``LANDMARKS``); every
text is scored whole, long ones piece by piece.  Only n-gram sets of the landmarks and
kernel values of the sample reach the driver, no texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from forecourt.llm.common import staged, unused

FIT_ROWS = 4000       # labelled texts at most, dealt evenly to the languages
LANDMARKS = 128       # of them, likewise
MAX_LANGS = 128       # languages learnt: the most frequent ones
LONGEST = 4           # bytes of an n-gram
GRAMS_A_LANDMARK = 20_000  # the shortest first; bounds what a landmark sends to the driver
MAX_GRAMS = 1 << 16   # those that most landmarks have (ties: the shorter, smaller ones)
RIDGE = 1e-3
UNKNOWN = "und"
_BATCH_BYTES = 1 << 18
_TABLE_BITS = 20

# ASCII letters, and all bytes of other characters, stand for themselves; the rest is blank.
_LETTERS = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def spelled(text: str | None) -> bytes:
    """Lower case, one blank for each run of ASCII characters that are no letters, one at either end."""
    return b" " + b" ".join((text or "").lower().encode("utf-8", "replace").translate(_LETTERS).split()) + b" "


def gram_codes(data: np.ndarray) -> Iterable[np.ndarray]:
    """Code of the n-gram that begins at each byte, for n = 1, 2, .. (the last n - 1 bytes have
    none).  Codes of different n-grams differ, as no byte is zero."""
    code = data.astype(np.uint64)
    yield code
    for n in range(2, LONGEST + 1):
        code = data[n - 1:].astype(np.uint64) | code[:-1] << np.uint64(8)
        yield code


def gram_set(text: str | None) -> np.ndarray:
    """Codes of the n-grams of a text, sorted; a long text is read in pieces."""
    line = spelled(text)
    found = np.zeros(0, dtype=np.uint64)
    for at in range(0, len(line), _BATCH_BYTES):
        data = np.frombuffer(line, dtype=np.uint8)[at:at + _BATCH_BYTES + LONGEST - 1]
        found = np.union1d(found, np.unique(np.concatenate(list(gram_codes(data)))))
    return found


class Spectrum:
    """Numbers the n-grams of a sorted array, and finds those that texts have."""

    def __init__(self, grams: np.ndarray):
        self.grams = grams
        self.table = np.full(1 << _TABLE_BITS, -1, dtype=np.int32)
        left = np.arange(len(grams), dtype=np.int32)
        self.rounds = 0
        while len(left):   # open addressing, all at once: whoever did not get its place tries the next
            at = self._place(grams[left], self.rounds)
            free = self.table[at] < 0
            self.table[at[free]] = left[free]
            left = left[self.table[at] != left]
            self.rounds += 1

    @staticmethod
    def _place(codes: np.ndarray, turn: int) -> np.ndarray:
        mixed = (codes + np.uint64(turn)) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)

    def numbers(self, codes: np.ndarray) -> np.ndarray:
        """Number of each code, -1 for those that are not among the grams."""
        out = np.full(len(codes), -1, dtype=np.int32)
        if not len(self.grams):
            return out
        open_, left = np.arange(len(codes)), codes
        for turn in range(self.rounds):
            got = self.table[self._place(left, turn)]
            hit = (got >= 0) & (self.grams[np.maximum(got, 0)] == left)
            out[open_[hit]] = got[hit]
            go_on = (got >= 0) & ~hit     # a place never taken ends the search
            open_, left = open_[go_on], left[go_on]
            if not len(left):
                break
        return out

    def presence(self, texts: list[bytes]) -> np.ndarray:
        """Row per text, column per gram: 1 where the text has it."""
        out = np.zeros((len(texts), len(self.grams)), dtype=np.float32)
        flat = out.reshape(-1)
        pieces, rows, load = [], [], 0

        def mark() -> None:
            data = np.frombuffer(b"\0".join(pieces), dtype=np.uint8)
            row = np.repeat(np.array(rows, dtype=np.int64), [len(p) + 1 for p in pieces])[:len(data)]
            for code in gram_codes(data):
                number = self.numbers(code)   # a zero byte inside makes no gram's code, one in front may
                hit = np.flatnonzero((number >= 0) & (data[:len(code)] > 0))
                flat[row[hit] * len(self.grams) + number[hit]] = 1

        for i, text in enumerate(texts):
            for at in range(0, len(text), _BATCH_BYTES):
                pieces.append(text[at:at + _BATCH_BYTES + LONGEST - 1])
                rows.append(i)
                load += len(pieces[-1])
                if load >= _BATCH_BYTES:
                    mark()
                    pieces, rows, load = [], [], 0
        if pieces:
            mark()
        return out


@dataclass(frozen=True)
class LanguageModel:
    """``weights``: row per gram, column per language (landmarks, whitening and regression in one)."""
    langs: tuple[str, ...]
    grams: np.ndarray
    weights: np.ndarray


def normed(presence: np.ndarray) -> np.ndarray:
    """Rows over the root of their sums, so that scalar products are kernel values."""
    size = presence.sum(axis=1, keepdims=True)
    return presence / np.sqrt(np.maximum(size, 1))


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2


def _sample(docs: DataFrame, kinds: dict[str, int], each: int) -> DataFrame:
    """``lang, h, text, place``: of each language the ``each`` texts with the smallest hashes,
    equal texts once; ``place`` counts from 1.

    ``kinds`` has the number of different texts of each language, about.  It tells how small
    the hashes are that can be among the smallest, so that few rows reach the ranking; in
    the unlikely case that these are fewer than ``each`` the sample is smaller.
    """
    least = [(lang, min(2**63 - 1, (1 << 64) * max(4 * each, 64) // max(n, 1) - 2**63)) for lang, n in kinds.items()]
    chosen = F.broadcast(docs.sparkSession.createDataFrame(least, "lang string, highest long"))   # MAX_LANGS rows at most
    keys = docs.join(chosen, "lang").filter("h <= highest").select("lang", "h").distinct()
    order = Window.partitionBy("lang").orderBy("h")
    firsts = keys.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= each)
    texts = docs.join(F.broadcast(firsts), ["lang", "h"])          # at most FIT_ROWS keys, or one a language
    return texts.groupBy("lang", "h").agg(F.min("text").alias("text"), F.first("place").alias("place"))


def fit(docs: DataFrame, learn: Column | None = None, text_col: str = "text", lang_col: str = "lang",
        fit_rows: int = FIT_ROWS, landmarks: int = LANDMARKS, max_langs: int = MAX_LANGS) -> LanguageModel:
    """Learn from rows of ``docs`` with a language and a text that has a letter, those of ``learn`` only.

    Takes the ``max_langs`` most frequent languages (ties: by name) and of each an equal share of
    ``fit_rows`` texts, one at least.  Equal texts of one language count once.  Without
    such rows the model has no language.
    """
    rows = docs if learn is None else docs.filter(learn)
    rows = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).filter(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).withColumn("h", F.xxhash64("text"))
    counts = (rows.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct("h").alias("kinds"))
              .orderBy(F.desc("n"), "lang").limit(max_langs).collect())
    langs = sorted(r.lang for r in counts)
    if not langs:
        return LanguageModel((), np.zeros(0, dtype=np.uint64), np.zeros((0, 0)))
    sample, _ = staged(_sample(rows, {r.lang: r.kinds for r in counts}, max(1, fit_rows // len(langs))), "language-sample")
    few = max(1, landmarks // len(langs))

    def sets(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column("text").to_pylist():
                grams = gram_set(text)[:GRAMS_A_LANDMARK].astype(np.int64)
                yield pa.RecordBatch.from_pydict({"grams": pa.array([grams], type=pa.list_(pa.int64()))})

    marks = sample.filter(F.col("place") <= few).select("text").mapInArrow(sets, "grams array<bigint>")
    marks = sorted((np.array(r.grams, dtype=np.uint64) for r in marks.collect()),   # landmarks only
                   key=lambda m: m.tobytes())                                       # whatever order they came in
    codes, common = np.unique(np.concatenate(marks), return_counts=True)
    grams = np.sort(codes[np.argsort(-common, kind="stable")[:MAX_GRAMS]])
    has = np.array([np.isin(grams, m, assume_unique=True) for m in marks], dtype=np.float32)
    marks = normed(has)
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    good = values > 1e-6 * values[-1]
    whiten = vectors[:, good] / np.sqrt(values[good])                       # K_mm^(-1/2), as far as it exists
    known = _values(sample.select("lang", "text"), grams, marks.T, "lang string, k array<float>",
                    lambda cols, k: {"lang": cols["lang"], "k": list(k)}).collect()
    known.sort(key=lambda r: (r.lang, r.k))
    x = np.array([r.k for r in known], dtype=np.float64) @ whiten
    y = np.array([[1.0 if r.lang == lang else 0.0 for lang in langs] for r in known])
    # languages weigh the same, however many texts each has
    w = 1 / np.maximum(y.sum(axis=0), 1)[np.argmax(y, axis=1)]
    left = x.T @ (x * w[:, None]) + RIDGE * np.eye(x.shape[1])
    ridge = np.linalg.solve(left, x.T @ (y * w[:, None]))
    return LanguageModel(tuple(langs), grams, marks.T @ (whiten @ ridge))


def _values(docs: DataFrame, grams: np.ndarray, weights: np.ndarray, schema: str | StructType,
            out: Callable[[dict[str, list], np.ndarray], dict[str, Iterable]], text_col: str = "text") -> DataFrame:
    """``out`` of the columns and the values (normed presence times ``weights``) of every row's text."""
    sent = docs.sparkSession.sparkContext.broadcast((grams, weights.astype(np.float32)))
    out_schema = docs.sparkSession.createDataFrame([], schema).schema if isinstance(schema, str) else schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        want = to_arrow_schema(out_schema)
        spectrum, weights = Spectrum(sent.value[0]), sent.value[1]
        step = max(1, min(64, (1 << 22) // max(1, len(spectrum.grams))))    # 16 MB of presence at most
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                cols = {n: c.to_pylist() for n, c in zip(part.schema.names, part.columns)}
                values = normed(spectrum.presence([spelled(t) for t in cols[text_col]])) @ weights
                got = out(cols, values)
                yield pa.RecordBatch.from_arrays([pa.array(got[f.name], type=f.type) for f in want], schema=want)

    return docs.mapInArrow(run, out_schema)


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text", lang_col: str = "lang_pred",
            score_col: str = "score") -> DataFrame:
    """``docs`` with the predicted language and a score from 0 to 1 (share of the best language in
    the values above zero).  Null texts, texts without a letter and an empty model give
    ``und`` with score 0.  Columns of these names are replaced."""
    keep = docs.drop(lang_col, score_col)
    text = unused(keep, "language_text")
    schema = StructType([*keep.schema.fields, StructField(lang_col, StringType()), StructField(score_col, DoubleType())])
    langs, columns = model.langs, keep.columns

    def out(cols: dict[str, list], values: np.ndarray) -> dict[str, Iterable]:
        pred, score = [], []
        for asked, row in zip(cols[text], values):
            if langs and has_letter(asked):
                best, above = int(np.argmax(row)), float(np.maximum(row, 0).sum())
                pred.append(langs[best])
                score.append(min(1.0, float(row[best]) / above) if row[best] > 0 else 0.0)
            else:
                pred.append(UNKNOWN)
                score.append(0.0)
        return {c: cols[c] for c in columns} | {lang_col: pred, score_col: score}

    asked = docs.select(F.col(text_col).cast("string").alias(text), *(docs[c] for c in columns))
    return _values(asked, model.grams, model.weights, schema, out, text)


def identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per row: ``doc_id, held_out, lang_pred, score``; learnt from the rows that are not held out.

    Rows that share an id, or have none (held out is then null and the row is not learnt from), are
    predicted each by its own text."""
    model = fit(docs, ~held_out(id_col), text_col, lang_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"),
                       F.col(text_col).cast("string").alias("text"))
    return predict(rows, model).drop("text")
