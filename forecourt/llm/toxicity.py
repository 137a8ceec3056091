"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on toxic and one on ordinary text.
Each text is cut into short overlapping windows, each window is compressed with
either dictionary, and the bytes that the toxic one saves are its distance.  A
logistic curve over a text's distances, fitted on other labelled rows than the
dictionaries, gives the score; windows whose distance passes calibrated
thresholds are counted in it.

Only what tells the classes apart may differ between the dictionaries, else the
lengths differ by chance.  So both have the same ordinary prose at the end, and
before it equally much of the kind's own strings: runs of byte n-grams that are
significantly more frequent in lines of that kind than of the other.

Fitting takes a bounded sample of the labelled rows (``FIT_ROWS`` of each class,
those with the smallest hashes of their id).  Scoring covers every text whole, in
tasks over Arrow batches, without a shuffle: compression has no Spark expression.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

FIT_ROWS = 3000        # of each class, at most
GRAM = 5               # bytes of an n-gram whose frequency is compared
WINDOW, STEP = 48, 36  # bytes
OWN_BYTES, COMMON_BYTES = 6000, 8192
LEVEL = 6
MISS_COST = 3.0       # what a missed toxic text weighs against a clean one that is flagged
CUTS = (2, 4, 6, 8)    # saved bytes; how many windows pass each is weighed by the fit


def lines_of(text: str | None) -> list[bytes]:
    return [x for x in (text or "").lower().encode().split(b"\n") if x]


def telling_grams(own: set[bytes], other: set[bytes], gram: int = GRAM) -> set[bytes]:
    """n-grams in significantly more of the lines ``own`` than of ``other``."""
    def counts(lines: set[bytes]) -> Counter:
        out: Counter = Counter()
        for x in lines:
            out.update({x[i:i + gram] for i in range(len(x) - gram + 1)})
        return out

    a, b, n, m = counts(own), counts(other), max(len(own), 1), max(len(other), 1)

    def deviation(g: bytes) -> float:
        rate = (b[g] + 2) / (m + 2)
        return (a[g] / n - rate) / math.sqrt(rate * max(1 - rate, 1e-9) / n)

    return {g for g, c in a.items() if c >= 4 and c / n >= 6 * b[g] / m and deviation(g) >= 6}


def telling_strings(own: set[bytes], grams: set[bytes], most: int, gram: int = GRAM) -> bytes:
    """The runs of ``grams`` in ``own`` as dictionary content, the most frequent at
    the end; runs whose n-grams are all there already are left out."""
    runs: Counter = Counter()
    for x in own:
        i = 0
        while i <= len(x) - gram:
            j = i
            while j <= len(x) - gram and x[j:j + gram] in grams:
                j += 1
            if j > i:
                runs[x[i:j - 1 + gram]] += 1
            i = j + 1
    content: list[bytes] = []
    covered: set[bytes] = set()
    size = 0
    for run, _ in sorted(runs.items(), key=lambda r: (-r[1] * len(r[0]), r[0])):
        own_grams = {run[i:i + gram] for i in range(len(run) - gram + 1)}
        if not own_grams <= covered and size + len(run) <= most:
            covered |= own_grams
            content.append(run)
            size += len(run)
    return b"".join(reversed(content))


def windows(data: bytes) -> list[bytes]:
    return [data[i:i + WINDOW] for i in range(0, max(len(data) - WINDOW + STEP, 1), STEP)]


def _compressor(content: bytes):
    import zstandard as z

    params = z.ZstdCompressionParameters.from_level(
        LEVEL, source_size=WINDOW, dict_size=len(content), write_content_size=0, write_dict_id=0,
        write_checksum=0, format=z.FORMAT_ZSTD1_MAGICLESS)
    made = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
    made.precompute_compress(compression_params=params)
    return z.ZstdCompressor(dict_data=made, compression_params=params)


def distances(data: bytes, ordinary, toxic) -> np.ndarray:
    """Bytes that the toxic dictionary saves in each window."""
    parts = windows(data)
    shrink_a, shrink_b = ordinary.compress, toxic.compress
    return np.array([len(shrink_a(w)) - len(shrink_b(w)) for w in parts], dtype=np.float64)


def features(text: str | None, ordinary, toxic) -> np.ndarray:
    data = (text or "").lower().encode()
    d = distances(data, ordinary, toxic)
    top = np.sort(d)[::-1]
    share = [float((d >= c).mean()) for c in CUTS]
    return np.array([top[0], top[:3].mean(), d.mean(), np.maximum(d, 0).mean(), *share,
                     *np.sqrt(share), math.log(len(d)), min(len(data), WINDOW) / WINDOW])


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray   # the last one is the constant

    def score(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) / self.scale @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights by Newton steps with a ridge, the constant last and free."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(hessian, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def dictionaries(rows: list[tuple[str | None, int]]) -> tuple[bytes, bytes]:
    """Contents of the ordinary and of the toxic dictionary, of the same size."""
    own = [{x for text, y in rows if y == k for x in lines_of(text)} for k in (0, 1)]
    both = [telling_strings(own[k], telling_grams(own[k], own[1 - k]), OWN_BYTES) for k in (0, 1)]
    prose = b"\n".join(sorted(own[0], key=lambda x: (hash_of(x), x))).ljust(64, b" ")
    size = max(map(len, both))
    return tuple(prose[::-1][:size - len(x)] + x + prose[:COMMON_BYTES] for x in both)


def train(rows: list[tuple[str | None, int]]) -> Model:
    """A model from texts and labels; without rows of both classes every score is
    the share of label 1 (a half without any row).

    The curve is fitted to distances under dictionaries that did not see the text:
    each half of the rows is compressed with those of the other half.
    """
    half = [rows[0::2], rows[1::2]]
    x, y = [], []
    for part, other in (half, half[::-1]):
        a, b = map(_compressor, dictionaries(other))
        x += [features(t, a, b) for t, _ in part]
        y += [label for _, label in part]
    ordinary, toxic = dictionaries(rows)
    x = np.array(x or [features("", _compressor(ordinary), _compressor(toxic))])
    y = np.array(y or [0.5], dtype=float)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale < 1e-9] = 1.0
    w = np.zeros(x.shape[1] + 1)
    if 0 < y.mean() < 1 and len(y) > 1:
        w = _logistic((x - mean) / scale, y)
        w[-1] += math.log(MISS_COST)
    else:
        share = min(max(float(y.mean()), 0.001), 0.999)
        w[-1] = math.log(share / (1 - share))
    return Model(ordinary, toxic, mean, scale, w)


def hash_of(x: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(x, 7)


def fit(docs: DataFrame, labels: DataFrame, learn: F.Column | None = None, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "toxic", fit_rows: int = FIT_ROWS) -> Model:
    """A :class:`Model` from at most ``fit_rows`` labelled rows of each class.

    ``learn`` (over the id, named ``doc_id``) picks the labels that may be used.
    Labels other than 0 and 1, null ids and null texts are left out; an id with
    more than one label counts with each.
    """
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y"))
    known = known.filter("y in (0, 1) and doc_id is not null").distinct()
    if learn is not None:
        known = known.filter(learn)
    order = F.xxhash64("doc_id")
    chosen = (known.filter("y = 0").orderBy(order, "doc_id").limit(fit_rows)
              .unionAll(known.filter("y = 1").orderBy(order, "doc_id").limit(fit_rows)))
    shares = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    got = texts.join(F.broadcast(chosen), "doc_id").filter("text is not null").select("doc_id", "text", "y").collect()
    rows = sorted((hash_of(str(r.doc_id).encode()), r.text, r.y) for r in got)
    model = train([(t, y) for _, t, y in rows])
    taken = Counter(y for _, _, y in rows)
    if len(taken) == 2 and len(shares) == 2:  # where a class was cut to fit_rows
        model.weights[-1] += math.log(shares[1] / taken[1]) - math.log(shares[0] / taken[0])
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the score of ``text_col``, 0 to 1, higher: likelier toxic.

    Null and empty texts are scored as a text of no bytes.  Rows and further
    columns stay; a column named ``score_col`` is replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop(score_col)
    at = docs.columns.index(text_col)

    def run(batches):
        m = sent.value
        a, b = _compressor(m.ordinary), _compressor(m.toxic)
        for batch in batches:
            x = np.array([features(t.as_py(), a, b) for t in batch.column(at)]).reshape(batch.num_rows, -1)
            scores = m.score(x) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())],
                                             names=[*batch.schema.names, score_col])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(score_col, DoubleType(), False)]))


def held_out(doc_id: str = "doc_id") -> F.Column:
    """A fifth of the rows, by the id's text."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: ``doc_id, held_out, score, predicted``; labels of held-out rows
    are not used."""
    model = fit(docs, labels, learn=~held_out())
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
