"""Token counts by a linear longest-match automaton.

Greedy word pieces take the longest piece of the vocabulary again and again.  On a
trie of the vocabulary, every node knows where matching goes on when the next
character has no edge (its failure link) and how many pieces are complete by then
(its popped count).  One pass over a word adds the popped counts up; no piece is
built and no character is read twice.

Texts are cut at white space and counted in tasks over Arrow batches; each
different word of a batch is matched once.
"""

from __future__ import annotations

import json
import unicodedata
from collections import deque
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField, StructType

WORDS_KEPT = 250_000         # bound on a worker's cache
VOCABULARY_BYTES = 64 << 20  # bound on the vocabulary that is sent to tasks
END = "\ue000"         # stands for a vocabulary's end-of-word mark


class LongestMatch:
    """Piece counts of greedy longest matches.

    ``continuation`` is what pieces inside a word begin with ("##" or nothing).  A
    word that cannot be cut into pieces counts as one unknown token.
    """

    def __init__(self, pieces: Iterable[str], continuation: str = "##"):
        self.edges: list[dict[str, int]] = [{}]
        whole = [False]

        def add(text: str) -> int:
            node = 0
            for c in text:
                if c not in self.edges[node]:
                    self.edges[node][c] = len(self.edges)
                    self.edges.append({})
                    whole.append(False)
                node = self.edges[node][c]
            return node

        self.inside = add(continuation)   # where matching goes on inside a word
        for piece in pieces:
            if piece and piece != continuation:
                whole[add(piece)] = True
        self.fail: list[int] = [-1] * len(self.edges)
        self.popped = [0] * len(self.edges)
        queue = deque((0, c, n) for c, n in self.edges[0].items())
        if self.inside:                   # the links of inner pieces lead below this node
            queue = deque((self.inside, c, n) for c, n in self.edges[self.inside].items())
            queue.extend((0, c, n) for c, n in self.edges[0].items())
        seen = set()
        while queue:
            parent, c, node = queue.popleft()
            if node in seen:
                continue
            seen.add(node)
            if node != self.inside:
                self._link(parent, c, node, whole[node])
            queue.extend((node, d, n) for d, n in self.edges[node].items())

    def _link(self, parent: int, c: str, node: int, is_piece: bool) -> None:
        if is_piece:
            self.fail[node], self.popped[node] = self.inside, 1
            return
        at, count = self.fail[parent], self.popped[parent]
        while at >= 0 and c not in self.edges[at]:
            count += self.popped[at]
            at = self.fail[at]
        if at >= 0:
            self.fail[node], self.popped[node] = self.edges[at][c], count

    def count(self, word: str) -> int:
        edges, fail, popped = self.edges, self.fail, self.popped
        node = total = 0
        for c in word:
            while c not in edges[node]:
                total += popped[node]
                node = fail[node]
                if node < 0:
                    return 1
            node = edges[node][c]
        while node != self.inside and node != 0:
            total += popped[node]
            node = fail[node]
            if node < 0:
                return 1
        return total


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself where it
    is printable in Latin-1, else the next one from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordCounter:
    """Counts of a vocabulary file: words by its pattern, in lower case, over byte
    letters, each with the end-of-word mark."""

    def __init__(self, spec: str):
        import regex

        model = json.loads(spec)
        mark = model["end"]
        self.match = LongestMatch((p[:-len(mark)] + END if mark and p.endswith(mark) else p
                                   for p in model["pieces"]), model["continuation"])
        self.end = END if mark else ""
        self.cut = regex.compile(model["pattern"])
        self.letters = byte_letters()
        self.known: dict[str, tuple[int, int]] = {}

    def words(self, chunk: str) -> list[str]:
        return ["".join(map(self.letters.__getitem__, w.encode())) + self.end for w in self.cut.findall(chunk)]

    def _counts(self, chunk: str) -> tuple[int, int]:
        """Words and pieces of a text without white space."""
        got = self.known.get(chunk)
        if got is None:
            words = self.words(unicodedata.normalize("NFC", chunk).lower())
            got = len(words), sum(map(self.match.count, words))
            if len(self.known) >= WORDS_KEPT:
                self.known.clear()
            if len(chunk) <= 64:
                self.known[chunk] = got
        return got

    def count(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Words and pieces of each text."""
        chunks = pc.utf8_split_whitespace(pc.fill_null(texts, ""))
        coded = chunks.flatten().dictionary_encode()
        each = np.array([self._counts(c) for c in coded.dictionary.to_pylist()], dtype=np.int64).reshape(-1, 2)
        begin = chunks.offsets.to_numpy().astype(np.int64)
        begin -= begin[0]
        sums = np.vstack((np.zeros((1, 2), dtype=np.int64),
                          np.cumsum(each[coded.indices.to_numpy(zero_copy_only=False)], axis=0)))
        per_text = sums[begin[1:]] - sums[begin[:-1]]
        return per_text[:, 0], per_text[:, 1]


def read_vocabulary(path: str, end_of_word: str = "</w>", continuation: str = "") -> str:
    """What tasks need of a tokenizer file in JSON: its pieces and its word pattern."""
    with open(path, "rb") as f:
        data = f.read(VOCABULARY_BYTES + 1)
    if len(data) > VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {VOCABULARY_BYTES} bytes")
    model = json.loads(data)
    pattern = next(p["pattern"]["Regex"] for p in model["pre_tokenizer"]["pretokenizers"] if "pattern" in p)
    return json.dumps({"pieces": list(model["model"]["vocab"]), "pattern": pattern, "end": end_of_word,
                       "continuation": continuation})


_COUNTERS: dict[str, WordCounter] = {}


def token_counts(docs: DataFrame, vocabulary: str, text_col: str = "text", words_col: str = "n_words",
                 tokens_col: str = "n_tokens") -> DataFrame:
    """``docs`` with the number of words and of greedy word pieces of ``text_col``.

    ``vocabulary`` is a tokenizer file whose words end with ``</w>``; texts are brought to
    NFC and lower case, as the file says.  Null and empty texts count nothing.  Words
    that cannot be cut into pieces count one.  Columns of the new names are replaced.
    """
    spec = read_vocabulary(vocabulary)
    sent = docs.sparkSession.sparkContext.broadcast(spec)
    docs = docs.drop(words_col, tokens_col)
    at = docs.columns.index(text_col)
    schema = StructType([*docs.schema.fields, StructField(words_col, LongType(), False),
                         StructField(tokens_col, LongType(), False)])

    def run(batches):
        if sent.value not in _COUNTERS:
            _COUNTERS.clear()
            _COUNTERS[sent.value] = WordCounter(sent.value)
        counter = _COUNTERS[sent.value]
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                words, tokens = counter.count(part.column(at))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(words), pa.array(tokens)],
                                                 names=[*part.schema.names, words_col, tokens_col])

    return docs.mapInArrow(run, schema)
