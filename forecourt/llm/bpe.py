"""Byte-level BPE by prefix dynamic programming.

For every byte prefix of a piece exactly one last token is valid: the token ``t``
that ends there, whose predecessor is the valid last token of the prefix before
``t``, and which that predecessor would not have merged across.  A table of these
last tokens is the encoding (read backwards); it grows by appending bytes, and
after an edit only the bytes near it are computed anew.

Texts are cut by a pattern first, each match encoded separately.  The encoder
runs in tasks over Arrow batches: Spark has no expression for it.  A worker
remembers pieces it met, up to a bound on the entries (a cache, without effect
on results).
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

VOCABULARY_BYTES = 64 << 20   # bound on the vocabulary file that is sent to tasks
PIECES_KEPT = 200_000         # bounds on a worker's caches, in entries
PAIRS_KEPT = 250_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a file with a base64 token and a rank per line."""
    with open(path, "rb") as f:
        data = f.read(VOCABULARY_BYTES + 1)
    if len(data) > VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {VOCABULARY_BYTES} bytes")
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}


class PrefixBpe:
    """Encoder for one vocabulary whose ranks are the merge order."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {r: t for t, r in ranks.items()}
        self.size_of = {r: len(t) for t, r in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks {len(missing)} single bytes")
        # Automaton over the tokens, its steps filled in as they are met.  A state is
        # the longest end of a prefix that some token begins with; it knows the
        # tokens that end there, the longest first.
        self.starts = {t[:i] for t in ranks for i in range(1, len(t) + 1)}
        self.state_of: dict[bytes, int] = {b"": 0}
        self.states: list[bytes] = [b""]
        self.ending: list[tuple[tuple[int, int], ...]] = [()]
        self.steps: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int] | None] = {}
        self.fits: dict[int, bool] = {}   # by left token << 32 | right token

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge made ``token``; None for a single byte."""
        if token not in self.parts:
            text = self.bytes_of[token]
            seq = [self.ranks[text[i:i + 1]] for i in range(len(text))]
            while len(seq) > 2:
                best, at = None, -1
                for i in range(len(seq) - 1):
                    r = self.ranks.get(self.bytes_of[seq[i]] + self.bytes_of[seq[i + 1]])
                    if r is not None and r < token and (best is None or r < best):
                        best, at = r, i
                if best is None:
                    break
                seq[at:at + 2] = [best]
            self.parts[token] = (seq[0], seq[1]) if len(seq) == 2 else None
        return self.parts[token]

    def compatible(self, left: int, right: int) -> bool:
        """Whether ``left`` and ``right`` side by side stay two tokens.

        Both are taken apart from the latest merge backwards.  At each state the
        two tokens that touch must have no merge that comes before the one just
        undone: it would have joined them first.
        """
        key = left << 32 | right
        known = self.fits.get(key)
        if known is not None:
            return known
        a, b, before, ok = left, right, 1 << 62, True
        while True:
            joined = self.ranks.get(self.bytes_of[a] + self.bytes_of[b])
            if joined is not None and joined < before:
                ok = False
                break
            ha, hb = self._halves(a), self._halves(b)
            # undo the later merge; with equal ranks the left one was made first
            if hb is not None and (ha is None or b >= a):
                before, b = b + 1, hb[0]   # a tie across the boundary lies left of b's own merge
            elif ha is not None:
                before, a = a, ha[1]
            else:
                break
        if len(self.fits) >= PAIRS_KEPT:
            self.fits.clear()
        self.fits[key] = ok
        return ok

    def _step(self, state: int, byte: int) -> int:
        """The state after one more byte."""
        end = self.states[state] + bytes([byte])
        while end not in self.starts:
            end = end[1:]
        if end not in self.state_of:
            self.state_of[end] = len(self.states)
            self.states.append(end)
            self.ending.append(tuple((len(end) - i, self.ranks[end[i:]])
                                     for i in range(len(end)) if end[i:] in self.ranks))
        self.steps[state << 8 | byte] = self.state_of[end]
        return self.state_of[end]

    def extend(self, data: bytes, last: list[int], states: list[int], stop: int | None = None) -> None:
        """Fill ``last`` and ``states`` (last token and automaton state of each prefix,
        those of the empty one at 0) up to the prefix of ``stop`` bytes."""
        step, fits, ending = self.steps.get, self.fits.get, self.ending
        state = states[-1]
        for at in range(len(last) - 1, len(data) if stop is None else stop):
            byte = data[at]
            after = step(state << 8 | byte)
            state = self._step(state, byte) if after is None else after
            states.append(state)
            for size, token in ending[state]:
                if size > at:
                    last.append(token)
                    break
                before = last[at + 1 - size]
                ok = fits(before << 32 | token)
                if ok or ok is None and self.compatible(before, token):
                    last.append(token)
                    break
            else:
                raise ValueError("no valid last token: the ranks are not a merge order")

    def tokens(self, last: list[int]) -> list[int]:
        out, at, size = [], len(last) - 1, self.size_of
        while at:
            token = last[at]
            out.append(token)
            at -= size[token]
        out.reverse()
        return out

    def encode_piece(self, data: bytes) -> list[int]:
        return self.encode_pieces([data])[data]

    def encode_pieces(self, pieces: Iterable[bytes]) -> dict[bytes, list[int]]:
        """Each piece's ids.  In sorted order a piece takes over the last tokens of
        the prefix it shares with the one before and appends the rest."""
        out: dict[bytes, list[int]] = {}
        before, last, states = b"", [-1], [0]
        for data in sorted(pieces):
            whole = self.ranks.get(data)
            if whole is not None:
                out[data] = [whole]
                continue
            same = 0
            for a, b in zip(before, data):
                if a != b:
                    break
                same += 1
            del last[same + 1:], states[same + 1:]
            self.extend(data, last, states)
            out[data] = self.tokens(last)
            before = data
        return out


class PrefixTable:
    """Encoding of one growing or edited byte string (one piece, no pattern)."""

    def __init__(self, bpe: PrefixBpe, data: bytes = b""):
        self.bpe, self.data, self.last, self.states = bpe, b"", [-1], [0]
        self.append(data)

    def append(self, data: bytes) -> None:
        self.data += data
        self.bpe.extend(self.data, self.last, self.states)

    def replace(self, start: int, end: int, data: bytes) -> int:
        """Put ``data`` for the bytes ``start:end``; returns how many prefixes were
        computed.  A last token depends on the ``longest`` prefixes before it only,
        so once that many in a row behind the edit are as before, the rest is too."""
        old, old_states, shift = self.last, self.states, len(data) - (end - start)
        self.data = self.data[:start] + data + self.data[end:]
        self.last, self.states, same, at = old[:start + 1], old_states[:start + 1], 0, start
        while at < len(self.data):
            at += 1
            self.bpe.extend(self.data, self.last, self.states, at)
            behind = at - start - len(data)
            same = same + 1 if behind > 0 and self.last[at] == old[at - shift] else 0
            if same >= self.bpe.longest and behind >= self.bpe.longest:
                self.last += old[at - shift + 1:]
                self.states += old_states[at - shift + 1:]
                break
        return at - start

    def tokens(self) -> list[int]:
        return self.bpe.tokens(self.last)


class TextEncoder:
    """Cuts texts by a pattern and encodes the matches; remembers what it met."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, cut_at_spaces: bool):
        import regex

        self.bpe, self.cut, self.cut_at_spaces = PrefixBpe(ranks), regex.compile(pattern), cut_at_spaces
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.after_space: dict[str, tuple[int, ...]] = {}   # of a space and the key

    def _ids(self, cuts: list[list[str]]) -> list[tuple[int, ...]]:
        """The ids of lists of pieces, each list's in one tuple."""
        spaced, others = self.after_space, self.pieces
        new = {p for ps in cuts for p in ps if (p[1:] not in spaced if p[0] == " " else p not in others)}
        if len(spaced) + len(others) + len(new) > PIECES_KEPT:   # start again with what this round needs
            used = {p for ps in cuts for p in ps} - new
            spaced, others = ({p[1:]: spaced[p[1:]] for p in used if p[0] == " "},
                              {p: others[p] for p in used if p[0] != " "})
            self.after_space, self.pieces = spaced, others
        found = self.bpe.encode_pieces({p.encode() for p in new})
        for p in new:
            if p[0] == " ":
                spaced[p[1:]] = tuple(found[p.encode()])
            else:
                others[p] = tuple(found[p.encode()])
        out = []
        for ps in cuts:
            ids: tuple[int, ...] = ()
            for p in ps:
                ids += spaced[p[1:]] if p[0] == " " else others[p]
            out.append(ids)
        for p in new:   # long unbroken pieces are none to meet again
            if len(p) > 64:
                (spaced if p[0] == " " else others).pop(p[1:] if p[0] == " " else p)
        return out

    def _after_space(self, words: list[str]) -> list[tuple[int, ...]]:
        """The ids of a space and each of ``words``, which hold no space."""
        out = list(map(self.after_space.get, words))
        new = [w for w, ids in zip(words, out) if ids is None]
        plain = [w for w in new if w and not w[-1].isspace()]
        # nearly every word is one match of the pattern, together with its space
        single: dict[str, str] = {}
        longer: dict[str, list[str]] = {w: self.cut.findall(" " + w) for w in set(new).difference(plain)}
        at, word, current = iter(plain), "", None
        for piece in self.cut.findall(" " + " ".join(plain)) if plain else ():
            if piece[0] == " ":   # the only spaces are those between the words
                word, current = next(at), None
                single[word] = piece
            elif current is None:
                current = longer[word] = [single.pop(word), piece]
            else:
                current.append(piece)
        learnt = dict(zip(longer, self._ids(list(longer.values()))))
        data = [piece.encode() for piece in single.values()]
        found = self.bpe.encode_pieces(data)
        learnt.update((w, tuple(found[d])) for w, d in zip(single, data))
        if len(self.after_space) + len(self.pieces) + len(learnt) > PIECES_KEPT:   # keep what this round has used
            self.after_space = {w: ids for w, ids in zip(words, out) if ids is not None}
        self.after_space.update((w, ids) for w, ids in learnt.items() if len(w) <= 64)
        return [learnt[w] if ids is None else ids for w, ids in zip(words, out)]

    def encode(self, texts: pa.Array) -> pa.ListArray:
        """An array of ids for each text."""
        texts = pc.fill_null(texts, "")
        whole = pc.or_(pc.match_substring_regex(texts, _SPACE_BESIDE_SPACE), not self.cut_at_spaces)
        words = pc.split_pattern(pc.if_else(whole, "", texts), " ")
        coded = words.flatten().dictionary_encode()
        index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        begin = words.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
        begin = begin - begin[0]
        # what a text begins with has no space before it; some texts are cut as a whole
        heads = [self.cut.findall(t) for t in
                 pc.if_else(whole, texts, pc.list_element(words, 0)).to_pylist()]
        entries = self._after_space(coded.dictionary.to_pylist()) + self._ids(heads)
        index[begin[:-1]] = len(coded.dictionary) + np.arange(len(texts))
        sizes = np.fromiter(map(len, entries), dtype=np.int64, count=len(entries))
        flat = np.fromiter(chain.from_iterable(entries), dtype=np.int32, count=int(sizes.sum()))
        offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
        taken = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)).take(pa.array(index))
        return pa.ListArray.from_arrays(pa.array(taken.offsets.to_numpy()[begin]), taken.values)


# A space at the end or beside another white-space character.
_WHITE = r"[\t-\r\x1c-\x1f \x{85}\p{Z}]"
_SPACE_BESIDE_SPACE = f" {_WHITE}|{_WHITE} | $"
_ENCODERS: dict[tuple, TextEncoder] = {}


def _encoder(ranks: dict[bytes, int], pattern: str, cut_at_spaces: bool) -> TextEncoder:
    """The worker's encoder for a vocabulary and pattern."""
    mark = (len(ranks), hash(frozenset(ranks.items())), pattern, cut_at_spaces)
    if mark not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[mark] = TextEncoder(ranks, pattern, cut_at_spaces)
    return _ENCODERS[mark]


def _slices(batch: pa.RecordBatch, at: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows of about ``most`` bytes of text (one row at least)."""
    lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False))
    run = np.cumsum(lengths.astype(np.int64)) // most
    starts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
    for a, b in zip(starts, starts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def encode(docs: DataFrame, vocabulary: str, pattern: str, text_col: str = "text",
           ids_col: str = "token_ids", cut_at_spaces: bool = True) -> DataFrame:
    """``docs`` with the token ids of ``text_col`` in ``ids_col`` (array of int).

    Null and empty texts give an empty array.  Whole texts are encoded; rows and
    further columns stay as they are.  A column named ``ids_col`` is replaced.
    ``cut_at_spaces`` holds for patterns that let a single space between two other
    characters only begin a match, as those of the usual vocabularies do: texts
    without runs of white space are then cut there before the pattern is tried.
    """
    ranks = read_ranks(vocabulary)
    sent = docs.sparkSession.sparkContext.broadcast(ranks)
    docs = docs.drop(ids_col)
    schema = StructType([*docs.schema.fields,
                         StructField(ids_col, ArrayType(IntegerType(), False), False)])
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(sent.value, pattern, cut_at_spaces)
        for batch in batches:
            for part in _slices(batch, at):
                ids = encoder.encode(part.column(at))
                yield pa.RecordBatch.from_arrays([*part.columns, ids],
                                                 names=[*part.schema.names, ids_col])

    return docs.mapInArrow(run, schema)


def decode(df: DataFrame, vocabulary: str, ids_col: str = "token_ids",
           bytes_col: str = "decoded") -> DataFrame:
    """``df`` with the bytes of ``ids_col`` in ``bytes_col``; null ids count as none.
    An id outside the vocabulary is an error."""
    by_id = {r: t for t, r in read_ranks(vocabulary).items()}
    sent = df.sparkSession.sparkContext.broadcast([by_id.get(i) for i in range(max(by_id, default=-1) + 1)])
    df = df.drop(bytes_col)
    schema = StructType([*df.schema.fields, StructField(bytes_col, BinaryType(), False)])
    at = df.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = pa.array(sent.value, pa.binary())
        for batch in batches:
            ids = batch.column(at)
            parts = tokens.take(ids.flatten())   # the bytes of all tokens, one after the other
            if parts.null_count:
                raise ValueError("an id is not in the vocabulary")
            sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
            ends = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
            begin = np.frombuffer(parts.buffers()[1], dtype=np.int32)[parts.offset:][:len(parts) + 1] if len(parts) \
                else np.zeros(1, dtype=np.int32)
            text = pa.Array.from_buffers(pa.binary(), batch.num_rows, [
                None, pa.py_buffer(np.ascontiguousarray(begin[ends])), parts.buffers()[2]])
            yield pa.RecordBatch.from_arrays([*batch.columns, text], names=[*batch.schema.names, bytes_col])

    return df.mapInArrow(run, schema)


def encoding_digest(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """Per document: number of ids, digest of the ids, digest of the decoded bytes."""
    ids = encode(docs.select("doc_id", "text"), vocabulary, pattern).select("doc_id", "token_ids")
    both = decode(ids, vocabulary)
    return both.select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("token_ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
