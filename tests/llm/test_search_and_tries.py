"""Ranked search, language identification and prefix tries against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from forecourt.llm import language, prefixtrie, ranking
from forecourt.llm.common import ship
from tests.llm.brute import lower_ascii

SF = "/root/testdata/sf0.001"
ROWS = "doc_id long, text string"


# --- ranked search -----------------------------------------------------------

def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower_ascii(text))


def ranked(docs, items, top=20):
    docs = [(d, t, Counter(terms(t)), len(terms(t))) for d, t in docs]
    n_docs, n_terms = sum(n > 0 for *_, n in docs), sum(n for *_, n in docs)
    df = Counter(w for _, _, c, _ in docs for w in c)
    asked = defaultdict(Counter)
    for item, text in items:
        asked[item].update(terms(text))
    out = []
    for item, words in asked.items():
        found = []
        for doc, text, tf, n in docs:
            score = 0
            for w, times in words.items():
                if tf[w]:
                    m = 100 - 25 + 25 * n * n_docs // n_terms
                    score += times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (
                        1_000_000_000 * tf[w] // (1000 * tf[w] + 12 * m))
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        found = sorted(found)[:top]
        out += [(item, k + 1, None if none else doc, -s) for k, (s, none, doc) in enumerate(found)]
    return sorted(out, key=str)


def random_text(rng, n):
    return "".join(
        rng.choice(["a", "b", "Bc", "c", "the", "THE", "éa", "É", "x1", "9", "中文", "q" * 50]) + rng.choice([" ", "  ", "\n", ".", "-", "_", "\x00", " "])
        for _ in range(n))


@pytest.mark.parametrize("block_items, block_bytes", [(2048, 1 << 20), (3, 1 << 20), (2048, 200)])
def test_ranking_is_the_plain_one(spark, block_items, block_bytes):
    rng = random.Random(3)
    docs = [(i, random_text(rng, rng.randint(0, 30))) for i in range(300)] + [(None, "a b the"), (None, "a b the c"), (5, "the the é"),
                                                                             (7, None), (8, ""), (9, "..."), (1000, "a " * 50_000), (-3, "a b the")]
    docs += [(2000 + i, "hot copy the a") for i in range(100)]
    items = [(i, random_text(rng, rng.randint(0, 8))) for i in range(12)] + [(3, "a 中文"), (50, None), (51, "?"), (52, "absent words"), (None, "b c")]
    frame = ship(spark).createDataFrame([(t, d, [1.0], 5) for d, t in docs], "text string, doc_id long, ids array<double>, score long").repartition(5)
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int")
    got = ranking.ranked(frame, asked, block_items=block_items, block_bytes=block_bytes)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == ranked(docs, items)


def test_ranking_of_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], ROWS), spark.createDataFrame([(1, "a")], "item_id long, text string")
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs, items.withColumn("text", F.lit(None).cast("string"))),
                 (docs.withColumn("text", F.lit("-")), items)):
        empty = ranking.ranked(d, i)
        assert empty.count() == 0 and dict(empty.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    assert [tuple(r)[:3] for r in ranking.ranked(docs, items).collect()] == [(1, 1, 1)]
    more = spark.createDataFrame([(1, "a b"), (2, "b"), (3, "b c")], ROWS)
    assert [tuple(r)[:3] for r in ranking.ranked(more, items).collect()] == [(1, 1, 1)]


def test_a_guarded_term_is_no_part_of_a_longer_one(spark):
    counted = ranking._counted(["ab abc ab,ab\nAB cab", None, ""], ("ab", "abc"))
    assert counted == {"n": [6, 0, 0], "ids": [[0, 1], [], []], "tfs": [[4, 1], [], []]}


# --- language identification -------------------------------------------------

def test_presence_is_that_of_plain_sets():
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcé ñ1.\n") for _ in range(rng.randint(0, 60))) for _ in range(40)] + ["", "x" * 700_000 + "yz", "\x00a\x00"]

    def grams(text):
        line = language.spelled(text)
        return {int.from_bytes(line[k:k + n], "big") for n in range(1, 5) for k in range(len(line) - n + 1)}

    known = np.unique(np.concatenate([language.gram_set(t) for t in texts[:20]]))
    assert set(known.tolist()) == set().union(*(grams(t) for t in texts[:20]))
    got = language.Spectrum(known).presence([language.spelled(t) for t in texts])
    for row, text in zip(got, texts):
        assert set(known[row > 0].tolist()) == grams(text) & set(known.tolist())


def test_scores_are_those_of_the_kernel_machine(spark):
    """The multiplied-out weights give what kernel, whitening and ridge regression give one after the other."""
    rng = random.Random(2)
    words = {"xx": ["foo", "bar", "baz"], "yy": ["été", "çà", "là"], "zz": ["und", "ach", "ich"]}
    rows = [(i, " ".join(rng.choice(words[lang]) for _ in range(rng.randint(1, 6))), lang) for i in range(60) for lang in words]
    docs = ship(spark).createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs, fit_rows=30, landmarks=9)
    assert model.langs == ("xx", "yy", "zz")
    by_lang = defaultdict(set)
    for r in docs.select("lang", "text", F.xxhash64("text").alias("h")).collect():
        by_lang[r.lang].add((r.h, r.text))
    sample = [(lang, t) for lang in model.langs for _, t in sorted(by_lang[lang])[:10]]
    marks = [language.gram_set(t) for lang in model.langs for _, t in sorted(by_lang[lang])[:3]]

    def kernel(a, b):
        a, b = set(a.tolist()) & known, set(b.tolist()) & known
        return len(a & b) / math.sqrt(max(len(a), 1) * max(len(b), 1))

    known = set(np.concatenate(marks).tolist())
    assert known == set(model.grams.tolist())
    values, vectors = np.linalg.eigh(np.array([[kernel(a, b) for b in marks] for a in marks]))
    good = values > 1e-6 * values[-1]
    whiten = vectors[:, good] / np.sqrt(values[good])
    x = np.array([[kernel(language.gram_set(t), m) for m in marks] for _, t in sample]) @ whiten
    y = np.array([[float(lang == k) for k in model.langs] for lang, _ in sample])
    w = (1 / y.sum(axis=0))[y.argmax(axis=1)][:, None]
    ridge = np.linalg.solve(x.T @ (x * w) + language.RIDGE * np.eye(x.shape[1]), x.T @ (y * w))
    spectrum = language.Spectrum(model.grams)
    asked = [t for _, t, _ in rows[:40]] + ["foo été", "zzz", "und"]
    got = language.normed(spectrum.presence([language.spelled(t) for t in asked])) @ model.weights
    want = np.array([[kernel(language.gram_set(t), m) for m in marks] for t in asked]) @ whiten @ ridge
    assert np.allclose(got, want, atol=1e-3)


def test_languages_of_held_out_documents(spark):
    docs = ship(spark).read.parquet(f"{SF}/documents.parquet")
    got = language.identified(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert len(held) > 30 and sum(r.lang == r.lang_pred for r in held) / len(held) >= 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_odd_texts_and_tables_of_languages(spark):
    base = [(i, t, lang) for i in range(40) for t, lang in (("the and of " * 3 + str(i), "en"), ("der die und " * 3 + str(i), "de"))]
    odd = [(900, None, "en"), (901, "", "en"), (902, "123 ... —", "de"), (903, "the " * 200_000, "en"), (None, "der die das", "de"),
           (None, "the the", None), (904, "of the", None), (904, "und die", "de"), (905, "中文", "en")]
    frame = ship(spark).createDataFrame([(*r, 1.0, True, "x") for r in base + odd],
                                        "doc_id long, text string, lang string, score double, held_out boolean, lang_pred string")
    got = language.identified(frame)
    assert got.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"] and got.count() == len(base) + len(odd)
    by_id = defaultdict(list)
    for r in got.collect():
        by_id[r.doc_id].append(r)
    assert [(r.lang_pred, r.score) for k in (900, 901, 902) for r in by_id[k]] == [("und", 0.0)] * 3
    assert by_id[903][0].lang_pred == "en" and sorted(r.lang_pred for r in by_id[904]) == ["de", "en"]
    assert sorted(r.lang_pred for r in by_id[None]) == ["de", "en"] and by_id[None][0].held_out is None
    none = language.identified(frame.withColumn("lang", F.lit(None).cast("string")))
    assert {(r.lang_pred, r.score) for r in none.collect()} == {("und", 0.0)}
    assert language.identified(frame.limit(0)).count() == 0
    model = language.fit(frame.filter("lang is not null"))
    said = language.predict(frame.withColumnRenamed("text", "body"), model, "body", "lang_pred", "score")
    assert said.count() == frame.count() and set(said.columns) == {"doc_id", "body", "lang", "held_out", "lang_pred", "score"}


def test_lang_and_id_are_no_inputs(spark):
    """Whatever label, source and id a held-out text carries, the prediction is the same."""
    docs = ship(spark).read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source")
    model = language.fit(docs, ~language.held_out())
    some = docs.filter(language.held_out())
    changed = some.withColumns({"lang": F.lit("xx"), "source": F.lit("y"), "doc_id": -F.col("doc_id")})
    a = sorted((r.text, r.lang_pred, r.score) for r in language.predict(some, model).collect())
    assert a == sorted((r.text, r.lang_pred, r.score) for r in language.predict(changed, model).collect())


# --- prefix tries ------------------------------------------------------------

def trie(convs):
    """Node rows of {id: [(role, text)]}."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids, leaves, saved = defaultdict(list), {}, {}
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    for p in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        leaves[p] = sum(leaves[x] for x in kids[p]) or 1
        saved[p] = sum(saved[x] for x in kids[p]) + (len(members[p]) - 1) * words
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, sorted(c for c in m if len(convs[c]) == len(p)))).encode()).hexdigest())
                   for p, m in members.items()), key=str)


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[c].append((turn is not None, turn or 0, role, tie, text))
    own = {c: [(t[2], t[4]) for t in sorted(v)] for c, v in own.items()}
    return {c: own.get(c - int(math.fmod(c, 20)), [])[:zlib.crc32(str(c).encode()) % 4] + v[zlib.crc32(str(c).encode()) % 4:]
            for c, v in own.items()}


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
TURNS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("n, depth, texts, pack", [(200, 8, 2, 40), (150, 12, 1, 25), (200, 5, 5, 10**6), (40, 40, 1, 30), (120, 3, 3, 1)])
def test_prefix_trie_is_the_plain_one(spark, n, depth, texts, pack):
    rng = random.Random(n + depth)
    rows = [(None, 1, "user", "lost")]
    for c in range(-30, n - 30):
        if rng.random() > .1:
            for t in range(rng.randint(1, depth)):
                rows.append((c, t if rng.random() > .05 else rng.choice([None, 0, 3]), rng.choice(["user", "user", "bot", None]) if texts > 2 else "u",
                             rng.choice(["a b", "c", "", None, "x  y\tz\n"][:texts])))
    rows += [(10_000 + i, t, "user", f"copy {t}") for i in range(60) for t in range(3)]      # a hot group of copies
    frame = spark.createDataFrame([(*r, r[0], 1) for r in rows], TURNS + ", depth long, n_convs long").repartition(6)
    got = prefixtrie.conversation_trie(frame, pack).select(*COLUMNS).collect()
    assert sorted((tuple(r) for r in got), key=str) == trie(rebuilt(rows))


def test_empty_and_turnless_tries(spark):
    assert prefixtrie.conversation_trie(spark.createDataFrame([], TURNS)).count() == 0
    # no conversation 20, so what stands for the first turns of these is nothing
    short = [(c, 0, "user", "hello there") for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 > 0]
    got = prefixtrie.conversation_trie(spark.createDataFrame(short, TURNS)).select(*COLUMNS).collect()
    assert [tuple(r) for r in got] == trie(rebuilt(short)) and got[0].depth == 0 and got[0].n_leaves == 1


def test_a_very_long_conversation(spark):
    rows = [(c, t, "user", "word " * (50_000 if t == 7 else 1)) for c in (1, 2) for t in range(1500)] + [(2, 1500, "user", "end")]
    sequences = prefixtrie.turn_sequences(spark.createDataFrame(rows, TURNS))
    for pack in (100, 10**6):
        got = prefixtrie.prefix_trie(sequences, pack).agg(F.count("*"), F.sum("n_convs"), F.max("saved_tokens"), F.max("n_leaves")).first()
        assert tuple(got) == (1502, 3 + 2 * 1500, 1499 + 50_000, 1)


def test_double_array_holds_exactly_its_sequences():
    rng = random.Random(9)
    sequences = sorted({tuple(rng.randrange(50) for _ in range(rng.randint(0, 6))) for _ in range(500)})
    made = prefixtrie.DoubleArray([list(s) for s in sequences])
    prefixes = {s[:d] for s in sequences for d in range(len(s) + 1)}
    assert len(made.order) == len(prefixes) == len(set(made.order))
    slots = {p: made.walk(list(p)) for p in prefixes}
    assert all(len(slots[p]) == len(p) + 1 for p in prefixes) and len({s[-1] for s in slots.values()}) == len(prefixes)
    for _ in range(2000):
        p = tuple(rng.randrange(55) for _ in range(rng.randint(1, 5)))
        longest = max(d for d in range(len(p) + 1) if p[:d] in prefixes)
        assert len(made.walk(list(p))) == longest + 1
    assert len(made.check) < 3 * len(prefixes)
