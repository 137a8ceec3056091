"""Each operator against its plain version, over the small tables and odd inputs."""

from __future__ import annotations

import random

import pytest

from forecourt.llm import decontaminate, lines, paragraphs, simhash, vectors, wordpiece
from forecourt.llm.common import ship
from tests.llm import brute

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i % 977}" for i in range(60_000))
ODD = [(901, None), (902, ""), (903, "   "), (904, "one"), (905, "ÄÖ É 123"), (906, "a b c d"), (907, LONG),
       (908, LONG + " more"), (909, "x"), (910, "X"), (911, "\n\n"), (912, "tab\tand\x0bmore\r\nwords  here")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(r.doc_id, r.text) for r in ship(spark).read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    return rows + ODD


@pytest.fixture(scope="module")
def frame(spark, docs):
    # columns that clash with the operators' own
    return spark.createDataFrame([(d, t, "l", "s", 1, 2, 3, "k") for d, t in docs],
                                 "doc_id long, text string, line string, key string, fp int, start int, node int, __id string").repartition(3)


def test_decontamination(spark, docs, frame):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    words = docs[5][1].split()
    items += [(1001, None), (1002, " . "), (1003, " ".join(words[3:7])), (1004, " ".join(words[2:30]).upper()),
              (1005, " ".join(words[2:30])), (1006, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11"), (1007, "nowhere1 at all")]
    got = decontaminate.contamination(frame, spark.createDataFrame(items, "item_id long, text string"))
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == brute.contamination(docs, items)


def test_decontamination_without_items(spark, docs, frame):
    got = decontaminate.contamination(frame, spark.createDataFrame([], "item_id long, text string"))
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == brute.contamination(docs, [])
    empty = decontaminate.contamination(frame.limit(0), spark.createDataFrame([(1, "a")], "item_id long, text string"))
    assert empty.count() == 0


def test_decontamination_by_text(spark):
    item = "one two three four five six seven eight nine ten"
    rows = [(None, f"so {item} there"), (None, "clean text"), (5, f"{item} again {item}"), (5, "also clean"), (5, None), (6, None)]
    got = decontaminate.contamination(spark.createDataFrame(rows, "doc_id long, text string"),
                                      spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in got) == [
        (0, 2, 0, 0, False), (0, 12, 10, 1, True), (5, 0, 0, 0, False), (5, 2, 0, 0, False), (5, 21, 20, 1, True), (6, 0, 0, 0, False)]


def test_simhash(docs, frame):
    got = simhash.near_duplicates(frame)
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == brute.near_duplicates(docs)


def test_simhash_links_every_distance(spark):
    rng = random.Random(5)
    fps = [rng.getrandbits(64) for _ in range(60)]
    for f in list(fps):
        for n in (1, 2, 3, 4, 5):
            fps.append(f ^ sum(1 << b for b in rng.sample(range(64), n)))
    fps = sorted({simhash._signed(f) for f in fps})
    frame = spark.createDataFrame([(f,) for f in fps], "fp long")
    near = simhash.with_partners(frame)
    links = {(r.src, r.dst) for r in simhash.ball_links(near).collect()}
    sets, want = brute.Sets(fps), brute.Sets(fps)
    for a, b in links:
        assert ((a ^ b) & (1 << 64) - 1).bit_count() <= 4
        sets.join(a, b)
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4:
                want.join(a, b)
    assert [sets.find(f) for f in fps] == [want.find(f) for f in fps]


def test_keep_first(docs, frame):
    kept = simhash.keep_first(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in brute.near_duplicates(docs).values()})


def test_keep_first_chooses_by_group(spark):
    rng = random.Random(11)
    a, b, c, d, e = (" ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(40)) for _ in range(5))
    rows = [(5, a, 1), (5, b, 2), (3, b, 3), (None, c, 4), (None, d, 5), (None, c, 6), (9, d, 7), (None, e, 8),
            (7, e.upper(), 9), (7, e, 10), (None, None, 11), (None, "", 12)]
    got = simhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string, n int")).collect()
    assert sorted(((r.doc_id or 0), r.text or "") for r in got) == sorted(
        [(5, a), (3, b), (0, c), (9, d), (7, e.upper()), (0, "")])   # upper case sorts first
    many = [(None, " ".join(f"x{i}y{k}" for k in range(30)), i) for i in range(200)]
    assert simhash.keep_first(spark.createDataFrame(many, "doc_id long, text string, n int")).count() == 200


def near_lines():
    rng = random.Random(3)
    base = ["the quick brown fox jumps", "aaaaaaaaaaaaaaaaaaaaaa", "ünïcödé line of some length", "short one"]
    out = []
    for k in range(60):
        line = list(rng.choice(base))
        for _ in range(rng.randint(0, 2)):
            at, what = rng.randrange(len(line)), rng.randrange(3)
            if what == 0:
                del line[at]
            elif what == 1:
                line.insert(at, rng.choice("abé "))
            else:
                line[at] = rng.choice("xyzß")
        out.append((k, "\n".join(["".join(line), "short one", "", rng.choice(base)])))
    return out


def test_lines(spark, docs, frame):
    want = brute.dedup_lines(docs)
    got = lines.dedup_lines(frame)
    assert got.columns == frame.columns
    assert {r.doc_id: r.text for r in got.collect()} == want


def test_lines_within_one_edit(spark):
    rows = near_lines()
    got = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.text for r in got.collect()} == brute.dedup_lines(rows)


def test_lines_null_ids_and_repeated_rows(spark):
    rows = [(None, "the very same line here"), (3, "the very same line here"), (5, "another line\nmore"), (5, "another line\nmore")]
    got = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or -1, r.text) for r in got) == [
        (-1, "the very same line here"), (3, ""), (5, "another line\nmore"), (5, "another line\nmore")]
    assert lines.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_paragraphs(spark):
    rng = random.Random(9)
    vocabulary = [f"wort{i}" for i in range(400)]

    def prose(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    rows, base = [], [prose(60 + 15 * k) for k in range(5)]
    for d in range(60):
        parts = [" ".join(prose(rng.randint(5, 80)))]
        p = list(rng.choice(base))
        for _ in range(rng.choice((0, 0, 1, 2, 6))):
            p[rng.randrange(len(p))] = rng.choice(vocabulary)
        parts.insert(rng.randrange(2), " ".join(p))
        rows.append((d, "\n".join(parts)))
    rows += [(100, None), (101, ""), (102, rows[0][1]), (103, rows[0][1].upper())]
    got = paragraphs.repeated_paragraphs(spark.createDataFrame([(d, t, 0, 0) for d, t in rows], "doc_id long, text string, h1 int, n int"))
    got = got.collect()
    want = brute.repeated_paragraphs(rows)
    assert {(r.doc_id, r.line_no): (r.cluster_doc_id, r.cluster_line_no) for r in got} == want
    assert all(r.kept == ((r.doc_id, r.line_no) == (r.cluster_doc_id, r.cluster_line_no)) for r in got)
    assert paragraphs.repeated_paragraphs(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_passages(spark):
    rng = random.Random(4)

    def prose(n):
        return [f"p{rng.randrange(10 ** 7)}" for _ in range(n)]

    def lines_of(words, n):
        return "\n".join(" ".join(words[k:k + n]) for k in range(0, len(words), n))

    inside, over, near, exact = prose(70), prose(70), prose(120), prose(50)
    changed = list(near)
    changed[40], changed[85] = "other1", "other2"
    short = " ".join(prose(9))

    def around(passage, before, after):
        return " ".join(prose(before) + passage + prose(after))

    planted = {1: (30, 70), 2: (55, 70), 3: (40, 70), 4: (21, 70), 5: (10, 120), 6: (33, 120), 11: (25, 50), 12: (60, 50)}
    rows = [(1, around(inside, 30, 40)), (2, around(inside, 55, 12)),
            (3, lines_of(prose(40) + over + prose(9), 11)), (4, lines_of(prose(21) + over + prose(30), 17)),
            (5, around(near, 10, 20)), (6, around(changed, 33, 0)),
            (7, f"{around([], 20, 0)}\n{short}"), (8, f"{short}\n{around([], 60, 0)}"),
            (9, around([], 300, 0)), (10, " ".join(["same"] * 60)), (11, around(exact, 25, 30)), (12, around(exact, 60, 8)),
            (None, around(inside, 5, 5)), (None, around(inside, 5, 6)), (13, None), (14, "")]
    got = paragraphs.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.line_no, r.kept) for r in got if r.unit == "line"} == {(7, 1, True), (8, 0, False)}
    spans = [r for r in got if r.unit == "passage" and r.doc_id is not None]
    assert {r.doc_id for r in spans} == set(planted)
    for doc, (start, n) in planted.items():
        words = {k for r in spans if r.doc_id == doc for k in range(r.first_word, r.first_word + r.n_words)}
        assert len(words & set(range(start, start + n))) >= n - 24
        assert words <= set(range(start - 6, start + n + 6))
    assert {(r.doc_id, r.kept) for r in spans} == {(3, True), (4, False), (5, True), (6, False), (1, False), (2, False), (11, True), (12, False)}
    none = [r for r in got if r.doc_id is None]
    assert sorted(r.kept for r in none) == [False, True]   # the same passage, in texts without an id
    assert [r.line_no for r in spans if r.doc_id == 4] == [min(r.first_word // 17 for r in spans if r.doc_id == 4)]
    twice = paragraphs.repeated_passages(spark.createDataFrame([(1, rows[8][1])] * 2, "doc_id long, text string")).collect()
    assert {(r.n_rows, r.kept) for r in twice if r.unit == "passage"} == {(2, True)}
    assert paragraphs.repeated_passages(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_passages_of_long_texts(spark):
    rng = random.Random(12)
    words = [f"v{rng.randrange(10 ** 7)}" for _ in range(30_000)]
    other = [f"u{rng.randrange(10 ** 7)}" for _ in range(100)]
    rows = [(1, " ".join(words)), (2, " ".join(other + words[9_000:9_200])), (3, None), (4, " ".join(words[:-1]) + " Ä")]
    got = paragraphs.repeated_passages(spark.createDataFrame(
        [(d, t, 1, 2, 3, "k") for d, t in rows], "doc_id long, text string, h1 int, of int, start int, keys string")).collect()
    assert {(r.doc_id, r.cluster_doc_id, r.kept) for r in got if r.unit == "line"} == {(1, 1, True), (4, 1, False)}
    spans = [r for r in got if r.unit == "passage" and r.doc_id == 2]
    assert all((r.cluster_doc_id, r.kept) == (1, False) for r in spans)
    found = {k for r in spans for k in range(r.first_word, r.first_word + r.n_words)}
    assert found <= set(range(100, 300)) and len(found) >= 176


def test_vectors(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    n = len(rows)
    odd = [None, [], [0.0] * 64, [1.0] * 63 + [None], [float("nan")] * 64, [float("inf")] + [1.0] * 63, [1e-200] * 64,
           [1e200] * 64, [1.0] * 3, [2.0] * 3, rows[0][1], rows[0][1]]
    rows += [(n + k + 1000, v) for k, v in enumerate(odd)]
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, node int, h string")
    got = {r.vec_id: r for r in vectors.near_vectors(frame).collect()}
    want, _ = brute.near_vectors([(i, None if v is not None and v and max((abs(x) for x in v if x), default=0) in (1e-200, 1e200)
                                   else v) for i, v in rows])
    tiny = {n + 1006, n + 1007}   # link with each other, which the plain sum of squares cannot tell
    assert got[n + 1006].n_links == got[n + 1007].n_links == 1
    linked = sum(want[i][0] for i in want if i not in tiny)
    assert all(got[i].n_links <= want[i][0] for i in want if i not in tiny)
    assert sum(got[i].n_links for i in want if i not in tiny) >= 0.97 * linked
    assert all(got[i].kept == (got[i].component_id == i) for i in got)


def test_vectors_hot_bucket(spark, monkeypatch):
    import numpy as np

    monkeypatch.setattr(vectors, "BLOCK", 16)
    rng = np.random.default_rng(1)
    centre = rng.standard_normal(32)
    rows = [(i, (centre + 0.01 * rng.standard_normal(32)).tolist()) for i in range(150)]
    rows += [(1000 + i, rng.standard_normal(32).tolist()) for i in range(30)]
    got = vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    want, _ = brute.near_vectors(rows)
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want


@pytest.mark.parametrize("continuation", ["##", ""])
def test_longest_match(continuation):
    rng = random.Random(2)
    for _ in range(60):
        pieces = {(continuation if rng.random() < 0.6 else "") + "".join(rng.choice("abc") for _ in range(rng.randint(1, 5)))
                  for _ in range(rng.randint(1, 25))}
        automaton = wordpiece.LongestMatch(pieces, continuation)
        for _ in range(60):
            word = "".join(rng.choice("abcd" if rng.random() < 0.2 else "abc") for _ in range(rng.randint(1, 12)))
            assert automaton.count(word) == brute.longest_match(word, pieces, continuation), (pieces, word)
