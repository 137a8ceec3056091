"""Round trips, invariants and held-out accuracy."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from forecourt.llm import bpe, components, replytrees, sharding, toxicity, wordpiece
from forecourt.llm.common import set_bits, ship, with_bit
from forecourt.llm.queries import QUERIES, vocabulary
from tests.llm import brute

P = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    import tiktoken

    ranks = bpe.read_ranks(vocabulary("byte_bpe_50k.tiktoken"))
    return ranks, tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts(n):
    rng = random.Random(1)
    parts = ["a", "B", " ", "  ", "\n", "\t", "1", "'s", "!", " ", "é", "中", "　", "the", "tion", "\U0001f600", "́", "x" * 70]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(n)] + [
        "", " ", "  ", "a  b", "a   b", " a b ", "a \n b", "abc\n", "<|endoftext|>", "a" * 5000, "word " * 30_000]


def test_bpe_is_the_librarys(spark, library):
    rows = [(r.doc_id, r.text) for r in ship(spark).read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows += [(10_000 + i, t) for i, t in enumerate(odd_texts(3000))] + [(None, None), (7, None)]
    frame = spark.createDataFrame([(d, t, [1], b"x") for d, t in rows], "doc_id long, text string, token_ids array<int>, decoded binary")
    coded = bpe.encode(frame, vocabulary("byte_bpe_50k.tiktoken"), P.PATTERN)
    both = bpe.decode(coded, vocabulary("byte_bpe_50k.tiktoken"))
    assert sorted(both.columns) == sorted(frame.columns)
    for r in both.collect():
        assert r.token_ids == library[1].encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()
    assert bpe.encode(frame.limit(0), vocabulary("byte_bpe_50k.tiktoken"), P.PATTERN).count() == 0


def test_bpe_pieces_and_edits(library):
    ranks, enc = library
    one, rng = bpe.PrefixBpe(ranks), random.Random(4)
    for i in range(4000):
        n = rng.randint(1, 30)
        data = bytes(rng.choice(b"abetn ") for _ in range(n)) if i % 2 else bytes(rng.randrange(256) for _ in range(n))
        assert one.encode_piece(data) == enc._encode_single_piece(data)
    text = bpe.PrefixTable(one, b"hello world this is a test of the thing " * 20)
    for _ in range(200):
        a = rng.randint(0, len(text.data))
        b = min(len(text.data), a + rng.randint(0, 5))
        text.replace(a, b, bytes(rng.choice(b"theing abc") for _ in range(rng.randint(0, 6))))
        assert text.last == bpe.PrefixTable(one, text.data).last
    far = bpe.PrefixTable(one, b" the cat sat on the mat" * 1000)
    assert far.replace(100, 101, b"q") < 600   # not all 23,000 prefixes


def test_word_pieces_are_the_librarys(spark):
    from tokenizers import Tokenizer, models

    spec = wordpiece.read_vocabulary(vocabulary("word_bpe_49k.json"))
    counter = wordpiece.WordCounter(spec)
    import json
    pieces = [p[:-4] + wordpiece.END if p.endswith("</w>") else p for p in json.loads(spec)["pieces"]]
    greedy = Tokenizer(models.WordPiece({p: i for i, p in enumerate(pieces)} | {"[UNK]": len(pieces)}, unk_token="[UNK]",
                                        continuing_subword_prefix="", max_input_chars_per_word=10**6))
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(60).collect()] + odd_texts(200)[:-2]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in wordpiece.token_counts(frame, vocabulary("word_bpe_49k.json")).collect()}
    import unicodedata
    for i, t in enumerate(texts):
        words = counter.words(unicodedata.normalize("NFC", t).lower())
        assert got[i].n_words == len(words)
        assert got[i].n_tokens == sum(len(greedy.encode(w).ids) for w in words)
    assert got[None].n_tokens == 0


def test_toxicity_held_out():
    import duckdb

    rows = duckdb.sql("SELECT doc_id, text, toxic FROM '/root/testdata/sf0.1/documents.parquet' "
                      "JOIN '/root/testdata/sf0.1/labels.parquet' USING (doc_id) ORDER BY hash(doc_id)").fetchall()
    kept = [zlib.crc32(str(d).encode()) % 5 == 0 for d, _, _ in rows]
    model = toxicity.train([(t, y) for (_, t, y), out in zip(rows, kept) if not out])
    a, b = toxicity._compressor(model.ordinary), toxicity._compressor(model.toxic)
    scores = [(float(model.score(toxicity.features(t, a, b)[None])[0]), y) for (_, t, y), out in zip(rows, kept) if out]
    toxic, clean = [s for s, y in scores if y], [s for s, y in scores if not y]
    auc = sum((s > c) + (s == c) / 2 for s in toxic for c in clean) / len(toxic) / len(clean)
    assert auc > 0.8       # 350 toxic texts to learn from; with 1,700 it is 0.99
    assert sum(c >= 0.5 for c in clean) / len(clean) < 0.03
    assert sum(s >= 0.5 for s in toxic) / len(toxic) > 0.5


def test_toxicity_odd_inputs(spark):
    docs = spark.createDataFrame([(1, "you idiot " * 9, 0.5, "m"), (2, None, 0.1, "m"), (3, "", 0.1, "m"), (None, "kind words here", 0.1, "m"),
                                  (1, "you idiot " * 9, 0.5, "m")], "doc_id long, text string, score double, y string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (3, None), (None, 1), (9, 1)], "doc_id long, toxic int")
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert toxicity.toxicity(docs, labels.limit(0)).count() == 5
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0


def test_reply_trees(spark):
    rng = random.Random(6)
    rows, up = [], {}
    for tree in range(5):
        for node in range(1, 40):
            up[tree, node] = rng.randint(1, node - 1) if node > 1 and rng.random() < 0.95 else None
            rows.append((tree, node, up[tree, node], rng.choice(["user", "assistant"]), f"t{node} \\### < </turn> : x", rng.random()))
    rows += [(9, 1, 2, "user", "ring", 1.0), (9, 2, 1, "user", "ring", 1.0), (None, 1, None, None, None, None)]
    frame = spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double")
    known, score = {(r[0], r[1]): r for r in rows}, {(r[0], r[1]): r[5] for r in rows}
    want = {}
    for tree, node in up:
        if (tree, node) not in {(t, p) for (t, _), p in up.items()}:
            path, at = [], node
            while at:
                path.append(at)
                at = up[tree, at]
            want[tree, node] = path[::-1]
    want[None, 1] = [1]
    got = {(r.tree, r.leaf): [(t.role, t.text) for t in r.turns] for r in replytrees.branches(frame, None).collect()}
    assert got == {k: [(known[k[0], n][3], known[k[0], n][4]) for n in path] for k, path in want.items()}
    best = {(r.tree, r.leaf) for r in replytrees.branches(frame, 1).collect()}
    for tree in range(5):
        leaves = [k for k in want if k[0] == tree]
        assert max(leaves, key=lambda k: (sum(score[tree, n] for n in want[k]) / len(want[k]), -k[1])) in best


def test_chat_round_trip(spark):
    rng = random.Random(8)
    bits = ["\\", "###", "####", "<", "</turn>", " </turn>\n", "### assistant : ", " : ", ":", "\n", "é", "x", " ", "\\\\###", "$0"]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "odd : role\\", None]),
             None if rng.random() < 0.1 else "".join(rng.choice(bits) for _ in range(rng.randint(0, 8)))) for c in range(60) for t in range(c % 7 + 1)]
    rows += [(100, 0, "assistant", "y" * 300_000), (None, 0, "user", "lost"), (101, 1, "assistant", "b"), (101, 1, "assistant", "b"), (101, None, "user", "a")]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, node int")
    want = defaultdict(list)
    for c, t, r, x in sorted(rows, key=lambda r: (r[0] or -1, -1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        want[c].append((r or "", x or ""))
    got = replytrees.conversation_digest(frame).collect()
    assert len(got) == len(want)
    for r in got:
        turns = want[r.conv_id]
        loss = "".join(x for role, x in turns if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(turns), brute.sha("".join(f"{a}\n{b}\n" for a, b in turns)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), brute.sha(loss))
    assert replytrees.conversation_digest(frame.limit(0)).count() == 0


def test_sharding(spark):
    rows = [(i, f"text {i % 400}" if i % 3 else "the common one", "x") for i in range(3000)]
    rows += [(5000, None, "x"), (5001, None, "x"), (None, "é", "x"), (5002, "", "x"), (5002, "", "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, shard string").repartition(5)
    got = sharding.sharding(frame).collect()
    assert len(got) == len(rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, _ in rows)
    counts = Counter(r.shard for r in got)
    assert set(counts) == set(range(24)) and max(counts.values()) - min(counts.values()) <= 1
    for s, n in counts.items():
        assert sorted(r.slot for r in got if r.shard == s) == list(range(n))
    shards = defaultdict(set)
    for r in got:
        shards[r.size, r.text_crc32].add(r.shard)
    small = [len(v) for k, v in shards.items() if k != (len("the common one") + 8, zlib.crc32(b"the common one"))]
    assert sum(small) / len(small) < 2         # a hash would part nearly all of them
    assert sharding.sharding(frame.limit(0)).count() == 0
    assert sharding.sharding(frame.limit(7)).count() == 7


def test_components(spark):
    rng = random.Random(11)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(i, i + 1) for i in range(1000, 1300)]
    edges += [(2000, 2000 + i) for i in range(500)] + [(None, 3), (5, None), (7, 7)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    sets = brute.Sets({x for e in edges for x in e if x is not None})
    for a, b in edges:
        if a is not None and b is not None:
            sets.join(a, b)
    assert got == {x: sets.find(x) for x in sets.up if sum(1 for a, b in edges if None not in (a, b) and a != b and x in (a, b))}


def test_bit_map(spark):
    hashes = [random.Random(k).getrandbits(64) - (1 << 63) for k in range(3000)]
    bits = set_bits(spark.createDataFrame([(h,) for h in hashes], "h long"))
    assert all(with_bit(bits, h) for h in hashes)
    assert sum(with_bit(bits, k * 7919) for k in range(10_000)) < 100
    assert not any(set_bits(spark.createDataFrame([], "h long")))


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs, _ = corpus_pipeline.staged(stage(spark, docs, SF), f"test-{name}")
        if name != "bpe":
            assert docs.columns == columns
    whole = corpus_pipeline.run(spark, SF)
    assert {tuple(r[:5]) for r in whole.collect()} == {tuple(r[:5]) for r in docs.collect()}
    assert 0 < docs.count() < spark.read.parquet(f"{SF}/documents.parquet").count()
    empty, _ = corpus_pipeline.staged(spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 0"), "test-empty")
    for _, stage in corpus_pipeline.STAGES:
        empty, _ = corpus_pipeline.staged(stage(spark, empty, SF), "test-empty")
    assert empty.count() == 0


def test_all_operators_are_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert set(QUERIES) <= set(names)


def test_queries_against_sql(spark):
    import duckdb

    from forecourt.llm.queries import ORACLES

    db = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name, sql in ORACLES.items():
        got = QUERIES[name](spark, SF)
        want = db.sql(sql)
        columns = sorted(want.columns)
        assert sorted(got.columns) == columns
        assert sorted(map(tuple, got.select(columns).collect())) == sorted(want.select(*map(duckdb.ColumnExpression, columns)).fetchall())
