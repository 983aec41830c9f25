"""Byte BPE against the merges done one by one, and packing."""

import os
import random
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

pytest.importorskip("millrace.llm")
pytest.importorskip("ahocorasick")

from millrace.llm import bytebpe as B  # noqa: E402
from millrace.llm import packing as P  # noqa: E402

if not os.path.exists(B.VOCABULARY):
    pytest.skip("no vocabulary here", allow_module_level=True)


def merged(bpe, text):
    """Merges of least rank first, as the definition says."""
    out = []
    for piece in bpe.pattern.findall(text):
        parts = list(piece.encode().decode("latin-1"))
        while len(parts) > 1:
            ranks = [(bpe.ids.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            rank, i = min(ranks)
            if rank == 1 << 60:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        out += [bpe.ids[p] for p in parts]
    return out


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("abcdefghilnorstuwyABT019 \n\té中😀́'-_."), max_size=60))
def test_equals_the_merges(text):
    bpe = B.encoder()
    ids = bpe.encode(text)
    assert ids == merged(bpe, text) and bpe.decode(ids) == text


def test_equals_tiktoken_on_whole_documents(data):
    import base64

    import duckdb
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(B.VOCABULARY, "rb"))}
    other = tiktoken.Encoding("own", pat_str=B.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [r[0] for r in duckdb.sql(f"SELECT text FROM '{data}/documents.parquet' WHERE text IS NOT NULL").fetchall()]
    texts += ["a" * 20_000, "<|endoftext|>", " " * 3000, "\r\n\r\n"]
    assert all(B.encoder().encode(t) == other.encode_ordinary(t) for t in texts)


def test_tables(spark):
    df = spark.createDataFrame([(1, "hello world", "c"), (2, "", "c"), (3, None, "c"), (4, " ", "c"), (1, "hello world", "c")], "doc_id long, text string, ids string")
    got = [(r.doc_id, r.ids) for r in B.token_ids(df).collect()]
    assert sorted(got)[:2] == [(1, B.encoder().encode("hello world"))] * 2 and dict(got)[2] == [] == dict(got)[3] and len(dict(got)[4]) == 1
    assert {(r.doc_id, r.n_tokens) for r in B.token_counts(df).collect()} == {(1, 2), (2, 0), (3, 0), (4, 1)}
    assert B.token_ids(df.limit(0)).count() == 0


def test_counts_of_all_texts_at_once():
    import pyarrow as pa

    rng = random.Random(2)
    signs = "abest'sR09  \n\t\x1c\x85\xa0é中😀٠²-_."
    texts = [None, "", " ", "a", " a", "a ", "a  b", "a \nb", "a\n b", "\n", "it 's", *("".join(rng.choices(signs, k=rng.randint(0, 30))) for _ in range(3000))]
    bpe = B.encoder()
    assert bpe.count_all(pa.array(texts)).tolist() == [len(bpe.encode(t)) for t in texts] == [len(merged(bpe, t or "")) for t in texts]
    assert bpe.count_all(pa.array(texts).slice(7, 50)).tolist() == [len(bpe.encode(t)) for t in texts[7:57]]
    assert bpe.count_all(pa.array([], pa.string())).tolist() == []


def test_equal_parts_of_texts_are_counted_once(monkeypatch):
    import pyarrow as pa

    bpe, seen = B.encoder(), []
    monkeypatch.setattr(bpe, "words", lambda text, words=bpe.words: seen.append(text) or words(text))
    texts = [" ".join(["pose", *random.Random(i).choices(["quxolant", "vrimble", "tofset"], k=200)]) for i in range(100)]
    assert bpe.count_all(pa.array(texts)).tolist() == [sum(len(bpe.piece(w)) for w in bpe.pattern.findall(t)) for t in texts]
    assert len(seen) <= 4 + 1  # " pose" and "pose"


# ------------------------------------------------------------------ packing
def test_genetic_steps_keep_every_item():
    rng = random.Random(1)
    sizes = [rng.randint(1, 60) for _ in range(150)]
    order = sorted(range(150), key=lambda i: -sizes[i])
    a, b = P.best_fit(order, sizes, 100, []), P.best_fit(list(range(150)), sizes, 100, [])
    for child in (P.crossover(b, a, sizes, 100, rng), P.mutate(b, sizes, 100, rng), P.decode(P.encode(a, 150))):
        assert sorted(i for x in child for i in x) == list(range(150)) and all(sum(sizes[i] for i in x) <= 100 for x in child)
    best = P.evolve(sizes, 100, [b], rng, 20)[0]
    assert P.fitness(best, sizes, 100) >= P.fitness(b, sizes, 100) and len(best) <= len(b)


def test_packing(spark, monkeypatch):
    monkeypatch.setattr(P, "SHARD_ITEMS", 60)
    rng = random.Random(4)
    sizes = {i: rng.choice([rng.randint(1, 99), 100, 250, 300, 0]) for i in range(400)}
    df = spark.createDataFrame([*((i, n, "c") for i, n in sizes.items()), (1000, None, "c"), (1001, -5, "c")], "doc_id long, n long, container string")
    rows = P.pack_items(df, "doc_id", "n", 100).collect()
    by_doc, fill = defaultdict(int), defaultdict(int)
    for r in rows:
        by_doc[r.doc_id] += r["size"]
        fill[r.container] += r["size"]
    assert by_doc == {**sizes, 1000: 0, 1001: 0} and max(fill.values()) <= 100
    pieces = defaultdict(int)
    for r in rows:
        pieces[r.doc_id] += 1
    assert all(pieces[i] == max(1, -(-n // 100)) for i, n in sizes.items())
    bound = -(-sum(sizes.values()) // 100)
    assert len([f for f in fill.values() if f]) <= 1.05 * bound + 2
    again = P.pack_items(df.repartition(5), "doc_id", "n", 100)
    assert again.select("doc_id", "piece", "container").exceptAll(spark.createDataFrame([(r.doc_id, r.piece, r.container) for r in rows], "doc_id long, piece int, container string")).count() == 0


def test_packing_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, n long")
    assert P.pack_items(empty, "doc_id", "n", 10).count() == 0
    assert P.pack_items(empty.union(spark.createDataFrame([(1, 10)], "doc_id long, n long")), "doc_id", "n", 10).select(F.sum("size")).first()[0] == 10
    with pytest.raises(ValueError):
        P.pack_items(empty, "doc_id", "n", 0)


def test_evolution_beats_best_fit_where_that_is_not_optimal():
    rng = random.Random(1)
    sizes, cap = [], 1000
    for _ in range(20):  # three items fill a container
        a = rng.randint(380, 490)
        b = rng.randint(251, 749 - a)
        sizes += [a, b, cap - a - b]
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    alone, population = P.best_fit(order, sizes, cap, []), []
    for epoch in range(P.EPOCHS):
        population = P.evolve(sizes, cap, population, random.Random(epoch), 20)
    best = population[0]
    assert P.lower_bound(sizes, cap) == 20 <= len(best) < len(alone)
    assert sorted(i for b in best for i in b) == list(range(60)) and max(sum(sizes[i] for i in b) for b in best) <= cap


def test_a_population_at_the_lower_bound_keeps_its_best_member_only():
    sizes = [60, 40, 50, 50, 30, 70, 10, 90]
    rested = P.evolve(sizes, 100, [], random.Random(1), 3)
    assert len(rested) == 1 and len(rested[0]) == 4 == P.lower_bound(sizes, 100)


def test_epochs_and_migrations_are_one_run(spark, monkeypatch):
    rng, cuts = random.Random(7), []
    items = spark.createDataFrame([(i, rng.randint(1, 99)) for i in range(200)], "key long, size long")
    monkeypatch.setattr(P, "SHARD_ITEMS", 60)
    monkeypatch.setattr(P, "cut", lambda df, cut=P.cut: cuts.append(df) or cut(df))
    packed = P._pack(items, 100, 1)
    assert len(cuts) == 1  # no table between the epochs
    rows = packed.collect()
    assert sorted(r.key for r in rows) == list(range(200))
    held = defaultdict(int)
    for r in rows:
        held[r.shard, r.bin] += r["size"]
    assert all(held[r.shard, r.bin] == r.load <= 100 for r in rows)


def test_fill_report(spark):
    df = spark.createDataFrame([("a", 6), ("a", 4), ("b", 5)], "container string, size long")
    assert P.fill_report(df, 10).first()[:] == (3, 2, 2, 0.75)
    assert P.fill_report(df.limit(0), 10).first()[:] == (0, 0, 0, None)
