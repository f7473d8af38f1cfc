"""Near-duplicates of the pipeline: SimHash blocks against all pairs."""

from __future__ import annotations

import random

import corpus_pipeline
import numpy as np
import pytest
from quire.llm import common, minhash, similar


def naive_fingerprint(hashes, k):
    """SimHash under the k-th SplitMix64."""
    ones, mask = [0] * 64, 2**64 - 1
    for z in hashes:
        z = (z + (k + 1) * 0x9E3779B97F4A7C15) & mask
        z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & mask
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & mask
        z ^= z >> 31
        ones = [n + (z >> b & 1) for b, n in enumerate(ones)]
    return sum(1 << b for b, n in enumerate(ones) if 2 * n > len(hashes))


def groups(n, links):
    own = list(range(n))
    for a, b in links:
        low, high = sorted((own[a], own[b]))
        own = [low if x == high else x for x in own]
    return own


def near(a, b):
    return len(a & b) * 9 >= (len(a) + len(b)) * 4 > 0


def grams(text):
    found = text.lower().split()
    return {tuple(found[j : j + 5]) for j in range(max(len(found) - 4, 1 if found else 0))}


@pytest.mark.parametrize("n", [1, 4, 255, 256, 700])
def test_fingerprints(n):
    hashes = np.random.default_rng(n).integers(0, 2**64, n, dtype=np.uint64, endpoint=False)
    found = similar.fingerprints(hashes).tolist()
    assert found[::13] == [naive_fingerprint(hashes.tolist(), k) for k in range(0, similar.FINGERPRINTS, 13)]


@pytest.mark.parametrize("long", [1_024, 3])
def test_close_pairs(monkeypatch, long):
    """Runs of any length give the components that all close pairs give; short ones give the pairs."""
    monkeypatch.setattr(similar, "LONG", long)
    r = np.random.default_rng(5)
    place = np.sort(r.integers(0, 12, 150))
    prints = r.integers(0, 2**64, (9, 2), dtype=np.uint64)[r.integers(0, 9, 150)]
    for k in range(150):
        for bit in r.integers(0, 64, 16):
            prints[k, bit % 2] ^= np.uint64(1) << np.uint64(bit)
    a, b = similar.close_pairs(place, prints)
    every = [(i, j) for j in range(150) for i in range(j) if place[i] == place[j] and np.bitwise_count(prints[i] ^ prints[j]).sum() <= similar.CLOSE]
    assert set(zip(a.tolist(), b.tolist())) == set(every) if long > 150 else {tuple(sorted(x)) for x in zip(a.tolist(), b.tolist())} <= set(every)
    assert similar.least_reached(150, a, b).tolist() == groups(150, every) == groups(150, zip(a, b))


@pytest.mark.parametrize(("group", "block"), [(16, 512), (2, 5)])
def test_classes(spark, monkeypatch, group, block):
    """One text of each class stays, by pairs and in crowds, however the crowd hangs together."""
    monkeypatch.setattr(similar, "GROUP", group)
    monkeypatch.setattr(similar, "BLOCK", block)
    r, texts = random.Random(17), []
    for k in range(30):
        words = [f"b{k}w{j}" for j in range(200)]
        for _ in range(r.choice([1, 2, 5, 9])):
            texts.append(" ".join(words))
            for j in r.sample(range(200), r.randrange(9)):
                words[j] = f"n{r.random()}"
    texts += ["one two", "One  two", "one two three", "", None, " "]
    sets = [grams(t or "") for t in texts]
    own = groups(len(texts), [(a, b) for b in range(len(texts)) for a in range(b) if sets[a] == sets[b] or near(sets[a], sets[b])])
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = [x["doc_id"] for x in similar.keep_representatives(frame.unionByName(frame.filter("doc_id < 9"))).collect()]
    assert sorted(kept) == sorted(set(own))
    assert similar.keep_representatives(frame.filter("false")).count() == 0


def test_near_dedup_chain(spark):
    """A crowd that hangs together as a chain is one class for the stage, though its ends are not near."""
    words, texts = [f"w{j}" for j in range(300)], []
    for k in range(60):
        words[5 * k] = f"n{k}"
        texts.append(" ".join(words))
    assert minhash.SIMILARITY == (4, 5) and not near(grams(texts[0]), grams(texts[-1]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [x["doc_id"] for x in corpus_pipeline.near_dedup(spark, docs, "").collect()] == [0]


def test_rows_of_shuffles_rows_once(spark):
    """Rows are dealt by key once, also where the kept keys come from a file, whose fields may all be null."""
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c")], "doc_id long, text string")
    kept = common.durable(docs.filter("doc_id = 1 or doc_id is null").select(common.row_key(docs).alias("key")).distinct())
    found = common.rows_of(docs, kept)
    assert sorted(x["text"] for x in found.collect()) == ["a", "c"]
    plan = common.rows_of(docs, kept.hint("merge"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


def test_sifted(spark):
    """What is wanted stays, and most else goes."""
    rows = spark.range(40_000).selectExpr("id % 7 as a", "id as b", "cast(id as string) as c")
    found = {x["b"] for x in common.sifted(rows, rows.filter("b % 100 = 3").select("a", "b")).collect()}
    assert set(range(3, 40_000, 100)) <= found and len(found) < 500
    assert common.sifted(rows, rows.filter("false").select("b")).count() == 0
