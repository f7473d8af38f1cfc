"""The queries themselves on the smallest tables: against their SQL, or against brute force."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from quire.llm import packing, queries, tokencount

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.fixture(scope="module")
def texts(duck):
    return dict(duck.execute("SELECT doc_id, text FROM documents").fetchall())


def found(spark, sf_dir, name):
    return queries.QUERIES[name](spark, sf_dir)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_against_sql(spark, duck, sf_dir, name):
    rows = found(spark, sf_dir, name)
    columns = sorted(rows.columns)
    expected = duck.execute(f"SELECT {', '.join(columns)} FROM ({queries.ORACLE_SQL[name]})").fetchall()
    assert Counter(map(tuple, rows.select(*columns).collect())) == Counter(expected)


def base(text):
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {k + j for k, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def test_op1(spark, sf_dir, texts):
    rows = found(spark, sf_dir, "op1_quality_rules").collect()
    assert {r["doc_id"]: r[1:7] for r in rows} == {i: base(t or "") for i, t in texts.items()} and len(rows) == len(texts)
    assert not any(r["kept"] for r in rows if r["base_failed"]) and sum(r["kept"] for r in rows) > len(rows) / 2


def test_op2(spark, sf_dir, texts):
    trie = tokencount.Trie(tokencount.load(), max_nodes=1)
    rows = {r["doc_id"]: r for r in found(spark, sf_dir, "op2_token_counts").collect()}
    assert rows.keys() == texts.keys()
    for i, t in list(texts.items())[::20]:
        words = WORD.findall(t or "")
        assert (rows[i]["n_pretokens"], rows[i]["n_tokens"]) == (len(words), sum(trie._unshared(tokencount.MARK + w) for w in words))


def test_op4(spark, sf_dir, texts):
    rules = [("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), ("access", r"AKIA[A-Z0-9]+"), ("hex", r"[0-9a-f]+")]
    for r in found(spark, sf_dir, "op4_secret_scan").collect():
        spans = []
        for rank, (kind, pattern) in enumerate(rules):
            for m in re.finditer(pattern, texts[r["doc_id"]] or ""):
                if len(m[2]) >= 6 if kind == "assign" else len(m[0]) >= (20 if kind == "access" else 24):
                    spans.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
        listed = [x[2] for x in sorted(spans)]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(x.startswith(k) for x in listed) for k in ("assign", "access", "hex")]
        assert r["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest() and set(listed) <= set(r["spans"].split(",")) | {""}


def test_op5(spark, duck, sf_dir, texts):
    """Scores are of all rows, and held-out toxic ones are told from the others."""
    rows = {r["doc_id"]: r for r in found(spark, sf_dir, "op5_toxicity").collect()}
    toxic = dict(duck.execute("SELECT doc_id, toxic FROM labels").fetchall())
    assert rows.keys() == texts.keys() and all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows.values())
    known = [(rows[i]["score"], t) for i, t in toxic.items() if i in rows]
    above = [s > p for s, t in known if t for p, u in known if not u]
    assert not above or np.mean(above) > 0.9


def test_op9(spark, sf_dir, texts):
    tokenizer = packing.encoder(None)._tokenizer
    rows, room = found(spark, sf_dir, "op9_best_fit_packing").collect(), defaultdict(list)
    pieces = defaultdict(list)
    for r in rows:
        room[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for parts in room.values():
        edges = np.cumsum([0] + [n for _, n in sorted(parts)])
        assert [a for a, _ in sorted(parts)] == edges[:-1].tolist() and edges[-1] <= 1024
    lengths = Counter()
    for i, t in texts.items():
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        first = len(ids) % 1024 or 1024
        edges = [0, *range(first, len(ids) + 1, 1024)] if len(ids) > 1024 else [0, len(ids)]
        expected = [(k, a, b - a, zlib.crc32(np.asarray(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(edges, edges[1:]))]
        assert sorted(pieces[i]) == expected
        lengths.update(b - a for a, b in zip(edges, edges[1:]))
    rooms = []
    for n in sorted(lengths.elements(), reverse=True):  # plain best-fit decreasing
        fits = [k for k, x in enumerate(rooms) if x >= n]
        at = min(fits, key=lambda k: rooms[k], default=None)
        if at is None:
            rooms.append(1024 - n)
        else:
            rooms[at] -= n
    assert len(room) <= len(rooms)


def test_op10(spark, sf_dir, texts):
    prints = {}
    for i, t in texts.items():
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        hashes = [xxhash.xxh64_intdigest(" ".join(w[k : k + 3]).encode(), 42) for k in range(max(1, len(w) - 2))] if w else []
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if w else 0
    own = {i: i for i in prints}

    def root(i):
        while own[i] != i:
            i = own[i]
        return i

    ids = sorted(prints)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                low, high = sorted((root(a), root(b)))
                own[high] = low
    rows = found(spark, sf_dir, "op10_simhash").collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == {i: (f"{prints[i]:016x}", root(i)) for i in ids}
