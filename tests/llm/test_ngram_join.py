"""The n-gram join against brute force and its SQL."""

import random
import re

import duckdb
import numpy as np
import pytest

from airwave.llm import ngram_join
from airwave.llm.queries import QUERIES, oracle_sql
from airwave.llm.common import key_bits, may_hold

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, node long, label string, n_shingles string, token int"


def plain_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 4]) for i in range(max(len(words) - 3, 0))} or ({tuple(words)} if words else set())


def plain_components(rows):
    """{(doc_id, text): smallest doc_id that links reach} by comparing all pairs."""
    docs = list(dict.fromkeys(rows))
    sets = [plain_set(text) for _, text in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if both and 100 * both >= 85 * (len(x) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        known = least.get(find(i))
        least[find(i)] = doc_id if known is None else known if doc_id is None else min(known, doc_id)
    return {d: (len(sets[i]), least[find(i)] if sets[i] else d[0]) for i, d in enumerate(docs)}


def families(seed):
    """Star and chain families of near copies, exact copies, a passage that many share, unlike texts."""
    random.seed(seed)
    word = lambda: "".join(random.choices("abcdefgh", k=4))
    passage = [word() for _ in range(12)]
    texts = []
    for family in range(6):
        base = [word() for _ in range(random.choice([8, 40, 120]))]
        for _ in range(random.randint(3, 25)):
            copy = list(base)
            for _ in range(random.randint(0, 3)):
                copy[random.randrange(len(copy))] = word()
            texts.append(copy)
            if family % 2:
                base = copy
    texts += [[word() for _ in range(30)] + passage for _ in range(20)] + [[word() for _ in range(k)] for k in (1, 2, 3, 4, 5) for _ in range(2)]
    rows = [(i, random.choice([" ", "\n", "  "]).join(t)) for i, t in enumerate(texts)]
    rows += [(1000 + i, random.choice(rows)[1].upper()) for i in range(15)]
    rows += [(2000, None), (2001, ""), (2002, " \n\t"), (2003, "one two"), (2004, "One  two"), (None, rows[0][1]), (None, "alone " * 9), (3, rows[3][1])]
    rows += [(3000 + i, "word " * 20_000 + str(i)) for i in range(2)]
    return rows


@pytest.mark.parametrize("seed,block", [(1, 1024), (2, 3)])
def test_components_are_all_pairs_components(spark, monkeypatch, seed, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = families(seed)
    df = spark.createDataFrame([(*r, 1, "x", "y", 2) for r in rows], COLUMNS).repartition(3)
    got = ngram_join.components(df).collect()
    want = plain_components(rows)
    assert sorted(map(repr, ((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got))) == sorted(
        map(repr, ((r[0], *want[r]) for r in rows))
    )


def test_nothing_to_link(spark):
    df = spark.createDataFrame([(1, "a b c d e f", 1, "x", "y", 2), (2, "u v w x y z", 1, "x", "y", 2), (3, None, 1, "x", "y", 2)], COLUMNS)
    assert sorted(tuple(r) for r in ngram_join.components(df).collect()) == [(1, 3, 1), (2, 3, 2), (3, 0, 3)]
    assert ngram_join.components(df.where("false")).collect() == []


def test_similar_sets_share_a_prefix_token_under_every_order():
    rng = np.random.RandomState(5)
    levels = rng.randint(0, 3, 1 << 16).astype(np.uint8)
    for _ in range(300):
        n = rng.randint(1, 80)
        x = np.unique(rng.randint(0, 1 << 62, n, dtype=np.int64).astype(np.uint64))
        y = np.unique(np.concatenate([x[rng.rand(len(x)) > 0.08], rng.randint(0, 1 << 62, rng.randint(0, 6), dtype=np.int64).astype(np.uint64)]))
        both = len(np.intersect1d(x, y))
        if not len(y) or 100 * both < 85 * (len(x) + len(y) - both):
            continue
        bitmaps = ngram_join._parities(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)]))
        for width in (64, 32, 8):
            p, q = (ngram_join._folded([b], width) for b in bitmaps)
            assert ngram_join._near(p, q, np.array([len(x) + len(y)])).all()
        for order in range(ngram_join.ORDERS):
            p, q = (ngram_join._prefixes(v, np.array([0, len(v)]), levels, order)[0] for v in (x, y))
            shared = np.minimum(*(ngram_join.least_shared(len(v)) for v in (x, y))) if order == 0 else 1
            assert len(p) == ngram_join.prefix_length(len(x)) + (ngram_join.least_shared(len(x)) - 1) * (order == 0)
            assert len(np.intersect1d(p, q)) >= shared >= (ngram_join.least_shared(-(-85 * len(x) // 100)) if order == 0 else 1)


def test_counts_are_packed_without_loss():
    counts = np.append(np.arange(4095), 1 << 40)
    assert (ngram_join._unpacked(ngram_join._packed(counts)) == counts).all()


def test_key_bits_hold_every_key(spark):
    keys = spark.range(5000).selectExpr("id * 7919 AS key")
    bits = key_bits(keys, "key")
    places = [r[0] for r in keys.selectExpr(f"pmod(xxhash64(key), {8 * len(bits)})").collect()]
    other = [r[0] for r in spark.range(5000).selectExpr(f"pmod(xxhash64(-1 - id), {8 * len(bits)})").collect()]
    assert may_hold(bits, np.array(places)).all() and may_hold(bits, np.array(other)).mean() < 0.1


def test_query_equals_sql(spark):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = QUERIES["op11_ngram_join"](spark, SF).select("doc_id", "n_shingles", "component_id").collect()
    cursor = db.execute(oracle_sql()["op11_ngram_join"])
    assert [c[0] for c in cursor.description] == ["doc_id", "n_shingles", "component_id"]
    assert sorted(tuple(r) for r in got) == sorted(cursor.fetchall())
