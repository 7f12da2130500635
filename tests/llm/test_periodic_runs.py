"""Periodic runs against a search over all periods."""

import hashlib
import random

import numpy as np
import pytest

from skewscope.llm import periodic_runs as P

SCHEMA = "doc_id long, text string, lang string, runs string, n_words string"  # two names clash with the result's


def brute(words):
    out = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                out.setdefault((i, j + q - i), q)  # the least period comes first
            i = j + 1
    return sorted((s, n, q) for (s, n), q in out.items())


def kept(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone).decode()


def some_words(rnd):
    k, n, out = rnd.choice([1, 2, 3, 5, 50]), rnd.choice([0, 1, 5, 6, 7, 20, 60, 200, 700]), []
    while len(out) < n:
        piece = [rnd.randrange(k) for _ in range(rnd.randrange(1, 40))]
        if rnd.random() < 0.6:
            if rnd.random() < 0.4:  # a period that is itself almost periodic
                piece = piece * rnd.randrange(1, 6) + [rnd.randrange(k)]
            piece = piece * rnd.randrange(2, 9) + piece[:rnd.randrange(len(piece))]
        out += piece
    return [str(x).encode() for x in out[:n]]


@pytest.mark.parametrize("seed", range(4))
def test_batches_against_all_periods(seed):
    rnd = random.Random(seed)
    for _ in range(40):
        docs = [(i, some_words(rnd)) for i in range(rnd.randrange(1, 12))]
        for (_, words), row in zip(docs, P._record(docs).to_pylist()):
            runs = [(r["start"], r["length"], r["period"]) for r in row["runs"]]
            assert runs == brute(words)
            assert row["collapsed"] == kept(words, runs)


def test_range_successor():
    rng = np.random.default_rng(0)
    for n in (1, 2, 5, 17, 64, 100):
        values = rng.permutation(n).astype(np.int32)
        tree = P.WaveletTree(values)
        left = rng.integers(0, n, 60).astype(np.int32)
        right = np.array([rng.integers(a, n + 1) for a in left], np.int32)
        least = rng.integers(0, n + 2, 60).astype(np.int32)
        exact = [min([v for v in values[a:b] if v >= c], default=n) for a, b, c in zip(left, right, least)]
        assert tree.successor(left, right, least).tolist() == exact


def test_very_long_texts():
    one = P._record([(1, [b"a"] * 300_000)]).to_pylist()[0]
    assert one["runs"] == [{"start": 0, "length": 300_000, "period": 1}] and one["collapsed"] == "a"
    words = ([b"a"] * 500 + [b"b"]) * 200
    runs = [(r["start"], r["length"], r["period"]) for r in P._record([(1, words)]).to_pylist()[0]["runs"]]
    assert runs == sorted([(0, len(words), 501), *((k * 501, 500, 1) for k in range(200))], key=lambda r: (r[0], r[2]))


def test_table_edges(spark):
    long = " ".join(["x", "y"] * 20_000)
    rows = [(1, "a b a b a b a b c", "en", "r", "n"), (1, "a b a b a b a b c", "en", "r", "n"), (None, "a a a a a a", None, None, None),
            (2, None, "en", "r", "n"), (3, "", "", "", ""), (4, " \t\n\x0b\x0c\r ", "", "", ""), (5, long, "", "", ""),
            (6, "a a a a a a a a a a a a", "", "", "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in P.periodic_runs(docs).collect()), key=str)
    assert got == sorted([
        (1, 9, [(0, 8, 2)], "a b c"), (1, 9, [(0, 8, 2)], "a b c"), (None, 6, [(0, 6, 1)], "a"), (2, 0, [], ""), (3, 0, [], ""),
        (4, 0, [], ""), (5, 40_000, [(0, 40_000, 2)], "x y"), (6, 6, [(0, 6, 1)], "a a")], key=str)
    assert P.periodic_runs(docs.limit(0)).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: (r.text or "").encode().split() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r for r in P.op12_periodic_runs(spark, sf).collect()}
    assert got.keys() == texts.keys()
    edited = 0
    for doc, words in texts.items():
        edited += P.looped_tail(doc, words) != words
        words = P.looped_tail(doc, words)
        runs, row = brute(words), got[doc]
        top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        assert row.n_runs == len(runs)
        assert (row.start, row.length, row.period) == (top or (None,) * 3)
        assert row.exponent_milli == (1000 * top[1] // top[2] if top else None)
        assert row.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(kept(words, runs).encode()).hexdigest()
    assert edited > 5
