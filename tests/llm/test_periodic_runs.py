import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from sluice.llm import periodic_runs as pr
from sluice.llm import queries


def brute(words, exponent=4, least=6):
    """All runs by comparing each word with the one a period later."""
    found = set()
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, exponent * q):
                found.add((i, j + q - i, q))
            i = max(j, i + 1)
    smallest = {}
    for s, length, q in found:
        smallest[s, length] = min(q, smallest.get((s, length), q))
    return sorted((s, length, q) for (s, length), q in smallest.items())


def collapse(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_of_random_words():
    r = random.Random(1)
    for _ in range(1500):
        kinds, exponent, least = r.choice([1, 2, 3, 4]), r.choice([2, 3, 4]), r.choice([2, 6])
        texts = [[b"%d" % r.randrange(kinds) for _ in range(r.randint(0, 50))] for _ in range(3)]
        symbols, begins = pr._numbered(texts)
        got = sorted(zip(*(x.tolist() for x in pr.find_runs(symbols, exponent, least))))
        want = [(s + int(begins[i]), n, q) for i, t in enumerate(texts) for s, n, q in brute(t, exponent, least)]
        assert got == sorted(want)


def test_ranks_and_common_parts():
    symbols = np.array([0, 1, 0, 1, 0, 2])
    levels = pr.doubled_ranks(symbols)
    assert levels[-1].tolist() == [1, 4, 0, 3, 2, 5] or sorted(levels[-1].tolist()) == list(range(6))
    assert pr.common_prefix(levels, np.array([0]), np.array([2])).tolist() == [3]
    assert pr.common_suffix(levels, np.array([2]), np.array([4])).tolist() == [2]


def test_operator_on_edges(spark, make):
    long = " ".join(str(i % 7) for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b a b a b a b"), (4, "a b a b a b a b"), (None, "x x x x x x y"),
            (5, "a\tb\x0ba  b\na b A B"), (6, long), (7, "plain words only"), (8, "x x x x x")]
    docs = make(rows).withColumnRenamed("n_chars", "runs")
    got = sorted((tuple(r) for r in pr.periodic_runs(spark, docs).collect()), key=repr)
    want = []
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        runs = [(0, 30_000, 7)] if text == long else brute(words)
        want.append((doc_id, len(words), runs, collapse(words, runs)))
    assert [(i, n, [tuple(r) for r in runs], c) for i, n, runs, c in got] == sorted(want, key=repr)
    assert pr.periodic_runs(spark, docs.limit(0)).collect() == []


def test_parameters(spark, make):
    docs = make([(1, "a b c a b c d d")])
    one = pr.periodic_runs(spark, docs, exponent=2, least_words=2).first()
    assert [tuple(r) for r in one.runs] == [(0, 6, 3), (6, 2, 1)]
    assert one.collapsed == "a b c d"


def contract(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute(words)
    top = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None,) * 3
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    exponent = top[1] * 1000 // top[2] if runs else None
    digests = [hashlib.sha256(t.encode()).hexdigest() for t in (listed, collapse(words, runs))]
    return (doc_id, len(runs), *top, exponent, *digests)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    # Brute force squares with the words, so the longest texts are left to the test above.
    short = given.filter("n_chars < 6000").unionByName(
        spark.createDataFrame([(-1, None, "en", "s", 0), (-2, "", "en", "s", 0)], given.schema)
    )
    short.write.parquet(str(folder / "documents.parquet"))
    return str(folder)


def test_query_follows_the_contract(spark, folder):
    got = sorted(tuple(r) for r in queries.op12_periodic_runs(spark, folder).collect())
    want = sorted(contract(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect())
    assert got == want
    assert sum(1 for row in got if row[1]) > 10
