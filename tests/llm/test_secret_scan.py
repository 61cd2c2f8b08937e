import random
import re

import pytest
from pyspark.sql import functions as F

from sluice.llm import secret_scan as ss


def brute(rows):
    """doc_id, word_index, nth, candidate by plain scanning."""
    out = []
    for i, text in rows:
        for k, word in enumerate(re.split(r"[ \t-\r]+", text or "")):
            nth = 0
            for m in re.finditer(r"[A-Za-z0-9+/_-]+={0,2}", word):
                body = m[0].rstrip("=")
                if len(body) >= 16 and re.search("[0-9]", body):
                    out.append((i, k, nth, m[0]))
                    nth += 1
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.doc_id, r.word_index, r.nth, r.candidate) for r in df.collect()), key=repr)


def test_candidates_of_given_documents(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert found(ss.findings(documents)) == brute(rows)


def test_odd_rows(spark, make):
    rows = [(1, None), (2, ""), (3, "a1" * 8), (4, "onlylettersinthisword"), (5, 'x="' + "f0" * 20 + '",y=' + "b1" * 10 + "=="),
            (None, "1" * 20), (6, "z" * 200_000 + "1"), (7, " lead\n" + "9f" * 9), (7, " lead\n" + "9f" * 9), (8, "1" * 200_000)]
    docs = make(rows).withColumn("word", F.lit("clash"))
    assert found(ss.findings(docs)) == brute(rows)
    judged = ss.scan(spark, docs, F.lit(None).cast("int"))
    assert found(judged) == brute(rows)
    assert {(r.probability, r.kept) for r in judged.collect()} == {(None, True)}
    assert ss.scan(spark, docs.limit(0), F.lit(1)).count() == 0


@pytest.mark.parametrize("most", [0, 1_000_000])
def test_coverage_counts_words_of_all_documents(spark, make, monkeypatch, most):
    monkeypatch.setattr(ss, "BROADCAST_PIECES", most)
    docs = make([(i, "common and other words") for i in range(5)] + [(9, "common_x_0123456789 rarely0123456789abcd")])
    rows = {r.covered_candidate: r.covered for r in ss.coverage(spark, ss.findings(docs), docs).collect()}
    assert rows == {"common_x_0123456789": 6 / 19}


def test_held_out_findings_are_told_apart(spark, make):
    r = random.Random(5)
    rows, truth = [], {}
    for i in range(600):
        if i % 2:
            text = f'set api_key = "{"".join(r.choice("0123456789abcdef") for _ in range(40))}" here'
        else:
            text = f"order no {''.join(r.choice('0123456789') for _ in range(18))} was sent"
        rows.append((i, text))
        truth[i] = i % 2
    docs = make(rows)
    label = F.when(F.col("doc_id") < 400, (F.col("doc_id") % 2).cast("int"))
    judged = [r for r in ss.scan(spark, docs, label).collect() if r.doc_id >= 400]
    assert len(judged) == 200
    assert sum(r.kept == bool(truth[r.doc_id]) for r in judged) >= 198
    again = {(r.doc_id, r.probability) for r in ss.scan(spark, docs.repartition(7), label).collect()}
    assert {(r.doc_id, r.probability) for r in judged} <= again
