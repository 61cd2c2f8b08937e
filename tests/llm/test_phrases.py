import random
import re
from collections import Counter
from itertools import groupby

import numpy as np

from sluice.llm import phrases as ph


def pieces(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
        yield re.findall(r"[^\x20\x09]+", piece)


def counts(rows, longest):
    """f for each language, and n; rows: (lang, text)."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, " ".join(words[i : i + k])) for i in range(len(words) - k + 1))
    return f, n


def brute(rows, longest=3, least=10, covered=50, top=2000):
    f, n = counts(rows, longest)
    frequent = {key: a for key, a in f.items() if a >= least and " " in key[1]}
    found = []
    for (lang, phrase), a in frequent.items():
        words = phrase.split(" ")
        cuts = []
        for k in range(1, len(words)):
            left, right = f[lang, " ".join(words[:k])], f[lang, " ".join(words[k:])]
            cuts.append((1000000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        inside = any(
            lang == other and len(long) > len(words) and any(long[i : i + len(words)] == words for i in range(len(long))) and 100 * b >= covered * a
            for (other, text), b in frequent.items()
            for long in [text.split(" ")]
        )
        if not inside:
            found.append((lang, -score, -a, phrase.encode(), left, right, n[lang]))
    out = []
    for lang, own in groupby(sorted(found), key=lambda x: x[0]):
        for rank, (_, score, a, phrase, left, right, total) in enumerate(list(own)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total, -score))
    return out


def got(df):
    return sorted(tuple(r) for r in df.collect())


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, g) for i, (g, t) in enumerate(rows)], "n long, text string, lang string").repartition(parts)


def sample(seed, rows=120):
    r = random.Random(seed)
    words = ["Ab", "b", "c", "dé", "É", "über", "x" * 40, "e", "\x00", "f g"]
    text = lambda: "".join(r.choice(words) + r.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b"]) for _ in range(r.randint(0, 60)))
    return [(r.choice(["en", "de", None, ""]), r.choice([text(), text(), text(), None, ""])) for _ in range(rows)]


def test_given_edges_against_brute_force(spark):
    rows = sample(3)
    assert got(ph.collocations(spark, frame(spark, rows))) == sorted(brute(rows))


def test_other_parameters(spark):
    rows = sample(4, 60)
    for longest, least, covered, top in ((2, 5, 50, 2000), (4, 4, 80, 7)):
        found = ph.collocations(spark, frame(spark, rows), longest=longest, least=least, covered=covered, top=top)
        assert got(found) == sorted(brute(rows, longest, least, covered, top))


def test_small_chunks_and_full_summaries_change_nothing(spark, monkeypatch):
    rows = sample(5)
    want = sorted(brute(rows))
    monkeypatch.setattr(ph, "CHUNK_BYTES", 50)
    monkeypatch.setattr(ph, "ENTRIES", 40)
    # The settings are read in this process, so the passes are run here.
    batches = frame(spark, rows).selectExpr("coalesce(lang, 'und') as lang", "text").toArrow().to_batches(5)
    summaries = [b for b in ph._summarise(3, 3)(iter(batches))]
    assert len(summaries) > 3
    f, _ = counts(rows, 3)
    kept = {}
    by_part = {}
    for batch in summaries:
        for part, mass, summary in zip(*(c.to_pylist() for c in batch.columns)):
            by_part.setdefault(part, []).append((mass, summary))
    for part, own in by_part.items():
        mass = sum(m for m, _ in own)
        head = ph.pa.RecordBatch.from_pylist([{"part": part, "mass": mass, "summary": None}], schema=ph.SUMMARY)
        tail = [ph.pa.RecordBatch.from_pylist([{"part": part, "mass": m, "summary": s}], schema=ph.SUMMARY) for m, s in own]
        for out in ph._merge(10)(iter([head, *tail])):
            keys, _ = ph.unpacked(out.column(2)[0].as_py())
            assert len(keys) <= mass // 10
            kept[part] = set(keys.tolist())
    # Whatever occurs often enough survives.
    for lang in {k[0] for k in f}:
        own = [t or "" for g, t in rows if ("und" if g is None else g) == lang]
        counted = ph.Counted([t.encode() for t in own], 3)
        for n, (keys, (_, times)) in enumerate(zip(counted.keys(lang), counted.grams), 1):
            for key, time in zip(keys.tolist(), times.tolist()):
                assert time < 10 or key in kept[key >> (ph.KEY_BITS - 3)]
    assert want


def test_merge_keeps_what_is_frequent():
    r = np.random.default_rng(0)
    keys = np.concatenate([r.integers(0, 1 << 40, 5000).astype(np.uint64), np.repeat(np.arange(20, dtype=np.uint64), 60)])
    r.shuffle(keys)
    capacity = len(keys) // 50
    own = (np.array([], np.uint64), np.array([], np.int64))
    for at in range(0, len(keys), 137):
        part = keys[at : at + 137]
        own = ph.merged(np.concatenate([own[0], part]), np.concatenate([own[1], np.ones(len(part), np.int64)]), capacity)
        assert len(own[0]) <= capacity
    assert set(range(20)) <= set(own[0].tolist())


def test_summaries_survive_packing():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 48, 1000).astype(np.uint64))
    back = ph.unpacked(ph.packed(keys, np.arange(len(keys))))
    assert (back[0] == keys).all() and (back[1] == np.arange(len(keys))).all()


def test_scores_pass_64_bits(spark):
    df = spark.createDataFrame([(30_000_000_000, 40_000_000_000, 50_000_000_000)], "a long, l long, r long")
    assert df.select(ph._floor(df.a, df.l, df.r)).first()[0] == 1000000 * 30**2 // (40 * 50)


def test_nothing_to_count(spark):
    for rows in ([], [(None, None), ("en", "")], [("en", "a b c")]):
        assert got(ph.collocations(spark, frame(spark, rows))) == []


def test_clashing_columns(spark):
    rows = sample(6, 40)
    docs = frame(spark, rows).selectExpr("text", "lang", "n as part", "n as phrase", "n as words")
    assert got(ph.collocations(spark, docs)) == sorted(brute(rows))
