import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from sluice.llm import lm_score as lm
from sluice.llm.elias_fano import EliasFano, Trie, quantise


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]


def brute(rows):
    """(doc_id, held_out, n_tokens, n_known, N, base, exact model) for each row."""
    held = [i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows]
    one, two, before = Counter(), Counter(), Counter()
    for (i, t), h in zip(rows, held):
        if not h:
            own = tokens(t)
            one.update(own)
            two.update(zip(["<s>", *own], own))
            before.update(["<s>", *own[:-1]])
    n, v = sum(one.values()), len(one)
    out = []
    for (i, t), h in zip(rows, held):
        own = tokens(t)
        p = {w: (one[w] + 0.1) / (n + 0.1 * (v + 1)) for w in own}
        model = sum(math.log10((two[a, w] + 4 * p[w]) / (before[a] + 4)) for a, w in zip(["<s>", *own], own))
        out.append((i, h, len(own), sum(one[w] > 0 for w in own), n, sum(math.log10(p[w]) for w in own), model))
    return sorted(out, key=lambda r: (r[0] is None, r))


def check(df, rows, slack):
    got = sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is None, r))
    want = brute(rows)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    np.testing.assert_allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9)
    off = [abs(g[6] - w[6]) / w[2] for g, w in zip(got, want)]
    assert max(off) < slack, max(off)


@pytest.mark.parametrize("sizes", [{}, {"shard_tokens": 2000}, {"shard_tokens": 500, "hot_words": 3}])
def test_given_documents(spark, documents, sizes):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    check(lm.score_texts(spark, documents, **sizes), rows, 0.05)


def test_odd_rows(spark, make, prose):
    rows = [(1, None), (2, ""), (2, ""), (None, "The the THE"), (30, "É é"), (31, prose(1, 20_000)), (32, "the " * 3000), (43, "unseen words only")]
    rows += [(100 + i, "the hot words the") for i in range(60)]
    docs = make(rows).withColumnRenamed("source", "score")
    check(lm.score_texts(spark, docs, shard_tokens=3000), rows, 0.05)
    assert lm.score_texts(spark, docs.limit(0)).count() == 0


def test_held_out_text_is_likelier_than_by_words_alone(spark, documents):
    rows = lm.score_texts(spark, documents).filter("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


@pytest.mark.parametrize("seed", range(8))
def test_sequences_against_sorted_arrays(seed):
    r = np.random.default_rng(seed)
    top = [1, 5, 1000, 1 << 20, 1 << 40, (1 << 63) - 1, 70, 3][seed]
    values = np.sort(r.integers(0, top, [1, 3, 500, 4000, 4000, 4000, 64, 200][seed], dtype=np.uint64, endpoint=True))
    s = EliasFano.of(values)
    assert (s[np.arange(len(values))] == values).all()
    wanted = np.concatenate((values, r.integers(0, top, 3000, dtype=np.uint64, endpoint=True), [np.uint64(0), np.uint64(top)]))
    there, at = s.find(wanted)
    assert (there == np.isin(wanted, values)).all()
    assert (at[there] == np.searchsorted(values, wanted[there])).all()
    empty = EliasFano.of(np.zeros(0, np.uint64))
    assert not empty.find(wanted)[0].any()


def test_model_opens_from_a_mapped_file(spark, documents, tmp_path):
    shards = lm.model_shards(spark, documents, shard_tokens=20_000).collect()
    assert len(shards) > 1
    path = tmp_path / "levels"
    path.write_bytes(shards[0].levels)
    mapped, plain = Trie.open(np.memmap(path, np.uint8, "r")), Trie.open(shards[0].levels)
    words = mapped.words[np.arange(mapped.words.length)]
    contexts = mapped.contexts[np.arange(mapped.contexts.length)][: len(words)]
    words = words[: len(contexts)]
    assert (mapped.find(words, contexts, -9.0) == plain.find(words, contexts, -9.0)).all()


def test_quantised_values_stay_close():
    values = np.random.default_rng(1).normal(size=20_000)
    codes, book = quantise(values)
    assert np.abs(book[codes] - values).max() <= (values.max() - values.min()) / 256
