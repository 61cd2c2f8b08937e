import hashlib
import random
import re

import pytest

from sluice.llm import exact_dedup as ed


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[ \t-\r]", "", t or ""), []).append((i, t or ""))
    out = []
    for norm, members in groups.items():
        best = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))
        used = False
        for i, t in members:
            kept = i == best[0] and len(t) == len(best[1]) and not used
            used |= kept
            out.append((i, best[0], len(members), kept, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


ROWS = [
    (1, "a b c"), (2, "abc"), (3, "a  b  c"), (4, "a  b\tc"), (5, None), (6, ""), (7, " \n\t"), (8, "ab"),
    (9, "abcd"), (10, "Ünïcode ß"), (11, "Ünïcodeß"), (12, "abc"), (12, "abc"), (13, "x y"), (13, "x y"), (None, "q"),
    (14, "q"), (None, "only null"), (15, "a b"), (16, "ab"),
]


@pytest.mark.parametrize("trie_bytes", [1, 1 << 20])
def test_decisions_match_brute_force(spark, make, trie_bytes):
    assert result(ed.exact_dedup(spark, make(ROWS), trie_bytes=trie_bytes)) == brute(ROWS)


def test_hot_group_and_long_texts(spark, make, prose):
    long = prose(1, 30_000)
    rows = [(i, "hot text here") for i in range(300)] + [(1000 + i, long + " " * i) for i in range(4)]
    rows += [(2000 + i, prose(i, 20)) for i in range(100)]
    assert result(ed.exact_dedup(spark, make(rows, 7))) == brute(rows)


def test_given_documents(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert result(ed.exact_dedup(spark, documents)) == brute(rows)


def test_stage_keeps_all_columns_and_one_row_of_each(spark, make):
    docs = make(ROWS).withColumnRenamed("source", "kept").withColumnRenamed("n_chars", "keep_id")
    kept = ed.keep_owners(spark, docs)
    assert kept.columns == docs.columns
    expected = sorted((r[0] for r in brute(ROWS) if r[3]), key=repr)
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == expected


def test_empty(spark, make):
    empty = make([(1, "x")]).limit(0)
    assert result(ed.exact_dedup(spark, empty)) == []
    assert ed.keep_owners(spark, empty).count() == 0


def test_trie_against_a_dictionary():
    r = random.Random(3)
    trie, own = ed.PatriciaTrie(), {}
    for i in range(3000):
        key = bytes(r.choice(b"ab") for _ in range(r.randint(0, 9)))
        trie.insert(key, ed.Owner(len(key), i, 1, 1, ()))
        own.setdefault(key, []).append(i)
    found = {k: (o.doc_id, o.rows) for k, o in trie.drain()}
    assert found == {k: (min(v), len(v)) for k, v in own.items()}
    assert not trie.root.kids and trie.size == 0


def test_a_trie_counts_what_it_holds():
    def held(trie):
        stack, size = [*trie.root.kids.values()], 0
        while stack:
            node = stack.pop()
            size += len(node.label) + ed.NODE_BYTES
            stack += node.kids.values()
        return size

    r = random.Random(4)
    trie = ed.PatriciaTrie()
    for i in range(1000):
        key = b"p" * 5000 + b"%d" % i if i % 2 else bytes(r.choice(b"abc") for _ in range(r.randint(1, 9)))
        trie.insert(key, ed.Owner(len(key), i, 1, 1, (i % 7,)))
        assert trie.size == held(trie)
    list(trie.drain((3,)))
    assert trie.size == held(trie) > 0
    list(trie.drain())
    assert trie.size == 0


def test_many_equal_rows_without_id(spark, make):
    rows = [(None, "same text")] * 400 + [(None, "same  text")] * 30 + [(None, None)] * 200 + [(3, "other")]
    docs = make(rows, 4)
    found = ed.exact_dedup(spark, docs).collect()
    assert sum(r.kept for r in found) == 3 and len(found) == len(rows)
    assert sorted(len(r.text or "") for r in ed.keep_owners(spark, docs).collect()) == [0, 5, 10]
