import random
import re

import numpy as np
import xxhash

from sluice.llm import simhash as sh


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    parts = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Smallest id reachable for each distinct fingerprint; prints: (id, fp)."""
    fps = sorted({f for _, f in prints})
    top = {f: f for f in fps}

    def root(f):
        while top[f] != f:
            f = top[f]
        return f

    array = np.array(fps, np.uint64)
    for i, f in enumerate(fps):
        for j in np.flatnonzero(np.bitwise_count(array[i + 1 :] ^ array[i]) <= 3):
            top[root(fps[i + 1 + j])] = root(f)
    low = {}
    for i, f in prints:
        if i is not None:
            low[root(f)] = min(low.get(root(f), i), i)
    return {f: low.get(root(f)) for f in fps}


def expected(rows):
    prints = [(i, brute_print(t)) for i, t in rows]
    comp = brute_components(prints)
    return sorted(((i, f"{f:016x}", comp[f]) for i, f in prints), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "fingerprint", "component_id").collect()), key=repr)


def test_given_documents(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert got(sh.near_dedup(spark, documents)) == expected(rows)


def test_edges_of_the_contract(spark, make, prose):
    base = prose(5, 400)
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One"), (5, "one"), (6, "two words"), (7, "TWO  words"), (None, "lone"),
            (8, base), (9, base + " more"), (10, base + " x"), (11, base.replace("Ba", "ba")), (8, base), (None, base),
            (12, "É é"), (13, "é É"), (14, prose(9, 20_000))]
    assert got(sh.near_dedup(spark, make(rows))) == expected(rows)


def near_family(seed, size):
    r = random.Random(seed)
    centre, out = r.getrandbits(64), set()
    while len(out) < size:
        f = centre
        for _ in range(r.randint(0, 5)):
            f ^= 1 << r.randrange(64)
        out.add(f)
    return out


def test_links_connect_all_in_reach(spark):
    fps = near_family(1, 400) | near_family(2, 50) | {random.Random(7).getrandbits(64) for _ in range(500)}
    # Three bits in one block, two blocks, three blocks; chains of such steps.
    f = 0x0123456789ABCDEF
    for bits in ((0, 1, 2), (21, 22, 43), (42, 43, 63), (60, 61, 62), (5, 30, 50)):
        f ^= sum(1 << b for b in bits)
        fps.add(f)
    prints = list(enumerate(sorted(fps)))
    signed = [(i, f - (1 << 64) if f >> 63 else f) for i, f in prints]
    nodes = spark.createDataFrame([(f, i) for i, f in signed], "fp long, low long").repartition(5)
    edges = sh.near_links(nodes)
    rooted = {r.fp: r.low for r in sh.connected(spark, nodes, edges).collect()}
    found = {f: rooted.get(s, i) for (i, f), (_, s) in zip(prints, signed)}
    assert found == brute_components(prints)
    assert edges.count() < 131 * len(fps)


def test_stage_keeps_one_of_each(spark, make, prose):
    base = prose(5, 400)
    rows = [(3, base), (1, base), (1, base), (2, prose(6, 300)), (None, base), (9, None)]
    docs = make(rows).withColumnRenamed("source", "component_id")
    kept = sh.keep_first_rows(spark, docs)
    assert kept.columns == docs.columns
    # A row without an id comes after those with one.
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 9]
    assert sh.keep_first_rows(spark, docs.limit(0)).count() == 0


def test_rows_out_of_reach_that_share_most_shingles_are_one(spark, make, prose):
    base = prose(5, 300).split()
    near = [*base]
    near[40] = near[150] = near[151] = near[260] = "changed"
    far = [*base]
    far[10::5] = ["changed"] * len(far[10::5])
    rows = [(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(far)), (4, prose(8, 300)), (5, "two words"), (6, "two  more")]
    a, b = (sh.fingerprint(t.encode()) for _, t in rows[:2])
    assert bin(a ^ b).count("1") > sh.RADIUS
    assert sorted(r.doc_id for r in sh.keep_first_rows(spark, make(rows)).collect()) == [1, 3, 4, 5, 6]


def brute_kept(rows):
    """Ids that stay: all pairs compared by fingerprint and by covered words."""
    prints = [sh.fingerprint((t or "").encode()) for _, t in rows]
    seqs = [sh.similar_shingles((t or "").encode()) for _, t in rows]
    top = list(range(len(rows)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            near = bin(prints[i] ^ prints[j]).count("1") <= sh.RADIUS
            if near or min(sh.covered(seqs[i], seqs[j]), sh.covered(seqs[j], seqs[i])) >= sh.COVERED:
                top[root(i)] = root(j)
    low = {}
    for i, (doc_id, _) in enumerate(rows):
        low[root(i)] = min(low.get(root(i), doc_id), doc_id)
    return sorted(low.values())


def changed(text, seed, share):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(10**6)}" if r.random() < share else w for w in text.split())


def test_large_buckets_lose_no_link(spark, make, prose, monkeypatch):
    """Families of over 100 texts in one bucket, some near enough and some not, and two that share half of their words."""
    monkeypatch.setattr(sh, "PAIRED", 4)
    monkeypatch.setattr(sh, "ROUND_PAIRS", 64)
    half = prose(1, 120)
    rows = [(i, changed(half + " " + prose(2, 120), i, 0.02)) for i in range(110)]
    rows += [(200 + i, changed(half + " " + prose(3, 120), i, 0.05)) for i in range(25)]
    rows += [(300 + i, prose(50 + i, 80)) for i in range(20)]
    # Each of a chain is near the next one only.
    text = prose(4, 200)
    for i in range(10):
        rows.append((400 + i, text))
        text = changed(text, 1000 + i, 0.03)
    kept = sorted(r.doc_id for r in sh.keep_first_rows(spark, make(rows)).collect())
    want = brute_kept(rows)
    assert kept == want and len(want) < 60


def test_given_documents_lose_their_near_copies(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.filter("n_chars < 8000").collect()]
    kept = sorted(r.doc_id for r in sh.keep_first_rows(spark, documents.filter("n_chars < 8000")).collect())
    assert kept == brute_kept(rows)


def test_covered_words():
    def of(text):
        return sh.similar_shingles(text.encode())

    text = " ".join(f"w{i}" for i in range(20))
    assert sh.covered(of(text), of(text)) == 1.0
    assert sh.covered(of(text), of("w0 w1 w2 w3 w4 w5 x")) == 6 / 20
    assert sh.covered(of("a b"), of("A, b!")) == 1.0 and sh.covered(of("a b"), of("a c")) == 0.0
    assert sh.covered(of(""), of("a")) == 0.0 and len(of("...")) == 0


def test_blocks_hold_all_that_cover_each_other(prose):
    texts = [changed(prose(1, 60) + " " + prose(2 + i % 2, 60), i, 0.03) for i in range(40)] + ["a b", "A, b!", "a c"]
    shingles = [sh.similar_shingles(t.encode()) for t in texts]
    marks = [(s >> np.uint64(48)).astype("<u2") for s in shingles]
    pairs = [(i, j) for i in range(len(texts)) for j in range(len(texts))]
    want = {(i, j) for i, j in pairs if min(sh.covered(shingles[i], shingles[j]), sh.covered(shingles[j], shingles[i])) >= sh.COVERED}
    found = set(sh.coverable(marks, marks))
    assert want <= found and len(found) < len(want) + 20


def test_large_buckets_meet_in_blocks(spark, make, prose):
    """Strangers that share a passage are not paired off as rows."""
    rows = [(bytes([i]), (sh.similar_shingles(prose(i, 100).encode()) >> np.uint64(48)).astype("<u2").tobytes()) for i in range(120)]
    many = spark.createDataFrame([(7, *r) for r in rows], "band long, own binary, mark binary")
    pairs = sh.compared(many.select("band", "own"), many)
    met = pairs._jdf.queryExecution().optimizedPlan().children().head()
    assert pairs.sparkSession is spark and pairs.count() == 0
    assert "collect_list" in met.toString()


def test_large_buckets_are_through_after_all_had_their_turn(spark, make, prose, monkeypatch):
    """Components are found before and after the members outside are compared, and not once more."""
    found, connected = [], sh.connected
    monkeypatch.setattr(sh, "connected", lambda *a: found.append(1) or connected(*a))
    text = prose(1, 120)
    rows = [(i, changed(text, i, 0.03)) for i in range(120)]
    rows += [(200 + i, prose(2, 60) + " " + prose(50 + i, 60)) for i in range(40)]
    kept = sorted(r.doc_id for r in sh.keep_first_rows(spark, make(rows)).collect())
    assert kept == brute_kept(rows)
    assert len(found) <= 2


def test_strangers_that_share_a_passage_have_no_partner(spark, prose):
    own = [prose(1, 60) + " " + prose(50 + i, 60) for i in range(30)] + [changed(prose(3, 90), i, 0.02) for i in range(5)]
    own += ["two words", "two  words", "no other"]
    rows = [(bytes([i]), sh.similar_shingles(t.encode()).tobytes()) for i, t in enumerate(own)]
    sets = spark.createDataFrame(rows, "own binary, shingles binary").repartition(4)
    found = {r.own[0] for r in sh.partnered(sets, sets).collect()}
    assert found == {*range(30, 37)}
