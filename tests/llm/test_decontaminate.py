import re

from sluice.llm import decontaminate as dc


def words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def parts(text):
    w = words(text)
    return {" ".join(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(docs, items):
    out = set()
    for i, t in docs:
        own = parts(t)
        for k, it in items:
            want = parts(it)
            hit = len(want & own)
            if want and hit * 10 >= len(want) * 8:
                out.add((i, k, hit, len(want)))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r)[:4] for r in df.collect()), key=repr)


def test_given_documents(spark, documents):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in documents.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert got(dc.contaminated(spark, documents, items)) == want


def test_sizes_edits_and_odd_rows(spark, make, prose):
    items = [(n, prose(n, n)) for n in (1, 4, 5, 6, 9, 10, 14, 24, 25, 60, 200)] + [(900, None), (901, ""), (902, prose(24, 24))]
    filler = prose(77, 3000)
    docs = [(n, filler + " " + t + " " + filler) for n, t in items if t]
    for n, t in items:
        w = (t or "").split()
        if len(w) > 24:
            w[0] = "changed"
            docs.append((1000 + n, "before " + " ".join(w) + " after"))
            w[len(w) // 2] = "changed"
            docs.append((2000 + n, "before " + " ".join(w) + " after"))
            docs.append((3000 + n, "before " + " ".join(w[: len(w) // 2])))
    docs += [(None, items[8][1]), (None, items[9][1]), (1, docs[0][1]), (50, None), (51, ""), (52, items[9][1].upper())]
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' as doc_id")
    frame = make(docs)
    assert got(dc.contaminated(spark, frame, bench)) == brute(docs, items)
    kept = dc.drop_contaminated(spark, frame, bench)
    gone = {r[0] for r in brute(docs, items)}
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((i for i, _ in docs if i not in gone), key=repr)
    assert kept.columns == frame.columns


def test_ways_without_broadcast_agree(spark, make, prose, monkeypatch):
    items = [(n, prose(n, 20)) for n in range(10)]
    docs = [(n, prose(100 + n, 30) + " " + t) for n, t in items]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for name in ("BROADCAST_SKETCHES", "BROADCAST_PAIRS", "BROADCAST_ITEMS"):
        monkeypatch.setattr(dc, name, 0)
    assert got(dc.contaminated(spark, make(docs), bench)) == brute(docs, items)


def test_broadcast_follows_the_size_of_rows(spark):
    few = spark.createDataFrame([(1, ["x" * 600]), (2, ["y" * 600])], "item_id long, item array<string>")
    size = dc.F.octet_length(dc.F.concat_ws(" ", "item"))
    for df, sent in ((dc._small(few, 2000, size), True), (dc._small(few, 1000, size), False), (dc._small(few, 2), True)):
        assert ("ResolvedHint" in df._jdf.queryExecution().analyzed().toString()) == sent


def test_empty(spark, make):
    bench = spark.createDataFrame([], "item_id long, text string")
    docs = make([(1, "a b c d e f")])
    assert dc.contaminated(spark, docs, bench).count() == 0
    assert dc.drop_contaminated(spark, docs, bench).count() == 1
    assert dc.contaminated(spark, docs.limit(0), bench).count() == 0


def test_each_text_without_id_is_told_by_itself(spark, make, prose):
    item = prose(1, 40)
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    words = item.split()
    rows = [(None, "x " + item), (None, item + " y"), (None, " ".join(words[:20])), (None, " ".join(words[20:])), (None, "x " + item)]
    assert [r[:2] for r in got(dc.contaminated(spark, make(rows), bench))] == [(None, 1)] * 2
