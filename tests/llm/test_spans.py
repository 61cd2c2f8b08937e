import random
import re

import xxhash

from sluice.llm import spans as sp


def brute_sentences(text):
    out, start, i = [], 0, 0
    for m in re.finditer(r"\n|(?<=[.!?])\s", text):
        if m.start() >= i:
            out.append((start, m.start()))
            start = i = m.end()
    out.append((start, len(text)))
    trimmed = []
    for a, b in out:
        while a < b and text[a].isspace():
            a += 1
        while a < b and text[b - 1].isspace():
            b -= 1
        if a < b:
            trimmed.append((a, b))
    return trimmed


def brute(docs, run, least):
    """Characters to remove of each document, from all spans in order."""
    seen, gone = {}, {}
    for i, text in sorted((d for d in docs if d[0] is not None), key=lambda d: d[0]):
        own = brute_sentences(text or "")
        for k in range(max(1, len(own) - run + 1) if own else 0):
            part = own[k : k + run]
            words = [text[a:b].lower().split() for a, b in part]
            if sum(map(len, words)) < least:
                continue
            key = str(words)
            if seen.setdefault(key, (i, part[0][0])) != (i, part[0][0]):
                gone.setdefault(i, set()).update(range(part[0][0], part[-1][1]))
    return gone


def found(spark, docs, run=2, least=10):
    out = {}
    for r in sp.repeated_spans(spark, docs, run=run, least_words=least).collect():
        out.setdefault(r.doc_id, set()).update(range(r.start, r.end))
    return out


def test_given_documents(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    for run, least in ((2, 10), (3, 1)):
        assert found(spark, documents, run, least) == brute(rows, run, least)


def test_odd_rows(spark, make, prose):
    a, b = prose(1, 40), prose(2, 40)
    rows = [(1, a), (2, "Own start here. " + a + " Own end."), (3, a.upper()), (4, None), (5, ""), (6, "\n \n"), (7, "One only sentence " * 4),
            (8, "One only sentence " * 4), (None, a), (9, b + "\n" + b), (9, b + "\n" + b), (10, a.replace(" ", "  ")), (11, "A. B. C. " * 9), (12, prose(3, 20_000) + " " + a)]
    docs = make(rows)
    unique = rows[:10] + rows[11:]
    assert found(spark, docs) == brute(unique, 2, 10)
    assert sp.repeated_spans(spark, docs.limit(0)).count() == 0


def test_texts_lose_what_was_found(spark, make, prose):
    a = prose(1, 40)
    rows = [(1, a), (2, "Own start here. " + a + " Own end."), (None, a), (3, None)]
    docs = make(rows).withColumnRenamed("source", "start")
    cut = sp.remove_repeats(spark, docs)
    assert cut.columns == docs.columns and cut.schema["text"].dataType.simpleString() == "string"
    texts = {r.doc_id: r.text for r in cut.collect()}
    gone = brute(rows[:2], 2, 10)
    assert texts == {i: t if not t else "".join(c for k, c in enumerate(t) if k not in gone.get(i, ())) for i, t in rows}
    assert len(texts[2]) < 20 + len("Own start here.  Own end.")


def test_merging():
    assert sp.merged([(5, 9, 3), (0, 4, 2), (8, 12, 1)]) == [(0, 4, 2), (5, 12, 1)]


def covered(spark, docs):
    out = {}
    for r in sp.repeated_spans(spark, docs, growing=True).collect():
        out.setdefault(r.doc_id, set()).update(range(r.start, r.end))
    return out


def test_growing_runs_cover_short_and_long_sentences(spark, make, prose):
    short = "Yes. No.\nErwhed!! Well then? " + " ".join(f"W{i}." for i in range(60)) + " So it is. Ab. Cd. Ef gh ij kl mn. Op."
    long = prose(4, 400).replace(".", "") + "."
    middle = " ".join(long.split()[3:22]) + " " + " ".join(long.split()[22:48]) + "."
    few = "Just a short one of eleven words that stands alone here."
    rows = [(1, "Own first. " + short + " Own last."), (2, "Other start.\n" + short + "\nOther end of it."),
            (3, "Here. " + long + " There."), (4, "Before that. " + long + " After that."), (5, prose(6, 50) + " " + middle),
            (6, "Aa bb. " + middle + " Cc dd."), (7, "Left of it. " + few + " Right."), (8, "Up. " + few + " Down."), (9, "Yes. No."), (10, "Yes. No.")]
    got = covered(spark, make(rows))
    texts = dict(rows)

    def place(i, part):
        at = texts[i].index(part)
        return set(range(at, at + len(part)))

    assert got[2] >= place(2, short[:-1]) and got[4] >= place(4, long)
    # Part of a long sentence is found from the first boundary on.
    assert len(got[6] & place(6, middle)) >= 0.6 * len(middle)
    assert set(got) == {2, 4, 5, 6} and not got[2] & place(2, "Other start.") and not got[4] & place(4, "After that.")


def test_growing_runs_find_no_less(spark, documents):
    fixed, more = found(spark, documents), covered(spark, documents)
    texts = {r.doc_id: r.text for r in documents.collect()}
    assert all(more[i] >= {k for k in gone if not texts[i][k].isspace()} for i, gone in fixed.items())


def test_grown_runs_are_the_shortest():
    r = random.Random(3)
    for _ in range(500):
        sizes = [r.choice((1, 1, 2, 3, 12)) for _ in range(r.randint(0, 14))]
        good = {(i, j) for i in range(len(sizes)) for j in range(i + 2, len(sizes) + 1) if sum(sizes[i:j]) >= 10}
        want = {(i, min(j for a, j in good if a == i)) for i, _ in good} | {(max(i for i, b in good if b == j), j) for _, j in good}
        if len(sizes) == 1 and sizes[0] >= 10:
            want = {(0, 1)}
        assert sp.grown(sizes, 2, 10) == want


def brute_pieces(text, a, b, least):
    """A long sentence cut after words whose pair hash is the smallest of its neighbours."""
    places = [(a + m.start(), a + m.end()) for m in re.finditer(r"\S+", text[a:b])]
    words = [text[x:y].lower() for x, y in places]
    value = [xxhash.xxh64_intdigest(f"{x} {y}".encode()) for x, y in zip(words, words[1:])]
    cuts = []
    for i in range(4, len(value) - 4):
        if all(value[i] < v for v in value[i - 4 : i]) and all(value[i] <= v for v in value[i + 1 : i + 5]):
            cuts.append(i + 1)
    cuts = cuts or [len(places) // 2]
    out, at = [], 0
    for cut in [*cuts, len(places)]:
        step = least if cut - at > 40 else cut - at
        while at < cut:
            out.append((places[at][0], places[min(at + step, cut) - 1][1]))
            at = min(at + step, cut)
    return out


def brute_growing(docs, run=2, least=10):
    """Characters to remove where runs grow, from all shortest runs of all documents in order."""
    seen, gone = {}, {}
    for i, text in sorted((d for d in docs if d[0] is not None), key=lambda d: d[0]):
        text, own = text or "", []
        for a, b in brute_sentences(text):
            own += brute_pieces(text, a, b, least) if len(text[a:b].split()) >= 2 * least else [(a, b)]
        words = [text[a:b].lower().split() for a, b in own]
        spans = set()
        for x in range(len(own)):  # from each sentence on
            y = next((y for y in range(x + run, len(own) + 1) if sum(map(len, words[x:y])) >= least), None)
            spans |= {(x, y)} if y else set()
        for y in range(run, len(own) + 1):  # and up to each
            x = next((x for x in range(y - run, -1, -1) if sum(map(len, words[x:y])) >= least), None)
            spans |= {(x, y)} if x is not None else set()
        if 0 < len(own) < run and sum(map(len, words)) >= least:
            spans = {(0, len(own))}
        for x, y in sorted(spans, key=lambda s: own[s[0]][0]):
            key = str(words[x:y])
            if seen.setdefault(key, (i, own[x][0])) != (i, own[x][0]):
                gone.setdefault(i, set()).update(range(own[x][0], own[y - 1][1]))
    return gone


def test_growing_runs_against_brute_force(spark, documents, make, prose):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert covered(spark, documents) == brute_growing(rows)
    a = prose(1, 60)
    odd = [(1, a), (2, "Own. " + a.upper()), (3, None), (4, ""), (5, "Yes. No. " * 30), (6, prose(2, 500).replace(".", "")), (7, prose(2, 500).replace(".", ""))]
    assert covered(spark, make(odd)) == brute_growing(odd)


def test_an_id_on_several_texts(spark, make, prose):
    """Each text loses its own repeats, and none by the offsets of another one."""
    a, b, c = prose(1, 40), prose(2, 40), prose(3, 40)
    rows = [(1, a), (2, "Start here now. " + a), (2, b), (2, b), (3, c + " " + a), (3, c)]
    cut = sorted(((r.doc_id, r.text) for r in sp.remove_repeats(spark, make(rows), growing=True).collect()))
    kept = {(1, a), (2, b)}
    assert kept <= set(cut) and len(cut) == len(rows) and cut.count((2, b)) == 2
    rest = [(i, t) for i, t in cut if (i, t) not in kept]
    assert all(a not in t for _, t in rest)
    # One of the two texts of id 3 keeps what both have.
    assert sum(c in t for i, t in rest if i == 3) == 1
