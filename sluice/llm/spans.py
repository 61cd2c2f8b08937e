"""Substring dedup: repeated runs of sentences.

Every run of two consecutive sentences is hashed to 128 bits and joined over all documents.  The first
one of equal runs, by document id and place, stays; sentences that any other of them covers
are removed.  A document that is shorter than a run is one run as a whole.  Runs of few words
repeat by chance and are not compared.

When runs may grow (``growing``), one of few words is lengthened instead of passed over: from each
sentence on, and up to each sentence, until it has the sentences and the words.  So a repeated
passage of whole sentences is covered from its first to its last one, however short they are.
A sentence of twice the least words or more is then cut into pieces, each taken as a
sentence: after words whose hash is the smallest among their neighbours, which depends on these
alone.  So it is found between other neighbours too, and so are long parts of it, but for the words before the
first cut and after the last one in it.

Sentences end at ``.``, ``!`` or ``?`` before white space, and at line ends; they are
compared in lower case with single spaces.  Offsets are code points, ends exclusive.

Defined results: null and empty texts have no sentences; rows without an id cannot be reported
and are left alone; rows repeated with their id are one document; where an id stands on several texts, each of
them is a document of its own; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import prepare, staged

#: Sentences in a run, and words a run must have.
RUN = 2
LEAST_WORDS = 10

#: Words on each side among which a long sentence is cut at most once, and words of the longest piece.
NEAR = 4
LONGEST = 40

GAP = re.compile(r"(?<=[.!?])\s+|\s*\n\s*")
SPANS = "doc_id long, text_key long, start int, end int, h1 long, h2 long"


def sentences(text: str) -> list[tuple[int, int]]:
    """Start and end of each sentence."""
    out, start = [], 0
    for gap in GAP.finditer(text):
        if gap.start() > start:
            out.append((start, gap.start()))
        start = gap.end()
    if start < len(text):
        out.append((start, len(text)))
    trimmed = []
    for a, b in out:
        own = text[a:b]
        a += len(own) - len(own.lstrip())
        if own := own.strip():
            trimmed.append((a, a + len(own)))
    return trimmed


WORD = re.compile(r"\S+")


def pieces(text: str, start: int, end: int, size: int) -> Iterator[tuple[int, int]]:
    """Start and end of the pieces of a long sentence; where nothing cuts it for long, ``size`` words each."""
    places = [m.span() for m in WORD.finditer(text, start, end)]
    words = [text[a:b].lower().encode("utf-8", "replace") for a, b in places]
    hashes = [xxhash.xxh64_intdigest(b"%b %b" % pair) for pair in zip(words, words[1:])]
    cuts = [
        i + 1
        for i in range(NEAR, len(hashes) - NEAR)
        if hashes[i] < min(hashes[i - NEAR : i]) and hashes[i] <= min(hashes[i + 1 : i + 1 + NEAR])
    ]
    at = 0
    for cut in (*(cuts or [len(places) // 2]), len(places)):
        step = size if cut - at > LONGEST else cut - at
        for first in range(at, cut, step):
            yield places[first][0], places[min(first + step, cut) - 1][1]
        at = cut


def grown(sizes: list[int], run: int, least_words: int) -> set[tuple[int, int]]:
    """Shortest runs (from, to) from each sentence on and up to each, of enough sentences and words."""
    upto = [0]
    for size in sizes:
        upto.append(upto[-1] + size)
    out, a, b = set(), 0, 0
    for i in range(len(sizes)):
        b = max(b, min(i + run, len(sizes)))
        while b < len(sizes) and upto[b] - upto[i] < least_words:
            b += 1
        if b - i >= run and upto[b] - upto[i] >= least_words:
            out.add((i, b))
    for j in range(run, len(sizes) + 1):
        while a + 1 <= j - run and upto[j] - upto[a + 1] >= least_words:
            a += 1
        if upto[j] - upto[a] >= least_words:
            out.add((a, j))
    if 0 < len(sizes) < run and upto[-1] >= least_words:
        out.add((0, len(sizes)))
    return out


def runs(text: str, run: int, least_words: int, growing: bool = False) -> Iterator[tuple[int, int, bytes]]:
    """Start, end and normalised words of each run that is long enough to compare."""
    own = sentences(text)
    words = [text[a:b].lower().split() for a, b in own]
    if growing:
        own = [
            piece
            for (a, b), w in zip(own, words)
            for piece in (pieces(text, a, b, least_words) if len(w) >= 2 * least_words else ((a, b),))
        ]
        words = [text[a:b].lower().split() for a, b in own]
        chosen = sorted(grown([*map(len, words)], run, least_words))
    else:
        starts = range(max(1, len(own) - run + 1) if own else 0)
        chosen = [(i, min(i + run, len(own))) for i in starts if sum(map(len, words[i : i + run])) >= least_words]
    for i, j in chosen:
        yield own[i][0], own[j - 1][1], "\n".join(map(" ".join, words[i:j])).encode("utf-8", "replace")


def _spans(run: int, least_words: int, growing: bool):
    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, starts, ends, digests = [], [], [], [], []
            for doc_id, key, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for start, end, words in runs(text or "", run, least_words, growing):
                    ids.append(doc_id)
                    keys.append(key)
                    starts.append(start)
                    ends.append(end)
                    digests.append(xxhash.xxh3_128_digest(words))
            both = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(keys, pa.int64()),
                    pa.array(starts, pa.int32()),
                    pa.array(ends, pa.int32()),
                    pa.array(both[:, 0].copy()),
                    pa.array(both[:, 1].copy()),
                ],
                names=["doc_id", "text_key", "start", "end", "h1", "h2"],
            )

    return spans


def merged(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Overlapping (start, end, first document) as one, with the smallest first document."""
    out: list[tuple[int, int, int]] = []
    for start, end, first in sorted(found):
        if out and start <= out[-1][1]:
            before = out[-1]
            out[-1] = (before[0], max(before[1], end), min(before[2], first))
        else:
            out.append((start, end, first))
    return out


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [
            (doc_id, key, *span)
            for doc_id, key, found in zip(*(batch.column(i).to_pylist() for i in range(3)))
            for span in merged([(f["start"], f["end"], f["first_id"]) for f in found])
        ]
        columns = zip(*rows) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], names=["doc_id", "text_key", "start", "end", "first_id"]
        )


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text_key and text of the rows with an id.  The key tells the texts of one id apart; it is 0 where no id repeats."""
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    narrow = narrow.filter("doc_id is not null")
    repeats = narrow.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").limit(1).count()
    key = F.xxhash64(F.coalesce("text", F.lit(""))) if repeats else F.lit(0).cast("long")
    return narrow.select("doc_id", key.alias("text_key"), "text")


def repeated_spans(
    spark: SparkSession,
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    run: int = RUN,
    least_words: int = LEAST_WORDS,
    growing: bool = False,
) -> DataFrame:
    """doc_id, start, end of what is removed, and first_id, a document where some of it stays.

    Where an id stands on several texts its rows are those of each of them.
    """
    prepare(spark)
    return _repeated(spark, _keyed(docs, id_col, text_col), run, least_words, growing).drop("text_key")


def _repeated(spark: SparkSession, keyed: DataFrame, run: int, least_words: int, growing: bool) -> DataFrame:
    spans = staged(spark, keyed.mapInArrow(_spans(run, least_words, growing), SPANS), "spans")
    first = (
        spans.groupBy("h1", "h2")
        .agg(F.min(F.struct("doc_id", "text_key", "start")).alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("h1", "h2", "first")
    )
    first = staged(spark, first, "repeated")
    later = spans.join(first, ["h1", "h2"]).filter(F.struct("doc_id", "text_key", "start") != F.col("first"))
    found = later.groupBy("doc_id", "text_key").agg(
        F.collect_set(F.struct("start", "end", F.col("first.doc_id").alias("first_id"))).alias("found")
    )
    return found.mapInArrow(_merge, "doc_id long, text_key long, start long, end long, first_id long")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            at, kept = 0, []
            for span in sorted(spans or [], key=lambda s: s["start"]):
                kept.append(text[at : span["start"]])
                at = span["end"]
            texts.append(text if text is None else "".join(kept) + text[at:])
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), batch.column(2)], names=["text", "row"])


def remove_repeats(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **parameters: int
) -> DataFrame:
    """``docs`` with the repeated sentences cut out of the text; all rows and columns stay."""
    prepare(spark)
    settings = {"run": RUN, "least_words": LEAST_WORDS, "growing": False} | parameters
    found = _repeated(spark, _keyed(docs, id_col, text_col), **settings)
    found = found.groupBy(F.col("doc_id").alias("cut_id"), F.col("text_key").alias("cut_key")).agg(
        F.collect_list(F.struct("start", "end")).alias("cut_spans")
    )
    found = staged(spark, found, "cuts")
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    own_key = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    held = docs.select(
        F.col(id_col).cast("long").alias("own_id"), own_key.alias("own_key"), F.col(text_col).alias("text"), row.alias("row")
    )
    # A key of 0 stands for whatever text an id has.
    own = (F.col("own_id") == F.col("cut_id")) & F.col("cut_key").isin(0, F.col("own_key"))
    joined = held.join(found, own, "left").select("text", "cut_spans", "row")
    kind = docs.select(row.alias("row")).schema["row"].dataType.simpleString()
    cut = joined.mapInArrow(_cut, f"text string, row {kind}")
    return cut.select(F.col("row").withField(text_col, F.col("text")).alias("row")).select("row.*")
