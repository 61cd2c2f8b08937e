"""Periodic runs of words, by branching squares in an enhanced suffix array.

Texts are laid end to end, every word a number that is its own in its text, a mark of its own
after each text, so that nothing repeats across texts.  Ranks of all stretches of 1, 2, 4, ...
words (prefix doubling) give the suffix array and its inverse, the lengths of common prefixes and,
read backwards, those of common suffixes.

A square (twice the same d words) is branching if the word after it breaks the period.  For each
interval of suffixes that share d words, every suffix i outside the largest child looks whether
i+d and i-d lie in the interval too (their places in the inverse array); a pair that does and
differs in its next word is a branching square.  Each suffix is in a smaller child log n times
at most.  Every run ends in one branching square of its period; rotated to the left as far as the words agree it gives
the whole run.  Squares of several periods over the same stretch are one run, of the smallest.

All steps are array operations over many texts at once; no tree is built.  Memory is some
hundred bytes a word, for ``BATCH_WORDS`` words or the longest single text.

Defined results: null and empty texts have no words, no runs and an empty collapsed text; null and
repeated ids and repeated rows are rows like any other; other columns are not read; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import prepare, texts_of

#: A run repeats its period so often, and has so many words.
LEAST_EXPONENT = 4
LEAST_WORDS = 6
#: Words that are searched at a time; a longer text is searched by itself.
BATCH_WORDS = 1 << 17

RUN_TYPE = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def doubled_ranks(symbols: np.ndarray) -> list[np.ndarray]:
    """Ranks of the stretches of 1, 2, 4, ... symbols from each place on, until all differ.

    A rank is the number of smaller stretches.  The last symbol must occur once.
    """
    n = len(symbols)
    sizes = np.bincount(symbols)
    rank = (np.cumsum(sizes) - sizes)[symbols]
    levels = [rank]
    while True:
        active = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)
        if not len(active):
            return levels
        step = 1 << (len(levels) - 1)
        old = rank[active]
        key = old * n + rank[active + step]
        order = np.argsort(key)
        active, old, key = active[order], old[order], key[order]
        here = np.arange(len(key))
        group = np.maximum.accumulate(np.where(np.concatenate(([True], key[1:] != key[:-1])), here, 0))
        former = np.maximum.accumulate(np.where(np.concatenate(([True], old[1:] != old[:-1])), here, 0))
        rank = rank.copy()
        rank[active] = old + group - former
        levels.append(rank)


def common_prefix(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many symbols from a on and from b on are the same; a and b differ."""
    length = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 2, -1, -1):
        length += (levels[k][a + length] == levels[k][b + length]).astype(np.int64) << k
    return length


def common_suffix(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many symbols before a and before b are the same, a < b."""
    length = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 2, -1, -1):
        at = a - length - (1 << k)
        inside = at >= 0
        same = levels[k][np.maximum(at, 0)] == levels[k][np.maximum(b - length - (1 << k), 0)]
        length += (inside & same).astype(np.int64) << k
    return length


def _nearest_smaller(values: np.ndarray, at: np.ndarray, step: int) -> np.ndarray:
    """For the places ``at``, the nearest one in direction ``step`` with a smaller value.  Values at both ends are smallest."""
    jump = np.arange(len(values)) + step
    left = at
    while len(left):
        left = left[values[jump[left]] >= values[left]]
        jump[left] = jump[jump[left]]
    return jump[at]


def branching_squares(symbols: np.ndarray, levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Start and half length of each square whose next symbol breaks the period."""
    n, inverse = len(symbols), levels[-1]
    suffixes = np.empty(n, np.int64)
    suffixes[inverse] = np.arange(n)
    lcp = np.zeros(n + 1, np.int64)
    lcp[1:n] = common_prefix(levels, suffixes[:-1], suffixes[1:])
    at = np.flatnonzero(lcp)
    if not len(at):
        return at, at
    # Intervals: places of the same depth between the same neighbours of less depth.
    left, right, depth = _nearest_smaller(lcp, at, -1), _nearest_smaller(lcp, at, 1), lcp[at]
    order = np.lexsort((at, depth, left))
    at, left, right, depth = at[order], left[order], right[order], depth[order]
    first = np.flatnonzero(np.concatenate(([True], (left[1:] != left[:-1]) | (depth[1:] != depth[:-1]))))
    # Children: from the left end to the first place, from place to place, from the last one to the right end.
    begin = np.insert(at, first, left[first])
    heads = first + np.arange(len(first))
    counts = np.diff(np.append(heads, len(begin)))
    end = np.append(begin[1:], 0)
    end[heads + counts - 1] = right[first]
    size = end - begin
    largest = np.repeat(np.maximum.reduceat(size, heads), counts)
    one = np.minimum.reduceat(np.where(size == largest, np.arange(len(size)), len(size)), heads)
    smaller = np.ones(len(size), bool)
    smaller[one] = False
    size, begin = size[smaller], begin[smaller]
    low, high, d = (np.repeat(np.repeat(x[first], counts)[smaller], size) for x in (left, right, depth))
    i = suffixes[np.arange(len(d)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begin, size)]

    found = []
    for q, start in ((i + d, i), (i - d, i - d)):
        inside = q >= 0
        own = inverse[np.maximum(q, 0)]
        inside &= (low <= own) & (own < high)
        s, p = start[inside], d[inside]
        breaks = symbols[s + p] != symbols[s + 2 * p]
        found.append(np.stack((s[breaks], p[breaks])))
    both = np.unique(np.concatenate(found, 1), axis=1)
    return both[0], both[1]


def find_runs(
    symbols: np.ndarray, exponent: int = LEAST_EXPONENT, words: int = LEAST_WORDS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and smallest period of each maximal run, by start and period.  The last symbol occurs once."""
    levels = doubled_ranks(symbols)
    at, period = branching_squares(symbols, levels)
    turned = common_suffix(levels, at, at + period)
    start, length = at - turned, turned + 2 * period
    long = length >= np.maximum(words, exponent * period)
    start, length, period = start[long], length[long], period[long]
    # Of several periods of one stretch the smallest counts.
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    keep = np.concatenate(([True], (start[1:] != start[:-1]) | (length[1:] != length[:-1])))[: len(start)]
    start, length, period = start[keep], length[keep], period[keep]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """All words as numbers, each text with its own ones and a mark behind it; where each text begins."""
    numbers, begins, used = [], [], 0
    for words in texts:
        begins.append(len(numbers))
        own: dict[bytes, int] = {}
        numbers += [own.setdefault(w, used + len(own)) for w in words]
        used += len(own)
        numbers.append(used)
        used += 1
    return np.array(numbers, np.int64), np.array([*begins, len(numbers)], np.int64)


def _found(ids: list, texts: list[list[bytes]], exponent: int, least_words: int) -> pa.RecordBatch:
    symbols, begins = _numbered(texts)
    start, length, period = find_runs(symbols, exponent, least_words)
    owner = np.searchsorted(begins, start, "right") - 1
    # What follows the first period of a run goes.
    edges = np.zeros(len(symbols) + 1, np.int64)
    np.add.at(edges, start + period, 1)
    np.add.at(edges, start + length, -1)
    kept = np.cumsum(edges) == 0
    hit = set(owner.tolist())
    collapsed = [
        b" ".join(compress(words, kept[begins[i] : begins[i + 1] - 1].tolist()) if i in hit else words)
        for i, words in enumerate(texts)
    ]
    upto = np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32)
    runs = pa.StructArray.from_arrays(
        [pa.array(start - begins[owner]), pa.array(length), pa.array(period)], fields=list(RUN_TYPE)
    )
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()),
            pa.array([len(t) for t in texts], pa.int64()),
            pa.ListArray.from_arrays(pa.array(upto), runs),
            pa.array(collapsed, pa.binary()).cast(pa.string()),
        ],
        names=["doc_id", "n_words", "runs", "collapsed"],
    )


def _search(exponent: int, least_words: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, held = [], [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                words = text.split()
                if texts and held + len(words) > BATCH_WORDS:
                    yield _found(ids, texts, exponent, least_words)
                    ids, texts, held = [], [], 0
                ids.append(doc_id)
                texts.append(words)
                held += len(words) + 1
            if texts:
                yield _found(ids, texts, exponent, least_words)

    return search


def periodic_runs(
    spark: SparkSession,
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    exponent: int = LEAST_EXPONENT,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """doc_id, n_words, runs (start word, length, period) and the text collapsed to the first period of each run.

    Words are what stands between ASCII white space, compared as they are.
    """
    prepare(spark)
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(_search(exponent, least_words), SCHEMA)
