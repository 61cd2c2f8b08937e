"""Language-model scores from Elias-Fano tries.

The model is a bigram model with Dirichlet smoothing: (c(v,w) + M p(w)) / (c(v) + M), where p is the
add-0.1 unigram model.  It is learned from all documents whose id does not fall into the held-out
tenth.  The numerator's logarithm is what the tries hold, quantised; it depends on the word
and the word before only through counts that lie with the word, and the denominator on the
count of the earlier word, which lies with that word.  So a document's score is a sum
over its words, each at home in one shard, and one shuffle brings every batch's different
bigrams to their words, with the rows in which they occur.  A shard counts, builds its
trie, looks its bigrams up and gives back to each batch the sums by row.

Words with many occurrences (a list of bounded length) are dealt by the pair of words
instead, and their counts are sent along with the list, so no word makes a shard large.

Defined results: null and empty texts are one end mark; a null id is not held out; repeated rows
are scored each, and each counts as training text; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import prepare, staged, texts_of
from sluice.llm.elias_fano import KEY_BITS, Trie

ADDED = 0.1
#: Weight of the unigram model, in occurrences.
MASS = 4.0
FOLDS = 10
#: Occurrences that a shard has, about.
SHARD_TOKENS = 2 << 20
#: Words dealt by pairs, at most.
HOT_WORDS = 1 << 20
#: Hashes of the end mark and of what stands before the first word.
END, START = np.uint64(1), np.uint64(2)

U = np.uint64
#: What a batch sends to a shard.  A place is a row's number in its batch, with HELD set for held-out
#: rows.  One row of each batch has only the ids of its rows.
SHARDS = "batch long, shard int, words binary, spread binary, contexts binary, times binary, places binary, ids array<long>"
#: What comes back: sums for the places of a batch that occur in the shard.
SUMS = "batch long, places binary, n_tokens binary, n_known binary, base binary, model binary, ids array<long>"
SCORES = "doc_id long, n_tokens long, n_known long, base double, model double"
HELD = np.uint16(1 << 15)


def held_out(doc_id: int | None, folds: int = FOLDS) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % folds == 0


def _hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, 7) & int(KEY_BITS) | 4


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of each word in a batch, those in training text and all."""
    for batch in batches:
        train, every, docs, trained = Counter(), Counter(), 0, 0
        for doc_id, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
            words = text.lower().split()
            docs += 1
            if held_out(doc_id):
                every.update(words)
            else:
                trained += 1
                train.update(words)
        for word in train:
            every[word] += train[word]
        keys = [_hash(w) for w in every] + [int(END)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(keys, pa.int64()),
                pa.array([train.get(w, 0) for w in every] + [trained], pa.int64()),
                pa.array([*every.values(), docs], pa.int64()),
            ],
            names=["word", "c", "n"],
        )


def _mix(a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (a ^ (np.asarray(b, U) * U(0x9E3779B97F4A7C15))) * U(0xD6E8FEB86659FD93)
        return x ^ (x >> U(32))


def _among(sorted_keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(sorted_keys):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(sorted_keys, wanted), len(sorted_keys) - 1)
    return sorted_keys[at] == wanted, at


def _deal(shards: int, hot):
    """For each batch and shard: its words, what stood before them, how often, and in which rows."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        hot_words = hot.value[0]
        for batch in batches:
            ids = batch.column(0)
            seen: dict[bytes, int] = {}
            parts, lengths = [], []
            for text in texts_of(batch.column(1)):
                words = text.lower().split()
                parts.append(np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words)))
                lengths.append(len(words))
            own = np.concatenate((np.fromiter(map(_hash, seen), U, len(seen)), [START, END]))
            start, end = len(seen), len(seen) + 1
            first = np.concatenate([x for p in parts for x in ([start], p)])
            word = np.concatenate([x for p in parts for x in (p, [end])])
            place = np.repeat(np.arange(len(parts)), np.array(lengths) + 1)
            order = np.lexsort((place, first, word))
            word, first, place = word[order], first[order], place[order]
            new = np.concatenate(([True], (word[1:] != word[:-1]) | (first[1:] != first[:-1])))
            at = np.flatnonzero(new)
            times = np.diff(np.concatenate((at, [len(word)])))
            w, v = own[word[at]], own[first[at]]
            is_hot = _among(hot_words, own)[0][word[at]]
            shard = (np.where(is_hot, _mix(w, v), _mix(w, 0)) % U(shards)).astype(np.int64)
            mark = np.arange(len(parts)).astype(np.uint16)
            mark[[held_out(i) for i in ids.to_pylist()]] |= HELD
            place = mark[place]
            order = np.argsort(shard, kind="stable")
            cuts = np.flatnonzero(np.concatenate(([True], np.diff(shard[order]) != 0, [True])))
            home = int(_mix(np.array([base], U), 1)[0] % U(shards))
            rows = [(base, home, *[b""] * 5, ids.to_pylist())]
            for a, b in zip(cuts[:-1], cuts[1:]):
                g = order[a:b]
                # The places of these pairs, which lie in one piece each.
                n = times[g]
                starts = np.repeat(at[g] - (np.cumsum(n) - n), n)
                here = place[starts + np.arange(int(n.sum()))]
                heads = np.flatnonzero(np.concatenate(([True], w[g][1:] != w[g][:-1])))
                spread = np.diff(np.concatenate((heads, [len(g)]))).astype(np.int32)
                sent = (w[g][heads], spread, v[g], n.astype(np.int32), here)
                rows.append((base, int(shard[g[0]]), *(x.tobytes() for x in sent), None))
            base += 1
            columns = [*zip(*rows)]
            kinds = [pa.int64(), pa.int32()] + [pa.binary()] * 5 + [pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=_names(SHARDS))

    return deal


def _names(ddl: str) -> list[str]:
    return [field.split()[0] for field in ddl.split(", ")]


class _Shard:
    """The pairs that came to one shard, and the trie of those from training text."""

    def __init__(self, table: pa.Table, hot: tuple[np.ndarray, np.ndarray], tokens: int, words: int, mass: float):
        def joined(name: str, kind) -> np.ndarray:
            return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)

        self.batches, self.ids = table.column("batch").to_pylist(), table.column("ids").to_pylist()
        #: Places of all batches, and where each batch's begin.
        self.places = joined("places", np.uint16)
        self.ends = np.cumsum([len(x) // 2 for x in table.column("places").to_pylist()])
        times = joined("times", np.int32).astype(np.int64)
        word = np.repeat(joined("words", U), joined("spread", np.int32))
        context = joined("contexts", U)
        in_training = (self.places & HELD) == 0
        trained = np.add.reduceat(in_training.astype(np.int64), np.cumsum(times) - times) if len(times) else times
        # The same pair comes from many batches.
        order = np.lexsort((context, word))
        w, v = word[order], context[order]
        new = np.concatenate(([True], (w[1:] != w[:-1]) | (v[1:] != v[:-1])))
        new = new[: len(w)]
        pair = np.empty(len(w), np.int32)
        pair[order] = (np.cumsum(new) - 1).astype(np.int32)
        self.pair = np.repeat(pair, times)
        self.word, self.context = w[new], v[new]
        together = np.bincount(pair, trained).astype(np.int64)
        head = np.concatenate(([True], self.word[1:] != self.word[:-1]))[: len(self.word)]
        rank = np.cumsum(head) - 1
        different = self.word[head]
        counts = np.bincount(rank, together).astype(np.int64)
        is_hot, at = _among(hot[0], different)
        if len(hot[0]):
            counts = np.where(is_hot, hot[1][at], counts)
        self.count = counts[rank]
        whole = tokens + ADDED * (words + 1)
        prior = mass * (counts + ADDED) / whole
        known = counts > 0
        new_rank = np.cumsum(known) - 1
        inside = together > 0
        self.unknown = float(np.log10(mass * ADDED / whole))
        self.levels = Trie.build(
            different[known],
            np.log10(prior[known]),
            new_rank[rank[inside]],
            self.context[inside],
            np.log10(together[inside] + prior[rank[inside]]),
        ).to_bytes()

    def sums(self, mass: float) -> Iterator[tuple]:
        """A row of SUMS for each batch: tokens, known ones, logarithms of counts and of the model."""
        model = Trie.open(self.levels).find(self.word, self.context, self.unknown)
        # A word is also what the next one is conditioned on; the end mark is not.
        model -= np.where(self.word == END, 0.0, np.log10(self.count + mass))
        known, base = self.count > 0, np.log10(self.count + ADDED)
        for batch, ids, start, end in zip(self.batches, self.ids, [0, *self.ends[:-1]], self.ends):
            pair, row = self.pair[start:end], (self.places[start:end] & ~HELD).astype(np.int64)
            n = np.bincount(row)
            at = np.flatnonzero(n)
            found = (n, *(np.bincount(row, x[pair]) for x in (known, base, model)))
            kinds = (np.int32, np.int32, np.float64, np.float32)
            sent = [x[at].astype(k).tobytes() for x, k in zip(found, kinds)]
            yield batch, at.astype(np.uint16).tobytes(), *sent, ids


def _sum(hot, tokens: int, words: int, mass: float):
    def shard_sums(table: pa.Table) -> pa.Table:
        rows = _Shard(table, hot.value, tokens, words, mass).sums(mass)
        kinds = [pa.int64()] + [pa.binary()] * 5 + [pa.list_(pa.int64())]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=_names(SUMS))

    return shard_sums


def _add_up(table: pa.Table) -> pa.Table:
    """The sums of one batch from all shards, one row for each of its documents."""
    ids = next(x for x in table.column("ids").to_pylist() if x is not None)
    place = np.frombuffer(b"".join(table.column("places").to_pylist()), np.uint16)
    columns = [pa.array(ids, pa.int64())]
    for name, kind in (("n_tokens", np.int32), ("n_known", np.int32), ("base", np.float64), ("model", np.float32)):
        values = np.frombuffer(b"".join(table.column(name).to_pylist()), kind)
        total = np.bincount(place, values, minlength=len(ids))
        columns.append(pa.array(total.astype(np.int64) if kind is np.int32 else total))
    return pa.table(columns, names=_names(SCORES))


def _levels(hot, tokens: int, words: int, mass: float):
    def levels(table: pa.Table) -> pa.Table:
        shard = _Shard(table, hot.value, tokens, words, mass)
        return pa.table([table.column("shard")[:1], pa.array([shard.levels], pa.binary())], names=["shard", "levels"])

    return levels


class _Corpus:
    """Counts over all documents, and their pairs of words dealt to shards."""

    def __init__(self, spark: SparkSession, docs: DataFrame, id_col: str, text_col: str, shard_tokens: int, hot_words: int):
        prepare(spark)
        narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        vocabulary = narrow.mapInArrow(_count, "word long, c long, n long").groupBy("word")
        vocabulary = staged(spark, vocabulary.agg(F.sum("c").alias("c"), F.sum("n").alias("n")), "vocabulary")
        total = vocabulary.agg(
            F.sum("c"), F.sum((F.col("c") > 0).cast("long")), F.sum("n"), F.max(F.when(F.col("word") == int(END), F.col("c")))
        ).first()
        self.tokens, self.words, every, self.documents = (x or 0 for x in total)
        self.shards = max(1, -(-every // shard_tokens))
        # Fewer than hot_words words can have more than this share of all occurrences.
        least = max(every // (4 * self.shards), every // hot_words)
        hot = vocabulary.filter(F.col("n") > least).orderBy("word").collect()
        keys = np.array([r["word"] for r in hot], np.int64).astype(U)
        self.hot = spark.sparkContext.broadcast((keys, np.array([r["c"] for r in hot], np.int64)))
        self.dealt = narrow.mapInArrow(_deal(self.shards, self.hot), SHARDS).groupBy("shard")


def score_texts(
    spark: SparkSession,
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    mass: float = MASS,
    shard_tokens: int = SHARD_TOKENS,
    hot_words: int = HOT_WORDS,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score for every row."""
    corpus = _Corpus(spark, docs, id_col, text_col, shard_tokens, hot_words)
    sums = corpus.dealt.applyInArrow(_sum(corpus.hot, corpus.tokens, corpus.words, mass), SUMS)
    rows = sums.groupBy("batch").applyInArrow(_add_up, SCORES)
    whole = float(np.log10(corpus.tokens + ADDED * (corpus.words + 1)))
    begin = float(np.log10(corpus.documents + mass))
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS
    return rows.select(
        "doc_id",
        F.coalesce(fold == 0, F.lit(False)).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(corpus.tokens).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * whole).alias("base_score"),
        (F.col("model") - begin).alias("score"),
    )


def model_shards(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mass: float = MASS, **sizes: int) -> DataFrame:
    """The model itself: shard and levels, the bytes on which ``Trie.open`` opens its trie."""
    corpus = _Corpus(spark, docs, id_col, text_col, sizes.get("shard_tokens", SHARD_TOKENS), sizes.get("hot_words", HOT_WORDS))
    return corpus.dealt.applyInArrow(_levels(corpus.hot, corpus.tokens, corpus.words, mass), "shard int, levels binary")
