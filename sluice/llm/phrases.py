"""Phrases that occur together: Misra-Gries summaries find what is frequent, a second pass counts it.

First pass: every task counts the n-grams (1 to the longest words) of its texts and deals
them by hash into summaries, one for each hash partition.  Summaries of one partition are merged in one
task, which keeps at most ``capacity`` counters: whenever there are more, all are lowered by the first count
that has no place, and those at zero go.  An n-gram loses less than mass / capacity in all, mass being
all occurrences in the partition; with a capacity of mass / threshold everything that occurs ``threshold`` times
is sure to survive.  A task's own summary needs no cut: a capacity that may be used up once over
all tasks exceeds what one task holds.  Keys are 48 bits of a hash; a collision can only let more survive.

Second pass: the keys that survived are a bitmap of at most 2^28 bits (32 MB, whatever the input)
which every task gets.  What passes it is counted exactly, by its words.  With more survivors than the
bitmap tells apart more is counted, and the result stays the same.

Scores take the exact counts of the parts, which occur at least as often and so survive too.

Within a task n-grams are numbers made from the places of words in a dictionary, so that
counting is sorting; no word is compared by hash alone.  A hot n-gram is one entry a task.

Defined results: null texts are empty; a null language is ``und``; ids are not read, and repeated rows
count as often as they occur; ties are broken by the words; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.context import planned_bytes
from sluice.llm.common import prepare, staged, texts_of

LEAST = 10
LONGEST = 3
TOP = 2000
#: A phrase goes when a longer one holds this many hundredths of its occurrences.
COVERED = 50

#: Bits of a key, and of the largest bitmap of surviving keys.
KEY_BITS = 48
BITMAP_BITS = 28
#: Bytes of text counted at a time, and entries a task gathers before it sends its summaries.
CHUNK_BYTES = 1 << 20
ENTRIES = 1 << 19
#: Bytes of input for each hash partition, as a bound of what one merge has to hold.
PARTITION_BYTES = 24 << 20

# What ends a piece and what separates words; both cannot be part of a word.
ENDS, GAPS = b".,;:!?\n\x0b\x0c\r", b" \t"
END, GAP = 0, 32
_TABLE = bytes(
    END if b in ENDS else GAP if b in GAPS else b + 32 if 65 <= b <= 90 else b for b in range(256)
)


class Counted:
    """The different n-grams of some texts of one language, by the places of their words in a dictionary."""

    def __init__(self, texts: list[bytes], longest: int):
        data = np.frombuffer(b"\n".join(texts).translate(_TABLE), np.uint8)
        # NUL in a text is a character like any other: ends are told by the source.
        source = np.frombuffer(b"\n".join(texts), np.uint8)
        ends = np.isin(source, np.frombuffer(ENDS, np.uint8))
        inside = ~(ends | np.isin(source, np.frombuffer(GAPS, np.uint8)))
        edges = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
        starts, stops = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        offsets = np.concatenate(([0], np.cumsum(stops - starts)))
        words = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside].tobytes())]
        ).dictionary_encode()
        self.words: pa.Array = words.dictionary
        ids = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        piece = np.cumsum(ends)[starts] if len(starts) else starts
        self.total = len(ids)
        self.grams: list[tuple[np.ndarray, np.ndarray]] = []
        size = len(self.words)
        code, values = ids, np.arange(size)[:, None]
        for n in range(1, longest + 1):
            if n > 1:
                if len(ids) < n:
                    break
                whole = piece[n - 1 :] == piece[: len(ids) - n + 1]
                # Numbers of the shorter n-grams times words stay far below 63 bits.
                code = (code[: len(ids) - n + 1] * size + ids[n - 1 :]).astype(np.int64)
                code[~whole] = -1
            found, inverse, counts = np.unique(code, return_inverse=True, return_counts=True)
            if n > 1:
                values = np.column_stack((values[found // size], found % size))
            good = found >= 0
            self.grams.append((values[good], counts[good]))
            code = inverse

    def keys(self, lang: str) -> list[np.ndarray]:
        """The keys of the n-grams of each length."""
        hashed = np.fromiter((xxhash.xxh64_intdigest(w.as_py()) for w in self.words), np.uint64, len(self.words))
        out = []
        for n, (grams, _) in enumerate(self.grams, 1):
            key = np.full(len(grams), xxhash.xxh64_intdigest(lang.encode(), n), np.uint64)
            for column in range(n):
                key = (key ^ hashed[grams[:, column]]) * np.uint64(0x9E3779B97F4A7C15)
                key ^= key >> np.uint64(29)
            out.append(key >> np.uint64(64 - KEY_BITS))
        return out

    def phrases(self, n: int, which: np.ndarray) -> pa.Array:
        """The words of the chosen n-grams of a length, joined by a space."""
        grams = self.grams[n - 1][0][which]
        columns = [self.words.take(pa.array(grams[:, i])) for i in range(n)]
        return pc.binary_join_element_wise(*columns, pa.scalar(b" ", pa.large_binary())) if n > 1 else columns[0]


def _chunks(batches: Iterator[pa.RecordBatch], longest: int) -> Iterator[tuple[str, Counted]]:
    """Texts by language, counted in pieces of bounded size; a longer text is counted by itself."""
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
            held.setdefault(lang, []).append(text)
            sizes[lang] = sizes.get(lang, 0) + len(text)
            if sizes[lang] >= CHUNK_BYTES:
                yield lang, Counted(held.pop(lang), longest)
                del sizes[lang]
        if sum(sizes.values()) >= 4 * CHUNK_BYTES:  # many languages
            for lang in list(held):
                yield lang, Counted(held.pop(lang), longest)
            sizes.clear()
    for lang in list(held):
        yield lang, Counted(held.pop(lang), longest)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different keys and the sum of the counts of each."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first)


def merged(keys: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The merge of summaries that are laid end to end, cut to ``capacity`` counters."""
    keys, counts = summed(keys, counts)
    if len(keys) > capacity:
        counts = counts - np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1]
        keys, counts = keys[counts > 0], counts[counts > 0]
    return keys, counts


def _planes(numbers: np.ndarray) -> bytes:
    return np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _numbers(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def packed(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys as differences, and counts, byte by byte of all numbers."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return zstandard.ZstdCompressor(1).compress(_planes(steps) + _planes(counts.astype(np.uint64)))


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    half = len(raw) // 2
    return np.cumsum(_numbers(raw[:half]), dtype=np.uint64), _numbers(raw[half:]).astype(np.int64)


SUMMARY = pa.schema([("part", pa.int64()), ("mass", pa.int64()), ("summary", pa.binary())])


def _summarise(longest: int, part_bits: int):
    shift = np.uint64(KEY_BITS - part_bits)

    def sent(keys: list[np.ndarray], counts: list[np.ndarray]) -> pa.RecordBatch:
        key, count = summed(np.concatenate(keys), np.concatenate(counts))
        parts = (key >> shift).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], parts[1:] != parts[:-1])))
        rows = [
            (int(parts[a]), int(count[a:b].sum()), packed(key[a:b], count[a:b]))
            for a, b in zip(first, [*first[1:], len(key)])
        ]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), SUMMARY)], schema=SUMMARY)

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        for lang, counted in _chunks(batches, longest):
            keys += counted.keys(lang)
            counts += [c for _, c in counted.grams]
            if sum(map(len, keys)) >= ENTRIES:
                yield sent(keys, counts)
                keys, counts = [], []
        if sum(map(len, keys)):
            yield sent(keys, counts)

    return summarise


def _merge(least: int):
    def survivors(part: int, keys: np.ndarray) -> pa.RecordBatch:
        rows = [[part], [len(keys)], [packed(keys, np.ones(len(keys), np.int64))]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, SUMMARY)], schema=SUMMARY)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows by part, the one without a summary first: it has the mass of the part."""
        part, capacity, waiting = None, 0, 0
        keys: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        for batch in batches:
            for own, mass, summary in zip(*(batch.column(i) for i in range(3))):
                summary = summary.as_py()
                if summary is None:
                    if keys:
                        yield survivors(part, merged(np.concatenate(keys), np.concatenate(counts), capacity)[0])
                    part, capacity, waiting, keys, counts = own.as_py(), mass.as_py() // least, 0, [], []
                    continue
                key, count = unpacked(summary)
                keys.append(key)
                counts.append(count)
                waiting += len(key)
                if waiting > max(capacity, ENTRIES // 4):
                    key, count = merged(np.concatenate(keys), np.concatenate(counts), capacity)
                    keys, counts, waiting = [key], [count], 0
        if keys:
            yield survivors(part, merged(np.concatenate(keys), np.concatenate(counts), capacity)[0])

    return merge


def _slices(bits: int, part_bits: int):
    """The part of the bitmap that each hash partition stands for."""

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, found = [], []
            for part, summary in zip(batch.column(0).to_pylist(), batch.column(2)):
                marks = np.zeros(1 << (bits - part_bits), bool)
                places = (unpacked(summary.as_py())[0] >> np.uint64(KEY_BITS - bits)).astype(np.int64)
                marks[places - (part << (bits - part_bits))] = True
                parts.append(part)
                found.append(np.packbits(marks, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int64()), pa.array(found, pa.binary())], names=["part", "bits"])

    return slices


def bitmap(survivors: DataFrame, part_bits: int) -> tuple[np.ndarray, int]:
    """Marks of surviving keys, eight a byte, and how many leading bits of a key say where its mark is."""
    n = survivors.agg(F.sum("mass").alias("n")).first()["n"] or 0
    bits = max(part_bits + 3, min(BITMAP_BITS, (16 * n).bit_length()))
    marks = np.zeros(1 << (bits - 3), np.uint8)
    found = survivors.mapInArrow(_slices(bits, part_bits), "part long, bits binary").toArrow()
    width = 1 << (bits - part_bits - 3)
    for part, own in zip(found.column(0).to_pylist(), found.column(1)):
        marks[part * width : (part + 1) * width] = np.frombuffer(own.as_buffer(), np.uint8)
    return marks, bits


def _count(longest: int, marks: Broadcast, bits: int):
    shift = np.uint64(KEY_BITS - bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.frombuffer(marks.value, np.uint8)
        for lang, counted in _chunks(batches, longest):
            if counted.total:
                yield rows(lang, 0, pa.array([b""], pa.large_binary()), np.array([counted.total]))
            for n, (key, (_, counts)) in enumerate(zip(counted.keys(lang), counted.grams), 1):
                place = key >> shift
                passed = np.flatnonzero(held[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1)
                for at in range(0, len(passed), 1 << 16):
                    which = passed[at : at + (1 << 16)]
                    yield rows(lang, n, counted.phrases(n, which), counts[which])

    def rows(lang: str, n: int, phrases: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
        langs = pa.DictionaryArray.from_arrays(np.zeros(len(counts), np.int8), pa.array([lang])).cast(pa.string())
        return pa.RecordBatch.from_arrays(
            [langs, pa.array(np.full(len(counts), n, np.int32)), phrases.cast(pa.binary()).cast(pa.string()), pa.array(counts.astype(np.int64))],
            names=["lang", "words", "phrase", "n"],
        )

    return count


def frequent(
    spark: SparkSession,
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    longest: int = LONGEST,
    least: int = LEAST,
) -> DataFrame:
    """lang, words, phrase, n of all that occurs ``least`` times; words = 0 has the number of all words."""
    prepare(spark)
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    narrow = docs.select(lang.alias("lang"), F.col(text_col).alias("text"))
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    part_bits = min(24, max(3, (max(own, planned_bytes(docs) // PARTITION_BYTES) - 1).bit_length()))
    form = "part long, mass long, summary binary"
    summaries = staged(spark, narrow.mapInArrow(_summarise(longest, part_bits), form), "summaries")
    masses = summaries.groupBy("part").agg(F.sum("mass").alias("mass"))
    dealt = (
        masses.select("part", "mass", F.lit(None).cast("binary").alias("summary"))
        .union(summaries)
        .repartition("part")
        .sortWithinPartitions("part", F.col("summary").isNotNull())
    )
    survivors = staged(spark, dealt.mapInArrow(_merge(least), form), "survivors")
    marks, bits = bitmap(survivors, part_bits)
    shared = spark.sparkContext.broadcast(marks.tobytes())
    counted = narrow.mapInArrow(_count(longest, shared, bits), "lang string, words int, phrase string, n long")
    exact = counted.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))
    return staged(spark, exact.filter((F.col("words") == 0) | (F.col("n") >= least)), "frequent")


def _floor(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)); whole numbers of 38 digits."""
    big = "decimal(15,0)"
    top = (a.cast(big) * a.cast(big) * F.lit(1000000)).cast("decimal(38,0)")
    return F.call_function("div", top, (left.cast(big) * right.cast(big)).cast("decimal(38,0)"))


def collocations(
    spark: SparkSession,
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    longest: int = LONGEST,
    least: int = LEAST,
    covered: int = COVERED,
    top: int = TOP,
) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase of two words or more is scored by the weakest of its cuts; it goes when its words stand in a longer
    frequent phrase that has ``covered`` hundredths of its occurrences.
    """
    found = frequent(spark, docs, text_col, lang_col, longest, least)
    totals = found.filter("words = 0").select("lang", F.col("n").alias("all_words"))
    parts = found.filter("words > 0").select("lang", F.col("phrase").alias("part"), F.col("n").alias("times"))
    phrases = found.filter("words > 1").select("lang", "words", "phrase", F.col("n").alias("a"))
    split = F.split("phrase", " ")

    def words(first: Column, count: Column) -> Column:
        return F.array_join(F.slice(split, first, count), " ")

    # Each cut looks up both of its sides; the sides are rows, so that a frequent word is split like any skewed key.
    cut = phrases.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    one, two = words(F.lit(1), F.col("k")), words(F.col("k") + 1, F.col("words") - F.col("k"))
    scored = (
        cut.withColumn("one", one).withColumn("two", two)
        .join(parts.select("lang", F.col("part").alias("one"), F.col("times").alias("l")), ["lang", "one"])
        .join(parts.select("lang", F.col("part").alias("two"), F.col("times").alias("r")), ["lang", "two"])
        .withColumn("score", _floor(F.col("a"), F.col("l"), F.col("r")))
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    )
    def inner(n: int) -> DataFrame:
        """The phrases of n words inside each longer one."""
        firsts = F.sequence(F.lit(1), F.col("words") - n + 1)
        parts_of = F.transform(firsts, lambda i: words(i, F.lit(n)))
        return phrases.filter(F.col("words") > n).select("lang", "a", F.explode(parts_of).alias("phrase"))

    kept = scored
    if longest > 2:
        longer = reduce(DataFrame.union, [inner(n) for n in range(2, longest)]).groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
        kept = scored.join(longer, ["lang", "phrase"], "left").filter(
            F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * covered)
        )
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long"), "phrase", "a", "cut.l", "cut.r", F.col("all_words").alias("n"), "cut.score"
    )
