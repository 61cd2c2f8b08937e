"""SimHash near-dedup: fingerprints that differ in few bits meet in the middle.

The radius is three bits.  Fingerprints are cut into three blocks, and each block in
turn is masked.  Two fingerprints that differ in one to three bits have a block
that holds some of these bits; with that block masked at most two are left, and
half of that is one.  So every fingerprint emits, for each block, its unmasked bits
and all their variants with one bit flipped (131 rows), and two fingerprints in reach meet
on a variant.  Without the masked block half the radius would be two bits and 2081 rows.

In a bucket (one block masked, one variant) fingerprints are linked without pairing
them off.  Two kinds of stars are exact and find every pair in reach:
* members with equal masked bits differ in two bits at most, and those whose masked bits
  differ in one bit in three at most: each member also stands at the masked values one bit
  away, and whoever is there is linked to one that stands there itself;
* three differing bits inside one block: members whose unmasked bits are the variant itself
  differ in masked bits only; they stand at the values up to two bits away and link to
  one that is there within one bit.
Each link is verified by counting the differing bits.  Equal fingerprints are one node
from the start, so copies cost nothing here.

Defined results: null text counts as empty; texts without words have fingerprint zero and
are linked like any other; null ids stay, and their component is the smallest id reachable
or null when there is none; repeated rows come out as often as they go in.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm.common import prepare, staged, text_key, texts_of

#: Bits (from, to) of the blocks that are masked in turn.
BLOCKS = ((0, 22), (22, 43), (43, 64))
RADIUS = 3
SHINGLE_WORDS = 3
SEED = 42
#: Fingerprints whose variants are made at a time.
CHUNK = 4096

ONE = np.uint64(1)


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """Bits set in over half the XXH64 hashes of the text's word shingles."""
    parts = text.lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    starts = np.concatenate(([0], ends[:-1])).tolist()
    last = (ends[min(words, len(parts)) - 1 :] - 1).tolist()
    hashed = xxhash.xxh64_intdigest
    hashes = np.fromiter((hashed(joined[a:b], SEED) for a, b in zip(starts, last)), np.uint64, len(last))
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):  # a bounded piece of a long text at a time
        piece = hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(piece, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view(np.uint64)[0])


def _prints(words: int):
    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, words) for t in texts_of(batch.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.view(np.int64)), *batch.columns[2:]],
                names=["doc_id", "fp", *batch.schema.names[2:]],
            )

    return prints


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long."""
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(_prints(words), "doc_id long, fp long")


def _mask(block: int) -> np.uint64:
    low, high = BLOCKS[block]
    return np.uint64(((1 << high) - 1) ^ ((1 << low) - 1))


def _bits(numbers) -> np.ndarray:
    return ONE << np.asarray(list(numbers), np.uint64)


def variants(fps: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each block: its number, the variants, and the fingerprint of each."""
    for block, (low, high) in enumerate(BLOCKS):
        flips = np.concatenate(([np.uint64(0)], _bits(b for b in range(64) if not low <= b < high)))
        yield block, ((fps & ~_mask(block))[:, None] ^ flips).ravel(), np.repeat(fps, len(flips))


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = np.asarray(batch.column(0)).view(np.uint64)
        for at in range(0, len(fps), CHUNK):
            for block, keys, owners in variants(fps[at : at + CHUNK]):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(keys), block, np.int8)),
                        pa.array(keys.view(np.int64)),
                        pa.array(owners.view(np.int64)),
                    ],
                    names=["block", "variant", "fp"],
                )


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def stars(place: np.ndarray, value: np.ndarray, fp: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Link all that share a place and value to one of them that is near there."""
    if not len(fp):
        return fp, fp
    order = np.lexsort((fp, ~near, value, place))
    place, value, fp, near = place[order], value[order], fp[order], near[order]
    first = np.concatenate(([True], (place[1:] != place[:-1]) | (value[1:] != value[:-1])))
    hub = np.flatnonzero(first)[np.cumsum(first) - 1]
    linked = near[hub] & (fp != fp[hub])
    return fp[linked], fp[hub][linked]


def links(block: np.ndarray, variant: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Verified links among the members of whole buckets, rows sorted by bucket."""
    if not len(fp):
        return fp, fp
    new = np.concatenate(([True], (block[1:] != block[:-1]) | (variant[1:] != variant[:-1])))
    bucket = np.cumsum(new) - 1
    shared = np.bincount(bucket)[bucket] > 1
    block, variant, fp, bucket = block[shared], variant[shared], fp[shared], bucket[shared]
    found = []
    for b, (low, high) in enumerate(BLOCKS):
        here = block == b
        mask, ones = _mask(b), np.concatenate(([np.uint64(0)], _bits(range(low, high))))
        # Members stand at their own masked value, and one bit away from it.
        at, who = bucket[here], fp[here]
        steps = len(ones)
        found.append(
            stars(
                np.repeat(at, steps),
                ((who & mask)[:, None] ^ ones).ravel(),
                np.repeat(who, steps),
                np.tile(np.arange(steps) == 0, len(who)),
            )
        )
        # Those with the variant's own bits can differ in three masked bits.
        same = (who & ~mask) == variant[here]
        at, who = at[same], who[same]
        several = np.bincount(at, minlength=1)[at] > 1
        at, who = at[several], who[several]
        pairs = _bits(range(low, high))
        twos = (pairs[:, None] ^ pairs)[np.triu_indices(len(pairs), 1)]
        flips = np.concatenate((ones, twos))
        found.append(
            stars(
                np.repeat(at, len(flips)),
                ((who & mask)[:, None] ^ flips).ravel(),
                np.repeat(who, len(flips)),
                np.tile(np.arange(len(flips)) < len(ones), len(who)),
            )
        )
    a, b = (np.concatenate(x) for x in zip(*found))
    true = differing(a, b) <= RADIUS
    return a[true], b[true]


def _link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links from rows sorted by bucket; the last bucket of a batch waits for the next."""
    rest: tuple[np.ndarray, ...] | None = None

    def out(block, variant, fp):
        a, b = links(block, variant, fp)
        pairs = np.unique(np.stack((np.minimum(a, b), np.maximum(a, b)), 1), axis=0)
        for at in range(0, len(pairs), 1 << 16):
            part = pairs[at : at + (1 << 16)].view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(part[:, 0].copy()), pa.array(part[:, 1].copy())], names=["a", "b"])

    for batch in batches:
        rows = (
            np.asarray(batch.column(0)),
            np.asarray(batch.column(1)).view(np.uint64),
            np.asarray(batch.column(2)).view(np.uint64),
        )
        if rest is not None:
            rows = tuple(np.concatenate(x) for x in zip(rest, rows))
        block, variant, _ = rows
        if not len(block):
            continue
        ends = np.flatnonzero((block[1:] != block[:-1]) | (variant[1:] != variant[:-1]))
        cut = ends[-1] + 1 if len(ends) else 0
        rest = tuple(x[cut:] for x in rows)
        if cut:
            yield from out(*(x[:cut] for x in rows))
    if rest is not None:
        yield from out(*rest)


def near_links(fps: DataFrame) -> DataFrame:
    """Links a, b between different fingerprints, enough to connect all in reach."""
    met = fps.select("fp").mapInArrow(_emit, "block byte, variant long, fp long")
    dealt = met.repartition("variant", "block").sortWithinPartitions("block", "variant")
    return dealt.mapInArrow(_link, "a long, b long").distinct()


def connected(spark: SparkSession, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """fp and low: the smallest ``low`` reachable, for the nodes that have an edge.

    Every round takes the smallest root among the neighbours and then the root of that
    root, until nothing changes.  Rows are joined and summed, never gathered by node.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = staged(spark, both, "edges")
    linked = both.select(F.col("a").alias("fp")).distinct()
    labels = nodes.join(linked, "fp").select("fp", F.struct("low", "fp").alias("root"))
    labels = staged(spark, labels, "labels")
    while True:
        best = (
            both.join(labels.select(F.col("fp").alias("b"), "root"), "b")
            .groupBy(F.col("a").alias("fp"))
            .agg(F.min("root").alias("best"))
        )
        hop = labels.join(best, "fp").select("fp", F.col("root").alias("old"), F.least("root", "best").alias("root"))
        above = hop.select(F.col("fp").alias("up"), F.col("root").alias("top"))
        jumped = hop.join(above, F.col("root.fp") == F.col("up")).select(
            "fp", F.least("root", "top").alias("root"), (F.least("root", "top") != F.col("old")).alias("moved")
        )
        labels = staged(spark, jumped, "labels")
        if not labels.filter("moved").limit(1).count():
            return labels.select("fp", F.col("root.low").alias("low"))


#: Stands for no id while components are found; larger than any id.
NO_ID = (1 << 63) - 1


def near_dedup(
    spark: SparkSession,
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = SHINGLE_WORDS,
) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id for every row."""
    prepare(spark)
    prints = staged(spark, fingerprints(docs, id_col, text_col, words), "prints")
    nodes = prints.groupBy("fp").agg(F.coalesce(F.min("doc_id"), F.lit(NO_ID)).alias("low"))
    nodes = staged(spark, nodes, "nodes")
    rooted = connected(spark, nodes, staged(spark, near_links(nodes), "links"))
    roots = nodes.join(rooted.withColumnRenamed("low", "root"), "fp", "left").select(
        "fp", F.coalesce("root", "low").alias("component_id")
    )
    roots = staged(spark, roots, "roots")
    return prints.join(roots, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.nullif("component_id", F.lit(NO_ID)).alias("component_id"),
    )


#: Near copies of the stage: shingles of so many words, and the share of the words of each of two texts that must
#: stand in shingles which the other has too.
SIMILAR_WORDS = 5
COVERED = 0.8
#: A band is so many smallest hashes.  Texts that share 0.4 of all their shingles miss each other in all bands once in
#: 20 pairs, at 0.5 once in 400.  Pairs that agree in fewer smallest hashes than this share are not looked at further.
BANDS, BAND_ROWS = 45, 3
AGREED = 0.2
#: Members up to which all of a bucket are paired at once; larger ones go by rounds.
PAIRED = 16
#: Pairs that a bucket may compare in a round before its members are taken a few at a time.
ROUND_PAIRS = 1 << 21
#: Members of a large bucket are compared in blocks of about so many bytes of marks; so many members go to a task.
BLOCK_BYTES, TASK_MEMBERS = 1 << 14, 4096

LETTERS = re.compile(r"[^\W_]+")
_draws = np.random.default_rng(SEED).integers(0, 1 << 63, (2, BANDS * BAND_ROWS), np.uint64)
_XORS, _FACTORS = _draws[0], _draws[1] | ONE


def similar_shingles(text: bytes) -> np.ndarray:
    """Hashes of the shingles of runs of letters and digits, in order; a shorter text is one shingle."""
    parts = [w.encode() for w in LETTERS.findall(text.decode("utf-8", "replace").lower())]
    n = max(1, len(parts) - SIMILAR_WORDS + 1) if parts else 0
    hashed = xxhash.xxh64_intdigest
    return np.fromiter((hashed(b" ".join(parts[i : i + SIMILAR_WORDS]), SEED) for i in range(n)), np.uint64, n)


def covered(own: np.ndarray, other: np.ndarray) -> float:
    """Share of the words of a text that stand in a shingle which the other has too; shingles in order."""
    if not len(own) or not len(other):
        return 0.0
    shared = np.isin(own, other)
    if len(own) == 1:  # one shingle, of five words or fewer
        return float(shared[0])
    words = np.zeros(len(own) + SIMILAR_WORDS - 1, bool)
    for k in range(SIMILAR_WORDS):
        words[k : k + len(own)] |= shared
    return float(words.mean())


def smallest(shingles: np.ndarray) -> np.ndarray:
    """The smallest hash of a text's shingles under each draw."""
    low = np.full(BANDS * BAND_ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 512):
        low = np.minimum(low, ((shingles[at : at + 512, None] ^ _XORS) * _FACTORS).min(axis=0))
    return low


def bands(low: np.ndarray) -> list[int]:
    """One number for each band of smallest hashes."""
    return [xxhash.xxh64_intdigest(row.tobytes(), seed=i) for i, row in enumerate(low.reshape(BANDS, BAND_ROWS))]


SKETCHES = "doc_id long, own binary, fp long, sketch binary, bands array<long>"


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fingerprint, sketch and bands of each text; no sketch where there are no words.  Columns doc_id, text_key, text."""
    for batch in batches:
        fps, sketches, found, ends = [], [], [], [0]
        for text in texts_of(batch.column(2)):
            fps.append(fingerprint(text))
            shingles = similar_shingles(text)
            if len(shingles):
                low = smallest(shingles)
                found += bands(low)
            # Eight bits of each smallest hash do to tell strangers.
            sketches.append((low >> np.uint64(56)).astype(np.uint8).tobytes() if len(shingles) else None)
            ends.append(len(found))
        flat = pa.array(np.array(found, np.uint64).view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(np.array(fps, np.uint64).view(np.int64)),
                pa.array(sketches, pa.binary()),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat),
            ],
            names=["doc_id", "own", "fp", "sketch", "bands"],
        )


def _promising(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        one, two = (np.frombuffer(b"".join(c.to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in batch.columns[4:6])
        yield batch.select([0, 1, 2, 3]).filter(pa.array((one == two).mean(1) >= AGREED))


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = pa.array([similar_shingles(t).tobytes() for t in texts_of(batch.column(1))], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), rows], names=["own", "shingles"])


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sixteen bits of each shingle, in order.  Columns own, shingles."""
    for batch in batches:
        sets = (np.frombuffer(v.as_buffer(), np.uint64) for v in batch.column(1))
        marks = [(s >> np.uint64(48)).astype("<u2").tobytes() for s in sets]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks, pa.binary())], names=["own", "mark"])


def coverable(ones: list[np.ndarray], twos: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """Places of pairs whose marks cover each other.  Equal shingles have equal marks, so no true pair is missed."""
    if not twos:
        return
    pad, sizes = SIMILAR_WORDS - 1, np.array([len(y) for y in twos])
    marks, words = np.concatenate(twos), sizes + pad
    starts = np.cumsum(words) - words
    at = np.arange(len(marks)) + pad * np.repeat(np.arange(len(twos)), sizes)
    table, enough = np.zeros(1 << 16, bool), COVERED - 1e-9
    for i, x in enumerate(ones):
        table[x] = True
        shared = np.zeros(words.sum(), bool)
        shared[at] = table[marks]
        table[x] = False
        held = shared.copy()
        for k in range(1, SIMILAR_WORDS):
            held[k:] |= shared[:-k]
        share = np.add.reduceat(held, starts, dtype=np.int64) / words
        yield from ((i, j) for j in np.flatnonzero(share >= enough).tolist() if covered(x, twos[j]) >= enough)


def _coverable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs own < other out of blocks of members.  Columns one, two."""
    for batch in batches:
        own, other = [], []
        for one, two in zip(batch.column(0), batch.column(1)):
            one, two = one.as_py(), two.as_py()
            sides = ([np.frombuffer(m["mark"], "<u2") for m in side] for side in (one, two))
            for i, j in coverable(*sides):
                a, b = one[i]["own"], two[j]["own"]
                if a != b:
                    own.append(min(a, b))
                    other.append(max(a, b))
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.binary()), pa.array(other, pa.binary())], names=["own", "other"])


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        true = []
        for one, two in zip(batch.column(2), batch.column(3)):
            x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (one, two))
            true.append(covered(x, y) >= COVERED and covered(y, x) >= COVERED)
        yield batch.select(["a", "b"]).filter(pa.array(true, pa.bool_()))


def verified(spark: SparkSession, texts: DataFrame, sketches: DataFrame, pairs: DataFrame) -> DataFrame:
    """Links a, b between fingerprints of the pairs own, other of texts that cover each other.

    Only pairs that agree in enough of their sketches have their texts read.
    """
    one = sketches.select("own", F.col("fp").alias("a"), F.col("sketch").alias("x"))
    two = sketches.select(F.col("own").alias("other"), F.col("fp").alias("b"), F.col("sketch").alias("y"))
    met = pairs.distinct().join(one, "own").join(two, "other").filter("a <> b").select("own", "other", "a", "b", "x", "y")
    near = staged(spark, met.mapInArrow(_promising, "own binary, other binary, a long, b long"), "promising")
    needed = near.select("own").union(near.select("other")).distinct().withColumnRenamed("own", "needed")
    chosen = texts.join(needed, F.col("text_key") == F.col("needed"), "left_semi").select("text_key", "text")
    sets = staged(spark, chosen.mapInArrow(_shingled, "own binary, shingles binary").dropDuplicates(["own"]), "sets")
    own = sets.select("own", F.col("shingles").alias("x"))
    other = sets.select(F.col("own").alias("other"), F.col("shingles").alias("y"))
    both = near.join(own, "own").join(other, "other").select("a", "b", "x", "y")
    return staged(spark, both.mapInArrow(_similar, "a long, b long").distinct(), "similar")


def crossing(many: DataFrame, rooted: DataFrame, tried: DataFrame | None) -> DataFrame:
    """For large buckets whose members are in several components: members that are to be compared with all others.

    A bucket's largest component needs no turn of its own: each pair across components has a member outside of it.
    Members that had their turn in a bucket are not taken again.
    """
    alone = F.struct(F.col("fp").alias("doc_id"), F.lit(None).cast("binary").alias("text_key"))
    comp = F.coalesce("low", alone)
    placed = many.join(rooted, "fp", "left").select("band", "n", "own", comp.alias("comp"))
    sizes = placed.groupBy("band", "comp").agg(F.count("*").alias("size"))
    main = sizes.groupBy("band").agg(F.max(F.struct("size", "comp")).alias("main"), F.count("*").alias("comps"))
    outside = placed.join(main.filter("comps > 1"), "band").filter(F.col("comp") != F.col("main.comp"))
    if tried is not None:
        outside = outside.join(tried, ["band", "own"], "left_anti")
    return outside.select("band", "n", "own")


def _different(column: pa.Array) -> list[np.ndarray]:
    return [np.unique(np.frombuffer(v.as_buffer(), np.int64)) for v in column]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts of a batch each shingle stands.  Column shingles."""
    for batch in batches:
        if batch.num_rows:
            found, texts = np.unique(np.concatenate(_different(batch.column(0))), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(texts.astype(np.int64))], names=["shingle", "texts"])


def _each_shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different shingles of each text.  Columns own, shingles."""
    for batch in batches:
        if batch.num_rows:
            sets = _different(batch.column(1))
            own = batch.column(0).take(pa.array(np.repeat(np.arange(len(sets)), [len(s) for s in sets])))
            yield pa.RecordBatch.from_arrays([own, pa.array(np.concatenate(sets))], names=["own", "shingle"])


def _partnered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members whose words stand, as far as COVERED asks, in shingles that others have.  Columns own, shingles, common."""
    for batch in batches:
        true = []
        for own, common in zip(batch.column(1), batch.column(2)):
            common = np.array(common.values, np.int64).view(np.uint64)
            true.append(covered(np.frombuffer(own.as_buffer(), np.uint64), common) >= COVERED)
        yield batch.select(["own"]).filter(pa.array(true, pa.bool_()))


def partnered(asked: DataFrame, sets: DataFrame) -> DataFrame:
    """own: those of ``asked`` that can have a partner among ``sets`` (own, shingles).

    What another text covers of a text stands in shingles that the two share, so a text of which too little stands in
    shingles that any others have links with none.  Strangers that share a passage only go here, at the cost of their
    own length.
    """
    counts = sets.select("shingles").mapInArrow(_counted, "shingle long, texts long")
    common = counts.groupBy("shingle").agg(F.sum("texts").alias("texts")).filter("texts > 1").select("shingle")
    mine = sets.join(asked.select("own").distinct(), "own", "left_semi").select("own", "shingles")
    held = mine.mapInArrow(_each_shingle, "own binary, shingle long").join(common, "shingle")
    held = held.groupBy("own").agg(F.collect_list("shingle").alias("common"))
    return mine.join(held, "own").select("own", "shingles", "common").mapInArrow(_partnered, "own binary")


def compared(turns: DataFrame, many: DataFrame) -> DataFrame:
    """Pairs own, other of the members that have their turn with all of their bucket, as far as marks do not rule them out.

    Blocks meet and not members, so a bucket's rows grow with the square of its bytes over that of a block's.
    """
    row = F.collect_list(F.struct("own", "mark"))
    blocks = F.ceil(F.sum(F.length("mark")) / BLOCK_BYTES).alias("blocks")
    mine = turns.select("band", "own").join(many.select("band", "own", "mark"), ["band", "own"])
    dealt = mine.join(mine.groupBy("band").agg(blocks), "band").withColumn("block", F.pmod(F.xxhash64("own"), "blocks"))
    one = dealt.groupBy("band", "block").agg(row.alias("one"))
    held = many.select("band", "own", "mark").join(turns.select("band").distinct(), "band")
    sizes = held.groupBy("band").agg(F.ceil(F.count("*") / TASK_MEMBERS).alias("parts"), blocks)
    part, block = F.pmod(F.xxhash64("own"), "parts"), F.pmod(F.xxhash64("own", "band"), F.ceil(F.col("blocks") / F.col("parts")))
    spread = held.join(sizes, "band").select("band", "own", "mark", part.alias("part"), block.alias("block"))
    two = spread.repartition("band", "part").groupBy("band", "part", "block").agg(row.alias("two"))
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")
    met = one.join(sizes, "band").select("band", part, "one").join(two, ["band", "part"])
    return met.select("one", "two").mapInArrow(_coverable, "own binary, other binary")


def similar_roots(
    spark: SparkSession, texts: DataFrame, sketched: DataFrame, nodes: DataFrame, edges: DataFrame
) -> DataFrame:
    """As ``connected``, by ``edges`` and links between fingerprints of texts (text_key, text) that cover each other.

    Small buckets are paired off.  In larger ones each member is compared with the one that stands in most large buckets,
    so that a group of near copies meets the same few texts in all of its buckets.  Then, where the members of a bucket
    stand in several components, those outside the largest one that can have a partner at all are compared with all
    members.  A bucket is through when all of these had their turn; one with very many takes several rounds.  So no link
    that would join two components is passed over, and a large group of near copies, which is one component after
    the first step, is not paired off.
    """
    sketches = sketched.filter("sketch is not null").select("own", "fp", "sketch", "bands").dropDuplicates(["own"])
    sketches = staged(spark, sketches, "sketches")
    met = sketches.select(F.explode("bands").alias("band"), "own", "fp")
    sizes = met.groupBy("band").agg(F.count("*").alias("n"))
    shared = staged(spark, met.join(sizes.filter("n > 1"), "band"), "shared")
    few = shared.filter(F.col("n") <= PAIRED).select("band", "own")
    pairs = few.join(few.withColumnRenamed("own", "other"), "band").filter("own < other").select("own", "other")
    many = shared.filter(F.col("n") > PAIRED).withColumn("stands", F.count("*").over(Window.partitionBy("own")))
    hubs = many.groupBy("band").agg(F.max(F.struct("stands", "own")).alias("hub"))
    many = staged(spark, many.join(hubs, "band").select("band", "n", "own", "fp", F.col("hub.own").alias("hub")), "many")
    ends = F.least("own", "hub").alias("own"), F.greatest("own", "hub").alias("other")
    pairs = pairs.union(many.filter("own <> hub").select(*ends))
    edges = staged(spark, edges.union(verified(spark, texts, sketches, pairs)).distinct(), "links")
    rooted, tried, sets = connected(spark, nodes, edges), None, None
    while many.limit(1).count():
        outside = staged(spark, crossing(many, rooted, tried), "outside")
        if not outside.limit(1).count():
            return rooted
        many = staged(spark, many.join(outside.select("band").distinct(), "band", "left_semi"), "open")
        if sets is None:
            needed = many.select(F.col("own").alias("needed")).distinct()
            chosen = texts.join(needed, F.col("text_key") == F.col("needed"), "left_semi").select("text_key", "text")
            sets = staged(spark, chosen.mapInArrow(_shingled, "own binary, shingles binary").dropDuplicates(["own"]), "members")
        able = staged(spark, partnered(outside, sets), "partnered")
        turn = F.row_number().over(Window.partitionBy("band").orderBy("own"))
        due = F.col("turn") <= F.greatest(F.lit(1), F.lit(ROUND_PAIRS) / F.col("n"))
        turns = outside.join(able, "own", "left_semi").withColumn("turn", turn).select("band", "own", due.alias("due"))
        turns = staged(spark, turns, "turns")
        now = turns.filter("due").select("band", "own")
        met = many.join(now.select("band").distinct(), "band", "left_semi").select("band", "own")
        held = staged(spark, met.join(sets.mapInArrow(_marked, "own binary, mark binary"), "own"), "held")
        pairs = compared(now, held)
        edges = staged(spark, edges.union(verified(spark, texts, sketches, pairs)).distinct(), "links")
        rooted = connected(spark, nodes, edges)
        many = staged(spark, many.join(turns.filter("not due").select("band").distinct(), "band", "left_semi"), "many")
        tried = staged(spark, now if tried is None else tried.union(now), "tried")
    return rooted


def keep_first_rows(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component stays: the one with the smallest id, no id last, and then text key.

    Linked are fingerprints in reach, and texts of which enough words stand in shingles of five words that both have.

    Each row has its own decision, also where an id is null or stands on several texts.
    """
    prepare(spark)
    own_id = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))
    narrow = docs.select(own_id.alias("doc_id"), F.col(text_col).alias("text"), text_key(F.col(text_col)).alias("text_key"))
    sketched = staged(spark, narrow.select("doc_id", "text_key", "text").mapInArrow(_sketched, SKETCHES), "sketched")
    prints = sketched.select("doc_id", "fp", F.col("own").alias("text_key"))
    nodes = staged(spark, prints.groupBy("fp").agg(F.min(F.struct("doc_id", "text_key")).alias("low")), "nodes")
    rooted = similar_roots(spark, narrow.select("text_key", "text"), sketched, nodes, near_links(nodes))
    roots = nodes.join(rooted.withColumnRenamed("low", "root"), "fp", "left").select("fp", F.coalesce("root", "low").alias("root"))
    later = prints.join(staged(spark, roots, "roots"), "fp").filter(F.struct("doc_id", "text_key") != F.col("root"))
    gone = later.select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key")).distinct()
    gone = staged(spark, gone, "gone")
    # The row stands in a struct, so that its columns may have any names.
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    held = docs.select(own_id.alias("one_id"), text_key(F.col(text_col)).alias("one_key"), row)
    own = (F.col("one_id") == F.col("gone_id")) & (F.col("one_key") == F.col("gone_key"))
    kept = held.join(gone, own, "left_anti")
    if prints.groupBy("doc_id", "text_key").agg(F.count("*").alias("n")).filter("n > 1").limit(1).count():
        kept = kept.groupBy("one_id", "one_key").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return kept.select("row.*")
