"""Exact dedup: owners of equal texts, found in compressed radix tries.

Texts are equal when they are equal without ASCII white space.  Every task first
folds its own rows in a trie, so a text with a third of all rows leaves each task
once.  What is left is dealt by length and content hash, sorted by both, and put
into tries again; a terminal node holds the best row seen.  In that order a text
whose length and hash have been passed cannot come again, so a trie that grows
over its budget gives out whole finished subtrees and drops them.

Defined results: null text counts as empty, so null, empty and blank texts are one
group; a null id loses to any other; rows repeated with id and text are separate
rows of one group, of which one is kept; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import prepare, staged, texts_of

BLANKS = b" \t\n\x0b\x0c\r"
#: Bytes of edge labels a trie may hold before it gives out finished subtrees.
TRIE_BYTES = 64 << 20
#: Bytes of texts in one outgoing batch.
OUT_BYTES = 16 << 20

DIGESTS = "doc_id long, points long, text_sha256 binary"
PARTIAL = "length long, hash long, text binary, points long, doc_id long, copies long, rows long"
OWNERS = "text_sha256 binary, points long, keep_id long, copies long, group_size long"


class Owner:
    """What a terminal node holds: the best row so far, how often it occurs, all rows."""

    __slots__ = ("points", "doc_id", "copies", "rows", "run")

    def __init__(self, points: int, doc_id: int | None, copies: int, rows: int, run: tuple):
        self.points, self.doc_id, self.copies, self.rows, self.run = points, doc_id, copies, rows, run

    def rank(self) -> tuple:
        return (-self.points, self.doc_id is None, self.doc_id or 0)

    def add(self, other: Owner) -> None:
        mine, its = self.rank(), other.rank()
        if its == mine:
            self.copies += other.copies
        elif its < mine:
            self.points, self.doc_id, self.copies = other.points, other.doc_id, other.copies
        self.rows += other.rows


class Node:
    __slots__ = ("label", "kids", "owner")

    def __init__(self, label: bytes, owner: Owner | None = None):
        self.label, self.kids, self.owner = label, {}, owner


def shared_prefix(label: bytes, key: bytes, at: int) -> int:
    """Bytes that ``label`` and ``key`` from ``at`` have in common, by halving."""
    low, high = 0, min(len(label), len(key) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if key.startswith(label[low:middle], at + low):
            low = middle
        else:
            high = middle - 1
    return low


#: What a node takes beside its label, about.
NODE_BYTES = 200


class PatriciaTrie:
    """A compressed radix trie over byte strings; ``size`` is the bytes of its labels and nodes."""

    def __init__(self) -> None:
        self.root, self.size = Node(b""), 0

    def insert(self, key: bytes, owner: Owner) -> None:
        node, at = self.root, 0
        while at < len(key):
            child = node.kids.get(key[at])
            if child is None:
                child = node.kids[key[at]] = Node(key[at:])
                self.size += len(child.label) + NODE_BYTES
                at = len(key)
            elif key.startswith(child.label, at):
                at += len(child.label)
            else:
                n = shared_prefix(child.label, key, at)
                upper = Node(child.label[:n])
                child.label = child.label[n:]
                self.size += NODE_BYTES
                upper.kids[child.label[0]] = child
                node.kids[key[at]] = child = upper
                at += n
            node = child
        if node.owner is None:
            node.owner = owner
        else:
            node.owner.add(owner)

    def drain(self, but: tuple | None = None) -> Iterator[tuple[bytes, Owner]]:
        """Give out and drop the subtrees under the root that hold no text of run ``but``."""
        for first, child in [*self.root.kids.items()]:
            found, stack, stays, held = [], [(b"", child)], False, 0
            while stack:
                above, node = stack.pop()
                path = above + node.label
                held += len(node.label) + NODE_BYTES
                if node.owner is not None:
                    found.append((path, node.owner))
                    stays |= node.owner.run == but
                stack.extend((path, kid) for kid in node.kids.values())
            if not stays:
                del self.root.kids[first]
                self.size -= held
                yield from found
        if self.root.owner is not None and self.root.owner.run != but:
            yield b"", self.root.owner
            self.root.owner = None
        if not self.root.kids:
            self.size = 0


def _normal(text: bytes) -> bytes:
    return text.translate(None, BLANKS)


def _points(text: bytes) -> int:
    return len(text.decode("utf-8", "replace"))


def _fold(trie_bytes: int) -> Callable:
    """Fold the rows of one task; ``length`` and ``hash`` say where a text goes."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, schema = PatriciaTrie(), None

        def out(found: Iterator[tuple[bytes, Owner]]) -> Iterator[pa.RecordBatch]:
            rows, size = [], 0
            for text, o in found:
                rows.append((len(text), zlib.crc32(text), text, o.points, o.doc_id, o.copies, o.rows))
                size += len(text)
                if size >= OUT_BYTES:
                    yield _batch(rows, PARTIAL_ARROW)
                    rows, size = [], 0
            if rows:
                yield _batch(rows, PARTIAL_ARROW)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                trie.insert(_normal(text), Owner(_points(text), doc_id, 1, 1, ()))
                if trie.size > trie_bytes:
                    yield from out(trie.drain())
        yield from out(trie.drain())

    return fold


def _own(trie_bytes: int) -> Callable:
    """Owners from partial ones that arrive sorted by length and hash."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = PatriciaTrie()

        def out(found: Iterator[tuple[bytes, Owner]]) -> Iterator[pa.RecordBatch]:
            rows = [
                (hashlib.sha256(text).digest(), o.points, o.doc_id, o.copies, o.rows)
                for text, o in found
            ]
            if rows:
                yield _batch(rows, OWNERS_ARROW)

        for batch in batches:
            columns = [batch.column(i) for i in (0, 1, 3, 4, 5, 6)]
            for text, *row in zip(texts_of(batch.column(2)), *(c.to_pylist() for c in columns)):
                length, hashed, points, doc_id, copies, rows = row
                run = (length, hashed)
                trie.insert(text, Owner(points, doc_id, copies, rows, run))
                if trie.size > trie_bytes:
                    yield from out(trie.drain(but=run))
        yield from out(trie.drain())

    return own


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        points, shas = [], []
        for text in texts_of(batch.column(1)):
            points.append(_points(text))
            shas.append(hashlib.sha256(_normal(text)).digest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(points, pa.int64()), pa.array(shas, pa.binary())],
            names=["doc_id", "points", "text_sha256"],
        )


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in ddl.split(", "))])


PARTIAL_ARROW, OWNERS_ARROW = _schema(PARTIAL), _schema(OWNERS)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(values, field.type) for values, field in zip(zip(*rows), schema)], schema=schema
    )


def _narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def owners(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """One row per different text: its digest, the row that stays, and the rows it stands for."""
    folded = _narrow(docs, id_col, text_col).mapInArrow(_fold(trie_bytes), PARTIAL)
    dealt = folded.repartition("length", "hash").sortWithinPartitions("length", "hash")
    return dealt.mapInArrow(_own(trie_bytes), OWNERS)


def exact_dedup(
    spark: SparkSession,
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    trie_bytes: int = TRIE_BYTES,
) -> DataFrame:
    """A decision for every row: doc_id, keep_id, group_size, kept, text_sha256."""
    prepare(spark)
    own = staged(spark, owners(docs, id_col, text_col, trie_bytes), "owners")
    digests = _narrow(docs, id_col, text_col).mapInArrow(_digest, DIGESTS)
    digests = staged(spark, digests.withColumn("row_no", F.monotonically_increasing_id()), "digests")
    joined = digests.join(own.select("text_sha256", "keep_id", "group_size"), "text_sha256")
    # Rows repeated with their id are told apart by their number, the longest text first.  Summed before the
    # shuffle, so that any number of equal rows, with or without an id, is one row a task.
    one = F.min(F.struct((-F.col("points")).alias("back"), "row_no")).alias("one")
    several = digests.groupBy(F.col("doc_id").alias("same_id"), F.col("text_sha256").alias("same_text")).agg(one, F.count("*").alias("n"))
    several = several.filter("n > 1").select("same_id", "same_text", F.col("one.row_no").alias("one_no"))
    same = F.col("doc_id").eqNullSafe(F.col("same_id")) & (F.col("text_sha256") == F.col("same_text"))
    first = F.col("one_no").isNull() | (F.col("one_no") == F.col("row_no"))
    return joined.join(several, same, "left").select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & first).alias("kept"),
        F.lower(F.hex("text_sha256")).alias("text_sha256"),
    )


def keep_owners(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    prepare(spark)
    own = staged(spark, owners(docs, id_col, text_col), "owners")
    row = F.struct("*")
    rows = docs.select(row.alias("row"))
    with_id = rows.select(
        "row",
        F.col("row").getField(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col("row").getField(text_col), F.lit("")).alias("text"),
    )
    # An id can occur with several texts, so both id and digest say which row it is.
    keyed = with_id.withColumn("text_sha256", F.unhex(F.sha2(F.regexp_replace("text", r"[ \t-\r]+", ""), 256)))
    winners = own.select(
        "text_sha256", F.col("keep_id").alias("doc_id"), F.col("points").alias("most"), "copies"
    )
    same = keyed["doc_id"].eqNullSafe(winners["doc_id"]) & (keyed["text_sha256"] == winners["text_sha256"])
    kept = keyed.join(winners, same & (F.char_length(keyed["text"]) == winners["most"])).drop("text")
    if own.filter("copies > 1").limit(1).count():
        held = kept.select(keyed["doc_id"].alias("one_id"), keyed["text_sha256"].alias("one_text"), "row")
        kept = held.groupBy("one_id", "one_text").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return kept.select("row.*")
