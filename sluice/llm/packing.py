"""Packing: documents in the order of a space-filling curve, cut into full sequences.

Token counts are hashed into a short vector, projected to three dimensions, and given a
Hilbert key; rows are range-sorted by that key, so neighbours in a sequence are alike.
The documents of a range run on one after the other and are cut every 1024 tokens.
What is left at the end of a range is cut into powers of two, which need no padding.

Copies share a Hilbert key, so ranges are cut by key and a hash of the id; a group of copies with a
third of all rows falls into many ranges.

Defined results: null and empty texts are one token, the separator; rows repeated with
their id are packed each on their own; an empty table gives no sequences.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import prepare, staged

SEQUENCE = 1024
SEPARATOR = 0
FEATURES = 256
DIMENSIONS = 3
LEVEL = 16
#: Tokens that one task packs, about.
TASK_TOKENS = 16 << 20
#: Letters up to which a text goes by remembered words.
SHORT_TEXT = 128
#: Words whose ids a worker remembers.
REMEMBERED = 400_000
#: Letters of the longest word that is remembered.
REMEMBERED_LETTERS = 64
#: Sequences that a range may make without their ids meeting another range's.
RANGE_SEQUENCES = 1 << 36

TOKENS = "doc_id long, doc_tokens long, curve long, ids binary"
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


#: How a byte-level pre-tokenizer cuts text (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@cache
def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: printable ones stand for themselves."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(others)}


def _bytes_of(token: str) -> bytes:
    letters = _byte_letters()
    return bytes(letters[c] for c in token)


class Encoder:
    """Token ids of the tokenizer file, by way of the ids of its words.

    Longer texts are encoded at once, where the order of the merges is that of their ids; that takes less time than
    to look up each word.  Shorter ones, and all texts of other vocabularies, go by remembered words:
    the pre-tokenizer of a byte-level BPE always cuts before a lone space between two
    other characters, so a text can be cut there and the ids of each part be remembered.
    Other texts, and those that hold a special token, go through the tokenizer whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.wide = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = re.compile("|".join([r" \s", *map(re.escape, special)]))
        self.special = special
        self.known: dict[str, bytes] = {}
        self.ranked = self._by_rank()
        self.ids = self.ranked.encode_ordinary if self.ranked else (lambda part: self.tokenizer.encode(part, add_special_tokens=False).ids)

    def _by_rank(self) -> tiktoken.Encoding | None:
        """A faster encoder of the same vocabulary, where the order of its merges is that of its ids."""
        from tokenizers.pre_tokenizers import ByteLevel

        spec = json.loads(self.tokenizer.to_str())
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        plain = not spec.get("normalizer") and before.get("type") == "ByteLevel" and not before.get("add_prefix_space")
        if not plain or model.get("type") != "BPE" or not before.get("use_regex", True):
            return None
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        alphabet = len(ByteLevel.alphabet())
        if any(model["vocab"].get(a + b) != alphabet + i for i, (a, b) in enumerate(merges)):
            return None
        ranks = {_bytes_of(token): i for token, i in model["vocab"].items() if i < alphabet + len(merges)}
        return tiktoken.Encoding("of file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def pack(self, ids: list[int]) -> bytes:
        return np.array(ids, self.wide).tobytes()

    def encode(self, text: str) -> bytes:
        if self.ranked and len(text) > SHORT_TEXT and not any(s in text for s in self.special):
            return self.ranked.encode_to_numpy(text, disallowed_special=()).astype(self.wide).tobytes()
        if self.whole.search(text):
            return self.pack(self.tokenizer.encode(text, add_special_tokens=False).ids)
        first, *others = text.split(" ")
        parts = [first] + [" " + other for other in others]
        known = self.known
        try:
            return b"".join([known[part] for part in parts])
        except KeyError:
            missing = list({part for part in parts if part not in known})
        if len(known) + len(missing) > REMEMBERED:
            known.clear()
            missing = list(set(parts))
        own = {part: self.pack(self.ids(part)) for part in missing}
        known.update((part, ids) for part, ids in own.items() if len(part) <= REMEMBERED_LETTERS)
        return b"".join([own[part] if part in own else known[part] for part in parts])


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each worker process and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _mixed(numbers: np.ndarray) -> np.ndarray:
    """A 64-bit mix of counters, the source of all fixed random numbers here."""
    with np.errstate(over="ignore"):
        x = numbers.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def projection() -> np.ndarray:
    """Random signs, FEATURES by DIMENSIONS."""
    signs = _mixed(np.arange(1, FEATURES * DIMENSIONS + 1)) & np.uint64(1)
    return (signs.astype(np.float64) * 2 - 1).reshape(FEATURES, DIMENSIONS)


def hilbert(points: np.ndarray, level: int = LEVEL) -> np.ndarray:
    """Hilbert keys of points with ``level`` bits a coordinate (Skilling's transform)."""
    x = [column.astype(np.int64) for column in points.T]
    n = len(x)
    bit = 1 << (level - 1)
    while bit > 1:
        low = bit - 1
        for i in range(n):
            set_here = (x[i] & bit) != 0
            swap = np.where(set_here, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(set_here, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
        bit >>= 1
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    gray = np.zeros_like(x[0])
    bit = 1 << (level - 1)
    while bit > 1:
        gray = np.where((x[n - 1] & bit) != 0, gray ^ (bit - 1), gray)
        bit >>= 1
    x = [column ^ gray for column in x]
    key = np.zeros_like(x[0])
    for b in range(level - 1, -1, -1):
        for column in x:
            key = (key << 1) | ((column >> b) & 1)
    return key


def curve_keys(counts: np.ndarray) -> np.ndarray:
    """Hilbert keys of hashed token counts, one row for each document."""
    vectors = np.log1p(counts.astype(np.float64))
    vectors /= np.maximum(np.sqrt((vectors**2).sum(1, keepdims=True)), 1e-9)
    flat = np.tanh(vectors @ projection())
    return hilbert(((flat + 1) / 2 * ((1 << LEVEL) - 1)).astype(np.int64))


def _tokenize(path: str):
    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path)
        ending = tool.pack([SEPARATOR])
        for batch in batches:
            ids = [tool.encode(text or "") + ending for text in batch.column(1).to_pylist()]
            held = [np.frombuffer(x, tool.wide) for x in ids]
            counts = np.stack([np.bincount(x & (FEATURES - 1), minlength=FEATURES) for x in held]) if held else np.zeros((0, FEATURES))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(x) for x in held], pa.int64()),
                    pa.array(curve_keys(counts)),
                    pa.array(ids, pa.binary()),
                ],
                names=["doc_id", "doc_tokens", "curve", "ids"],
            )

    return tokenize


def halves(tokens: int) -> list[int]:
    """``tokens`` as a sum of powers of two, the largest first."""
    return [1 << b for b in range(tokens.bit_length() - 1, -1, -1) if tokens >> b & 1]


class Packer:
    """Cuts documents, as they come, into sequences of one range."""

    def __init__(self, first_id: int, wide: str):
        self.sequence, self.wide, self.waiting, self.fill, self.rows = first_id, wide, [], 0, []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        tokens = np.frombuffer(ids, self.wide).astype("<u4")
        start = 0
        while start < len(tokens):
            length = min(SEQUENCE - self.fill, len(tokens) - start)
            self.waiting.append((doc_id, start, tokens[start : start + length], len(tokens)))
            self.fill += length
            start += length
            if self.fill == SEQUENCE:
                self.close([SEQUENCE])

    def close(self, sizes: list[int] | None = None) -> None:
        """Put what waits into sequences of ``sizes``, which add up to it."""
        sizes = list(halves(self.fill) if sizes is None else sizes)
        offset = 0
        for doc_id, start, tokens, of in self.waiting:
            done = 0
            while done < len(tokens):
                length = min(sizes[0] - offset, len(tokens) - done)
                crc = zlib.crc32(tokens[done : done + length].tobytes())
                self.rows.append((doc_id, start + done, length, crc, of, self.sequence, offset))
                done += length
                offset += length
                if offset == sizes[0]:
                    del sizes[0]
                    self.sequence += 1
                    offset = 0
        self.waiting, self.fill = [], 0

    def take(self) -> pa.RecordBatch:
        columns = zip(*self.rows) if self.rows else [[]] * 7
        names = [field.split()[0] for field in PIECES.split(", ")]
        batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)
        self.rows = []
        return batch


def _pack(wide: str):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(TaskContext.get().partitionId() * RANGE_SEQUENCES, wide)
        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                packer.add(doc_id, ids)
            yield packer.take()
        packer.close()
        yield packer.take()

    return pack


def pack_documents(
    spark: SparkSession,
    docs: DataFrame,
    tokenizer: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    task_tokens: int = TASK_TOKENS,
) -> DataFrame:
    """The pieces of all documents and where each lies."""
    prepare(spark)
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # Numbered, so that rows which are equal in all else are cut into ranges too.
    tokens = narrow.mapInArrow(_tokenize(tokenizer), TOKENS).withColumn("row_no", F.monotonically_increasing_id())
    tokens = staged(spark, tokens, "tokens")
    total = tokens.agg(F.sum("doc_tokens")).first()[0] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // task_tokens))
    order = ["curve", F.xxhash64("doc_id"), "doc_id", "doc_tokens"]
    ranged = tokens.repartitionByRange(ranges, *order, "row_no").sortWithinPartitions(*order, F.xxhash64("ids"), "row_no")
    return ranged.select("doc_id", "ids").mapInArrow(_pack(encoder(tokenizer).wide), PIECES)
