import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sluice.llm import packing as pk

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def check(rows, pieces, tokenizer):
    """Every id in exactly one piece, sequences gapless, whole or a power of two."""
    want = {}
    for i, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        want.setdefault(i, []).append(ids)
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert by_doc.keys() == want.keys()
    for i, lists in want.items():
        assert sum(p.length for p in by_doc[i]) == sum(map(len, lists))
        if len(lists) == 1:
            at = 0
            for p in sorted(by_doc[i], key=lambda p: p.start):
                assert (p.start, p.doc_tokens) == (at, len(lists[0])) and p.length > 0
                own = np.array(lists[0][at : at + p.length], "<u4")
                assert p.ids_crc32 == zlib.crc32(own.tobytes())
                at += p.length
            assert at == len(lists[0])
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 1024 and at & (at - 1) == 0


def test_given_documents(spark, documents, tokenizer):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    check(rows, pk.pack_documents(spark, documents, task_tokens=50_000).collect(), tokenizer)


def test_odd_texts(spark, make, prose, tokenizer):
    odd = ["", None, " ", "  ", "\n", " a", "a ", "a  b", "a \nb", "a\n b", "a\n\n b", "a\n \nb", "  x", "x 　y", "don't 12 34a",
           "<|endoftext|>", "a <|endoftext|> b", "É ñ 漢字 🙂 x", "a\r\nb", "\x1c x \x85 y", prose(1, 9000)]
    rows = list(enumerate(odd)) + [(500, "again"), (500, "again"), (None, "no id")]
    check(rows, pk.pack_documents(spark, make(rows)).collect(), tokenizer)
    assert pk.pack_documents(spark, make(rows).limit(0)).count() == 0


def test_encoder_forgets_and_stays_right(documents, tokenizer, monkeypatch):
    monkeypatch.setattr(pk, "REMEMBERED", 500)
    tool = pk.Encoder(PATH)
    for r in documents.limit(60).collect():
        assert np.frombuffer(tool.encode(r.text), tool.wide).tolist() == tokenizer.encode(r.text, add_special_tokens=False).ids


def test_long_words_are_not_remembered(tokenizer):
    tool = pk.Encoder(PATH)
    for text in ("a " + "long" * 5000 + " b " + "x" * 63, "x" * 65, " " + "y" * 64 + " end", ""):
        for _ in range(2):
            assert np.frombuffer(tool.encode(text), tool.wide).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert max(map(len, tool.known)) <= pk.REMEMBERED_LETTERS


def test_hilbert_curve_visits_every_cell_by_single_steps():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    keys = pk.hilbert(cells, 3)
    assert sorted(keys) == list(range(512))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_copies_are_spread_over_ranges(spark, make):
    rows = [(i, "same text for all of these rows") for i in range(400)]
    pieces = pk.pack_documents(spark, make(rows), task_tokens=500).collect()
    assert len({p.sequence_id // pk.RANGE_SEQUENCES for p in pieces}) > 3


def test_longer_texts_are_encoded_at_once(tokenizer):
    tool = pk.Encoder(PATH)
    long = "Some  words\n\n and\tmore, of it's 12,345 kinds é\U0001f600 " * 9
    for text in (long, long + "<|endoftext|>" + long, " " + long + "  ", "\n" + long + "\r\n"):
        assert np.frombuffer(tool.encode(text), tool.wide).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert not tool.known and tool.encode("few words") and tool.known
