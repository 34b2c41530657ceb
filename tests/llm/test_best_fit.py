"""Bounded-space best fit: whole token streams come back, bins keep their bounds, little space is left."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tarnlake.llm import best_fit
from tarnlake.llm.byte_tokens import ByteTokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


ODD = [
    "a  b\n\n c\t\td", "it's we'll 'tis x''s 'LL", " ½ a² \x85 b c 漢字 é", "a <|endoftext|> b", "", " ", "tail  ",
    "\x1c\x1d a \x0b\x0c b", "Ñandú×3÷4 ªº µ", "don't 12th a1b2 $$$ 5% \r\n x", "  two leading", "a\n", "a \n b", "<|endof text|>",
    "é combining", "nbsp  here", "line sep", "😀 😀😀", "x" * 5000, "\x00\x01 nul", "\n\n\n", "a.  b,  c",
]


def test_ids_are_the_tokenizers(tokenizer):
    store = ByteTokens(PATH)
    for texts in (ODD, ODD[::-1], [t * 3 for t in ODD], [], [""]):
        counts, ids = store.encode(texts)
        wanted = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert counts.tolist() == [len(w) for w in wanted]
        assert ids.tolist() == sum(wanted, [])


def test_small_store_changes_no_result(tokenizer, spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()]
    store = ByteTokens(PATH, limit=50)
    for at in range(0, 60, 5):
        counts, ids = store.encode(texts[at:at + 5])
        wanted = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts[at:at + 5]]
        assert counts.tolist() == [len(w) for w in wanted] and ids.tolist() == sum(wanted, [])


def plain_best_fit(lengths, capacity, most):
    """Best fit with a list of open bins."""
    opened, closed = [], []
    for item, length in enumerate(lengths):
        fitting = [b for b in opened if b[0] >= length]
        if fitting:
            chosen = min(fitting, key=lambda b: b[0])
            opened.remove(chosen)
        else:
            chosen = (capacity, ())
        chosen = (chosen[0] - length, (*chosen[1], item))
        if chosen[0] == 0:
            closed.append(chosen)
            continue
        if len(opened) == most:
            fullest = min(opened, key=lambda b: b[0])
            opened.remove(fullest)
            closed.append(fullest)
        opened.append(chosen)
    return [free for free, _ in closed], [free for free, _ in opened]


@pytest.mark.parametrize("most", [1, 3, 50])
def test_bins_are_those_of_plain_best_fit(most):
    lengths = np.random.default_rng(most).integers(1, 65, 400).tolist()
    bins, closed = best_fit.OpenBins(64, most), []
    for item, length in enumerate(lengths):
        if contents := bins.add(length, item):
            closed.append(contents)
        assert bins.open <= most
    frees = [64 - sum(lengths[i] for i in c) for c in closed]
    rest = list(bins.rest())
    wanted_closed, wanted_open = plain_best_fit(lengths, 64, most)
    assert frees == wanted_closed
    assert sorted(64 - sum(lengths[i] for i in c) for c in rest) == sorted(wanted_open)
    assert sorted(i for c in closed + rest for i in c) == list(range(400))


def check_sequences(rows, capacity):
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_documents_round_trip(spark, tokenizer):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = best_fit.pack_documents(docs, PATH).collect()
    pieces = defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
    total = 0
    for doc in docs.collect():
        ids = tokenizer.encode(doc["text"], add_special_tokens=False).ids + [0]
        total += len(ids)
        own = sorted(pieces.pop(doc["doc_id"]), key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own))) and len(own) == -(-len(ids) // 2048)
        at = 0
        for k, r in enumerate(own):
            assert r["start"] == at and (k == 0 or r["length"] == 2048)
            data = np.array(ids[at:at + r["length"]], "<u4").tobytes()
            assert r["ids_crc32"] == zlib.crc32(data)
            at += r["length"]
        assert at == len(ids)
    assert not pieces
    assert check_sequences(rows, 2048) <= 1.01 * total / 2048 + 1


def test_many_tasks_leave_few_gaps(spark, monkeypatch):
    """Bins that are open when the tasks end are packed once more."""
    monkeypatch.setattr(best_fit, "PIECES_PER_TASK", 500)
    pieces = spark.range(6000).select(
        F.lit(None).cast("long").alias("doc_id"), (F.pmod(F.xxhash64("id"), F.lit(90)) + 1).alias("length"),
        F.lit("x").alias("in_0"), F.lit(1).alias("Sequence_Id"))
    rows = best_fit.pack(pieces, capacity=100, open_bins=250, run=250).collect()
    assert len(rows) == 6000 and sorted(rows[0].asDict()) == ["doc_id", "in_0", "length", "offset", "sequence_id"]
    total = sum(r["length"] for r in rows)
    closed, opened = plain_best_fit(sorted((r["length"] for r in rows), reverse=True), 100, 6000)
    assert check_sequences(rows, 100) <= 1.05 * (len(closed) + len(opened))
    # One open bin at a time is still right, if loose.
    rows = best_fit.pack(pieces, capacity=100, open_bins=1, run=7).collect()
    assert sum(r["length"] for r in rows) == total
    check_sequences(rows, 100)


def test_oddities(oddities, nothing, tokenizer):
    rows = best_fit.pack_documents(oddities, PATH, capacity=512).collect()
    check_sequences(rows, 512)
    ids = lambda t: tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
    wanted = sum(-(-len(ids(r["text"])) // 512) for r in oddities.collect())
    assert len(rows) == wanted
    assert sum(r["length"] for r in rows) == sum(len(ids(r["text"])) for r in oddities.collect())
    assert sum(r["doc_id"] is None for r in rows) == 2
    assert best_fit.pack_documents(nothing, PATH).count() == 0
