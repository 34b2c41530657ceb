"""Packing documents into training sequences by bounded-space best fit."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnlake.llm.byte_tokens import TEXT_BYTES, byte_tokens
from tarnlake.llm.common import named, settle
from tarnlake.llm.tokens import slices

END_ID = 0
OPEN_BINS = 4096
RUN = 4096
PIECES_PER_TASK = 50_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACES = "sequence_id long, offset long, still_open boolean"


def token_pieces(docs: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text",
                 capacity: int = 2048, end_id: int = END_ID) -> DataFrame:
    """Tokenise whole documents, each with ``end_id`` behind it; documents over ``capacity`` ids are cut into full
    pieces behind a first piece that holds the rest.

    Returns ``doc_id``, ``piece`` (from 0), ``start``, ``length`` and ``ids_crc32`` (of the ids as unsigned 32-bit
    little-endian numbers). No ids leave the task. A null or empty text is the end id alone. Repeated rows and
    rows with a null or repeated key are documents of their own; other columns are left out, whatever their
    names. An empty table gives no rows.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = byte_tokens(tokenizer)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            for low, high in slices(texts, TEXT_BYTES):
                counts, ids = tokens.encode(texts[low:high])
                n = counts + 1
                ends = np.cumsum(n)
                whole = np.full(int(ends[-1]), end_id, np.uint32)
                inside = np.ones(len(whole), bool)
                inside[ends - 1] = False
                whole[inside] = ids
                n_pieces = -(-n // capacity)
                doc = np.repeat(np.arange(len(n)), n_pieces)
                nth = np.arange(len(doc)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
                first = (n - capacity * (n_pieces - 1))[doc]
                start = np.where(nth > 0, first + capacity * (nth - 1), 0)
                length = np.where(nth > 0, capacity, first)
                begin = (ends - n)[doc] + start
                data = memoryview(whole.astype("<u4").view(np.uint8))
                crc = [zlib.crc32(data[4 * b:4 * (b + m)]) for b, m in zip(begin.tolist(), length.tolist())]
                yield pa.RecordBatch.from_arrays([
                    keys.take(pa.array(doc + low)), pa.array(nth.astype(np.int32)), pa.array(start),
                    pa.array(length), pa.array(crc, pa.int64())],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])

    plain = docs.select(named(key).cast("long").alias("doc_id"), F.coalesce(named(text), F.lit("")).alias("text"))
    return plain.mapInArrow(cut, PIECES)


class OpenBins:
    """Best fit into at most ``most`` open bins. Bins are kept by their free space, and a bitset tells which free
    spaces there are: its lowest bit from a length on is the best fit. A full bin closes; when one more would be
    open than ``most``, the fullest closes."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.spaces, self.held, self.open = 0, [[] for _ in range(capacity + 1)], 0

    def _close_fullest(self) -> list:
        free = (self.spaces & -self.spaces).bit_length() - 1
        return self._take(free)

    def _take(self, free: int) -> list:
        bins = self.held[free]
        taken = bins.pop()
        if not bins:
            self.spaces &= ~(1 << free)
        self.open -= 1
        return taken

    def add(self, length: int, item: int) -> list | None:
        """Place an item; the items of the bin that closes by it, if one does."""
        fitting = self.spaces >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            contents = self._take(free)
        else:
            free, contents = self.capacity, []
        contents.append(item)
        free -= length
        if not free:
            return contents
        closed = self._close_fullest() if self.open == self.most else None
        self.held[free].append(contents)
        self.spaces |= 1 << free
        self.open += 1
        return closed

    def rest(self) -> Iterator[list]:
        while self.open:
            yield self._close_fullest()


def _fill(capacity: int, most: int, run: int, length_at: int):
    """A task's part of the packing: rows in, the same rows with their places out, bin by bin as bins close.

    ``run`` rows at a time are taken with the longest first, so that short ones find the gaps of long ones. Only
    the rows of open bins are held."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        number = context.partitionId() << 40
        bins, held, lengths = OpenBins(capacity, most), None, np.zeros(0, np.int64)

        def placed(closed: list[list[int]], still_open: bool) -> pa.RecordBatch:
            nonlocal number
            rows = np.array([i for b in closed for i in b], np.int64)
            sizes = np.array([len(b) for b in closed], np.int64)
            own = lengths[rows]
            ahead = np.cumsum(own) - own
            first = np.repeat(np.cumsum(sizes) - sizes, sizes)
            out = held.take(pa.array(rows))
            columns = [*out.columns, pa.array(np.repeat(number + np.arange(len(sizes)), sizes)),
                       pa.array(ahead - ahead[first]), pa.array(np.full(len(rows), still_open))]
            number += len(sizes)
            return pa.RecordBatch.from_arrays(columns, [*out.schema.names, "sequence_id", "offset", "still_open"])

        for rows in _runs(batches, run):
            # Rows of open bins come first and are numbered anew; the bins' lists hold those numbers.
            kept = sorted(i for b in bins.held for contents in b for i in contents)
            again = dict(zip(kept, range(len(kept))))
            for b in bins.held:
                for contents in b:
                    contents[:] = [again[i] for i in contents]
            held = rows if held is None else pa.Table.from_batches(
                [held.take(pa.array(kept, pa.int64())), rows]).combine_chunks().to_batches()[0]
            lengths = held.column(length_at).to_numpy()
            order = np.argsort(-lengths[len(kept):], kind="stable") + len(kept)
            closed = [bins.add(int(lengths[i]), i) for i in order.tolist()]
            if some := [c for c in closed if c]:
                yield placed(some, False)
        if bins.open:
            yield placed(list(bins.rest()), True)

    return fill


def _runs(batches: Iterator[pa.RecordBatch], run: int) -> Iterator[pa.RecordBatch]:
    """The rows in batches of ``run``, but for the last."""
    waiting, n = [], 0
    for batch in batches:
        waiting.append(batch)
        n += batch.num_rows
        if n >= run:
            whole = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
            for at in range(0, n - run + 1, run):
                yield whole.slice(at, run)
            waiting, n = ([whole.slice(n - n % run)] if n % run else []), n % run
    if n:
        yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]


def _packed(rows: DataFrame, n: int, length: str, capacity: int, most: int, run: int, seed: int) -> DataFrame:
    """Deal ``n`` rows out evenly, whatever their keys, shuffle them in their tasks, and fill bins."""
    tasks = max(1, -(-n // PIECES_PER_TASK))
    dealt = rows.repartition(tasks).sortWithinPartitions(F.xxhash64(F.lit(seed), *rows.columns))
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return dealt.mapInArrow(_fill(capacity, most, run, rows.columns.index(length)), f"{shape}, {PLACES}")


def pack(pieces: DataFrame, *, capacity: int = 2048, open_bins: int = OPEN_BINS, run: int = RUN,
         seed: int = 13) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (with a ``length`` from 1 to ``capacity``) so that no sequence
    exceeds ``capacity``.

    Pieces are dealt out evenly to tasks of about ``PIECES_PER_TASK``. A task puts each piece into the open
    bin with the least space that still takes it, or else into a new one; at most ``open_bins`` are open, and the
    fullest closes first. The bins that are open when the tasks end are then packed as wholes in the same
    way, so that tasks leave few gaps behind. ``sequence_id`` is unique, with gaps.

    Repeated rows are pieces of their own, and a null or repeated key is no matter, as rows are not dealt by key.
    Other columns are kept; input columns named like a result are replaced. An empty table gives no rows.
    """
    outputs = ("sequence_id", "offset")
    kept = [c for c in pieces.columns if c.lower() not in outputs]
    inner = {c: f"in_{k}" for k, c in enumerate(kept)}
    length = inner[next(c for c in kept if c.lower() == "length")]
    plain = pieces.select(*[named(c).cast("long" if i == length else pieces.schema[c].dataType).alias(i)
                            for c, i in inner.items()])
    first = settle(_packed(plain, plain.count(), length, capacity, open_bins, run, seed), "packed-pieces")
    open_rows = first.where("still_open")
    left = open_rows.groupBy("sequence_id").agg(F.sum(length).alias("length")).select(
        F.col("sequence_id").alias("left_id"), "length")
    merged = settle(_packed(left, left.count(), "length", capacity, open_bins, run, seed), "packed-rests")
    # A sequence of several rests is named by one of them, so that its name is no other sequence's.
    moved = merged.select("left_id", F.col("offset").alias("shift"), F.min("left_id").over(
        Window.partitionBy("sequence_id")).alias("new_id"))
    rests = open_rows.join(moved, F.col("sequence_id") == F.col("left_id")).select(
        *plain.columns, F.col("new_id").alias("sequence_id"), (F.col("offset") + F.col("shift")).alias("offset"))
    whole = first.where("NOT still_open").select(*plain.columns, *outputs).unionByName(rests)
    return whole.select(*[F.col(i).alias(c) for c, i in inner.items()], *outputs)


def pack_documents(docs: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text",
                   capacity: int = 2048, end_id: int = END_ID, **options) -> DataFrame:
    """Pieces of all documents with the sequence and offset they are packed at: ``token_pieces`` and ``pack``."""
    pieces = token_pieces(docs, tokenizer, key=key, text=text, capacity=capacity, end_id=end_id)
    return pack(settle(pieces, "byte-token-pieces"), capacity=capacity, **options)
