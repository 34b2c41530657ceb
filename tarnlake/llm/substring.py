"""Substring dedup: windows of words that an earlier document holds, found in FM-indexes of shards.

Streaming every document past every shard's index would take corpus times shards. Here a shard holds the
stretches of text that share minimizers, and only those stretches stream past it: every window of words has
one minimizer (the least hash among its grams), equal windows have equal ones and so meet in one shard.

The stretches of a frequent minimizer are dealt out over several shards. Each shard's index finds the windows
that a lesser document of the same shard holds; what no shard finds goes on to a second round, whose minimizers
are longer grams. Of a window's occurrences only those of each shard's least document go on, so that copies
shrink from round to round and none is lost.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnlake.llm.common import named, packed, settle, unpacked
from tarnlake.llm.fm_index import FmIndex
from tarnlake.llm.tokens import text_slices

WINDOW = 13
# Words in the grams of the first round's minimizers, and of the second's.
GRAM, LONG_GRAM = 5, 9
# Windows a stretch may have: no more than grams in a window, so that it stays short.
MOST_WINDOWS = WINDOW - GRAM + 1
# A minimizer in more stretches than this is frequent text, dealt out over shards of about so many stretches.
FREQUENT = 500
SHARD_WORDS = 300_000
ROWS_AT_ONCE = 20_000
# Text that is cut at once: its words and their hashes take some twenty times as much memory.
TEXT_BYTES = 2_000_000
SEGMENTS = "doc_id long, crc long, start int, windows int, minimizer long"
STRETCHES = "minimizer long, parts long, words binary, doc_id long, crc long, start int, windows int"
RESULTS = "doc_id long, crc long, start int, windows int, bits long, words binary"


def hash_words(words: list[bytes]) -> np.ndarray:
    index: defaultdict[bytes, int] = defaultdict()
    index.default_factory = index.__len__
    codes = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
    index.default_factory = None  # else the words stay in memory, held by themselves
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w) for w in index), np.uint64, len(index))[codes]


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ values >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
    return values ^ values >> np.uint64(29)


def segment(texts: list[bytes], gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Cut texts into runs of windows with the same minimizer: text number, first word, windows, minimizer."""
    most = WINDOW - gram + 1
    split = [text.split() for text in texts]
    n = np.array([len(words) for words in split], dtype=np.int64)
    flat = hash_words([w for words in split for w in words])
    total = len(flat) - WINDOW + 1
    if total <= 0:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    grams = np.zeros(len(flat) - gram + 1, np.uint64)
    for k in range(gram):
        grams = grams * np.uint64(0xBF58476D1CE4E5B9) + flat[k:len(flat) - gram + 1 + k]
    grams = mixed(grams)
    least = grams[:total].copy()
    for k in range(1, most):
        np.minimum(least, grams[k:k + total], out=least)
    text = np.repeat(np.arange(len(texts)), n)
    inside = text[:total] == text[WINDOW - 1:]
    at = np.flatnonzero(inside)
    if not len(at):
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    text, least = text[at], least[at]
    change = np.r_[True, (text[1:] != text[:-1]) | (least[1:] != least[:-1])]
    since = np.arange(len(at)) - np.flatnonzero(change)[np.cumsum(change) - 1]
    first = np.flatnonzero(since % most == 0)
    word = at - (np.cumsum(n) - n)[text]
    return text[first], word[first], np.diff(np.r_[first, len(at)]), least[first].view(np.int64)


def segments(docs: DataFrame) -> DataFrame:
    """The segments of ``doc_id``, ``crc`` and ``text`` (binary)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, texts in text_slices(batch.column(2), TEXT_BYTES):
                text, start, windows, least = segment(texts)
                rows = pa.array(text + low)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(rows), batch.column(1).take(rows), pa.array(start.astype(np.int32)),
                    pa.array(windows.astype(np.int32)), pa.array(least)],
                    ["doc_id", "crc", "start", "windows", "minimizer"])

    return docs.select("doc_id", "crc", "text").mapInArrow(scan, SEGMENTS)


def shared_minimizers(found: DataFrame) -> DataFrame:
    """The minimizers that two documents share, and over how many shards (``parts``) each is dealt out."""
    return found.groupBy("minimizer").agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count(F.lit(1)).alias("n")).where(
        "low < high").select("minimizer", F.ceil(F.col("n") / FREQUENT).alias("parts"))


def stretches(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The words of the wanted segments: from the first word of the first window to the last of the last.
    A task takes rows that are alike in key and checksum once."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: list[bytes] = []
        places: list[tuple[int, int, int, int, int, int]] = []
        seen: set[tuple[int, int]] = set()

        def made() -> pa.RecordBatch:
            least, parts, docs_, crcs, first, many = np.array(places, np.int64).T
            return pa.RecordBatch.from_arrays([
                pa.array(least), pa.array(parts), pa.array(texts, pa.binary()), pa.array(docs_), pa.array(crcs),
                pa.array(first.astype(np.int32)), pa.array(many.astype(np.int32))],
                ["minimizer", "parts", "words", "doc_id", "crc", "start", "windows"])

        for batch in batches:
            for row in range(batch.num_rows):
                doc, crc = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
                if (doc, crc) in seen:
                    continue
                seen.add((doc, crc))
                words = batch.column(2)[row].as_py().split()
                found = batch.column(3).slice(row, 1).flatten().flatten()
                for s, n, m, parts in zip(*[f.to_pylist() for f in found]):
                    places.append((m, parts, doc, crc, s, n))
                    texts.append(b" ".join(words[s:s + n + WINDOW - 1]))
                if len(texts) >= ROWS_AT_ONCE:
                    yield made()
                    texts.clear()
                    places.clear()
        if texts:
            yield made()

    # Written, so that the shuffle files of its making are gone before the texts are shuffled.
    listed = settle(wanted.groupBy("doc_id", "crc").agg(
        F.collect_set(F.struct("start", "windows", "minimizer", "parts")).alias("found")), "wanted-segments")
    joined = docs.select("doc_id", "crc", "text").join(listed, ["doc_id", "crc"])
    return joined.select("doc_id", "crc", "text", "found").mapInArrow(cut, STRETCHES)


def search_shard(texts: list[bytes], docs: np.ndarray) -> np.ndarray:
    """For the stretches of a shard and the document of each: a bit for every window (by place in the stretch)
    that a lesser document holds too.

    The index holds every stretch, equal ones as often as they are there. A window's suffix interval names all
    its places, whose least document decides. Equal stretches ask for the same intervals, so one of them asks.
    """
    known: defaultdict[bytes, int] = defaultdict()
    known.default_factory = known.__len__
    kind = np.fromiter(map(known.__getitem__, texts), np.int64, len(texts))
    index: defaultdict[bytes, int] = defaultdict()
    index.default_factory = lambda: len(index) + 1
    symbols: list[int] = []
    sizes = np.zeros(len(known), np.int64)
    for at, text in enumerate(known):
        words = text.split()
        sizes[at] = len(words)
        symbols += map(index.__getitem__, words)
        symbols.append(0)
    known.default_factory = index.default_factory = None  # as in hash_words
    asked = np.array(symbols, np.int64)
    begins = np.cumsum(sizes + 1) - sizes - 1
    long = sizes[kind] + 1
    held = asked[np.arange(long.sum()) + np.repeat(begins[kind] - np.cumsum(long) + long, long)]
    fm = FmIndex(held, len(index) + 1, WINDOW)
    windows = sizes - WINDOW + 1
    ahead = np.cumsum(windows) - windows
    ends = np.arange(windows.sum()) + np.repeat(begins - ahead, windows) + WINDOW - 1
    matched, low, high = fm.matching_statistics(asked, ends, WINDOW)
    hit = np.flatnonzero(matched == WINDOW)
    least = np.full(len(ends), np.iinfo(np.int64).max)
    least[hit] = fm.least_in(np.repeat(docs, long), low[hit], high[hit])
    bits = np.zeros(len(texts), np.int64)
    for place in range(int(windows.max(initial=0))):
        there = np.flatnonzero(windows[kind] > place)
        earlier = least[ahead[kind[there]] + place] < docs[there]
        bits[there] |= earlier.astype(np.int64) << place
    return bits


def searched(pieces: DataFrame) -> DataFrame:
    """Index and search the stretches of each shard: ``bits``, the windows of a stretch that a lesser document
    of its shard holds, and ``words``, where other shards may hold its other windows. Other stretches without
    such windows are left out.

    A shard is a minimizer, or a part of a frequent one, told by a hash of the stretch's document and place;
    a task solves several shards at once.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def solve(table: pa.Table) -> pa.RecordBatch:
            table = table.combine_chunks()
            bits = search_shard(table.column("words").to_pylist(), table.column("doc_id").to_numpy())
            every = (np.int64(1) << table.column("windows").to_numpy().astype(np.int64)) - 1
            open_ = (table.column("parts").to_numpy() > 1) & (bits != every)
            rows = np.flatnonzero(open_ | (bits != 0))
            words = pa.array(table.column("words").take(pa.array(rows)).to_pylist(), pa.binary(), mask=~open_[rows])
            kept = [table.column(n).combine_chunks().take(pa.array(rows)) for n in ("doc_id", "crc", "start", "windows")]
            return pa.RecordBatch.from_arrays(
                [*kept, pa.array(bits[rows]), words], ["doc_id", "crc", "start", "windows", "bits", "words"])

        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                held.append(part)
                size += part.num_rows * (WINDOW + MOST_WINDOWS // 2)
                if size < SHARD_WORDS:
                    continue
                table = pa.Table.from_batches(held)
                shards = table.column("shard").to_numpy()
                new = np.flatnonzero(shards[1:] != shards[:-1])
                if len(new):
                    cut = int(new[-1]) + 1
                    yield solve(table.slice(0, cut))
                    held = table.slice(cut).combine_chunks().to_batches()
                    size = sum(b.num_rows for b in held) * (WINDOW + MOST_WINDOWS // 2)
        if held:
            yield solve(pa.Table.from_batches(held))

    # Told by Spark, as a second step of Python in a stage would be a second worker, with its memory, for each task.
    part = F.pmod(F.xxhash64("doc_id", "crc", "start"), F.col("parts"))
    shard = F.when(F.col("parts") > 1, F.xxhash64("minimizer", part)).otherwise(F.col("minimizer"))
    dealt = pieces.select(shard.alias("shard"), *[c for c in pieces.columns if c != "minimizer"])
    return dealt.repartition("shard").sortWithinPartitions("shard").mapInArrow(search, RESULTS)


def finer(results: DataFrame) -> DataFrame:
    """The stretches that a round left open, cut anew by the minimizers of longer grams; without those pieces
    all of whose windows have been found."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("words").to_pylist()
            row, first, windows, least = segment(words, LONG_GRAM)
            every = (np.int64(1) << windows) - 1
            bits = batch.column("bits").to_numpy()[row]
            left = np.flatnonzero((bits >> first & every) != every)
            row, first, windows, least = (a[left] for a in (row, first, windows, least))
            split = [w.split() for w in words]
            texts = [b" ".join(split[r][f:f + n + WINDOW - 1])
                     for r, f, n in zip(row.tolist(), first.tolist(), windows.tolist())]
            start = batch.column("start").to_numpy()[row] + first
            rows = pa.array(row)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").take(rows), batch.column("crc").take(rows), pa.array(start.astype(np.int32)),
                pa.array(windows.astype(np.int32)), pa.array(least), pa.array(texts, pa.binary())],
                ["doc_id", "crc", "start", "windows", "minimizer", "words"])

    return results.where("words IS NOT NULL").mapInArrow(cut, SEGMENTS + ", words binary")


def grouped(results: DataFrame) -> DataFrame:
    """What both rounds left open, window by window: the least document of equal windows, by grouping."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, crc, start, windows, bits = (
                batch.column(n).to_pylist() for n in ("doc_id", "crc", "start", "windows", "bits"))
            rows = []
            for at in range(batch.num_rows):
                words = batch.column("words")[at].as_py().split()
                rows += [(doc[at], crc[at], start[at] + k, b" ".join(words[k:k + WINDOW]))
                         for k in range(windows[at]) if not bits[at] >> k & 1]
            names = ["doc_id", "crc", "start", "window"]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)], names)

    single = results.where("words IS NOT NULL").mapInArrow(
        cut, "doc_id long, crc long, start int, window binary").withColumn("window", F.sha2("window", 256))
    least = single.groupBy("window").agg(F.min("doc_id").alias("first"))
    return single.join(least, "window").where("doc_id > first").select(
        "doc_id", "crc", "start", F.lit(1).cast("long").alias("bits"))


def found_windows(docs: DataFrame) -> list[DataFrame]:
    """For ``doc_id``, ``crc`` and ``text`` (binary): the windows to remove, as first window (``start``) and a
    bit for each window from there, found by the first round, by the second, and by grouping."""
    found = settle(segments(docs), "segments")
    shared = settle(shared_minimizers(found), "shared-minimizers")
    first = settle(searched(stretches(docs, found.join(shared, "minimizer"))), "first-round")
    pieces = settle(finer(first), "finer-stretches")
    second = settle(searched(pieces.join(shared_minimizers(pieces), "minimizer").select(
        "minimizer", "parts", "words", "doc_id", "crc", "start", "windows")), "second-round")
    return [r.select("doc_id", "crc", "start", "bits").where("bits <> 0") for r in (first, second, grouped(second))]


def repeated_windows(docs: DataFrame) -> DataFrame:
    """The windows to remove from each document, as ``runs`` of first window and bits."""
    first, second, rest = found_windows(docs)
    return settle(first.union(second).union(rest).groupBy("doc_id", "crc").agg(
        F.collect_set(F.struct("start", "bits")).alias("runs")), "repeated-windows")


def kept_words(text: bytes, runs) -> tuple[int, int, str]:
    """The words in all, the words removed, and the words that stay, joined by one space."""
    words = text.split()
    if runs is None or not len(runs):
        return len(words), 0, b" ".join(words).decode("utf-8", "replace")
    gone = np.zeros(len(words) + 1, np.int64)
    for run in runs:
        for k in range(MOST_WINDOWS):
            if run["bits"] >> k & 1:
                gone[run["start"] + k] += 1
                gone[run["start"] + k + WINDOW] -= 1
    stay = np.cumsum(gone[:-1]) == 0
    kept = [words[k] for k in np.flatnonzero(stay).tolist()]
    return len(words), len(words) - len(kept), b" ".join(kept).decode("utf-8", "replace")


REMOVAL = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                        T.StructField("kept", T.StringType())])


@F.pandas_udf(REMOVAL)
def removal(text: pd.Series, runs: pd.Series) -> pd.DataFrame:
    return pd.DataFrame(
        [kept_words(t, r) for t, r in zip(text, runs)], columns=["n_words", "n_removed", "kept"])


def octets(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).cast("binary")


def with_removals(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``row`` and the ``result`` of ``removal`` for it."""
    frame = packed(docs, doc_id=named(key).cast("long"), crc=F.crc32(octets(named(text))))
    plain = docs.select(
        named(key).cast("long").alias("doc_id"), F.crc32(octets(named(text))).alias("crc"),
        octets(named(text)).alias("text"))
    runs = repeated_windows(plain.where("doc_id IS NOT NULL"))
    return frame.join(runs, ["doc_id", "crc"], "left").withColumn(
        "result", removal(octets(F.col("row").getField(text)), F.col("runs")))


def remove_repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Remove every word in a window of ``WINDOW`` words that a document with a smaller key holds too.

    Windows are judged on the input. Returns the input columns, ``n_words``, ``n_removed`` and ``kept`` (the
    words that stay, joined by one space).

    - A null text has no words. Texts shorter than a window stay whole.
    - A null key is smaller than none and larger than none: such rows lose nothing and take nothing away.
    - Rows with the same key don't take from each other. They are told apart by their text's checksum; equal
      rows come back as often, with the same result.
    - An empty table gives no rows. Input columns named like a result are replaced.
    """
    return unpacked(with_removals(docs, key, text), docs.columns, {
        n: F.col("result").getField(n) for n in ("n_words", "n_removed", "kept")})


def without_repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text",
                    length: str | None = "n_chars") -> DataFrame:
    """The documents with their own columns, texts that lost words replaced by what is kept of them."""
    kept, lost = F.col("result").getField("kept"), F.col("result").getField("n_removed") > 0
    made = {text: F.when(lost, kept).otherwise(F.col("row").getField(text))}
    if length in docs.columns:
        made[length] = F.when(lost, F.char_length(kept).cast("long")).otherwise(F.col("row").getField(length))
    result = with_removals(docs, key, text)
    return result.select(*[made.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])
