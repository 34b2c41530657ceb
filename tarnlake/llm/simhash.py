"""SimHash near-duplicates by a Gray-ordered hierarchical index over fingerprints."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.common import named, null_free, packed, settle, unpacked
from tarnlake.llm.tokens import text_slices

# Fixed value: the seed of the shingle hash.
SEED = 42
BITS = 64
# Fingerprints at most DISTANCE bits apart differ in at most DISTANCE of the BLOCKS, so they share the bits of
# at least BLOCKS - DISTANCE blocks. Each choice of those is an upper node's mask.
DISTANCE, BLOCKS = 2, 4
PATTERN_BITS = 8
ROWS_AT_ONCE = 50_000
PAIRS_AT_ONCE = 2_000_000
# Text that is hashed at once: the bits of its shingles take some ten times as much memory.
TEXT_BYTES = 1_000_000


def fingerprint_batch(texts: list[bytes], shingle: int) -> np.ndarray:
    """The fingerprints of UTF-8 texts. A bit is set if it is set in over half of the shingle hashes."""
    digest = xxhash.xxh64_digest
    digests, sizes = [], np.zeros(len(texts), np.int64)
    for at, text in enumerate(texts):
        words = text.lower().split()
        if not words:
            continue
        joined = b" ".join(words)
        if len(words) <= shingle:
            digests.append(digest(joined, SEED))
            sizes[at] = 1
            continue
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        ends = np.cumsum(lengths)
        begins = (ends - lengths)[:len(words) - shingle + 1].tolist()
        digests += [digest(joined[b:e], SEED) for b, e in zip(begins, (ends[shingle - 1:] - 1).tolist())]
        sizes[at] = len(begins)
    prints = np.zeros(len(texts), np.uint64)
    filled = np.flatnonzero(sizes)
    if len(filled):
        bits = np.unpackbits(np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 8), axis=1)
        starts = (np.cumsum(sizes) - sizes)[filled]
        counts = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        major = np.packbits(counts * 2 > sizes[filled, None], axis=1)
        prints[filled] = np.ascontiguousarray(major).view(">u8").ravel()
    return prints.view(np.int64)


def fingerprints(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = 3,
                 identity: Column | None = None) -> DataFrame:
    """``doc_id`` and ``fp`` (the fingerprint's 64 bits) of every row; a null text is an empty one.

    With ``identity`` (binary) it comes back beside them, as ``id``.
    """
    more = [] if identity is None else [identity.alias("id")]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, texts in text_slices(batch.column(1), TEXT_BYTES):
                carried = [batch.column(k).slice(low, len(texts)) for k in range(2, batch.num_columns)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, len(texts)), pa.array(fingerprint_batch(texts, shingle)),
                     *carried], ["doc_id", "fp", "id"][:2 + len(carried)])

    plain = docs.select(
        named(key).cast("long").alias("doc_id"), F.coalesce(named(text), F.lit("")).cast("binary").alias("text"),
        *more)
    return plain.mapInArrow(scan, "doc_id long, fp long" + ", id binary" * len(more))


def masks(distance: int = DISTANCE, blocks: int = BLOCKS) -> list[int]:
    width = BITS // blocks
    block = [((1 << width) - 1) << (BITS - width * (k + 1)) for k in range(blocks)]
    return [sum(block[k] for k in chosen) for chosen in combinations(range(blocks), blocks - distance)]


def signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def gray_rank(code: Column) -> Column:
    """The place of a code in Gray order: neighbours differ in one bit, equal leading bits stand together."""
    for shift in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, shift))
    return code


def levels(mask: int) -> list[np.uint64]:
    """The bits outside of a node's mask, leading bits first, in patterns of ``PATTERN_BITS``."""
    free = [b for b in range(BITS - 1, -1, -1) if not mask >> b & 1]
    return [np.uint64(sum(1 << b for b in free[k:k + PATTERN_BITS])) for k in range(0, len(free), PATTERN_BITS)]


def chunks(counts: np.ndarray, most: int) -> Iterator[slice]:
    start, total = 0, 0
    ends = np.cumsum(counts)
    while start < len(counts):
        stop = max(start + 1, int(np.searchsorted(ends, total + most, side="right")))
        yield slice(start, stop)
        start, total = stop, int(ends[stop - 1])


def hierarchy_links(groups: np.ndarray, codes: np.ndarray, patterns: list[np.uint64], distance: int):
    """Pairs of positions in the same group whose codes differ in at most ``distance`` bits.

    Codes are distinct in a group, and rows are in Gray order of the bits in ``patterns``. A node of a level is a
    run of rows with the same bits down to that level; pairs of nodes are followed down the levels, adding up
    the differences of their patterns, and dropped with all rows below once these exceed ``distance``.
    """
    n = len(codes)
    change = np.r_[True, groups[1:] != groups[:-1]]
    tops = [np.flatnonzero(change)]
    for pattern in patterns:
        part = codes & pattern
        change = change | np.r_[True, part[1:] != part[:-1]]
        tops.append(np.flatnonzero(change))

    def descend(level: int, a: np.ndarray, b: np.ndarray, apart: np.ndarray):
        if level == len(patterns):
            different = a != b
            yield tops[level][a[different]], tops[level][b[different]]
            return
        above, below = tops[level], tops[level + 1]
        first = np.searchsorted(below, above)
        last = np.searchsorted(below, np.r_[above[1:], n])
        wide_a, wide_b = (last - first)[a], (last - first)[b]
        for some in chunks(wide_a * wide_b, PAIRS_AT_ONCE):
            wa, wb, pairs = wide_a[some], wide_b[some], (wide_a * wide_b)[some]
            of = np.repeat(np.arange(len(pairs)), pairs)
            nth = np.arange(len(of)) - np.repeat(np.cumsum(pairs) - pairs, pairs)
            left, right = first[a[some]][of] + nth // wb[of], first[b[some]][of] + nth % wb[of]
            more = np.bitwise_count((codes[below[left]] ^ codes[below[right]]) & patterns[level])
            total = apart[some][of] + more
            near = (total <= distance) & (left <= right)
            if near.any():
                yield from descend(level + 1, left[near], right[near], total[near])

    roots = np.flatnonzero(np.diff(np.r_[tops[0], n]) > 1)
    return descend(0, roots, roots, np.zeros(len(roots), np.int64))


def spanning_roots(n: int, links) -> np.ndarray:
    """For each position the least position of its component."""
    label = np.arange(n)
    for a, b in links:
        while True:
            low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
            open_ = low != high
            if not open_.any():
                break
            np.minimum.at(label, high[open_], low[open_])
            while not np.array_equal(jumped := label[label], label):
                label = jumped
    return label


def near_links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Edges ``a``, ``b`` that connect all of the distinct fingerprints ``fp`` which are linked, directly or
    through others: for each upper node a spanning forest, not its pairs."""
    nodes = masks(distance)
    struct = [F.struct(F.lit(k).alias("node"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("shared"),
                       gray_rank(F.col("fp").bitwiseAND(F.lit(signed(~m & (1 << BITS) - 1)))).alias("rank"))
              for k, m in enumerate(nodes)]
    indexed = prints.select("fp", F.explode(F.array(*struct)).alias("at")).select("fp", "at.*")
    parts = indexed.repartition("node", "shared").sortWithinPartitions(
        "node", "shared", F.col("rank").bitwiseXOR(F.lit(signed(1 << (BITS - 1)))))

    def forest(node: int, groups: np.ndarray, codes: np.ndarray) -> pa.RecordBatch:
        label = spanning_roots(len(codes), hierarchy_links(
            groups, codes.view(np.uint64), levels(nodes[node]), distance))
        child = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays([pa.array(codes[label[child]]), pa.array(codes[child])], ["a", "b"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, 3), np.int64)

        def solve(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
            for node in np.unique(rows[:, 0]):
                mine = rows[rows[:, 0] == node]
                yield forest(int(node), mine[:, 1], np.ascontiguousarray(mine[:, 2]))

        for batch in batches:
            rows = np.column_stack([batch.column(k).to_numpy().astype(np.int64) for k in range(3)])
            held = np.concatenate([held, rows])
            if len(held) >= ROWS_AT_ONCE:
                new = np.flatnonzero((held[1:, :2] != held[:-1, :2]).any(axis=1))
                if len(new):
                    cut = int(new[-1]) + 1
                    yield from solve(held[:cut])
                    held = held[cut:]
        if len(held):
            yield from solve(held)

    return parts.select("node", "shared", "fp").mapInArrow(link, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``fp`` and ``label`` of every fingerprint on an edge; a label is one for each component.

    Each round points a fingerprint to the least of itself and its neighbours, in an order that changes from
    round to round, and replaces both ends of each edge by what they point to, until no edge is left. Every
    step is an aggregation or a join on a fingerprint, and each round starts from written tables.
    """
    edges = settle(edges, "links")
    labels = edges.select(F.col("a").alias("fp")).union(edges.select("b")).distinct().withColumn("label", F.col("fp"))
    labels = settle(labels, "labels")
    turn = 0
    while not edges.isEmpty():
        order = F.lit(signed((0x9E3779B97F4A7C15 * turn) % (1 << BITS)))
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        hops = settle(both.groupBy("u").agg(F.min(F.col("v").bitwiseXOR(order)).alias("v")).select(
            "u", F.least("v", F.col("u").bitwiseXOR(order)).bitwiseXOR(order).alias("to")), "hops")
        start, end = hops.toDF("a", "new_a"), hops.toDF("b", "new_b")
        edges = settle(edges.join(start, "a").join(end, "b").where("new_a <> new_b").select(
            F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b")).distinct(), "links")
        labels = settle(labels.join(hops.toDF("label", "to"), "label", "left").select(
            "fp", F.coalesce("to", "label").alias("label")), "labels")
        turn += 1
    return labels


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = 3,
                    distance: int = DISTANCE) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id`` of every row.

    Rows with the same fingerprint are linked, as are fingerprints at most ``distance`` bits apart; a
    component's id is the smallest key in it. Texts without words have fingerprint 0 and are linked like any
    other; a null text has none. Null keys are linked, but never the smallest; a component of null keys has a
    null id. Repeated rows come back as often. An empty table gives no rows.

    Copies meet as one fingerprint before anything is compared, so their number matters only to sums. Nothing
    but a flag whether links are left reaches the driver.
    """
    prints = settle(fingerprints(docs, key=key, text=text, shingle=shingle), "fingerprints")
    firsts = settle(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    labels = components(near_links(firsts.select("fp"), distance))
    linked = labels.join(firsts, "fp")
    smallest = linked.groupBy("label").agg(F.min("first").alias("least"))
    joined = settle(labels.join(smallest, "label").select("fp", "least"), "components")
    by_print = settle(firsts.join(joined, "fp", "left").select(
        "fp", F.coalesce("least", "first").alias("component_id")), "representatives")
    return prints.join(by_print, "fp").select("doc_id", "fp", "component_id")


def row_identity(docs: DataFrame, text: str) -> Column:
    """256 bits that differ for rows that differ in any column."""
    others = F.struct(*[named(c) for c in docs.columns if c.lower() != text.lower()])
    return F.unhex(F.sha2(F.concat(F.to_json(others), null_free(named(text))), 256))


def one_of_each_component(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = 3,
                          distance: int = DISTANCE) -> DataFrame:
    """Of each component of ``near_duplicates`` one row, with its own columns: that with the smallest key, a null
    key being the largest; of equal keys the one with the least ``row_identity``.

    Rows are told by all their columns, so each component keeps its row where a key has several texts or is
    null, and a rerun keeps the same ones.
    """
    identity = row_identity(docs, text)
    prints = settle(fingerprints(docs, key=key, text=text, shingle=shingle, identity=identity), "fingerprints")
    firsts = settle(prints.groupBy("fp").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("keyless"), "doc_id", "id")).alias("first")), "distinct-fingerprints")
    labels = components(near_links(firsts.select("fp"), distance))
    kept = firsts.join(labels, "fp", "left").groupBy(F.coalesce("label", "fp").alias("component")).agg(
        F.min("first").alias("first")).select("first.id")
    # Rows that are the same in every column become one in each task, before they meet.
    rows = packed(docs, id=identity).dropDuplicates(["id"]).join(kept, "id", "left_semi")
    return unpacked(rows, docs.columns, {})
