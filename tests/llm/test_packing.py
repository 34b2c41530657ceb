import gc
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tarnlake.llm import packing
from tarnlake.llm.tokens import WordTokens, slices, text_slices

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "a<|startoftext|>b <|endoftext|>c it's DON'T 'S  x  é ́a \x1c\x1d x\xa0y ΣΑΣ İ ﬁ １２3 <|endoftext|><|startoftext|>",
       "\n\t\r\x0b\x0c", "x" * 5000, " 's 'll", "😀😀 👍🏽 ‍ a\0b", "H̱ ẖ Å"]


def encoded(texts):
    tokenizer = Tokenizer.from_file(PATH)
    return [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("limit", [10, 250_000])
def test_word_by_word_gives_the_ids_of_the_whole_text(spark, limit):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()] + ODD
    store, expected = WordTokens(PATH, limit), encoded(texts)
    for low, high in slices([t.encode() for t in texts], 30_000):
        counts, ids = store.encode([t.encode() for t in texts[low:high]])
        assert counts.tolist() == [len(e) for e in expected[low:high]]
        assert ids.tolist() == [i for e in expected[low:high] for i in e]
    assert store.encode([])[0].tolist() == []


def test_slices_cover_everything_once():
    texts = ["x" * n for n in (5, 0, 0, 50, 3, 9, 1)]
    runs = list(slices(texts, 10))
    assert [k for a, b in runs for k in range(a, b)] == list(range(7)) and list(slices([], 10)) == []


def test_slices_of_a_column_are_those_of_its_texts():
    texts = [b"x" * n for n in (5, 0, 0, 50, 3, 9, 1)]
    column = pa.array([b"ahead", *texts]).slice(1)
    for most in (1, 4, 10, 68, 69, 1000):
        assert list(text_slices(column, most)) == [(a, texts[a:b]) for a, b in slices(texts, most)]
    assert list(text_slices(column.slice(0, 0))) == []


def test_words_that_are_no_longer_needed_leave_memory():
    gc.collect()
    gc.disable()
    try:
        store = WordTokens(PATH, 10)
        store.encode([b"w%d" % k for k in range(40)])
        store.encode([b"new"])
        assert not any(isinstance(x, defaultdict) and b"w39" in x for x in gc.get_objects())
    finally:
        gc.enable()


def test_knapsack_against_all_patterns():
    rng = np.random.default_rng(3)
    for _ in range(20):
        prices = rng.random(6).round(2)

        def best(room, least=0):
            return max([0.0] + [prices[k] + best(room - k - 1, k) for k in range(least, 6) if k < room])

        counts = packing.best_pattern(prices, 9)
        assert counts @ np.arange(1, 7) <= 9 and counts @ prices == pytest.approx(best(9))


def test_plan_uses_every_piece_once_and_nears_the_bound():
    rng = np.random.default_rng(5)
    for scale in (1, 40):
        demand = rng.integers(0, 9, 64) * scale
        plan = packing.cutting_plan(demand, 64)
        used = np.zeros(64, int)
        for p in plan:
            assert sum((c + 1) * n for c, n in p.counts) <= 64 and p.times > 0
            for c, n in p.counts:
                used[c] += n * p.times
        assert (used == demand).all()
        bound = (demand * np.arange(1, 65)).sum() / 64
        lower = sum(a for _, a in packing.column_generation(demand, 64))
        assert bound - 1e-6 <= lower <= sum(p.times for p in plan) <= lower + 12
    assert packing.cutting_plan(np.zeros(64, int), 64) == []
    assert [(p.counts, p.times) for p in packing.cutting_plan(np.eye(64, dtype=int)[63] * 7, 64)] == [(((63, 1),), 7)]


def check(rows, expected):
    sequences, documents = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.array(expected[r["doc_id"]], "<u4")
        assert r["doc_tokens"] == len(ids) and 0 < r["length"] <= 2048
        assert r["ids_crc32"] == zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes())
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        documents[r["doc_id"]].append((r["start"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    for doc, ids in expected.items():
        at = 0
        for start, length in sorted(documents[doc]):
            assert start == at
            at += length
        assert at == len(ids)
    return len(sequences)


def test_whole_table_is_packed_with_little_padding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    expected = {d: [*ids, 1] for d, ids in zip(texts, encoded(texts.values()))}
    n = check(packing.pack_documents(docs, PATH).collect(), expected)
    assert sum(map(len, expected.values())) / (2048 * n) > 0.98


def test_odd_documents(spark, oddities, nothing):
    docs = spark.createDataFrame([*enumerate(ODD), (100, None)], "doc_id long, text string")
    expected = {d: [*ids, 1] for d, ids in zip([*range(len(ODD)), 100], encoded([*ODD, ""]))}
    check(packing.pack_documents(docs, PATH).collect(), expected)
    rows = packing.pack_documents(oddities, PATH).collect()
    longest = len(encoded([oddities.where("doc_id = 5").orderBy("n_chars").collect()[-1]["text"]])[0]) + 1
    assert sum(r["doc_tokens"] == longest for r in rows) == 2 * -(-longest // 2048)
    assert packing.pack_documents(nothing, PATH).collect() == []


def test_columns_with_the_names_of_helpers(spark):
    pieces = spark.range(50).selectExpr(
        "id AS doc_id", "0L AS start", "1 + id * 40 AS length", "'r' AS rank", "id AS cell", "5 AS offset", "1 AS _class")
    rows = packing.pack(pieces).collect()
    assert {(r["rank"], r["cell"] == r["doc_id"], r["_class"]) for r in rows} == {("r", True, 1)}
    assert sum(r["length"] for r in rows if r["offset"] == 0) < sum(r["length"] for r in rows)


def test_many_pieces_of_one_length(spark):
    pieces = spark.range(30_000).selectExpr("id AS doc_id", "0L AS start", "IF(id % 3 > 0, 1L, 700L + id % 40) AS length")
    rows = packing.pack(pieces).collect()
    filled = defaultdict(int)
    for r in rows:
        filled[r["sequence_id"]] += r["length"]
    assert len(rows) == 30_000 and max(filled.values()) <= 2048


def test_pieces_under_one_key(spark):
    """A third of the pieces without a key and a third under one key: each is in one place, and none overlap."""
    pieces = spark.range(3000).selectExpr(
        "CASE id % 3 WHEN 0 THEN NULL WHEN 1 THEN 5 ELSE id END AS doc_id", "0L AS start",
        "1 + id * 37 % 900 AS length", "id AS own")
    rows = packing.pack(pieces).collect()
    assert sorted(r["own"] for r in rows) == list(range(3000))
    sequences = defaultdict(list)
    for r in rows:
        assert r["length"] == 1 + r["own"] * 37 % 900
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        ends = [offset + length for offset, length in sorted(parts)]
        assert [offset for offset, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 2048
    assert len(sequences) < 1.02 * sum(r["length"] for r in rows) / 2048 + 1
