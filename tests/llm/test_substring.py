import gc
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tarnlake.llm import substring
from tarnlake.llm.common import settle
from tarnlake.llm.fm_index import Bits, FmIndex, WaveletMatrix, suffix_order

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def removed_by_hand(rows):
    """For each (doc_id, text): all words, words removed, and those kept."""
    least = {}
    split = [(d, WORD.findall(t or "")) for d, t in rows]
    for doc, words in split:
        if doc is not None:
            for i in range(len(words) - 12):
                window = tuple(words[i:i + 13])
                least[window] = min(doc, least.get(window, doc))
    out = []
    for doc, words in split:
        gone = set()
        if doc is not None:
            for i in range(len(words) - 12):
                if least[tuple(words[i:i + 13])] < doc:
                    gone |= set(range(i, i + 13))
        out.append((doc, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return out


def check(spark, rows):
    got = substring.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got)
    assert found == Counter(removed_by_hand(rows))
    return sum(r["n_removed"] for r in got)


def test_rank_and_wavelet_matrix():
    rng = np.random.default_rng(1)
    bits = rng.integers(0, 2, 1000)
    at = np.arange(1001)
    assert (Bits(bits).rank(at) == np.r_[0, np.cumsum(bits)]).all()
    for n_symbols in (1, 2, 5, 300):
        symbols = rng.integers(0, n_symbols, 700)
        matrix = WaveletMatrix(symbols, n_symbols)
        for c in range(0, n_symbols, 7):
            counts = np.r_[0, np.cumsum(symbols == c)]
            assert (matrix.rank(np.full(701, c), np.arange(701)) == counts).all()


def test_backward_search_against_scanning():
    rng = random.Random(2)
    text = np.array([rng.choice([0, 1, 1, 2, 2, 3]) for _ in range(800)] + [0])
    index = FmIndex(text, 4, 6)
    order = suffix_order(text, 6)
    keys = [tuple(text[i:i + 6]) for i in order]
    assert keys == sorted(keys)
    ends = np.array([e for e in range(5, 800) if 0 not in text[e - 5:e + 1]])
    matched, low, high = index.matching_statistics(text, ends, 6)
    for e, m, a, b in zip(ends, matched, low, high):
        places = [sum(tuple(text[i:i + n]) == tuple(text[e - n + 1:e + 1]) for i in range(len(text))) for n in range(1, 7)]
        assert m == sum(p >= 2 for p in places)
        assert (b - a) == (places[5] if places[5] >= 2 else 0)
        if b > a:
            assert {tuple(text[i:i + 6]) for i in index.order[a:b]} == {tuple(text[e - 5:e + 1])}


def test_segments_cover_every_window_once_and_equal_windows_share_minimizers():
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.choice([0, 5, 12, 13, 14, 90]))).encode() for _ in range(200)]
    text, start, windows, least = substring.segment(texts)
    seen, of_window = Counter(), {}
    for t, s, n, m in zip(text.tolist(), start.tolist(), windows.tolist(), least.tolist()):
        assert 1 <= n <= substring.MOST_WINDOWS
        words = texts[t].split()
        for k in range(s, s + n):
            seen[t, k] += 1
            assert of_window.setdefault(tuple(words[k:k + 13]), m) == m
    assert set(seen) == {(t, k) for t, x in enumerate(texts) for k in range(len(x.split()) - 12)}
    assert set(seen.values()) <= {1}


@pytest.mark.parametrize("gram", [substring.GRAM, substring.LONG_GRAM])
def test_grams_of_any_length_cover_every_window(gram):
    words = [f"w{k % 40}" for k in range(200)]
    texts = [" ".join(words[a:a + n]).encode() for a, n in ((0, 90), (20, 60), (40, 12), (5, 13))]
    text, start, windows, least = substring.segment(texts, gram)
    of_window = {}
    for t, s, n, m in zip(text.tolist(), start.tolist(), windows.tolist(), least.tolist()):
        assert 1 <= n <= substring.WINDOW - gram + 1
        for k in range(s, s + n):
            assert of_window.setdefault(tuple(texts[t].split()[k:k + 13]), m) == m
    assert sum(windows.tolist()) == 78 + 48 + 1


def test_a_shard_holds_equal_stretches_and_the_least_document_decides():
    passage = " ".join(f"p{k}" for k in range(16)).encode()
    inner = b" ".join(passage.split()[1:14])
    docs = np.array([5, 3, 3, 9, 4, 1], np.int64)
    bits = substring.search_shard([passage, passage, passage, passage, inner, b"z " * 12 + b"z"], docs)
    # Windows 0 to 3 of documents 5 and 9 are in 3 too; the second copy of 3 loses nothing; 4 holds window 1 after 3.
    assert bits.tolist() == [15, 0, 0, 15, 1, 0]


def test_no_words_stay_in_memory():
    gc.collect()
    gc.disable()
    try:
        substring.segment([b" ".join(b"w%d" % k for k in range(30))])
        substring.search_shard([b"z " * 12 + b"z"] * 2, np.array([1, 2], np.int64))
        assert not any(isinstance(x, defaultdict) and (b"w7" in x or b"z" in x) for x in gc.get_objects())
    finally:
        gc.enable()


def test_a_stage_has_one_step_of_python(spark, monkeypatch):
    plans = []

    def planned(df, label):
        plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return settle(df, label)

    monkeypatch.setattr(substring, "settle", planned)
    text = " ".join(f"t{k}" for k in range(30))
    docs = spark.createDataFrame([(1, 1, text), (2, 1, text)], "doc_id long, crc long, text string").select(
        "doc_id", "crc", substring.octets(substring.F.col("text")).alias("text"))
    substring.found_windows(docs)
    assert sum("MapInArrow" in p for p in plans) >= 4
    # Above the first join a plan is a single line of steps; an exchange ends a stage.
    for line in (p.split("Join")[0] for p in plans):
        assert all(stage.count("MapInArrow") <= 1 for stage in line.split("Exchange")), line


@pytest.fixture
def small_shards(spark, monkeypatch):
    """Tasks that solve few shards at once, so that copies meet in later rounds."""
    monkeypatch.setattr(substring, "SHARD_WORDS", 500)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "40")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_most_windows_are_found_by_backward_search(spark, monkeypatch, small_shards):
    monkeypatch.setattr(substring, "FREQUENT", 20)
    passage = " ".join(f"p{k}" for k in range(40))
    rows = [(i, f"own{i} {passage} end{i}") for i in range(900)] + [(2000, "x " * 500), (2001, "x " * 500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select(
        "doc_id", substring.F.crc32("text").alias("crc"), substring.octets(substring.F.col("text")).alias("text"))
    rounds = [{(r["doc_id"], r["start"] + k) for r in found.collect() for k in range(9) if r["bits"] >> k & 1}
              for found in substring.found_windows(docs)]
    every = set().union(*rounds)
    sizes = [len(rounds[0]), len(rounds[1] - rounds[0]), len(rounds[2] - rounds[0] - rounds[1]), len(every)]
    assert sizes[0] > 0.9 * sizes[3] and 0 < sizes[1] and sizes[2] < 0.01 * sizes[3], sizes
    check(spark, rows)


@pytest.mark.parametrize("frequent", [1, 6, 500])
def test_few_words_and_many_repeats(spark, monkeypatch, frequent, small_shards):
    monkeypatch.setattr(substring, "FREQUENT", frequent)
    rng = random.Random(4)
    passage = [f"p{k}" for k in range(60)]
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 40)))) for i in range(200)]
    for i in range(200, 320):
        own = [f"w{rng.randrange(4000)}" for _ in range(rng.randint(0, 80))]
        at, a = rng.randint(0, len(own)), rng.randint(0, 30)
        rows.append((i, rng.choice([" ", "\n", "  "]).join(own[:at] + passage[a:a + rng.randint(10, 30)] + own[at:])))
    rows += [(320 + i, rows[250 + i][1]) for i in range(20)] + [(400, "x " * 300), (401, "x " * 20), (402, "x " * 12)]
    rng.shuffle(rows)
    assert check(spark, rows) > 1000


def test_whole_table_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    assert check(spark, rows) > 10_000


def test_oddities(spark, oddities, nothing):
    text = " ".join(f"t{k}" for k in range(30))
    check(spark, [(None, text), (None, text), (1, text), (1, text), (1, text + " more"), (2, text), (2, text), (3, None), (4, ""),
                  (5, "\xa0 \x1c " + text)])
    rows = substring.remove_repeats(oddities).collect()
    assert len(rows) == 10 and all(r["row"] == 1 and r["cell"] == "c" and r["n_removed"] == 0 for r in rows)
    out = substring.without_repeats(oddities)
    assert out.columns == oddities.columns
    assert Counter(map(tuple, out.collect())) == Counter(map(tuple, oddities.collect()))
    assert substring.remove_repeats(nothing).collect() == []


def test_texts_that_lose_words_are_replaced(spark):
    text = " ".join(f"t{k}" for k in range(30))
    docs = spark.createDataFrame([(1, text, 5), (2, f"new\nline {text} end", 6), (3, "left\n alone", 7)],
                                 "doc_id long, text string, n_chars long")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in substring.without_repeats(docs).collect()}
    assert got == {1: (text, 5), 2: ("new line end", 12), 3: ("left\n alone", 7)}
