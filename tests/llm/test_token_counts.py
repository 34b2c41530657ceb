import os
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tarnlake.llm import token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")


def by_hand(ids, end=0):
    out, start = [], 0
    for at, i in enumerate(ids):
        if i == end:
            out.append((len(out), start, at - start, True))
            start = at + 1
    return out + ([(len(out), start, len(ids) - start, False)] if start < len(ids) else [])


@pytest.mark.parametrize("width", [2, 4])
@pytest.mark.parametrize("block_ids", [1, 3, 64, 1 << 18])
def test_boundaries_across_blocks(spark, tmp_path, width, block_ids):
    rng = np.random.default_rng(block_ids)
    # Ids whose bytes look like a separator where they are not aligned, long stretches without one, empty
    # documents, an open end, a file of separators only, and an empty file.
    files = {
        "a": rng.choice([0, 256, 1, 7], 500), "b": np.r_[np.full(300, 256), 0], "c": np.zeros(70, int),
        "d": np.full(130, 9), "e": np.zeros(0, int), "f": np.r_[0, np.full(64, 3)], "g": np.r_[np.full(63, 3), 0],
    }
    for name, ids in files.items():
        (tmp_path / name).write_bytes(ids.astype(f"<u{width}").tobytes())
    found = token_counts.scan_token_files(spark, str(tmp_path), width=width, block_bytes=block_ids * width).collect()
    got = {}
    for r in found:
        got.setdefault(os.path.basename(r["path"]), []).append((r["ordinal"], r["start"], r["n_tokens"], r["ended"]))
    assert {n: sorted(v) for n, v in got.items()} == {n: by_hand(i) for n, i in files.items() if len(i)}


def test_blocks_hold_whole_ids(spark, tmp_path):
    with pytest.raises(ValueError):
        token_counts.scan_token_files(spark, str(tmp_path), block_bytes=7)


def counts(spark, docs, path):
    places = token_counts.write_token_files(docs, path, PATH)
    number = token_counts.F.regexp_extract("path", r"part-(\d+)", 1).cast("int")
    counted = token_counts.scan_token_files(spark, path, block_bytes=4096).withColumn("file", number)
    return places, places.join(counted, ["file", "ordinal"], "full").collect()


def expected(docs):
    tokenizer = Tokenizer.from_file(PATH)
    return Counter((r["doc_id"], len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids))
                   for r in docs.collect())


@pytest.mark.parametrize("split", ["128m", "40k"])
def test_files_written_and_counted(spark, tmp_path, split):
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    _, rows = counts(spark, docs, str(tmp_path / "t"))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert Counter((r["doc_id"], r["n_tokens"]) for r in rows) == expected(docs)
    stored = np.concatenate([np.fromfile(f, "<u2") for f in (tmp_path / "t").rglob("part-*")])
    assert len(stored) == sum(r["n_tokens"] for r in rows) + len(rows) and (stored == 0).sum() == len(rows)


def test_oddities(spark, oddities, nothing, tmp_path):
    _, rows = counts(spark, oddities.repartition(3), str(tmp_path / "t"))
    assert Counter((r["doc_id"], r["n_tokens"]) for r in rows) == expected(oddities)
    places = token_counts.write_token_files(nothing, str(tmp_path / "n"), PATH)
    assert places.collect() == []
