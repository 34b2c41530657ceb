import subprocess
import sys
from collections import defaultdict

import pytest

import corpus_pipeline
from tarnlake.llm import mixing, quality, simhash
from tarnlake.llm.common import settle
from tarnlake.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(settle(stage(spark, out[-1], FOLDER), name))
    return out


def test_all_but_the_last_return_the_columns_of_documents(stages):
    assert len(corpus_pipeline.STAGES) == 5
    for docs in stages[:-1]:
        assert docs.schema.simpleString() == stages[0].schema.simpleString()


def test_each_stage_does_to_its_input_what_its_operator_decides(spark, stages):
    first, good, single, cut, mixed, packed = stages
    verdict = {r["doc_id"] for r in quality.weak_quality(first).where("kept").select("doc_id").collect()}
    assert {r["doc_id"] for r in good.collect()} == verdict and 0 < len(verdict) < first.count()
    kept = {r["component_id"] for r in simhash.near_duplicates(good).collect()}
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(kept)
    texts, after = ({r["doc_id"]: r["text"] for r in df.collect()} for df in (single, cut))
    assert set(texts) == set(after)
    windows = defaultdict(set)
    for doc, text in after.items():
        words = text.split()
        assert len(words) <= len(texts[doc].split())
    for doc, text in texts.items():
        words = text.split()
        for i in range(len(words) - 12):
            windows[tuple(words[i:i + 13])].add(doc)
    losers = {d for docs in windows.values() for d in docs if d > min(docs)}
    assert {d for d in texts if texts[d] != after[d]} == losers
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(cut).collect()}
    words = defaultdict(int)
    for r in mixed.collect():
        words[r["doc_id"]] += mixed_words(r["text"])
        assert r["n_chars"] == len(r["text"])
    assert dict(words) == {d: n for d, n in taken.items() if n}
    lengths = packed.groupBy("sequence_id").sum("length").collect()
    assert max(r[1] for r in lengths) <= 2048
    assert packed.where("start = 0").count() == mixed.count()


def mixed_words(text):
    return len(text.encode().split())


def test_run_gives_what_the_stages_give(spark, stages):
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    whole = corpus_pipeline.run(spark, FOLDER).select(*columns)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, stages[-1].select(*columns).collect()))


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
        assert docs.collect() == []


def test_one_query_for_each_operator_and_the_pipeline():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES and set(ORACLES) <= set(QUERIES)


def test_nothing_else_imports_the_package():
    code = ("import sys, tarnlake.plans; assert not any(m.startswith('tarnlake.llm') or m == 'corpus_pipeline' for m in sys.modules)")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=corpus_pipeline.__file__.rsplit("/", 1)[0])
