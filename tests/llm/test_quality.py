import random
import re
from collections import Counter

import pytest

from tarnlake.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counted(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    again = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(again))


def test_counts_against_brute_force(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 60))) for _ in range(150)]
    texts += ["\n".join(rng.choice(["x y", "", " ", "#z | é", "漢字 😀"]) for _ in range(rng.randint(0, 9))) for _ in range(80)]
    texts += ["one two three four five six seven eight " * 3, "a " * 5000, "", " ", "\xa0 \x1c x", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = quality.weak_quality(docs).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == counted(r["text"])
        n, _, _, _, again = counted(r["text"])
        assert r["base_failed"] == (n < 20 or 100 * again > 30 * n)
        assert not (r["base_failed"] and r["kept"])


@pytest.mark.parametrize("folder", ["sf0.01", "sf0.1"])
def test_verdicts_against_the_labels(spark, folder):
    """The labels take no part in the fit; junk that passes the base rules is found, good text stays."""
    path = f"/root/testdata/{folder}"
    scored = quality.weak_quality(spark.read.parquet(f"{path}/documents.parquet")).where("NOT base_failed")
    labelled = scored.join(spark.read.parquet(f"{path}/labels.parquet"), "doc_id")
    counts = {(r["quality"], r["kept"]): r["count"] for r in labelled.groupBy("quality", "kept").count().collect()}
    assert counts.get((1, True), 0) > 100 and counts.get((1, False), 0) == 0
    assert counts.get((0, False), 0) > 10 and counts.get((0, True), 0) == 0


def test_em_finds_the_accuracies(spark):
    """Votes drawn from known probabilities: two rules that blame junk well, one that does so at random."""
    rng = random.Random(8)
    rows, truth = [], []
    for i in range(4000):
        bad = rng.random() < 0.2
        symbols = 50 if rng.random() < (0.9 if bad else 0.01) else 0
        capitals = 400 if rng.random() < (0.8 if bad else 0.02) else 0
        lines = 90 if rng.random() < 0.1 else 0
        rows.append((i, 100, 500, symbols, lines, 0, capitals, 0, 100))
        truth.append(bad)
    frame = spark.createDataFrame(rows, ", ".join(f"{n} long" for n in ("id", *quality.FEATURES)))
    model = quality.fit_votes(frame)
    assert abs(model.bad_share - 0.2) < 0.05
    names = [n for n, _, _ in quality.RULES]
    assert abs(model.bad[names.index("symbols")][quality.BAD] - 0.9) < 0.1
    assert abs(model.bad[names.index("lines")][quality.BAD] - model.good[names.index("lines")][quality.BAD]) < 0.08
    accuracies = dict(zip(names, model.accuracies()))
    assert accuracies["symbols"] > accuracies["lines"]
    verdict = {r["id"]: r["posterior"] >= 0.5 for r in quality.judged(frame, model).select("id", "posterior").collect()}
    assert sum(verdict[i] == (not bad) for i, bad in enumerate(truth)) > 0.95 * len(truth)


def test_oddities(oddities, nothing):
    rows = quality.weak_quality(oddities).collect()
    assert len(rows) == 10 and all(r["row"] == 1 and r["cell"] == "c" and isinstance(r["kept"], bool) for r in rows)
    assert quality.weak_quality(nothing).collect() == []
    kept = quality.keep_good(oddities)
    assert kept.columns == oddities.columns and {r["kept"] for r in kept.collect()} <= {"k"}


def test_no_python_on_the_main_path(spark, oddities):
    plan = quality.weak_quality(oddities)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
