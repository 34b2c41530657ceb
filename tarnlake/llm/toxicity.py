"""Toxicity as severity grades: cumulative-link ordinal regression on the words of a text."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnlake.llm.common import named, packed, unpacked
from tarnlake.llm.tokens import slices

MOST_LABELLED = 8_000
# A word's features are its hash and those of its first bytes, as stems carry what endings vary.
STEMS = (4, 5, 6, 7)
# Lower case, and a space for every ASCII character that is neither letter nor digit; other bytes stay.
FOLD = bytes(ord(chr(b).lower()) if chr(b).isascii() and chr(b).isalnum() else b if b > 127 else 32
             for b in range(256))


def word_features(word: bytes) -> list[int]:
    return [zlib.crc32(word), *[zlib.crc32(word[:k] + b"*") for k in STEMS if len(word) > k]]


def feature_sets(texts: list[bytes], known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The number of distinct features of each text, and these features (32-bit hashes), text by text.

    With ``known``, a sorted array, only those features are looked for.
    """
    split = [text.translate(FOLD).split() for text in texts]
    n = np.array([len(words) for words in split], np.int64)
    index: defaultdict[bytes, int] = defaultdict()
    index.default_factory = index.__len__
    codes = np.fromiter((index[w] for words in split for w in words), np.int64, int(n.sum()))
    each = [word_features(w) for w in index]
    hashes = np.array([h for features in each for h in features], np.int64)
    owner = np.repeat(np.arange(len(each)), [len(features) for features in each])
    if known is not None:
        found = np.isin(hashes, known)
        hashes, owner = hashes[found], owner[found]
    held = np.bincount(owner, minlength=len(each))
    starts, counts = (np.cumsum(held) - held)[codes], held[codes]
    at = np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(int(counts.sum()))
    pairs = np.unique((np.repeat(np.repeat(np.arange(len(texts)), n), counts) << 32) + hashes[at])
    return np.bincount(pairs >> 32, minlength=len(texts)), pairs & 0xFFFFFFFF


@dataclass
class OrdinalModel:
    """P(grade > j) = sigmoid(weights . x - thresholds[j]): one weight for each feature, whatever the
    threshold, and thresholds in rising order. Features that are not listed, in rising order, weigh nothing."""

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def scores(self, sizes: np.ndarray, features: np.ndarray) -> np.ndarray:
        """The weighted sums of sets made of listed features."""
        at = np.searchsorted(self.features, features)
        return np.bincount(np.repeat(np.arange(len(sizes)), sizes), weights=self.weights[at], minlength=len(sizes))

    def above(self, scores: np.ndarray) -> np.ndarray:
        """For each score the probability of a grade above each threshold."""
        return 1 / (1 + np.exp(-np.clip(scores[:, None] - self.thresholds[None, :], -50, 50)))


def telling_features(text: np.ndarray, place: np.ndarray, high: np.ndarray, most: int) -> np.ndarray:
    """The ``most`` features whose presence tells most about ``high`` (0 or 1 for each text), by the G
    statistic of their two by two tables."""
    with_, n, n_high = np.bincount(place), len(high), high.sum()
    both = np.bincount(place, weights=high[text])
    cells = [both, with_ - both, n_high - both, n - with_ - n_high + both]
    margins = [with_ * n_high, with_ * (n - n_high), (n - with_) * n_high, (n - with_) * (n - n_high)]
    gain = sum(np.where(c > 0, c * np.log(np.maximum(c, 1) * n / np.maximum(m, 1)), 0.0) for c, m in zip(cells, margins))
    return np.sort(np.argsort(-gain, kind="stable")[:most])


def fit_ordinal(sizes: np.ndarray, features: np.ndarray, grades: np.ndarray, n_grades: int, *,
                rounds: int = 400, rate: float = 0.05, ridge: float = 0.3, least_texts: int = 3,
                most_features: int = 1000) -> OrdinalModel:
    """Penalised maximum likelihood by Adam over all given texts. Only the ``most_features`` that tell grade 0
    from others best, of those in at least ``least_texts`` texts, get a weight. Thresholds are a first one and
    positive steps, so that they stay in order."""
    text = np.repeat(np.arange(len(sizes)), sizes)
    active, place, texts_with = np.unique(features, return_inverse=True, return_counts=True)
    usual = texts_with >= least_texts
    text, place = text[usual[place]], (np.cumsum(usual) - 1)[place[usual[place]]]
    active = active[usual]
    chosen = np.full(len(active), -1)
    best = telling_features(text, place, (grades > 0).astype(float), most_features) if len(active) else chosen
    chosen[best] = np.arange(len(best))
    text, place, active = text[chosen[place] >= 0], chosen[place][chosen[place] >= 0], active[best]
    shares = np.array([(grades > j).mean() if len(grades) else 0.0 for j in range(n_grades - 1)])
    start = -np.log((shares + 1e-3) / (1 - shares + 1e-3))
    free = np.concatenate([np.zeros(len(active)), start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    m, first, second = len(active), np.zeros(len(free)), np.zeros(len(free))
    for step in range(1, rounds + 1 if len(grades) else 1):
        steps = np.exp(free[m + 1:])
        thresholds = free[m] + np.concatenate([[0.0], np.cumsum(steps)])
        score = np.bincount(text, weights=free[:m][place], minlength=len(sizes))
        above = OrdinalModel(active, free[:m], thresholds).above(score)
        upper = np.column_stack([np.ones(len(score)), above])[np.arange(len(score)), grades]
        lower = np.column_stack([above, np.zeros(len(score))])[np.arange(len(score)), grades]
        chance = np.maximum(upper - lower, 1e-12)
        # Derivatives of the log likelihood by the upper and the lower link's argument.
        du, dl = upper * (1 - upper) / chance, lower * (1 - lower) / chance
        by_threshold = np.array([dl[grades == j].sum() - du[grades == j + 1].sum() for j in range(n_grades - 1)])
        by_score = np.bincount(place, weights=(du - dl)[text], minlength=m) if m else np.zeros(0)
        slope = np.concatenate([
            by_score - ridge * free[:m], [by_threshold.sum()],
            [by_threshold[j:].sum() * steps[j - 1] for j in range(1, n_grades - 1)]]) / len(grades)
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        free = free + rate * (1 - step / (rounds + 1)) * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return OrdinalModel(active, free[:m], free[m] + np.concatenate([[0.0], np.cumsum(np.exp(free[m + 1:]))]))


def severity_grades(sizes: np.ndarray, features: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Grades 0 to 2 from labels of two values: 0 for texts that are not toxic, and for toxic ones 1, or 2 if
    they hold at least the median number of features that are ten times as frequent in toxic texts."""
    text = np.repeat(np.arange(len(sizes)), sizes)
    _, place = np.unique(features, return_inverse=True)
    of_toxic = np.bincount(place, weights=toxic[text])
    of_clean = np.bincount(place) - of_toxic
    n_toxic, n_clean = max(1, toxic.sum()), max(1, (1 - toxic).sum())
    telling = (of_toxic >= 5) & (of_toxic / n_toxic > 10 * of_clean / n_clean)
    hits = np.bincount(text, weights=telling[place], minlength=len(sizes))
    middle = np.median(hits[(toxic == 1) & (hits > 0)]) if ((toxic == 1) & (hits > 0)).any() else np.inf
    return np.where(toxic == 1, np.where(hits >= middle, 2, 1), 0)


def labelled_sets(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text",
                  label: str = "toxic", most: int = MOST_LABELLED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature sets and labels of at most ``most`` labelled documents, chosen by a hash of their key.

    A key is one document: of rows that share it, the one whose text has the least digest, so that the bound holds
    however often keys repeat. A key labelled several times has its greatest label. Null keys and null labels are passed
    over; a null text is an empty one; other columns are left out. Without labelled documents all three are empty.
    """
    marked = labels.select(named(key).alias("doc_id"), named(label).cast("int").alias("label")).where(
        "doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    plain = docs.select(named(key).alias("doc_id"), F.coalesce(named(text), F.lit("")).cast("binary").alias("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for low, high in slices(texts):
                n, sets = feature_sets(texts[low:high])
                lists = pa.ListArray.from_arrays(np.r_[0, np.cumsum(n)].astype(np.int32), pa.array(sets.astype(np.uint32).view(np.int32)))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(low, high - low), batch.column(1).slice(low, high - low), lists],
                    ["doc_id", "label", "features"])

    single = plain.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(
        F.first("label").alias("label"), F.min_by("text", F.struct(F.xxhash64("text"), F.octet_length("text"))).alias("text"))
    rows = single.mapInArrow(scan, "doc_id long, label int, features array<int>").toArrow().sort_by("doc_id")
    lists = rows.column("features").combine_chunks()
    features = lists.flatten().to_numpy().view(np.uint32).astype(np.int64)
    return lists.value_lengths().to_numpy().astype(np.int64), features, rows.column("label").to_numpy().astype(np.int64)


def grade_texts(docs: DataFrame, model: OrdinalModel, *, text: str = "text", cut: float = 0.5) -> DataFrame:
    """The input columns, ``expected_severity`` (the mean grade), ``toxic_probability`` (of a grade above 0),
    ``grade`` (the number of thresholds passed with a probability of ``cut``) and ``is_toxic``.

    A null text is an empty one, and is graded by the thresholds alone; so is a text of unknown words. Equal
    texts are graded equally; an empty table gives no rows. Input columns named like a result are replaced.
    """
    result = T.StructType([T.StructField("expected_severity", T.DoubleType()),
                           T.StructField("toxic_probability", T.DoubleType()), T.StructField("grade", T.IntegerType())])
    @F.pandas_udf(result)
    def graded(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            values = batch.tolist()
            scores = [model.scores(*feature_sets(values[low:high], model.features)) for low, high in slices(values)]
            above = model.above(np.concatenate(scores)) if scores else np.zeros((0, len(model.thresholds)))
            yield pd.DataFrame({"expected_severity": above.sum(axis=1), "toxic_probability": above[:, 0],
                                "grade": (above >= cut).sum(axis=1).astype(np.int32)})

    frame = packed(docs, octets=F.coalesce(named(text), F.lit("")).cast("binary"))
    scored = frame.select("row", graded("octets").alias("result"))
    fields = {n: F.col("result").getField(n) for n in ("expected_severity", "toxic_probability", "grade")}
    return unpacked(scored, docs.columns, fields | {"is_toxic": fields["toxic_probability"] >= cut})
