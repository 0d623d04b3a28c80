"""Quality classifier: naive Bayes support vectors over hashed n-gram indicators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sumstone.llm.common import (
    joined,
    lower_ascii,
    mixed,
    range_hashes,
    row_ranges,
    text_bytes,
    word_ranges,
)

#: Labelled rows that the classifier is fitted on, about.
SAMPLE = 20_000
#: Parts of the sample that are left out in turn to learn how margins become chances.
FOLDS = 3
#: Hash buckets of lower-cased words.
WORDS = 1 << 16
#: Form codes of a word: repeats its predecessor or not, case, ending.
FORMS = 32
FEATURES = WORDS + FORMS + FORMS**2 + FORMS**3

_CHUNK = 1 << 20


def features(data: np.ndarray, offs: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Row (from 0) and feature of each distinct n-gram of the rows ``lo`` to ``hi``.

    The n-grams are lower-cased words, and runs of one to three word forms.  Runs do not cross
    documents.
    """
    buffer, starts, ends = joined(data, offs, lo, hi, b" ")
    first, last = word_ranges(buffer)
    if not len(first):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    row = np.searchsorted(ends, first, "right")
    low = lower_ascii(buffer)
    word = range_hashes(low, first, last)
    after = row[1:] == row[:-1]

    upper = np.concatenate([[0], np.cumsum(low != buffer)])
    small = np.concatenate([[0], np.cumsum((buffer >= 97) & (buffer <= 122))])
    digit = np.concatenate([[0], np.cumsum((buffer >= 48) & (buffer <= 57))])
    high = np.concatenate([[0], np.cumsum(buffer >= 128)])
    within = lambda sums: sums[last] - sums[first]
    uppers, smalls, digits = within(upper), within(small), within(digit)
    case = np.where(uppers == 0, 0, np.where((smalls == 0) & (uppers > 1), 2, 1))
    end = buffer[last - 1]
    ending = np.zeros(len(first), np.int64)
    ending[(end == 46) | (end == 44) | (end == 63)] = 1
    ending[end == 33] = 2
    ending[digits > 0] = 3
    ending[(uppers + smalls + digits + within(high)) == 0] = 4
    same = np.zeros(len(first), np.int64)
    same[1:] = (word[1:] == word[:-1]) & after
    form = (same * 3 + case) * 5 + ending

    pairs = form[:-1] * FORMS + form[1:]
    threes = pairs[:-1] * FORMS + form[2:]
    both = after[:-1] & after[1:]
    feature = np.concatenate(
        [
            (mixed(word) >> np.uint64(48)).astype(np.int64),
            WORDS + form,
            WORDS + FORMS + pairs[after],
            WORDS + FORMS + FORMS**2 + threes[both],
        ]
    )
    owner = np.concatenate([row, row, row[:-1][after], row[:-2][both]])
    key = np.unique((owner.astype(np.int64) << 18) | feature)
    return key >> 18, key & ((1 << 18) - 1)


def log_count_ratios(ids: list[np.ndarray], label: np.ndarray) -> np.ndarray:
    """Log of how much likelier each indicator is in class 1 than in class 0, smoothed by one."""
    sums = [np.ones(FEATURES), np.ones(FEATURES)]
    for one, own in zip(label, ids):
        sums[one][own] += 1
    return np.log(sums[1] / sums[1].sum()) - np.log(sums[0] / sums[0].sum())


def dual_descent(
    ids: list[np.ndarray], label: np.ndarray, ratio: np.ndarray, cost: float = 10.0, passes: int = 12
) -> np.ndarray:
    """Weights of the scaled indicators by dual coordinate descent on the hinge loss.

    One dual variable a row, bounded by ``cost``; each step solves its row exactly and moves the
    weights along that row (Hsieh et al. 2008).  Rows have unit length.
    """
    weight = np.zeros(FEATURES)
    rows = [ratio[own] / max(1e-12, np.sqrt((ratio[own] ** 2).sum())) for own in ids]
    sign = np.where(label == 1, 1.0, -1.0)
    alpha = np.zeros(len(ids))
    order = np.random.default_rng(7)
    for _ in range(passes):
        moved = 0.0
        for i in order.permutation(len(ids)):
            gradient = sign[i] * (weight[ids[i]] @ rows[i]) - 1
            new = min(max(alpha[i] - gradient, 0.0), cost)
            if new != alpha[i]:
                weight[ids[i]] += (new - alpha[i]) * sign[i] * rows[i]
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return weight


def sigmoid_of_margins(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve that turns margins into chances (Newton steps)."""
    ones = label.sum()
    aim = np.where(label == 1, (ones + 1) / (ones + 2), 1 / (len(label) - ones + 2))
    slope, offset = 1.0, 0.0
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(slope * margin + offset, -30, 30)))
        miss, bend = aim - chance, chance * (1 - chance) + 1e-9
        grad = np.array([(miss * margin).sum(), miss.sum()])
        hess = np.array(
            [[(bend * margin**2).sum(), (bend * margin).sum()], [(bend * margin).sum(), bend.sum()]]
        )
        step = np.linalg.solve(hess + 1e-6 * np.eye(2), grad)
        slope, offset = slope + step[0], offset + step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(slope), float(offset)


def margins(
    data: np.ndarray, offs: np.ndarray, weight: np.ndarray, ratio: np.ndarray
) -> np.ndarray:
    """Signed distance of each text; 0 for a text without words."""
    out = np.zeros(len(offs) - 1)
    pull, square = weight * ratio, ratio * ratio
    for lo, hi in row_ranges(np.diff(offs), _CHUNK):
        row, feature = features(data, offs, lo, hi)
        length = np.bincount(row, weights=square[feature], minlength=hi - lo)
        total = np.bincount(row, weights=pull[feature], minlength=hi - lo)
        out[lo:hi] = total / np.sqrt(np.maximum(length, 1e-24))
    return out


def fit(
    docs: DataFrame, labels: DataFrame, text: str, key: str, label: str, sample: int = SAMPLE
) -> dict:
    """Fit on about ``sample`` labelled rows; the rest of ``labels`` teaches nothing.

    Rows are chosen by the hash of their key.  The sample is small by construction, so it is
    broadcast to the scan of ``docs`` and its indicators are gathered in one task.  Null labels, and
    labels without a document, are left out; of several labels of one key the largest counts.
    """
    known = labels.filter(F.col(label).isin(0, 1)).groupBy(key).agg(F.max(label).alias("_label"))
    total = known.count()
    share = int((1 << 30) * min(1.0, sample / max(1, total)))
    chosen = known.filter(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < share)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = text_bytes(batch.column("text"))
            for lo, hi in row_ranges(np.diff(offs), _CHUNK):
                row, feature = features(data, offs, lo, hi)
                cuts = np.searchsorted(row, np.arange(1, hi - lo))
                ids = [x.astype("<i4").tobytes() for x in np.split(feature, cuts)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("label").slice(lo, hi - lo), pa.array(ids, pa.binary())],
                    ["label", "ids"],
                )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label, ids = [], []
        for batch in batches:
            label += batch.column("label").to_pylist()
            ids += [np.frombuffer(x, "<i4") for x in batch.column("ids").to_pylist()]
        order = sorted(range(len(ids)), key=lambda i: (ids[i].tobytes(), label[i]))
        order = np.random.default_rng(3).permutation(np.array(order, np.int64))
        label, ids = np.array(label, np.int64)[order], [ids[i] for i in order]
        if len(set(label.tolist())) < 2:
            constant = float(label.mean()) if len(label) else 0.5
            yield pa.RecordBatch.from_pydict(
                {"weight": [b""], "ratio": [b""], "slope": [0.0], "offset": [constant]}
            )
            return
        margin = np.zeros(len(ids))
        for fold in range(FOLDS):  # margins of rows that the fitted weights have not seen
            seen = np.flatnonzero(np.arange(len(ids)) % FOLDS != fold)
            if len(set(label[seen].tolist())) < 2:
                seen = np.arange(len(ids))
            rest = [ids[i] for i in seen]
            ratio = log_count_ratios(rest, label[seen])
            weight = dual_descent(rest, label[seen], ratio)
            for i in range(fold, len(ids), FOLDS):
                length = max(1e-12, np.sqrt((ratio[ids[i]] ** 2).sum()))
                margin[i] = weight[ids[i]] @ ratio[ids[i]] / length
        slope, offset = sigmoid_of_margins(margin, label)
        ratio = log_count_ratios(ids, label)
        weight = dual_descent(ids, label, ratio)
        yield pa.RecordBatch.from_pydict(
            {
                "weight": [weight.astype("<f4").tobytes()],
                "ratio": [ratio.astype("<f4").tobytes()],
                "slope": [slope],
                "offset": [offset],
            }
        )

    texts = docs.join(F.broadcast(chosen), key).select(F.col(text).alias("text"), F.col("_label").alias("label"))
    rows = texts.mapInArrow(extract, "label int, ids binary").repartition(1)
    schema = "weight binary, ratio binary, slope double, offset double"
    return rows.mapInArrow(learn, schema).first().asDict()


def score(docs: DataFrame, text: str, model: dict, carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` of ``docs`` (all if not given) with ``score``: the chance of label 1.

    Every whole text is scored, a null as an empty one, and an empty text by the curve's offset.
    Without labels of both classes each score is the mean label (0.5 if there is none).
    """
    carry = [c for c in carry or docs.columns if c != "score"]
    if not model["weight"]:
        return docs.select(*carry).withColumn("score", F.lit(float(model["offset"])))
    frozen = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = frozen.value
        weight = np.frombuffer(fitted["weight"], "<f4").astype(np.float64)
        ratio = np.frombuffer(fitted["ratio"], "<f4").astype(np.float64)
        for batch in batches:
            margin = margins(*text_bytes(batch.column(text)), weight, ratio)
            curve = np.clip(fitted["slope"] * margin + fitted["offset"], -50, 50)
            columns = [batch.column(c) for c in carry]
            columns.append(pa.array(1 / (1 + np.exp(-curve))))
            yield pa.RecordBatch.from_arrays(columns, [*carry, "score"])

    schema = StructType(list(docs.select(*carry).schema.fields)).add("score", "double")
    return docs.select(*dict.fromkeys([*carry, text])).mapInArrow(run, schema)


def accepted(score: Column, threshold: float = 0.3) -> Column:
    """1 where the score reaches the threshold, else 0."""
    return F.when(score >= threshold, 1).otherwise(0)
