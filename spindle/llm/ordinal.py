"""Quality classifier: ordinal regression with a cumulative logit link.

All grades share one weight per hashed text feature; ordered thresholds part
the grades: P(grade <= k) = sigmoid(threshold_k - score).  Weights are at most
0: features count as defects, so a long text gains nothing by its length and
one without known defects keeps the best grade.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_batches, text_or_empty
from .shingles import mix, powers, word_hashes

FEATURE_BITS = 21
LEAST_STEPS = 500
BEGINNINGS = range(4, 13)  # bytes of a word's beginning that are features of their own
MIN_DOCS = 8  # a feature of fewer documents of the sample has no weight
MAX_LABELLED = 20_000  # rows that the model is fitted on at most; every document is scored
MAX_SENT = 1_000_000  # ids and grades that are sent to every task at most, 12 bytes each


def shape_values() -> np.ndarray:
    """What is hashed of each byte for a word's shape: nothing of letters, one value for digits, else the byte."""
    values = np.arange(1, 257, dtype=np.uint64)
    for first, last in (("a", "z"), ("A", "Z")):
        values[ord(first):ord(last) + 1] = 0
    values[0x80:] = 0
    values[ord("0"):ord("9") + 1] = 1
    return values


def letter_values() -> np.ndarray:
    """What is hashed of each byte for a word itself: letters in lower case (and all bytes outside ASCII)."""
    values = np.arange(1, 257, dtype=np.uint64)
    values[:0x80] = 0
    for first, last, low in (("a", "z", "a"), ("A", "Z", "a")):
        values[ord(first):ord(last) + 1] = np.arange(ord(low), ord(low) + 26)
    return values


SHAPES, LETTERS = shape_values(), letter_values()
CAPITALS = np.zeros(256, np.uint64)
CAPITALS[ord("A"):ord("Z") + 1] = 1


def beginnings(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed first bytes of every word that goes on after them, of each number of bytes in
    :data:`BEGINNINGS`, and the number of the text of each.

    A word is here a run of letters (and bytes outside ASCII), in lower case.  What
    words share by their stem stands in more texts than any one of their forms, so it
    can be learnt from few ratings."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    value = LETTERS[data]
    edge = np.diff((value != 0).view(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    owner = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts, side="right")
    total, found, owners = np.zeros(len(starts), np.uint64), [], []
    for k, factor in enumerate(powers(max(BEGINNINGS))):
        longer = ends - starts > k + 1
        starts, ends, owner, total = starts[longer], ends[longer], owner[longer], total[longer]
        total = total + value[starts + k] * factor
        if k + 1 in BEGINNINGS:
            found.append(mix(total + np.uint64(5000 + k)))
            owners.append(owner)
    return np.concatenate(found), np.concatenate(owners)


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed features of each text, one list after another, and their numbers.

    A text has its words (their letters alone, in lower case), the beginnings of
    words, the shapes of their other characters, the patterns of their capitals, the logarithm of how many
    words equal the word before, and the tenth of its words that are distinct."""
    words, counts = word_hashes(texts, LETTERS)
    shapes, _ = word_hashes(texts, SHAPES)
    capitals, _ = word_hashes(texts, CAPITALS)
    n = len(texts)
    owner = np.repeat(np.arange(n), counts)
    again = np.bincount(owner[1:][(words[1:] == words[:-1]) & (owner[1:] == owner[:-1])], minlength=n)
    order = np.lexsort([words, owner])
    fresh = np.ones(len(words), bool)
    fresh[1:] = (words[order][1:] != words[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    tenth = 10 * np.bincount(owner[order][fresh], minlength=n) // np.maximum(counts, 1)
    hashed = [words, mix(shapes + np.uint64(1)), mix(capitals + np.uint64(2)), mix(np.log2(again + 1).astype(np.uint64) + np.uint64(1000)), mix(tenth.astype(np.uint64) + np.uint64(2000))]
    owners = [owner, owner, owner, np.flatnonzero(counts), np.flatnonzero(counts)]
    hashed[3:] = [h[counts > 0] for h in hashed[3:]]
    starts, beginners = beginnings(texts)
    hashed.append(starts)
    owners.append(beginners)
    shift = np.uint64(64 - FEATURE_BITS)
    distinct = np.unique(np.concatenate([(o << FEATURE_BITS) | (h >> shift).astype(np.int64) for o, h in zip(owners, hashed, strict=True)]))
    return distinct & ((1 << FEATURE_BITS) - 1), np.bincount(distinct >> FEATURE_BITS, minlength=n)


def scores(ids: np.ndarray, counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sum of the weights of each text's features."""
    total = np.concatenate([[0.0], np.cumsum(weights[ids], dtype=np.float64)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def cumulative(score: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """``n x grades`` probabilities of at least each grade; that of the lowest is 1."""
    above = sigmoid(score[:, None] - thresholds[None, :])
    return np.concatenate([np.ones((len(score), 1)), above], axis=1)


def fit(ids: np.ndarray, counts: np.ndarray, grades: np.ndarray, n_grades: int, passes: int = 12, rate: float = 0.05, sparse: float = 1e-3, decay: float = 1e-4, batch: int = 256, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """``weights, thresholds`` by Adam over shuffled batches of the likelihood, grades weighted evenly.

    Weights are kept at most 0 and drawn to it (``sparse``: of the absolute value,
    ``decay``: of the square); the step size falls to 0.  Thresholds are the first
    and positive steps, so they stay in order.  Without ratings every text keeps
    the best grade as the likeliest.  Small samples get more passes."""
    n, size = len(counts), 1 << FEATURE_BITS
    kept = np.bincount(ids, minlength=size)[ids] >= MIN_DOCS
    counts, ids = np.bincount(np.repeat(np.arange(n), counts)[kept], minlength=n), ids[kept]
    weights = np.zeros(size, np.float64)
    cut = np.concatenate([[-float(n_grades)], np.zeros(max(n_grades - 2, 0))])  # first threshold, logs of the steps
    if not n or n_grades < 2:
        return weights, np.cumsum(np.concatenate([cut[:1], np.exp(cut[1:])]))[: max(n_grades - 1, 0)]
    share = np.bincount(grades, minlength=n_grades)
    balance = (n / np.maximum(share, 1) / (share > 0).sum())[grades]
    starts = np.cumsum(counts) - counts
    m, v, mc, vc = np.zeros(size), np.zeros(size), np.zeros(len(cut)), np.zeros(len(cut))
    passes = max(passes, -(-LEAST_STEPS // -(-n // batch)))
    rng, step, steps = np.random.default_rng(seed), 0, passes * -(-n // batch)
    for _ in range(passes):
        order = rng.permutation(n)
        for at in range(0, n, batch):
            rows = order[at:at + batch]
            c = counts[rows]
            own = ids[np.repeat(starts[rows] - (np.cumsum(c) - c), c) + np.arange(c.sum())]
            thresholds = np.cumsum(np.concatenate([cut[:1], np.exp(cut[1:])]))
            s = scores(own, c, weights)
            above = np.concatenate([np.ones((len(rows), 1)), sigmoid(s[:, None] - thresholds), np.zeros((len(rows), 1))], axis=1)
            y = grades[rows]
            k = np.arange(len(rows))
            chance = np.maximum(above[k, y] - above[k, y + 1], 1e-9)
            slope = above * (1 - above)  # of each cumulative probability by the score
            w = balance[rows] / len(rows)
            by_score = -(slope[k, y] - slope[k, y + 1]) / chance * w
            by_threshold = np.zeros((len(rows), n_grades + 1))
            by_threshold[k, y] += slope[k, y] / chance * w
            by_threshold[k, y + 1] -= slope[k, y + 1] / chance * w
            t = by_threshold[:, 1:n_grades].sum(axis=0)
            by_cut = np.cumsum(t[::-1])[::-1] * np.concatenate([[1.0], np.exp(cut[1:])])
            own_rate = rate * (1 - step / steps)
            step += 1
            touched, where = np.unique(own, return_inverse=True)
            g = np.bincount(where, weights=np.repeat(by_score, c), minlength=len(touched)) + decay * weights[touched] + sparse * np.sign(weights[touched])
            m[touched] = 0.9 * m[touched] + 0.1 * g
            v[touched] = 0.999 * v[touched] + 0.001 * g * g
            fix1, fix2 = 1 - 0.9**step, 1 - 0.999**step
            weights[touched] = np.minimum(weights[touched] - own_rate * (m[touched] / fix1) / (np.sqrt(v[touched] / fix2) + 1e-8), 0)
            mc, vc = 0.9 * mc + 0.1 * by_cut, 0.999 * vc + 0.001 * by_cut**2
            cut = cut - own_rate * (mc / fix1) / (np.sqrt(vc / fix2) + 1e-8)
    return weights, np.cumsum(np.concatenate([cut[:1], np.exp(cut[1:])]))


def grade_of(quality: Column, toxic: Column) -> Column:
    """Rating 0: poor; 1: well written, but toxic; 2: well written and clean.  Null where quality is unknown."""
    return F.when(quality == 0, 0).when((quality == 1) & (toxic == 1), 1).when(quality == 1, 2).cast("int")


Model = tuple[list[int], list[float], list[float], float]
KEEP_BEST = 0.995  # share of the sample's documents of the best grade that the selection keeps at least
ROUNDING = 1e-9  # equal texts' sums differ by less, with what stands beside them in a batch


def train(docs: DataFrame, ratings: DataFrame, max_rows: int = MAX_LABELLED, n_grades: int = 3) -> Model:
    """Features with a weight, their weights, the thresholds and the least tail probability to select,
    from rated documents (``doc_id, grade``).

    That least probability is the highest at which the sample's best documents are
    kept (:data:`KEEP_BEST`), so others are let through as little as that allows;
    it is 0.5 where the sample has none.
    At most ``max_rows`` ratings are used, chosen by a hash of ``doc_id``; repeated
    ratings of a document count once, the lowest.  The sample's ids and grades go to
    every task, as they are at most ``max_rows`` pairs of numbers (more than
    :data:`MAX_SENT` are joined by a shuffle), and only features of the sampled texts
    move.  Of rows that repeat an id, one counts: that of least features.  One task
    fits the model, on the hashed features of that bounded sample; null ids and grades
    are left out."""
    rated = ratings.filter("doc_id is not null and grade is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("grade").alias("grade"))
    sample = rated.orderBy(F.xxhash64("doc_id", F.lit(17)), "doc_id").limit(max_rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    texts = texts.join(F.broadcast(sample) if max_rows <= MAX_SENT else sample, "doc_id").select("doc_id", "text", "grade")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, held in text_batches(batch.column("text").to_pylist()):
                ids, counts = features(held)
                rows = batch.slice(first, len(held))
                lists = [x.astype("<u4").tobytes() for x in np.split(ids, np.cumsum(counts)[:-1])]
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("grade"), pa.array(lists, pa.binary())], ["doc_id", "grade", "ids"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r["doc_id"], r["grade"], r["ids"]) for batch in batches for r in batch.to_pylist())  # any order of arrival gives one model
        lists = [np.frombuffer(x, "<u4").astype(np.int64) for _, _, x in rows]
        ids, counts, grades = np.concatenate([*lists, np.zeros(0, np.int64)]), np.array([len(x) for x in lists], np.int64), np.array([g for _, g, _ in rows], np.int64)
        weights, thresholds = fit(ids, counts, grades, n_grades)
        tail = cumulative(scores(ids, counts, weights), thresholds)[grades == n_grades - 1, -1]
        least = np.quantile(tail, 1 - KEEP_BEST, method="lower") - ROUNDING if len(tail) else 0.5
        some = np.flatnonzero(weights)
        yield pa.RecordBatch.from_pylist([{"features": some.tolist(), "weights": weights[some].tolist(), "thresholds": thresholds.tolist(), "least": least}],
                                         pa.schema([("features", pa.list_(pa.int64())), ("weights", pa.list_(pa.float64())), ("thresholds", pa.list_(pa.float64())), ("least", pa.float64())]))

    found = texts.mapInArrow(extract, "doc_id long, grade int, ids binary")
    sampled = found.groupBy("doc_id").agg(F.min(F.struct("ids", "grade")).alias("row")).select("doc_id", "row.grade", "row.ids").repartition(1)
    return tuple(sampled.mapInArrow(learn, "features array<long>, weights array<double>, thresholds array<double>, least double").collect()[0])


def score_documents(docs: DataFrame, model: Model, at_least: int = 2, min_tail: float | None = None) -> DataFrame:
    """The rows of ``docs`` with their columns, and ``expected_grade, tail_probability, selected``.

    ``tail_probability`` is that of grade ``at_least`` or more; a document is
    selected if it reaches ``min_tail`` (default: the model's).  A null text is empty; a text without
    words has score 0.  Equal texts have equal scores.  Columns of ``docs`` with
    the new names are replaced."""
    docs = docs.drop("expected_grade", "tail_probability", "selected")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most one number per hashed feature
    columns, least = docs.columns, model[3] if min_tail is None else min_tail

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, values, cuts = map(np.array, shared.value[:3])
        weights = np.zeros(1 << FEATURE_BITS)
        weights[some.astype(np.int64)] = values
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column(columns.index("text")).to_pylist()]
            for first, held in text_batches(texts):
                above = cumulative(scores(*features(held), weights), cuts)
                rows = batch.slice(first, len(held))
                tail = above[:, min(at_least, above.shape[1] - 1)]
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(above[:, 1:].sum(axis=1)), pa.array(tail), pa.array(tail >= least)],
                                                 [*columns, "expected_grade", "tail_probability", "selected"])

    schema = copy.deepcopy(docs.schema).add("expected_grade", "double").add("tail_probability", "double").add("selected", "boolean")
    return docs.mapInArrow(run, schema)
