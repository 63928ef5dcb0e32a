"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; all other text, whatever it is, is unlabelled.  With the
class prior p, the risk of a scorer is p R+(pos) + max(0, R-(unlabelled) - p R-(pos)): the second
part estimates the loss on clean text, and is kept from falling below zero, where fitting would go on
only by memorising the positives.  The scorer is linear in the presence of features: whole words and word
beginnings, known by 62-bit hashes, that occur once, twice or four times.  What confirmed examples have
is counted over all documents, and features with evidence are kept.  numpy finds first weights
on a bounded sample; then the risk of unlabelled text and its slope are summed over all documents, and numpy
moves the weights by these, round for round.  Every document is scored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfact.llm.shared import in_batches, stored
from skyfact.llm.words import by_bytes, give_back, hash_words, member, spans, text_bytes

#: Labelled toxic documents that are fitted on, at most.
POSITIVES = 4000
#: Unlabelled documents that the first weights come from, and rounds over all of them that follow.
START, ROUNDS = 12000, 12
#: Most features of a model, and the evidence (in nats) that each needs: more than chance gives to the best of all.
FEATURES, LEAST_GAIN = 4000, 10.0
PREFIXES = (4, 5, 6, 7, 8)
#: A word gives a feature for each of these numbers of occurrences that a text reaches.
LEVELS = (1, 2, 4)
STEPS = 1000
DECAY = 0.05
MIN_PRIOR, MAX_PRIOR = 0.005, 0.5

_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
# letters, digits and all bytes of other scripts
_LETTER = np.array([48 <= c <= 57 or 97 <= c <= 122 or c >= 128 for c in range(256)])
_SIFT = np.uint64((1 << 20) - 1)


def presence(column: pa.ChunkedArray | pa.Array, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature) for what every text has, each once, by document; only of words in ``wanted`` (sorted).

    A feature is a word's hash with the level in its two lowest bits.
    """
    buf, offsets = text_bytes(column)
    buf = _LOWER[buf]
    start, end, doc = spans(_LETTER[buf], offsets)
    if wanted is not None:
        sieve = np.zeros(int(_SIFT) + 1, bool)
        sieve[(wanted >> np.uint64(2)) & _SIFT] = True
    docs, feats = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for h in hash_words(buf, start, end, PREFIXES):
        ok = np.flatnonzero(h != 0 if wanted is None else sieve[(h >> np.uint64(2)) & _SIFT])
        f = h[ok] & ~np.uint64(3)
        if wanted is not None:
            exact = member(f, wanted)
            ok, f = ok[exact], f[exact]
        docs.append(doc[ok])
        feats.append(f)
    d, f = np.concatenate(docs), np.concatenate(feats)
    order = np.lexsort((f, d))
    d, f = d[order], f[order]
    cuts = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (f[1:] != f[:-1])]) if len(d) else np.zeros(0, np.int64)
    n = np.diff(np.r_[cuts, len(d)])
    at = [cuts[n >= least] for least in LEVELS]
    level = np.repeat(np.arange(len(LEVELS), dtype=np.uint64), [len(a) for a in at])
    at = np.concatenate(at)
    order = np.argsort(d[at], kind="stable")
    return d[at][order], (f[at] | level)[order]


@dataclass
class Model:
    """Features (sorted), their weights, and the bias."""

    features: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, column) -> np.ndarray:
        doc, feat = presence(column, np.unique(self.features & ~np.uint64(3)))
        known = member(feat, self.features)
        doc, feat = doc[known], feat[known]
        z = np.bincount(doc, self.weights[np.searchsorted(self.features, feat)], len(column)) + self.bias
        return _sigmoid(z)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _sparse(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature number) of documents' feature numbers."""
    return np.repeat(np.arange(len(docs)), [len(x) for x in docs]), np.concatenate([np.zeros(0, np.int64), *docs]).astype(np.int64)


def unlabelled_risk(docs: tuple[np.ndarray, np.ndarray], n_docs: int, w: np.ndarray, b: float) -> tuple[float, np.ndarray]:
    """Summed loss of taking documents for clean, and its slope by each weight and the bias."""
    d, f = docs
    z = np.bincount(d, w[f], n_docs) + b
    slope = _sigmoid(z)
    return float(np.logaddexp(0, z).sum()), np.append(np.bincount(f, slope[d], len(w)), slope.sum())


class Fit:
    """Weights on the way to the least non-negative risk, by moments of the slopes."""

    def __init__(self, pos: list[np.ndarray], n: int, prior: float, decay: float):
        self.pos, self.n_pos, self.n, self.prior, self.decay = _sparse(pos), len(pos), n, prior, decay
        self.w, self.b = np.zeros(n), float(np.log(MIN_PRIOR))
        self.m, self.v, self.steps = np.zeros(n + 1), np.zeros(n + 1), 0

    def move(self, loss: float, slope: np.ndarray, rate: float) -> None:
        """One step, by the mean loss and slope of unlabelled text."""
        d, f = self.pos
        z = np.bincount(d, self.w[f], self.n_pos) + self.b
        # logistic loss: softplus(-z) for toxic, softplus(z) for clean
        if loss - self.prior * np.logaddexp(0, z).mean() >= 0:
            g = -self.prior * (_sigmoid(-z) + _sigmoid(z)) / self.n_pos
        else:  # step back from the part that went below zero
            g, slope = self.prior * _sigmoid(z) / self.n_pos, -slope
        g = np.append(np.bincount(f, g[d], self.n) + self.decay / self.n * self.w, g.sum()) + slope
        self.steps += 1
        self.m, self.v = 0.9 * self.m + 0.1 * g, 0.999 * self.v + 0.001 * g * g
        step = rate * (self.m / (1 - 0.9**self.steps)) / (np.sqrt(self.v / (1 - 0.999**self.steps)) + 1e-9)
        self.w, self.b = self.w - step[:-1], float(self.b - step[-1])


def fit(pos: list[np.ndarray], unl: list[np.ndarray], features: np.ndarray, prior: float, steps: int = STEPS, decay: float = DECAY, everywhere=None) -> Model:
    """Fit on the documents' present features.  Without positives nothing is toxic; without text neither.

    ``everywhere`` gives mean loss and slope of all unlabelled text for weights and a bias; with it, ROUNDS more steps follow.
    """
    features = np.sort(features)
    n_unl, n = len(unl), len(features)
    if not len(pos) or not n_unl or not n:
        return Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log(MIN_PRIOR)))
    numbers = lambda docs: [np.searchsorted(features, x) for x in docs]
    state, sample = Fit(numbers(pos), n, prior, decay), _sparse(numbers(unl))
    for _ in range(steps):
        loss, slope = unlabelled_risk(sample, n_unl, state.w, state.b)
        state.move(loss / n_unl, slope / n_unl, 0.05)
    for t in range(1, ROUNDS + 1 if everywhere else 1):
        state.move(*everywhere(state.w, state.b), 0.02 / t**0.5)
    return Model(features, state.w, state.b)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _counted(feature: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([_signed(feature), pa.array(n.astype(np.int64))], ["feature", "n"])


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, number) of rows of packed numbers."""
    return _sparse([np.frombuffer(x, np.uint32) for x in column.to_pylist()])


def _packed(row: np.ndarray, number: np.ndarray, n: int) -> pa.Array:
    cuts = np.searchsorted(row, np.arange(n + 1))
    number = number.astype(np.uint32)
    return pa.array([number[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())


def seen_in(positives: DataFrame) -> np.ndarray:
    """Features (sorted) that three or more of the texts have; as many as a bounded number of texts allows."""

    def count(batches):
        for batch in (part for b in batches for part in by_bytes(b)):
            yield _counted(*np.unique(presence(batch["text"])[1], return_counts=True))
        give_back()

    counts = positives.select("text").mapInArrow(count, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    return np.sort(np.asarray(counts.filter("n >= 3").select("feature").toArrow()["feature"], np.int64).view(np.uint64))


def _numbers_in(features: np.ndarray):
    """A function of a batch (text): document and number of each of the features (sorted) that its texts have."""
    bases = np.unique(features & ~np.uint64(3))

    def of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        doc, feat = presence(batch["text"], bases)
        ok = member(feat, features)
        return doc[ok], np.searchsorted(features, feat[ok])

    return of


def with_presence(docs: DataFrame, features: np.ndarray) -> DataFrame:
    """(id, text) -> id, feats: the numbers of the features (sorted) that each text has, packed."""
    numbers = _numbers_in(features)

    def run(batches):
        for batch in (part for b in batches for part in by_bytes(b)):
            yield pa.RecordBatch.from_arrays([batch["id"], _packed(*numbers(batch), batch.num_rows)], ["id", "feats"])
        give_back()

    return docs.select("id", "text").mapInArrow(run, "id long, feats binary")


def feature_counts(rows: DataFrame, n: int) -> np.ndarray:
    """How many rows (feats) have each of n features.  A task sends one row for each feature that it has seen."""
    return _counts(rows.select("feats"), n, lambda batch: [_lists(batch["feats"])[1]])


def text_counts(docs: DataFrame, features: np.ndarray) -> np.ndarray:
    """How many texts have each of the features (sorted).  What a single text has is kept nowhere."""
    numbers = _numbers_in(features)
    return _counts(docs.select("text"), len(features), lambda batch: (numbers(part)[1] for part in by_bytes(batch)))


def _counts(rows: DataFrame, n: int, numbers) -> np.ndarray:
    def count(batches):
        total = np.zeros(n, np.int64)
        for found in (x for batch in batches for x in numbers(batch)):
            total += np.bincount(found, minlength=n)
        at = np.flatnonzero(total)
        yield _counted(at, total[at])
        give_back()

    counts = rows.mapInArrow(count, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(n, np.int64)
    out[np.asarray(counts["feature"], np.int64)] = np.asarray(counts["n"], np.int64)
    return out


def chosen(features: np.ndarray, p: np.ndarray, n_pos: int, n: np.ndarray, n_docs: int, most: int = FEATURES, least_gain: float = LEAST_GAIN) -> np.ndarray:
    """Numbers (sorted) of the features that tell positives, of which p have each, from all text, of which n have.

    The gain is the number of positives times the divergence of the feature's presence in them from that in all.
    """
    p, q = (p + 0.5) / (n_pos + 1), (np.minimum(n, n_docs) + 0.5) / (n_docs + 1)
    gain = np.where(p > q, n_pos * (p * np.log(p / q) + (1 - p) * np.log((1 - p) / (1 - q))), 0)
    best = np.lexsort((features, -gain))[:most]
    return np.sort(best[gain[best] > least_gain])


def risk_everywhere(rows: DataFrame, n: int, n_docs: int):
    """A function of weights and bias: mean loss and slope of unlabelled text over all rows (feats), summed by Spark."""

    def at(w: np.ndarray, b: float) -> tuple[float, np.ndarray]:
        def run(batches):
            loss, slope = 0.0, np.zeros(n + 1)
            for batch in batches:
                more, by = unlabelled_risk(_lists(batch["feats"]), batch.num_rows, w, b)
                loss, slope = loss + more, slope + by
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(n + 2)), pa.array(np.append(slope, loss))], ["number", "sum"])

        total = rows.select("feats").mapInArrow(run, "number long, sum double").groupBy("number").agg(F.sum("sum").alias("sum")).toArrow()
        out = np.zeros(n + 2)
        out[np.asarray(total["number"], np.int64)] = np.asarray(total["sum"], np.float64)
        return out[-1] / n_docs, out[:-1] / n_docs

    return at


def train(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, start: int = START) -> Model:
    """Documents (id, text) and labels (id, toxic) -> model.

    The prior is the share of toxic among all labels.  The first ``positives`` toxic ids in the order of a digest are
    fitted on; of rows with one id, the least text stands for it.  All documents are the unlabelled text, whose features
    are counted and whose risk is measured over every row; the first weights come from ``start`` of them.
    Only the features that are chosen are stored for each document.
    """
    known = labels.filter("id IS NOT NULL AND toxic IS NOT NULL").groupBy("id").agg(F.max("toxic").alias("toxic"))
    count = known.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")).first()
    if not count.n or not count.toxic:
        return fit([], [], np.zeros(0, np.uint64), MIN_PRIOR)
    prior = min(max(count.toxic / count.n, MIN_PRIOR), MAX_PRIOR)
    drawn = lambda ids, n: F.broadcast(stored(ids.orderBy(F.xxhash64("id"), "id").limit(n), "toxicity-ids"))
    one = lambda df, ids, column: df.join(ids, "id").groupBy("id").agg(F.min(column).alias(column))
    # at most ``positives`` ids, and ``start``
    toxic, others = drawn(known.filter("toxic = 1").select("id"), positives), drawn(docs.select("id").filter("id IS NOT NULL").distinct(), start)
    examples = stored(one(in_batches(docs).select("id", "text"), toxic, "text"), "toxicity-examples")
    seen = seen_in(examples)
    n_pos, n_docs = examples.count(), docs.count()
    if not n_pos or not n_docs or not len(seen):
        return fit([], [], np.zeros(0, np.uint64), MIN_PRIOR)
    features = seen[chosen(seen, text_counts(examples, seen), n_pos, text_counts(docs, seen), n_docs)]
    # texts are read again for the few features that are chosen: what they have of all would take twice the input
    unlabelled = stored(with_presence(docs, features), "toxicity-chosen")
    sample = lambda ids: [features[np.frombuffer(f, np.uint32)] for f in sorted(one(unlabelled, ids, "feats").toArrow()["feats"].to_pylist())]
    return fit(sample(toxic), sample(others), features, prior, everywhere=risk_everywhere(unlabelled, len(features), n_docs))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(id, text) -> id, score (0 to 1), predicted; null and empty texts get the bias alone."""

    def run(batches):
        for batch in (part for b in batches for part in by_bytes(b)):
            s = model.score(batch["text"])
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["id", "score", "predicted"])
        give_back()

    return docs.select(F.col("id").cast("long").alias("id"), F.col("text").cast("string").alias("text")).transform(in_batches).mapInArrow(run, "id long, score double, predicted int")


def filtered(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of (text, ...) that the model doesn't find toxic, with all their columns."""

    def run(batches):
        for batch in (part for b in batches for part in by_bytes(b)):
            yield batch.filter(pa.array(model.score(batch["text"]) < 0.5))
        give_back()

    return in_batches(docs).mapInArrow(run, docs.schema)
