"""Toxicity (operator 3) by a classifier chain of linear models.

Categories are predicted in order; each later model also gets the earlier
categories' probabilities. In training those are out-of-fold predictions, as
unsure as they will be on new texts; in scoring they are the earlier models'
own. The categories are the label columns the table offers: ``unfit`` (quality
0), then ``toxic``, which decides. Features are hashed words and the first
letters of longer words, weighted by the root of their share of the text and
by their log odds in the category (so that rare telling words count), with
unit length per text. The cut for rejecting is the one with the best F1 score
on the out-of-fold predictions.

The models are fitted on at most ``SAMPLE_ROWS`` labelled rows, a documented
bound, so that one task fits them in bounded memory: of each combination of
labels the ``LEAST_ROWS`` with the least digest of doc_id, so that rare ones are
there, then others by that digest. Where that makes a combination's share larger
than it is among all labels, its rows weigh less when the cut is chosen. Scoring
is a map over all rows and whole texts, without a shuffle; a model is
``CATEGORIES`` x ``BUCKETS`` numbers.

Defined results: a null text or one without words has probability 0 in all
categories and is kept; a category that lacks labels of both kinds in some fold
has probability 0 and tells the later ones nothing, and rejects no document if it
is the last one; of repeated labels of a doc_id the larger counts, for each
category by itself; extra columns are kept.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blockload.llm.runtime import pick, ship, staged, tidy

SAMPLE_ROWS = 6000
LEAST_ROWS = 200        # of each combination of labels
BUCKETS = 1 << 18
PREFIX = 5
FOLDS = 3
STEPS = 60
RATE, MOMENTUM, RIDGE, SMOOTH = 2.0, 0.9, 1e-4, 0.05
KNOWN_WORDS = 100_000

FEATURES = "doc_id long, labels array<double>, weight double, columns binary, values binary"
MODEL = "category int, bias double, earlier array<double>, weights binary, cut double"

LETTERS = re.compile(r"[^\W\d_]+")
_KNOWN: dict[str, tuple[int, int]] = {}


def _places(word: str) -> tuple[int, int]:
    """Buckets of a word and of its first letters (-1: a short word)."""
    known = _KNOWN.get(word)
    if known is None:
        if len(_KNOWN) > KNOWN_WORDS:
            _KNOWN.clear()
        head = zlib.crc32(("^" + word[:PREFIX]).encode()) % BUCKETS if len(word) >= PREFIX else -1
        known = _KNOWN[word] = (zlib.crc32(word.encode()) % BUCKETS, head)
    return known


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Columns and values of a text, values of unit length."""
    counts = Counter(LETTERS.findall((text or "").lower()))
    if not counts:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    places = np.array([_places(w) for w in counts], np.int64)
    n = np.fromiter(counts.values(), np.float64, len(counts))
    long = places[:, 1] >= 0
    columns, at = np.unique(np.concatenate([places[:, 0], places[long, 1]]), return_inverse=True)
    values = np.sqrt(np.bincount(at, np.concatenate([n, n[long]])))
    return columns.astype(np.int32), (values / np.linalg.norm(values)).astype(np.float32)


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [features(t.as_py()) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("labels"), batch.column("weight"), pa.array([c.tobytes() for c, _ in made], pa.binary()),
             pa.array([v.tobytes() for _, v in made], pa.binary())], names=["doc_id", "labels", "weight", "columns", "values"])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Sample:
    """The labelled rows as a sparse matrix in coordinates."""

    def __init__(self, columns: list[np.ndarray], values: list[np.ndarray]) -> None:
        self.n = len(columns)
        self.row = np.repeat(np.arange(self.n), [len(c) for c in columns])
        self.col = np.concatenate(columns) if columns else np.zeros(0, np.int32)
        self.val = np.concatenate(values).astype(np.float64) if values else np.zeros(0)

    def fit(self, y: np.ndarray, extra: np.ndarray, use: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Logistic regression on the rows ``use`` with balanced classes, by
        accelerated gradient steps over log-odds-weighted features."""
        m = use[self.row]
        row, col, val = self.row[m], self.col[m], self.val[m]
        pos = np.bincount(col, val * y[row], BUCKETS) + SMOOTH
        neg = np.bincount(col, val * (1 - y[row]), BUCKETS) + SMOOTH
        odds = np.log(pos / pos.sum()) - np.log(neg / neg.sum())
        x = val * odds[col]
        share, n = y[use].mean(), use.sum()
        weigh = np.where(y > 0, 0.5 / share, 0.5 / (1 - share)) * use / n
        w, dw = np.zeros(BUCKETS), np.zeros(BUCKETS)
        e, de = np.zeros(extra.shape[1]), np.zeros(extra.shape[1])
        b = db = 0.0
        for _ in range(STEPS):
            wl, el, bl = w + MOMENTUM * dw, e + MOMENTUM * de, b + MOMENTUM * db
            z = np.bincount(row, x * wl[col], self.n) + extra @ el + bl
            g = (_sigmoid(z) - y) * weigh
            dw = MOMENTUM * dw - RATE * (np.bincount(col, x * g[row], BUCKETS) + RIDGE * wl)
            de = MOMENTUM * de - RATE * (extra.T @ g + RIDGE * el)
            db = MOMENTUM * db - RATE * g.sum()
            w, e, b = w + dw, e + de, b + db
        return w * odds, e, b

    def predict(self, w: np.ndarray, e: np.ndarray, b: float, extra: np.ndarray) -> np.ndarray:
        return _sigmoid(np.bincount(self.row, self.val * w[self.col], self.n) + extra @ e + b)


def best_cut(y: np.ndarray, p: np.ndarray, weight: np.ndarray) -> float:
    """The cut with the best F1 score, in the middle of its gap."""
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum((weight * y)[order])
    f1 = 2 * hits / (np.cumsum(weight[order]) + (weight * y).sum())
    k = int(f1.argmax())
    below = p[order[k + 1]] if k + 1 < len(p) else 0.0
    return float((p[order[k]] + below) / 2)


def fit_chain(sample: Sample, labels: np.ndarray, fold: np.ndarray, weight: np.ndarray) -> dict[int, tuple]:
    """(bias, weights of the earlier probabilities, weights, cut) per category;
    one that cannot be fitted in every fold is left out, its probability 0."""
    models, earlier = {}, np.zeros((sample.n, 0))
    for k in range(labels.shape[1]):
        y, out = labels[:, k], np.zeros(sample.n)
        if all(0 < part.sum() < len(part) for part in (y[fold != f] for f in range(FOLDS))):
            for f in range(FOLDS):
                held = fold == f
                out[held] = sample.predict(*sample.fit(y, earlier, ~held), earlier)[held]
            w, e, b = sample.fit(y, earlier, np.ones(sample.n, bool))
            models[k] = (b, e.tolist(), w.astype(np.float32), best_cut(y, out, weight))
        earlier = np.column_stack([earlier, out])
    return models


def _trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: (r["doc_id"], r["columns"]))
    if rows:
        sample = Sample([np.frombuffer(r["columns"], np.int32) for r in rows],
                        [np.frombuffer(r["values"], np.float32) for r in rows])
        fold = np.array([zlib.crc32(str(r["doc_id"]).encode()) % FOLDS for r in rows])
        labels, weight = np.array([r["labels"] for r in rows], float), np.array([r["weight"] for r in rows])
        for k, (b, e, w, cut) in fit_chain(sample, labels, fold, weight).items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int32()), pa.array([b]), pa.array([e], pa.list_(pa.float64())),
                 pa.array([w.tobytes()], pa.binary()), pa.array([cut])],
                names=["category", "bias", "earlier", "weights", "cut"])


def train(docs: DataFrame, labels: DataFrame, categories: list[Column], sample_rows: int = SAMPLE_ROWS) -> list:
    """The chain's models, fitted in one task on a bounded sample."""
    ship(docs.sparkSession)
    names = [f"c{k}" for k in range(len(categories))]
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                          *[c.cast("double").alias(n) for n, c in zip(names, categories)])
    known = known.dropna().groupBy("doc_id").agg(*[F.max(n).alias(n) for n in names]).select(
        "doc_id", F.array(*names).alias("labels"))
    known = staged(known, "known-labels")
    digest = [F.xxhash64("doc_id"), "doc_id"]
    # Spark cuts each combination to sample_rows before it numbers them.
    place = F.row_number().over(Window.partitionBy("labels").orderBy(*digest))
    known_sample = known.withColumn("place", place).where(F.col("place") <= sample_rows)
    known_sample = staged(known_sample.orderBy(F.col("place") > LEAST_ROWS, *digest).limit(sample_rows), "label-sample")
    # As many rows as there are combinations of labels.
    share = known.groupBy("labels").agg(F.count(F.lit(1)).alias("all")).join(
        known_sample.groupBy("labels").agg(F.count(F.lit(1)).alias("some")), "labels")
    weighed = known_sample.join(share, "labels").select(
        "doc_id", "labels", (F.col("all") / F.col("some")).cast("double").alias("weight"))
    rows = pick(docs, "doc_id", "text").join(F.broadcast(weighed), "doc_id").select(   # sample_rows at most
        F.col("doc_id").cast("long").alias("doc_id"), "text", "labels", "weight")
    made = rows.mapInArrow(tidy(_featured, _KNOWN), FEATURES).orderBy(F.xxhash64("doc_id"), "doc_id", "columns").limit(sample_rows)
    return sorted(made.mapInArrow(tidy(_trained), MODEL).collect(), key=lambda m: m.category)


def _scorer(models: list, names: list[str]):
    fitted = {m.category: (m.bias, list(m.earlier), np.frombuffer(m.weights, np.float32).astype(np.float64), m.cut)
              for m in models}
    chain = [fitted.get(k) for k in range(len(names))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            probs: list[list[float]] = [[] for _ in names]
            hit = []
            for text in batch.column("text"):
                columns, values = features(text.as_py())
                row: list[float] = []
                for model in chain if len(columns) else []:
                    if model is None:
                        row.append(0.0)
                        continue
                    b, e, w, _ = model
                    z = float(values @ w[columns]) + b + sum(x * p for x, p in zip(e, row))
                    row.append(float(_sigmoid(np.float64(z))))
                hit.append(bool(row) and chain[-1] is not None and row[-1] >= chain[-1][3])
                for out, p in zip(probs, row or [0.0] * len(names)):
                    out.append(p)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(p, pa.float64()) for p in probs], pa.array(hit, pa.bool_())],
                names=[*batch.schema.names, *names, "rejected"])
    return run


def score(docs: DataFrame, models: list, names: list[str]) -> DataFrame:
    """``docs`` with one probability column per category, and ``rejected``."""
    ship(docs.sparkSession)
    docs = docs.drop(*[c for c in docs.columns if c.lower() in {*names, "rejected"}])
    added = [*[T.StructField(n, T.DoubleType()) for n in names], T.StructField("rejected", T.BooleanType())]
    return docs.mapInArrow(tidy(_scorer(models, names), _KNOWN), T.StructType([*docs.schema.fields, *added]))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with p_unfit, p_toxic and rejected, from a chain fitted on
    ``labels`` (doc_id, quality, toxic)."""
    models = train(docs, labels, [F.coalesce(F.col("quality") == 0, F.lit(False)), F.col("toxic") == 1])
    return score(docs, models, ["p_unfit", "p_toxic"])
