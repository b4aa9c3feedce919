"""A quality classifier trained by co-training: one view of the text, one of what is known about it."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapwise.llm.shingles import words_of
from gapwise.llm.spans import buffers
from gapwise.llm.staging import spare

#: Buckets for the values of the two names in the metadata.
LANGS, SOURCES = 16, 64
CONTENT = 13
_CLASS = np.zeros((256, 8), np.float32)
for _i, _own in enumerate(
    (range(97, 123), range(65, 91), range(48, 58), (32, 9, 13), (10,), (44, 46), (33, 63, 58, 59, 39, 34, 40, 41, 45), range(128, 256))
):
    _CLASS[list(_own), _i] = 1


def content_features(texts: pa.Array) -> np.ndarray:
    """Shares of kinds of characters, and how words repeat, for each text (null: empty)."""
    out = np.zeros((len(texts), CONTENT), np.float64)
    data, offsets = buffers(texts)
    for i, words in enumerate(words_of(texts)):
        own = data[offsets[i] : offsets[i + 1]]
        if not len(own):
            continue
        kinds = np.bincount(own, minlength=256) @ _CLASS / len(own)
        out[i, :8] = kinds
        out[i, 8] = 1 - kinds.sum()  # symbols
        out[i, 9] = min(1.0, np.log1p(len(words)) / 12)
        if len(words):
            ordered = np.sort(words)
            edges = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1], [True]]))
            out[i, 10] = (len(edges) - 1) / len(words)
            out[i, 11] = np.diff(edges).max() / len(words)
            out[i, 12] = (words[1:] == words[:-1]).mean() if len(words) > 1 else 0
    return out


def metadata_features(lang: pa.Array, source: pa.Array, n_chars: pa.Array) -> np.ndarray:
    """One-hot buckets of language and source (null is one more), and the length given."""
    out = np.zeros((len(lang), LANGS + SOURCES + 3), np.float64)
    rows = np.arange(len(lang))
    out[rows, [_bucket(x, LANGS) for x in lang.to_pylist()]] = 1
    out[rows, [LANGS + 1 + _bucket(x, SOURCES) for x in source.to_pylist()]] = 1
    size = np.array([0 if x is None else max(0, x) for x in n_chars.to_pylist()], np.float64)
    out[:, -1] = np.log1p(size) / 15
    return out


def _bucket(name: str | None, n: int) -> int:
    import zlib

    return n if name is None else zlib.crc32(name.encode()) % n


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _newton(x: np.ndarray, y: np.ndarray, penalty: np.ndarray, prior: np.ndarray, steps: int = 50) -> np.ndarray:
    """Weights of least logistic loss, with a quadratic penalty for leaving `prior`; each step lowers the loss."""

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((np.logaddexp(0, z) - y * z).sum() + 0.5 * (penalty * (w - prior) ** 2).sum())

    w, now = prior.copy(), loss(prior)
    for _ in range(steps):
        p = _sigmoid(x @ w)
        slope = x.T @ (p - y) + penalty * (w - prior)
        step = np.linalg.solve(x.T @ (x * (p * (1 - p) + 1e-6)[:, None]) + np.diag(penalty), slope)
        size = 1.0
        while size > 1e-4 and (then := loss(w - size * step)) > now:
            size /= 2
        if size <= 1e-4 or now - then < 1e-9 * (1 + abs(now)):
            break
        w, now = w - size * step, then
    return w


@dataclass
class View:
    """A logistic model over features and how far they reach beyond some of their own quantiles."""

    knots: np.ndarray
    weights: np.ndarray

    @staticmethod
    def _wide(x: np.ndarray, knots: np.ndarray) -> np.ndarray:
        reach = np.maximum(x[:, None, :] - knots[None], 0).reshape(len(x), knots.size)
        return np.hstack([np.ones((len(x), 1)), x, reach])

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, ridge: float = 0.1, steps: int = 30) -> View:
        knots = np.quantile(x, (0.02, 0.1, 0.5, 0.9, 0.98), axis=0)
        wide = cls._wide(x, knots)
        penalty = np.full(wide.shape[1], ridge)
        penalty[0] = 1e-6
        w = _newton(wide, y, penalty, np.zeros(wide.shape[1]), steps)
        return cls(knots, w)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self._wide(x, self.knots) @ self.weights


def _platt(logit: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Scale and shift that make a sigmoid of the logits a probability."""
    x = np.column_stack([np.clip(logit, -15, 15), np.ones(len(y))])
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    w = _newton(x, target, np.array([0.1, 0.01]), np.array([1.0, 0.0]))
    return float(max(w[0], 0.0)), float(w[1])


@dataclass
class Model:
    """Both views, their calibration, and how they are combined; without views all documents score 1."""

    content: View | None = None
    metadata: View | None = None
    calibration: tuple[tuple[float, float], tuple[float, float]] = ((1.0, 0.0), (1.0, 0.0))
    mixture: tuple[float, float, float] = (1.0, 0.0, 0.0)
    rounds: tuple[tuple[int, int], ...] = ()  # pseudo-labels that the views gave each other in each round

    def scores(self, content: np.ndarray, metadata: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated probabilities of good quality: by the text, by the metadata, by both."""
        if self.content is None or self.metadata is None:
            ones = np.ones(len(content))
            return ones, ones, ones
        a, b = (np.clip(v.logit(x), -15, 15) * s + t for v, x, (s, t) in zip((self.content, self.metadata), (content, metadata), self.calibration))
        u, v, c = self.mixture
        return _sigmoid(a), _sigmoid(b), _sigmoid(u * a + v * b + c)


def co_train(
    content: np.ndarray, metadata: np.ndarray, labels: np.ndarray, rounds: int = 4, grow: float = 0.02, held_out: float = 0.25
) -> Model:
    """A model of labelled rows (1, 0) and others (NaN).

    In each round either view labels the unlabelled rows it is surest of for the
    other one to learn from: of each class as many as `grow` of the labelled rows in
    it, and one at least, by rank, since a view that knows little is never sure in
    absolute terms. Every fourth labelled row is held out for the calibration and
    the mixture of the views.
    """
    known = np.flatnonzero(~np.isnan(labels))
    test = known[:: int(1 / held_out)]
    train, pool = np.setdiff1d(known, test), np.flatnonzero(np.isnan(labels))
    if any(len(np.unique(labels[part])) < 2 for part in (train, test)):
        return Model()
    views, gained = (content, metadata), []
    own = [(train, labels[train]), (train, labels[train])]
    free = [pool, pool]
    share = labels[train].mean()
    for r in range(rounds + 1):
        models = [View.fit(x[rows], y) for x, (rows, y) in zip(views, own)]
        if r == rounds:
            break
        given = []
        for i, model in enumerate(models):
            other, order = 1 - i, np.argsort(model.logit(views[i][free[i]]), kind="stable")
            bad, good = (min(len(order) // 2, max(1, int(grow * part * len(train)))) for part in (1 - share, share))
            rows = free[i][np.concatenate([order[:bad], order[len(order) - good :]])]
            y = np.repeat([0.0, 1.0], [bad, good])
            own[other] = (np.concatenate([own[other][0], rows]), np.concatenate([own[other][1], y]))
            free[i] = np.setdiff1d(free[i], rows)
            given.append(len(rows))
        gained.append(tuple(given))
    logits = [m.logit(x[test]) for m, x in zip(models, views)]
    calibration = tuple(_platt(z, labels[test]) for z in logits)
    both = np.column_stack([np.clip(z, -15, 15) * s + t for z, (s, t) in zip(logits, calibration)])
    mix = View.fit(both, labels[test], ridge=1.0)
    weights = np.maximum(mix.weights[1:3], 0)  # a view never counts against itself
    total = both @ weights
    scale, shift = _platt(total, labels[test]) if weights.any() else (0.0, 0.0)
    mixture = (float(scale * weights[0]), float(scale * weights[1]), shift) if weights.any() else (1.0, 0.0, 0.0)
    return Model(models[0], models[1], calibration, mixture, tuple(gained))


def _columns(docs: DataFrame) -> list[Column]:
    """text, lang, source, n_chars of `docs`; null where it lacks one."""
    kinds = {"text": "string", "lang": "string", "source": "string", "n_chars": "long"}
    return [(F.col(c) if c in docs.columns else F.lit(None)).cast(t).alias(c) for c, t in kinds.items()]


def fit(docs: DataFrame, labels: DataFrame, most: int = 8_000, unlabelled: int = 8_000) -> Model:
    """Trains on at most `most` labelled rows and as many as `unlabelled` others, drawn by a hash of their ids.

    `labels` has doc_id and quality (1 or 0); other values and null don't count, and
    of several labels of an id the lowest does. Of rows that share a labelled id the
    text with the lowest hash counts, of other rows that repeat an id and a text one.
    Only the features of the drawn rows, whose number these two parameters bound, come
    to the driver. Labels without a document and tables without rows or with one class
    only are fine: then the model has nothing to go by and keeps everything.
    """
    good = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    good = good.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.min("quality").alias("_quality"))
    place = lambda *c: F.pmod(F.xxhash64(*c, F.lit("quality")), F.lit(1 << 40))
    below = lambda n, total: int((1 << 40) * min(1.0, 0.9 * n / max(1, total)))
    # about nine tenths of the bound, so that the limits, which are for safety, cut nothing
    drawn = good.where(place("_id") < below(most, good.count())).orderBy(place("_id"), "_id").limit(most)
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), *_columns(docs)).withColumn("_place", place("_id", "text"))
    rest = F.col("_place") < below(unlabelled, docs.count())
    used = rows.join(F.broadcast(drawn), "_id", "left").where(F.col("_quality").isNotNull() | rest)

    def features(batches):
        for got in batches:
            content, metadata = content_features(got.column("text")), metadata_features(*(got.column(c) for c in ("lang", "source", "n_chars")))
            as_lists = [pa.array(list(x.astype(np.float32)), pa.list_(pa.float32())) for x in (content, metadata)]
            known = [got.column("_id"), got.column("_place"), got.column("_quality").cast(pa.int32())]
            yield pa.RecordBatch.from_arrays([*known, *as_lists], names=["id", "place", "quality", "content", "metadata"])

    found = used.mapInArrow(features, "id long, place long, quality int, content array<float>, metadata array<float>")
    own = F.when(F.col("quality").isNull(), F.col("place"))
    one = found.groupBy("id", "quality", own.alias("own")).agg(F.min_by(F.struct("content", "metadata"), "place").alias("x"))
    in_order = one.orderBy(F.col("quality").isNull(), "own", "id", "quality").limit(most + 2 * unlabelled)
    table = in_order.select("id", "quality", "x.*").toArrow()
    if not len(table):
        return Model()
    stacked = [table.column(c).combine_chunks().flatten().to_numpy().astype(np.float64).reshape(len(table), -1) for c in ("content", "metadata")]
    return co_train(*stacked, table.column("quality").to_numpy().astype(np.float64))


def score(docs: DataFrame, model: Model, into: tuple[str, str, str] = ("content_score", "metadata_score", "quality_score")) -> DataFrame:
    """`docs` with the scores of the text, the metadata and both, each from 0 to 1, named by `into`.

    All rows and columns stay; columns of these three names are replaced. Null or
    missing columns count as empty or unknown.
    """

    @F.arrow_udf("struct<content: double, metadata: double, both: double>")
    def scored(text: pa.Array, lang: pa.Array, source: pa.Array, n_chars: pa.Array) -> pa.Array:
        found = model.scores(content_features(text), metadata_features(lang, source, n_chars))
        return pa.StructArray.from_arrays([pa.array(x) for x in found], names=["content", "metadata", "both"])

    held = spare("scores", docs.columns)
    rows = docs.withColumn(held, scored(*_columns(docs)))
    return rows.withColumns({n: F.col(held)[part] for n, part in zip(into, ("content", "metadata", "both"))}).drop(held)
