"""Toxicity: cumulative-link ordinal regression on sparse word features.

Model: severity grades 0 < 1 < 2 share one weight vector; P(grade <= k) =
sigmoid(threshold_k - weights . x) with ordered thresholds.  Output is the expected
severity, sum over k of P(grade > k), the most likely grade, and whether the document is
toxic (P(grade > 0) at least ``cut``).

The fit maximises the likelihood of the observed grades under this model, the mean of
log(F(threshold_k - s) - F(threshold_k-1 - s)) with F the logistic function, less a penalty on
the weights.

Features: words (A-Z lower-cased) and their beginnings by hash, weighted 1 + log(1 + 100 *
share of the text's words); the ``n_features`` that separate the labels most are kept, so
the model is of fixed size.  The grade of a labelled document comes from its labels alone: 0 if it
isn't toxic, 1 if it is toxic in an otherwise good text, 2 if the text is poor besides.  Without a
column of quality labels toxic documents have grade 1; with ``graded`` the label column's own
integers are the grades.

Fitted on at most ``max_labelled`` labelled documents, taken in hash order of their id, one row
of each (a documented bound: at 2,000 words a document, well below 100 MB); scoring reads whole texts
of all documents and shuffles nothing.

Defined results: null or empty texts have severity by the thresholds alone (no words:
never toxic); texts of any length are scored whole; labels that are null or without a document are
left out; of repeated labels the largest grade counts; of rows that share a labelled id the one with
the smallest hash of its text is used; features that separate equally come in order of their hash; a
score at the cut is toxic; with no labels of both kinds nothing is toxic and severity is 0; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.llm import textkit as K
from seriesloom.sources.tables import written

MAX_LABELLED = 20_000
N_FEATURES = 2048
#: Lengths in bytes of the word beginnings that are features.
PREFIXES = (4, 5, 6, 7, 8, 9)
CUT = 0.2


def text_features(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and text number of each feature occurrence, and the words of each text.

    A word gives itself and its beginnings of PREFIXES bytes (inflected and compounded
    forms share them).
    """
    start, end, doc = K.words(buf, offs, K.ALNUM)
    hashes, own = [K.span_hashes(buf, start, end, True)], [doc]
    for k in PREFIXES:
        longer = np.flatnonzero(end - start > k)
        hashes.append(K.span_hashes(buf, start[longer], start[longer] + k, True) ^ K.MIX_A)
        own.append(doc[longer])
    return np.concatenate(hashes), np.concatenate(own), np.bincount(doc, minlength=len(offs) - 1)


def _separation(batches):
    """(feature, toxic texts, clean texts) with each feature."""
    for batch in batches:
        grade = batch.column(0).to_numpy()
        for lo, hi, buf, offs in K.chunks(batch.column(1)):
            hashes, own, _ = text_features(buf, offs)
            key = K.mix(hashes ^ K.mix(K.GOLDEN * (own + 1).astype(np.uint64)))
            _, once = np.unique(key, return_index=True)  # a text counts once
            feature, code = np.unique(hashes[once], return_inverse=True)
            toxic = np.bincount(code, grade[lo:hi][own[once]] > 0, minlength=len(feature)).astype(np.int64)
            every = np.bincount(code, minlength=len(feature))
            yield pa.RecordBatch.from_arrays([pa.array(feature.view(np.int64)), pa.array(toxic), pa.array(every - toxic)], ["feature", "toxic", "clean"])


def known_features(hashes: np.ndarray, own: np.ndarray, features: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, place in ``features``, times) of the known features of each text."""
    flags = np.zeros(1 << 16, dtype=bool)
    flags[(features & np.uint64(0xFFFF)).astype(np.int64)] = True
    near = np.flatnonzero(flags[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
    place = np.searchsorted(features, hashes[near])
    place[place == len(features)] = 0
    same = features[place] == hashes[near]
    pair, times = np.unique(own[near[same]] * len(features) + place[same], return_counts=True)
    return pair // len(features), pair % len(features), times


def _vectors(features: np.ndarray):
    def rows(batches):
        for batch in batches:
            for lo, hi, buf, offs in K.chunks(batch.column(1)):
                hashes, own, n = text_features(buf, offs)
                row, col, times = known_features(hashes, own, features)
                size = np.bincount(row, minlength=hi - lo)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(n.astype(np.int64)), K.list_array(col.astype(np.int32), size, pa.int32()), K.list_array(times.astype(np.int32), size, pa.int32())], ["grade", "n", "features", "times"])

    return K.tidied(rows)


class OrdinalModel:
    """Word hashes, their shared weights, the ordered thresholds, and the grades between them."""

    def __init__(self, words: np.ndarray, weights: np.ndarray, thresholds: np.ndarray, grades: np.ndarray | None = None):
        self.words, self.weights, self.thresholds = words, weights, thresholds
        self.grades = np.arange(len(thresholds) + 1) if grades is None else grades

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for each text and threshold."""
        return np.exp(-np.logaddexp(0, self.thresholds[None, :] - score[:, None]))

    def scores(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hashes, own, n = text_features(buf, offs)
        if not len(self.words):
            return np.zeros(len(n)), n
        row, col, times = known_features(hashes, own, self.words)
        return np.bincount(row, self.weights[col] * feature_value(times, n[row]), minlength=len(n)), n


def feature_value(times: np.ndarray, n: np.ndarray) -> np.ndarray:
    return 1 + np.log1p(100 * times / np.maximum(n, 1))


def _logistic(x: np.ndarray) -> np.ndarray:
    return np.exp(-np.logaddexp(0, -x))


def thresholds_of(first: float, gaps: np.ndarray) -> np.ndarray:
    """Ordered thresholds from the first one and the logs of the gaps."""
    return first + np.concatenate([[0], np.cumsum(np.exp(gaps))])


def likelihood(score: np.ndarray, grade: np.ndarray, first: float, gaps: np.ndarray) -> tuple[float, np.ndarray, float, np.ndarray]:
    """Mean log-likelihood of the grades, and its slopes by score, first threshold and gaps."""
    bound = np.concatenate([[-np.inf], thresholds_of(first, gaps), [np.inf]])
    low, high = bound[grade] - score, bound[grade + 1] - score
    under, upto = _logistic(low), _logistic(high)
    chance = np.maximum(upto - under, 1e-300)
    by_low, by_high = -under * (1 - under) / chance, upto * (1 - upto) / chance
    by_threshold = np.array([by_high[grade == k].sum() + by_low[grade == k + 1].sum() for k in range(len(gaps) + 1)]) / len(score)
    by_gap = np.exp(gaps) * np.cumsum(by_threshold[::-1])[::-1][1:]
    return float(np.log(chance).mean()), -(by_low + by_high) / len(score), float(by_threshold.sum()), by_gap


def fit(features: np.ndarray, rows: pa.Table, steps: int = 300, rate: float = 0.05, decay: float = 3e-3) -> OrdinalModel:
    """Fit on collected (grade, n, features, times) rows of the bounded sample."""
    grade = rows.column("grade").to_numpy().astype(np.int64)
    if not len(features) or not len(grade) or (grade > 0).all() or (grade == 0).all():
        return OrdinalModel(np.zeros(0, np.uint64), np.zeros(0), np.full(2, np.inf))
    grades, grade = np.unique(grade, return_inverse=True)  # grades that nobody has need no threshold
    lists = rows.column("features").combine_chunks()
    row = np.repeat(np.arange(len(grade)), lists.value_lengths().to_numpy())
    col = lists.flatten().to_numpy().astype(np.int64)
    value = feature_value(rows.column("times").combine_chunks().flatten().to_numpy(), rows.column("n").to_numpy()[row])
    weights, first, gaps = np.zeros(len(features)), 1.0, np.zeros(int(grade.max()) - 1)
    state = [np.zeros(len(features) + 1 + len(gaps)) for _ in range(2)]
    for step in range(1, steps + 1):
        _, by_score, by_first, by_gap = likelihood(np.bincount(row, weights[col] * value, minlength=len(grade)), grade, first, gaps)
        slope = np.concatenate([decay * weights - np.bincount(col, by_score[row] * value, minlength=len(features)), [-by_first], -by_gap])
        state[0] = 0.9 * state[0] + 0.1 * slope
        state[1] = 0.999 * state[1] + 0.001 * slope**2
        move = rate * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.999**step)) + 1e-9)
        weights = weights - move[: len(features)]
        first -= move[len(features)]
        gaps = gaps - move[len(features) + 1 :]
    return OrdinalModel(features, weights, thresholds_of(first, gaps), grades)


def train(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", quality_col: str = "quality", graded: bool = False, max_labelled: int = MAX_LABELLED, n_features: int = N_FEATURES) -> OrdinalModel:
    """Fit on the labelled documents, ``max_labelled`` at most; their ids and grades alone are broadcast."""
    label = F.col(label_col).cast("bigint")
    if not graded:
        poor = F.coalesce((F.col(quality_col) == 0).cast("bigint"), F.lit(0)) if quality_col in labels.columns else F.lit(0)
        label = F.when(label > 0, 1 + poor).when(label.isNotNull(), F.lit(0)).cast("bigint")
    sample = labels.select(F.col(id_col).cast("bigint").alias("label_id"), label.alias("grade")).dropna()
    sample = sample.groupBy("label_id").agg(F.max("grade").alias("grade")).orderBy(F.xxhash64("label_id"), "label_id").limit(max_labelled)
    docs = documents.select(F.col(id_col).cast("bigint").alias("label_id"), F.col(text_col).cast("string").alias("text"))
    rows = docs.join(F.broadcast(sample), "label_id").groupBy("label_id").agg(F.first("grade").alias("grade"), F.min_by("text", F.xxhash64("text")).alias("text"))
    rows = written(rows.select("grade", "text"))
    totals = rows.agg(F.count_if(F.col("grade") > 0), F.count_if(F.col("grade") == 0)).first()
    found = rows.mapInArrow(K.tidied(_separation), "feature bigint, toxic bigint, clean bigint").groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).filter(F.col("toxic") + F.col("clean") >= 3)
    odds = lambda x, n: F.log((F.col(x) + 0.5) / (n - F.col(x) + 0.5))
    found = found.withColumn("ratio", odds("toxic", totals[0]) - odds("clean", totals[1]))
    best = found.orderBy(F.desc(F.abs("ratio") * F.sqrt(F.col("toxic") + F.col("clean"))), "feature").limit(n_features).collect()
    features = np.sort(np.array([r.feature for r in best], dtype=np.int64).view(np.uint64))
    return fit(features, rows.mapInArrow(_vectors(features), "grade bigint, n bigint, features array<int>, times array<int>").toArrow())


def toxicity(documents: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text", cut: float = CUT) -> DataFrame:
    """All columns of ``documents``' id and (n_words, p_toxic, expected_severity, grade, toxic) of every row."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        model = shared.value
        for batch in batches:
            for lo, hi, buf, offs in K.chunks(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *scored(model, buf, offs, cut)], ["doc_id", "n_words", "p_toxic", "expected_severity", "grade", "toxic"])

    docs = documents.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return docs.mapInArrow(K.tidied(score), "doc_id bigint, n_words bigint, p_toxic double, expected_severity double, grade bigint, toxic boolean")


def scored(model: OrdinalModel, buf: np.ndarray, offs: np.ndarray, cut: float) -> list[pa.Array]:
    score, n = model.scores(buf, offs)
    above = model.above(score)
    level = np.concatenate([1 - above[:, :1], above[:, :-1] - above[:, 1:], above[:, -1:]], axis=1)
    toxic = (above[:, 0] >= cut) & (n > 0)
    # one rule for both: a toxic text has the likeliest grade above the first, any other the first
    grade = np.where(toxic, model.grades[1 + level[:, 1:].argmax(axis=1)], model.grades[0])
    return [pa.array(n.astype(np.int64)), pa.array(above[:, 0]), pa.array(above @ np.diff(model.grades).astype(float)), pa.array(grade.astype(np.int64)), pa.array(toxic)]


def without_toxic(documents: DataFrame, model: OrdinalModel, text_col: str = "text", cut: float = CUT) -> DataFrame:
    """The rows of ``documents`` that aren't toxic, as they are."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    at = documents.columns.index(text_col)

    def keep(batches):
        model = shared.value
        for batch in batches:
            for lo, hi, buf, offs in K.chunks(batch.column(at)):
                toxic = scored(model, buf, offs, cut)[-1]
                yield batch.slice(lo, hi - lo).filter(pa.array(~toxic.to_numpy(zero_copy_only=False)))

    return documents.mapInArrow(K.tidied(keep), documents.schema)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit on ``labels`` and score all of ``documents``."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity(documents, model)
