"""Toxicity by multiple-instance learning: sentence scores combined by noisy-or, trained from document labels.

A document is a bag of sentences. A sentence's probability of being toxic is a logistic function of its words; the
document's is ``1 - prod(1 - p_sentence)``, so one offending sentence is enough and the label of the bag teaches
the sentences. Word features are the lower-cased word without surrounding punctuation and its beginnings, which
carry over to inflected forms that training never saw.

Training uses a bounded sample of labelled documents (:class:`Limits`), balanced by label and drawn by a hash of
the id; scoring runs over all rows without a shuffle.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Sentences end at full stops, question and exclamation marks and line ends.
SENTENCE = re.compile(r"[^.!?\n]+")
EDGE = re.compile(r"^[\W_]+|[\W_]+$")


@dataclass(frozen=True)
class Limits:
    """Bounds of the training sample and of the model."""

    toxic: int = 2500
    clean: int = 5000
    max_chars: int = 20_000  # longer documents are not taken into the sample
    features: int = 20_000
    min_docs: int = 4  # toxic sample documents that a feature needs
    beginnings: tuple[int, int] = (4, 7)
    rounds: int = 500


def features(word: str, limits: Limits) -> list[str]:
    """The features of one lower-cased token: the bare word and its beginnings (marked ``*``)."""
    bare = EDGE.sub("", word)
    if not bare:
        return []
    low, high = limits.beginnings
    return [bare, *(bare[:k] + "*" for k in range(low, min(high, len(bare)) + 1))]


class Weights(dict):
    """Weight of a token, worked out on first sight and remembered for as many tokens as ``room``."""

    room = 300_000

    def __init__(self, table: dict[str, float], limits: Limits):
        self.table, self.limits = table, limits

    def __missing__(self, word: str) -> float:
        if len(self) > self.room:
            self.clear()
        get = self.table.get
        self[word] = value = sum(get(f, 0.0) for f in features(word, self.limits))
        return value


@dataclass
class Model:
    table: dict[str, float]
    bias: float
    limits: Limits

    def sentences(self, text: str | None, weights: Weights) -> list[tuple[int, int, float]]:
        """(start, end, logit) of the sentences of a text, in code points."""
        get = weights.__getitem__
        return [(m.start(), m.end(), self.bias + sum(map(get, m.group().lower().split())))
                for m in SENTENCE.finditer(text or "")]


def softplus(z: float) -> float:
    return z + math.log1p(math.exp(-z)) if z > 0 else math.log1p(math.exp(z))


def train(rows: list[tuple[str | None, int]], limits: Limits = Limits()) -> Model:
    """Fits the noisy-or model to (text, label) rows.

    No rows, or rows of one label only, give a model without features that calls nothing toxic. The order of rows
    does not matter beyond rounding; rows are used as often as they come.
    """
    split = lambda text: [set(x.lower().split()) for x in SENTENCE.findall(text or "")]
    toxic = sum(y for _, y in rows)
    clean = len(rows) - toxic
    # features of toxic documents first; of the others only those are counted, so memory follows the toxic part
    hit, other = Counter(), Counter()
    for text, y in rows:
        if y:
            hit.update({f for w in set().union(*split(text)) for f in features(w, limits)})
    hit = {f: n for f, n in hit.items() if n >= limits.min_docs}
    for text, y in rows:
        if not y:
            other.update({f for w in set().union(*split(text)) for f in features(w, limits) if f in hit})
    lift = {f: math.log((a + 0.5) / (toxic + 1)) - math.log((other[f] + 0.5) / (clean + 1)) for f, a in hit.items()}
    chosen = sorted((f for f in lift if lift[f] > 1.0), key=lambda f: (-lift[f] * math.sqrt(hit[f]), f))[:limits.features]
    at = {f: i for i, f in enumerate(chosen)}
    if not chosen or not clean:
        return Model({}, -20.0, limits)
    sent_of, feat_of, doc_of, y_of, plain = [], [], [], [], []
    for d, (text, y) in enumerate(rows):
        y_of.append(y)
        bare = 0
        for s in split(text):
            own = sorted({at[f] for w in s for f in features(w, limits) if f in at})
            if own:
                sent_of += [len(doc_of)] * len(own)
                feat_of += own
                doc_of.append(d)
            else:
                bare += 1
        plain.append(bare)
    sent, feat, doc = np.array(sent_of, dtype=np.int64), np.array(feat_of, dtype=np.int64), np.array(doc_of, dtype=np.int64)
    y, bare = np.array(y_of, dtype=float), np.array(plain, dtype=float)
    share = np.where(y > 0, 0.5 / max(toxic, 1), 0.5 / max(clean, 1)) * len(y)
    w, bias = np.zeros(len(chosen)), -9.0
    m = np.zeros(len(chosen) + 1)
    v = np.zeros(len(chosen) + 1)
    for step in range(1, limits.rounds + 1):
        z = bias + np.bincount(sent, w[feat], minlength=len(doc))
        cost = np.logaddexp(0, z)
        total = np.bincount(doc, cost, minlength=len(y)) + bare * np.logaddexp(0, bias)
        # loss = -log(1 - exp(-total)) for toxic bags, total for clean ones
        slope = share * np.where(y > 0, -1 / np.expm1(np.clip(total, 1e-9, 700)), 1.0)
        dz = slope[doc] / (1 + np.exp(-z))
        g = np.append(np.bincount(feat, dz[sent], minlength=len(chosen)) / len(y) + 5e-6 * w,
                      (dz.sum() + (slope * bare).sum() / (1 + math.exp(-bias))) / len(y))
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        move = 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w = np.maximum(w - move[:-1], 0)  # evidence only adds up: no sentence excuses another
        bias = min(bias - move[-1], -9.0)  # thousands of plain sentences stay far from a call
    return Model({f: float(w[i]) for f, i in at.items() if w[i] > 1e-3}, float(bias), limits)


def held_out(id_col: Column) -> Column:
    """Whether a row is kept from training: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id",
           text_col: str = "text", label_col: str = "toxic") -> list[tuple[str | None, int]]:
    """The training rows: per label the documents with the smallest id hashes, at most ``limits`` of each.

    Ids are drawn from the label table alone, so only the drawn documents' texts move. Null ids and labels are
    ignored, of contradicting labels of one id the highest holds.
    """
    marks = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).where(~held_out(F.col(id_col)))
             .groupBy(id_col).agg(F.max(label_col).cast("int").alias("__y")))
    order = [F.xxhash64(id_col), F.col(id_col)]
    drawn = (marks.where("__y = 1").orderBy(*order).limit(limits.toxic)
             .union(marks.where("__y = 0").orderBy(*order).limit(limits.clean)))
    texts = docs.select(id_col, text_col).where(F.length(text_col) <= limits.max_chars)
    rows = texts.join(F.broadcast(drawn), id_col).select(text_col, "__y", id_col).collect()  # bounded by limits
    return [(r[0], r[1]) for r in sorted(rows, key=lambda r: (r[2], r[0]))]


def score(docs: DataFrame, model: Model, text_col: str = "text", located: float = 0.5) -> DataFrame:
    """Adds score (0 to 1), n_offending and offending to every row; no shuffle.

    ``offending`` lists start and end (code points, end exclusive) and the probability of each sentence of at least
    ``located``. Null and empty texts score 0 and have none. Columns of these names are replaced, all others pass.
    """
    names = ("score", "n_offending", "offending")
    spans = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                                      T.StructField("p", T.DoubleType())]))
    kept = [c for c in docs.columns if c not in names]
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField("score", T.DoubleType()),
                           T.StructField("n_offending", T.LongType()), T.StructField("offending", spans)])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most limits.features weights
    least = math.log(located / (1 - located))

    def run(batches):
        model = shared.value
        weights, base = Weights(model.table, model.limits), softplus(model.bias)
        for batch in batches:
            scores, found = [], []
            for text in batch.column(batch.schema.get_field_index(text_col)).to_pylist():
                total, own = 0.0, []
                for start, end, z in model.sentences(text, weights):
                    if z == model.bias:
                        total += base
                        continue
                    total += softplus(z)
                    if z >= least:
                        own.append({"start": start, "end": end, "p": 1 / (1 + math.exp(-z))})
                scores.append(-math.expm1(-total))
                found.append(own)
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(scores, type=pa.float64()), pa.array([len(x) for x in found], type=pa.int64()),
                 pa.array(found, type=pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())])))],
                names=[*kept, *names])

    return docs.mapInArrow(run, schema)
