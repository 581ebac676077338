"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of PASSAGE_WORDS words.  Every passage is encoded from its own bytes and words; gated
attention weights say how much each passage counts; the weighted passage representation is scored.  All weights, the
encoder's and the attention's too, are learned from document labels alone.

The model is fitted on at most `max_documents` labelled documents of each class (those of smallest hash) of at most
`max_passages` passages each, so what reaches the driver has a fixed bound.  Scoring reads every whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociweave.llm.kernels import WHITE, Words, slices

PASSAGE_WORDS = 64
MAX_DOCUMENTS = 2000
MAX_PASSAGES = 64
THRESHOLD = 0.7
HIDDEN, ATTENTION = 24, 12

#: Classes of bytes: 0 other control, 1 white space, 2 upper, 3 lower, 4 digit, 5 lead and 6 continuation of a
#: non-ASCII character, and one class for each ASCII punctuation mark.
_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x20, *range(0x09, 0x0E)]] = 1
_CLASS[0x41:0x5B], _CLASS[0x61:0x7B], _CLASS[0x30:0x3A] = 2, 3, 4
_CLASS[0xC0:], _CLASS[0x80:0xC0] = 5, 6
_MARKS = [c for c in range(0x21, 0x7F) if not chr(c).isalnum()]
_CLASS[_MARKS] = np.arange(7, 7 + len(_MARKS))
CLASSES = 7 + len(_MARKS)
PAIRS = 64
FEATURES = CLASSES + PAIRS + 7


def passage_features(texts: pa.Array):
    """For each slice of rows: (passages of each row, features float32[passages, FEATURES]).

    A text without words is one passage of zeros.
    """
    for first, last, data, offsets in slices(texts):
        found = Words(data, offsets, WHITE, lower=False)
        n_words = np.diff(found.rows)
        n_passages = np.maximum(1, -(-n_words // PASSAGE_WORDS))
        total = int(n_passages.sum())
        base = np.concatenate([[0], np.cumsum(n_passages)])
        out = np.zeros((total, FEATURES), np.float32)
        if len(found.starts):
            row = np.repeat(np.arange(last - first), n_words)
            within = np.arange(len(row)) - np.repeat(found.rows[:-1], n_words)
            passage = base[row] + within // PASSAGE_WORDS
            begins = np.flatnonzero(np.r_[True, passage[1:] != passage[:-1]])
            which = passage[begins]
            ends = np.r_[begins[1:], len(passage)]
            byte_begin, byte_end = found.starts[begins], found.ends[ends - 1]
            size = (byte_end - byte_begin).astype(np.float32)
            owner = np.repeat(np.arange(len(begins)), byte_end - byte_begin)
            place = np.arange(len(owner)) + np.repeat(byte_begin - np.r_[0, np.cumsum(byte_end - byte_begin)[:-1]], byte_end - byte_begin)
            here = data[place]
            counts = np.bincount(owner * CLASSES + _CLASS[here], minlength=len(begins) * CLASSES).reshape(-1, CLASSES)
            after = np.r_[here[1:], np.uint8(0x20)]
            after[np.cumsum(byte_end - byte_begin) - 1] = 0x20  # never the next passage, which may be of another row
            pair = (here.astype(np.uint32) * np.uint32(0x9E3B) + after.astype(np.uint32) * np.uint32(0x85EB)) >> np.uint32(5) & np.uint32(PAIRS - 1)
            pairs = np.bincount(owner * PAIRS + pair, minlength=len(begins) * PAIRS).reshape(-1, PAIRS)
            hashed = found.hashes()
            length = found.ends - found.starts
            again = np.r_[False, (hashed[1:] == hashed[:-1]) & (passage[1:] == passage[:-1])]
            order = np.lexsort((hashed, passage))
            fresh = np.ones(len(order), bool)
            fresh[1:] = (hashed[order][1:] != hashed[order][:-1]) | (passage[order][1:] != passage[order][:-1])
            words = (ends - begins).astype(np.float32)
            first_class, last_class = _CLASS[data[found.starts]], _CLASS[data[found.ends - 1]]
            per_word = [again, length <= 3, length == 1, length, first_class == 2, last_class > 6]
            stats = [np.add.reduceat(x.astype(np.float32), begins) / words for x in per_word]
            stats.append(np.add.reduceat(fresh.astype(np.float32), begins) / words)
            out[which] = np.concatenate([np.sqrt(counts / size[:, None]), np.sqrt(pairs / size[:, None]), np.stack(stats, 1)], 1)
        yield n_passages, out


@dataclass
class Model:
    """Weights of encoder, gated attention and scorer, and the scale of the features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]
    shift: float

    def forward(self, x: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        begins = np.r_[0, np.cumsum(counts)[:-1]]
        bag = np.repeat(np.arange(len(counts)), counts)
        x = np.clip((x - self.mean) / self.scale, -6, 6)
        z = np.tanh(x @ w["encode"] + w["encode0"])
        t, g = np.tanh(z @ w["look"]), 1 / (1 + np.exp(-(z @ w["gate"])))
        raw = (t * g) @ w["attend"]
        raw = np.exp(raw - np.maximum.reduceat(raw, begins)[bag])
        a = raw / np.add.reduceat(raw, begins)[bag]
        pooled = np.add.reduceat(a[:, None] * z, begins)
        return {"x": x, "z": z, "t": t, "g": g, "a": a, "bag": bag, "begins": begins, "pooled": pooled, "logit": pooled @ w["score"] + w["score0"]}

    def score(self, x: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Scores to six places, from double sums: a task that runs again gives the same ones, however its batches fall."""
        logit = self.forward(x.astype(np.float64), counts)["logit"]
        return np.round(1 / (1 + np.exp(-np.clip(logit + self.shift, -30, 30))), 6)

    def gradient(self, x: np.ndarray, counts: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        w, f = self.weights, self.forward(x, counts)
        d = (1 / (1 + np.exp(-f["logit"])) - y) / len(y)
        out = {"score": f["pooled"].T @ d, "score0": d.sum(keepdims=True)}
        d_pool = (d[:, None] * w["score"])[f["bag"]]
        dz = f["a"][:, None] * d_pool
        da = (f["z"] * d_pool).sum(1)
        da = f["a"] * (da - np.add.reduceat(f["a"] * da, f["begins"])[f["bag"]])
        out["attend"] = (f["t"] * f["g"]).T @ da
        dtg = da[:, None] * w["attend"]
        dt, dg = dtg * f["g"] * (1 - f["t"] ** 2), dtg * f["t"] * f["g"] * (1 - f["g"])
        out["look"], out["gate"] = f["z"].T @ dt, f["z"].T @ dg
        dz = (dz + dt @ w["look"].T + dg @ w["gate"].T) * (1 - f["z"] ** 2)
        out["encode"], out["encode0"] = f["x"].T @ dz, dz.sum(0)
        return out


def fit(x: np.ndarray, counts: np.ndarray, y: np.ndarray, prior: float, epochs: int = 40, batch: int = 128, seed: int = 11) -> Model:
    """Adam on the log loss with weight decay and noisy features; prior is the share of label 1 that scores are set to."""
    rng = np.random.default_rng(seed)
    draw = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
    weights = {
        "encode": draw(FEATURES, HIDDEN), "encode0": np.zeros(HIDDEN, np.float32), "look": draw(HIDDEN, ATTENTION),
        "gate": draw(HIDDEN, ATTENTION), "attend": draw(ATTENTION), "score": draw(HIDDEN), "score0": np.zeros(1, np.float32),
    }
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    prior = float(np.clip(prior, 1e-3, 1 - 1e-3))
    model = Model(x.mean(0), np.maximum(x.std(0), 0.02), weights, float(np.log(prior / (1 - prior)) - np.log(share / (1 - share))))
    begins = np.r_[0, np.cumsum(counts)]
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(order), batch):
            take = order[at : at + batch]
            rows = np.concatenate([np.arange(begins[i], begins[i + 1]) for i in take])
            step += 1
            noisy = x[rows] + 0.5 * model.scale * rng.standard_normal((len(rows), FEATURES)).astype(np.float32)
            for k, g in model.gradient(noisy, counts[take], y[take]).items():
                g = g + 1e-2 * weights[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                weights[k] = weights[k] - 0.005 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


def held_out(doc_id: str) -> Column:
    """The fold that is never learned from: crc32 of the id as text leaves 2 by 4.  A null id is in no fold."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
    max_documents: int = MAX_DOCUMENTS, max_passages: int = MAX_PASSAGES,
) -> Model | float:
    """A model, or the share of label 1 where one of the classes has no document.

    Labels that are null or not 0/1, held-out ones and those without a document are ignored; an id with several labels
    takes the larger.  Documents of more than max_passages passages are left to scoring.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull() & ~held_out(doc_id))
    known = known.groupBy(F.col(doc_id).alias("_id")).agg(F.max(label).cast("int").alias("_y"))
    n1, n0 = known.agg(F.count_if(F.col("_y") == 1), F.count_if(F.col("_y") == 0)).first()
    share = (n1 + 1) / (n1 + n0 + 2)
    chosen = None
    for y in (0, 1):
        some = known.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(max_documents)
        chosen = some if chosen is None else chosen.unionByName(some)
    sample = docs.select(F.col(doc_id).alias("_doc"), F.col(text).cast("string").alias("_text")).join(F.broadcast(chosen), F.col("_doc") == F.col("_id"))
    sample = sample.select("_id", "_y", "_text")

    def encoded(batches):
        for batch in batches:
            done = 0
            for counts, x in passage_features(batch.column(2)):
                at = 0
                ids, ys, rows = [], [], []
                for k, n in enumerate(counts):
                    if n <= max_passages:
                        ids.append(batch.column(0)[done + k].as_py())
                        ys.append(batch.column(1)[done + k].as_py())
                        rows.append(x[at : at + n].tobytes())
                    at += n
                done += len(counts)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(ys, pa.int32()), pa.array(rows, pa.binary())], names=["id", "y", "x"])

    found = sorted(
        (r["id"], r["y"], bytes(r["x"]))
        for r in sample.mapInArrow(encoded, "id long, y int, x binary").limit(4 * max_documents).collect()
    )
    if len({y for _, y, _ in found}) < 2:
        return share
    xs = [np.frombuffer(b, np.float32).reshape(-1, FEATURES) for *_, b in found]
    return fit(np.concatenate(xs), np.array([len(x) for x in xs]), np.array([y for _, y, _ in found], np.float32), share)


def quality_score(docs: DataFrame, model: Model | float, text: str = "text") -> Column:
    """Score of each whole text, from 0 to 1; null counts as empty."""
    if not isinstance(model, Model):
        return F.lit(float(model))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        parts = [shared.value.score(x, counts) for counts, x in passage_features(texts)]
        return pa.array(np.concatenate(parts).astype(np.float64) if parts else np.zeros(0))

    return scored(F.col(text).cast("string"))


def score_documents(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted (1 from THRESHOLD up) for every row of docs, repeated rows included."""
    model = train(docs, labels, doc_id, text)
    rows = docs.select(F.col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"), quality_score(docs, model, text).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that the classifier does not reject, with all their columns.

    Where no model can be fitted, as one of the classes has no document, nothing is rejected and all rows stay.
    """
    model = train(docs, labels)
    if not isinstance(model, Model):
        return docs
    return docs.where(quality_score(docs, model) >= THRESHOLD)
