"""Scores against a forward pass written passage by passage, and gradients against differences."""

from __future__ import annotations

import math
import re

import numpy as np
import pytest

from lociweave.llm import quality

TEXTS = [
    "A plain sentence, with commas; and 12 numbers. " * 9, "one", "", None, " \t\n ", "é ü ñ " * 40 + "END!", "the the the cat THE the", "x" * 500,
    "\n".join(f"line {k}: (value={k * k})" for k in range(90)), "word " * 64, "word " * 65,
]


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(5)
    f, h, a = quality.FEATURES, quality.HIDDEN, quality.ATTENTION
    shapes = {"encode": (f, h), "encode0": (h,), "look": (h, a), "gate": (h, a), "attend": (a,), "score": (h,), "score0": (1,)}
    return quality.Model(rng.normal(0.2, 0.1, f), np.full(f, 0.3), {k: rng.normal(0, 0.5, s) for k, s in shapes.items()}, 0.4)


def class_of(byte):
    if byte == 0x20 or 0x09 <= byte <= 0x0D:
        return 1
    c = chr(byte)
    if byte < 0x80 and c.isalnum():
        return 2 if c.isupper() else 3 if c.islower() else 4
    if byte >= 0x80:
        return 5 if byte >= 0xC0 else 6
    marks = [m for m in range(0x21, 0x7F) if not chr(m).isalnum()]
    return 7 + marks.index(byte) if byte in marks else 0


def passages(text):
    data = (text or "").encode()
    words = list(re.finditer(rb"[^\x20\x09-\x0D]+", data))
    for at in range(0, max(1, len(words)), 64):
        own = words[at : at + 64]
        classes, pairs, stats = [0.0] * quality.CLASSES, [0.0] * quality.PAIRS, [0.0] * 7
        if own:
            part = data[own[0].start() : own[-1].end()]
            for k, byte in enumerate(part):
                after = part[k + 1] if k + 1 < len(part) else 0x20
                classes[class_of(byte)] += 1
                pairs[(byte * 0x9E3B + after * 0x85EB) >> 5 & 63] += 1
            said = [w.group() for w in own]
            n = len(said)
            stats = [
                sum(a == b for a, b in zip(said, said[1:], strict=False)) / n, sum(len(w) <= 3 for w in said) / n, sum(len(w) == 1 for w in said) / n, sum(map(len, said)) / n,
                sum(class_of(w[0]) == 2 for w in said) / n, sum(class_of(w[-1]) > 6 for w in said) / n, len(set(said)) / n,
            ]
            classes, pairs = ([math.sqrt(c / len(part)) for c in some] for some in (classes, pairs))
        yield [*classes, *pairs, *stats]


def plain_score(model, text):
    w, encoded, raw = model.weights, [], []
    for features in passages(text):
        x = [min(6, max(-6, (v - m) / s)) for v, m, s in zip(features, model.mean, model.scale, strict=True)]
        z = [math.tanh(sum(v * w["encode"][i][k] for i, v in enumerate(x)) + w["encode0"][k]) for k in range(quality.HIDDEN)]
        gated = [
            math.tanh(sum(v * w["look"][i][k] for i, v in enumerate(z))) / (1 + math.exp(-sum(v * w["gate"][i][k] for i, v in enumerate(z))))
            for k in range(quality.ATTENTION)
        ]
        encoded.append(z)
        raw.append(math.exp(sum(g * v for g, v in zip(gated, w["attend"], strict=True))))
    pooled = [sum(r * z[k] for r, z in zip(raw, encoded, strict=True)) / sum(raw) for k in range(quality.HIDDEN)]
    return 1 / (1 + math.exp(-(sum(p * v for p, v in zip(pooled, w["score"], strict=True)) + w["score0"][0] + model.shift)))


def test_scores_equal_a_plain_forward_pass(spark, model):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(3)
    got = dict(docs.select("doc_id", quality.quality_score(docs, model).alias("score")).collect())
    for k, text in enumerate(TEXTS):
        assert abs(got[k] - plain_score(model, text)) < 1e-5


def test_gradients_equal_differences(model):
    rng = np.random.default_rng(6)
    counts, y = np.array([3, 1, 2]), np.array([1.0, 0.0, 1.0])
    x = rng.normal(0.2, 0.2, (6, quality.FEATURES))

    def loss():
        logit = model.forward(x, counts)["logit"]
        return float((np.logaddexp(0, logit) - y * logit).mean())

    for name, gradient in model.gradient(x, counts, y).items():
        weights = model.weights[name]
        for place in {tuple(rng.integers(0, n) for n in weights.shape) for _ in range(4)}:
            kept = weights[place]
            weights[place] = kept + 1e-5
            above = loss()
            weights[place] = kept - 1e-5
            below = loss()
            weights[place] = kept
            assert abs((above - below) / 2e-5 - gradient[place]) < 1e-6
