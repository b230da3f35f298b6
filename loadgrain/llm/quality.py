"""A quality classifier learnt from trusted positives and unlabelled text.

Non-negative positive-unlabelled learning: with class prior p, the risk of a
scorer f is ``p E+[l(f)] + max(0, Eu[l(-f)] - p E+[l(-f)])``. Where the second
part falls below zero the step goes against it, so a flexible scorer cannot win
by calling every unlabelled text negative. The scorer is linear in features of
form (kinds of characters next to each other, repetition), not of vocabulary, so
it carries over to languages it has not seen.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadgrain.llm.common import share_of

#: Bounds of the sample to fit on: expected rows of either kind.
FIT_POSITIVES, FIT_UNLABELLED = 4000, 8000
THRESHOLD = 0.7
STEPS, RATE, DECAY = 300, 0.05, 2e-3
BATCH_CHARS = 1 << 18
SEED = 10

# Kinds of characters: letters in lower and upper case, digits, space, line
# end, and a few marks that prose and junk use differently.
_MARKS = ".,;:'\"-?!|*#$%&@/\\<>()[]{}=+_~^`"
KINDS = 6 + 26
_kinds: np.ndarray | None = None


def _kind_table() -> np.ndarray:
    """Kind of each code point; made once in each Python worker."""
    global _kinds
    if _kinds is None:
        table = np.full(0x110000, 5, dtype=np.uint8)
        for c in range(0x110000):
            char = chr(c)
            if char.isalpha():
                table[c] = 1 if char.isupper() else 0
            elif char.isdigit():
                table[c] = 2
            elif char.isspace():
                table[c] = 3
        table[10] = 4
        for i, char in enumerate(_MARKS):
            table[ord(char)] = 6 + min(i, 25)
        _kinds = table
    return _kinds


DENSE = 8
WIDTH = KINDS * KINDS + DENSE


def features(text: str | None) -> np.ndarray:
    """A fixed-width row: square roots of kind-pair shares, then repetition measures.

    NULL counts as empty. The text is read whole, a stretch at a time.
    """
    row = np.zeros(WIDTH, dtype=np.float32)
    if not text:
        return row
    table = _kind_table()
    pairs = np.zeros(KINDS * KINDS, dtype=np.int64)
    last = 4  # as if a line had just ended
    for at in range(0, len(text), BATCH_CHARS):
        piece = text[at : at + BATCH_CHARS].encode("utf-32-le", "surrogatepass")
        kinds = table[np.frombuffer(piece, dtype="<u4")].astype(np.int64)
        before = np.concatenate(([last], kinds[:-1]))
        pairs += np.bincount(before * KINDS + kinds, minlength=KINDS * KINDS)
        last = int(kinds[-1])
    row[: KINDS * KINDS] = np.sqrt(pairs / len(text))
    words = text.split()
    lines = [x for x in text.split("\n") if x]
    n = len(words)
    if n:
        same = sum(map(str.__eq__, words, words[1:]))
        row[-DENSE:] = (
            np.log1p(n) / 10,
            same / n,
            np.sqrt(same / n),
            len(set(words)) / n,
            len(set(words)) / np.sqrt(n) / 20,
            min(len(text) / n, 40) / 40,
            1 - len(set(lines)) / len(lines),
            1.0,
        )
    return row


@dataclass(frozen=True)
class QualityModel:
    prior: float
    weights: np.ndarray

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return _sigmoid(rows.astype(np.float64) @ self.weights[:-1] + self.weights[-1])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_rows(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> QualityModel:
    """Minimise the non-negative risk with logistic loss; full batches, Adam steps."""
    width = WIDTH + 1
    if len(positive) == 0 or len(unlabelled) == 0:
        # Nothing to learn from: the prior itself.
        weights = np.zeros(width)
        weights[-1] = np.log(prior / (1 - prior))
        return QualityModel(prior, weights)
    # One copy, scaled in place: the driver has little memory to spare.
    x = np.ones((len(positive) + len(unlabelled), width), dtype=np.float32)
    x[: len(positive), :-1] = positive
    x[len(positive) :, :-1] = unlabelled
    own = x[:, :-1]
    mean = own.mean(axis=0, dtype=np.float64)
    own -= mean.astype(np.float32)
    parts = (own[at : at + 512] for at in range(0, len(own), 512))
    scale = np.sqrt(sum((part**2).sum(axis=0, dtype=np.float64) for part in parts) / len(own))
    scale[scale < 1e-3] = 1.0
    own /= scale.astype(np.float32)
    p, u = x[: len(positive)], x[len(positive) :]
    w = np.zeros(width)
    w[-1] = np.log(prior / (1 - prior))
    first, second, averaged = np.zeros(width), np.zeros(width), np.zeros(width)
    softplus = lambda v: np.logaddexp(0, v)
    for step in range(1, STEPS + 1):
        narrow = w.astype(np.float32)
        fp, fu = p @ narrow, u @ narrow
        up = prior * -(_sigmoid(-fp) @ p).astype(np.float64) / len(p)
        # Slope of the part that estimates the risk on negatives, and its value.
        down = _sigmoid(fu) @ u / len(u) - prior * (_sigmoid(fp) @ p) / len(p)
        part = softplus(fu).mean() - prior * softplus(fp).mean()
        slope = up + down if part >= 0 else -down
        slope[:-1] += DECAY * w[:-1]
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        rate = RATE * (1 - step / (STEPS + 1))
        w -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        averaged += w * (step > STEPS // 2) / (STEPS - STEPS // 2)
    w = averaged
    folded = np.append(w[:-1] / scale, w[-1] - (w[:-1] / scale) @ mean)
    return QualityModel(prior, folded)


def _sampled(docs: DataFrame, rows: int, seed: int) -> np.ndarray:
    """Features of at most ``rows`` rows of ``docs``, chosen by a hash of id and text.

    They travel in half precision: all lie between 0 and about 1. Somewhat more than is
    wanted passes by its hash, and each task hands on no more than ``rows``.
    """
    n = max(1, docs.count())

    def run(batches):
        left = rows
        for frame in batches:
            frame = frame.iloc[:left]
            left -= len(frame)
            found = [features(t).astype(np.float16).tobytes() for t in frame["text"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "row": found})

    key = F.xxhash64("doc_id", "text")
    picked = docs.where(share_of(key, 1.25 * rows / n, seed)).mapInPandas(run, "doc_id bigint, row binary")
    got = picked.orderBy(F.xxhash64("doc_id", "row")).limit(rows).collect()
    got = sorted((r["doc_id"] or 0, r["row"]) for r in got)
    found = np.empty((len(got), WIDTH), dtype=np.float32)
    for i, (_, row) in enumerate(got):
        found[i] = np.frombuffer(row, dtype=np.float16)
    return found


def class_prior(labels: DataFrame) -> float:
    """Estimated share of good texts: that of the labelled rows, kept off 0 and 1.

    One row is added on either side, so few labels pull towards one half.
    """
    good = F.count_if(F.col("quality") == 1)
    n, k = labels.agg(F.count("quality"), good).first()
    return (k + 1) / (n + 2)


def fit(docs: DataFrame, labels: DataFrame, prior: float | None = None) -> QualityModel:
    """Fit on ``docs`` (``doc_id``, ``text``) and ``labels`` (``doc_id``, ``quality``).

    Positives are texts labelled 1; all of ``docs`` are the unlabelled text. The
    labels of bad texts serve for the class prior only. The sample is bounded by
    ``FIT_POSITIVES`` and ``FIT_UNLABELLED`` rows. Without positives, or without
    documents, every text scores the prior.
    """
    labels = labels.select(F.col("doc_id").cast("bigint"), "quality")
    docs = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    good = labels.where("quality = 1 AND doc_id IS NOT NULL")
    n = good.count()
    # Twice as many ids as wanted: not every label has its document here.
    some = good.where(share_of(F.col("doc_id"), 2 * FIT_POSITIVES / n if n else 1.0, SEED))
    positive = _sampled(docs.join(some, "doc_id", "left_semi"), FIT_POSITIVES, SEED)
    unlabelled = _sampled(docs, FIT_UNLABELLED, SEED + 1)
    return fit_rows(positive, unlabelled, class_prior(labels) if prior is None else prior)


def score(model: QualityModel, text: Column) -> Column:
    """Score of each text in 0 to 1, higher for better; NULL counts as empty."""

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        found = np.zeros(len(texts))
        for at in range(0, len(texts), 256):
            rows = np.stack([features(t) for t in texts.iloc[at : at + 256]])
            found[at : at + 256] = model.scores(rows)
        return pd.Series(found)

    return run(text)


def keep_good(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score at least ``threshold``, with all their columns."""
    return docs.where(score(model, F.col("text")) >= threshold)
