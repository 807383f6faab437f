"""Toxicity scores: a linear classifier over character n-grams, scaled by naive Bayes log-count ratios.

Features are the character n-grams (3 to 8 bytes of the lower-cased UTF-8 text, hashed) that a text holds. From the
labelled texts each feature gets the log ratio of its smoothed document frequencies in the two classes; the features that
part the classes best are kept, a text's value in one is that ratio, and logistic regression is fitted on top. Scoring is
one pass without a shuffle; the model is an array of a fixed size.

The labelled rows for the fit are a bounded sample (MOST_LABELLED, taken in the order of a hash of doc_id). The frequency
table has a fixed size as well, so the fit needs the same memory at every size of the input.

Edge cases: null and empty texts are scored by the intercept; of several labels of one doc_id the largest counts; rows
without a label value do not train; with no labels, or of one class only, every score is the share of that class
(smoothed by odds of one to two, so that no labels reject nothing); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, documents, map_texts, scratch, stored

#: Most labelled documents that the classifier is fitted on.
MOST_LABELLED = 16_000
SIZES = (3, 4, 5, 6, 7, 8)
BITS = 21
#: Least documents of the sample that a feature stands in.
LEAST_DOCUMENTS = 3
#: Features that the classifier keeps.
KEPT = 4096


def grams(text: str) -> list[np.ndarray]:
    """Hashed n-grams of one text, an array for each n."""
    b = np.frombuffer(b" " + text.encode().translate(LOWER) + b" ", np.uint8)
    return [_hashed(b, n) for n in SIZES if len(b) >= n]


def _hashed(b: np.ndarray, n: int) -> np.ndarray:
    h = np.full(len(b) - n + 1, n, np.uint32)
    for i in range(n):
        h *= np.uint32(0x01000193)
        h ^= b[i : len(b) - n + 1 + i]
    h *= np.uint32(0x9E3779B1)
    h >>= np.uint32(32 - BITS)
    return h


def presence(text: str) -> np.ndarray:
    """The distinct features of a text."""
    found = grams(text)
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint32)


def training_rows(docs: DataFrame, labels: DataFrame, target: str, most: int) -> DataFrame:
    """doc_id, text, y of the sample. The sample is taken from the labels alone and has a fixed bound, so it is broadcast."""
    known = labels.filter(F.col(target).isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(target).cast("int").alias("y"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return documents(docs).join(F.broadcast(sample), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, target: str = "toxic", most: int = MOST_LABELLED) -> dict[str, np.ndarray]:
    """weights: float32 of each feature (0: not kept); bias."""
    rows = training_rows(docs, labels, target, most)

    classes = {bool(y): n for y, n in rows.groupBy(F.col("y") > 0).count().collect()}
    n_neg, n_pos = classes.get(False, 0), classes.get(True, 0)
    weights = np.zeros(1 << BITS, np.float32)
    if not n_neg or not n_pos:
        return {"weights": weights, "bias": np.float64(np.log((n_pos + 1) / (n_neg + 2)))}

    def make():
        n = np.zeros((2, 1 << BITS), np.int32)

        def count(block: dict) -> Iterator[dict]:
            for text, y in zip(block["text"], block["y"], strict=True):
                n[int(y > 0), presence(text)] += 1
            return iter(())

        def finish() -> Iterator[dict]:
            at = np.flatnonzero(n.any(0))
            for i in range(0, len(at), 200_000):
                yield {"feature": (x := at[i : i + 200_000]), "neg": n[0, x], "pos": n[1, x]}

        count.finish = finish
        return count

    counts = map_texts(rows, make, "feature long, neg long, pos long").groupBy("feature").agg(F.sum("neg").cast("double").alias("neg"), F.sum("pos").cast("double").alias("pos"))
    neg, pos, n = F.col("neg"), F.col("pos"), n_neg + n_pos
    # how well presence parts the classes: chi-square of the two-by-two table
    chi = n * F.pow(pos * (n_neg - neg) - neg * (n_pos - pos), 2) / F.greatest(F.lit(1.0), F.lit(float(n_pos * n_neg)) * (neg + pos) * (n - neg - pos))
    with scratch():
        best = stored(counts.filter(neg + pos >= LEAST_DOCUMENTS).orderBy(chi.desc(), "feature").limit(KEPT)).toPandas().sort_values("feature")
    if not len(best):
        return {"weights": weights, "bias": np.float64(np.log((n_pos + 1) / (n_neg + 2)))}
    feature = best.feature.to_numpy()
    ratio = np.log((best.pos.to_numpy() + 1) / (n_pos + 2)) - np.log((best.neg.to_numpy() + 1) / (n_neg + 2))
    slot = np.full(1 << BITS, -1, np.int32)
    slot[feature] = np.arange(len(feature))

    def make_rows():
        def kept(block: dict) -> Iterator[dict]:
            out = []
            for text in block["text"]:
                s = slot[presence(text)]
                out.append(s[s >= 0].tolist())
            yield {"y": [int(v > 0) for v in block["y"]], "features": out, "doc_id": block["doc_id"]}

        return kept

    data = map_texts(rows, make_rows, "doc_id long, y int, features array<int>").toArrow().sort_by("doc_id")  # at most `most` rows of at most KEPT numbers
    y = data["y"].to_numpy().astype(float)
    lists = data["features"].combine_chunks()
    values = lists.flatten().to_numpy()
    row = np.repeat(np.arange(len(y)), np.diff(lists.offsets.to_numpy()))
    w, bias = logistic(row, values, ratio[values], y, len(feature))
    weights[feature] = w * ratio
    return {"weights": weights, "bias": np.float64(bias)}


def logistic(row: np.ndarray, col: np.ndarray, x: np.ndarray, y: np.ndarray, width: int, l2: float = 2e-4, steps: int = 300, rate: float = 0.03) -> tuple[np.ndarray, float]:
    """Weights and bias of logistic regression on sparse rows, by Adam on the whole batch."""
    w, bias = np.zeros(width + 1), np.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    w[-1] = bias
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    for t in range(1, steps + 1):
        z = np.bincount(row, x * w[col], len(y)) + w[-1]
        err = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) / len(y)
        g = np.append(np.bincount(col, x * err[row], width) + l2 * w[:-1], err.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return w[:-1], float(w[-1])


def score(docs: DataFrame, model: dict[str, np.ndarray], threshold: float = 0.5) -> DataFrame:
    """doc_id, score, predicted of every row, from its whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** BITS numbers

    def make():
        weights, bias = shared.value["weights"], float(shared.value["bias"])

        def scored(block: dict) -> Iterator[dict]:
            z = []
            for text in block["text"]:
                hits = [h[weights[h] != 0] for h in grams(text)]
                z.append(bias + float(weights[np.unique(np.concatenate(hits))].sum(dtype=np.float64)) if hits else bias)
            p = 1 / (1 + np.exp(-np.clip(np.array(z, float), -60, 60)))
            yield {"doc_id": block["doc_id"], "score": p, "predicted": (p >= threshold).astype(np.int32)}

        return scored

    return map_texts(documents(docs), make, "doc_id long, score double, predicted int")


def keep_clean(docs: DataFrame, model: dict[str, np.ndarray], threshold: float = 0.5) -> DataFrame:
    """The documents, all columns, whose score is below the threshold."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        weights, bias = shared.value["weights"], float(shared.value["bias"])
        limit = np.log(threshold / (1 - threshold))

        def kept(block: dict) -> Iterator[dict]:
            ok = []
            for i, text in enumerate(block["text"]):
                hits = [h[weights[h] != 0] for h in grams(text or "")]
                if bias + (float(weights[np.unique(np.concatenate(hits))].sum(dtype=np.float64)) if hits else 0.0) < limit:
                    ok.append(i)
            yield {k: [v[i] for i in ok] for k, v in block.items()}

        return kept

    return map_texts(docs, make, kinds)
