"""Document quality from a linear-chain conditional random field over lines."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waykit.llm import textvec as tv
from waykit.llm.common import DOCUMENT, pick

SAMPLE_DOCS = 4000  # labelled documents a model is fitted on, by a hash of their id
SAMPLE_LINES = 256  # longer documents are scored, but not fitted on
CUTOFF = 0.3
STEPS, RATE, RIDGE = 250, 0.08, 1e-3


def _bytes(chars: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=np.uint32)
    table[list(chars)] = 1
    return table


CLASSES = [
    _bytes(b"#*$%&|<>!@^~=+_\\{}[]"),
    _bytes(bytes(range(65, 91))),
    _bytes(b"0123456789"),
    _bytes(b".,;:'\"()?-/"),
]
OWN = 9  # features of a line by itself
LENT = [0, 1, 4, 5]  # those that its neighbours see
WIDTH = 1 + OWN + 2 * len(LENT) + 2


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, weight, text) of every line of every text; a text has one line more than it has newlines."""
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.r_[offsets[:-1], breaks + 1])
    # A newline at a text's end starts an empty last line at the offset where the next text starts: both are kept.
    text = np.repeat(np.arange(len(offsets) - 1), np.bincount(np.searchsorted(offsets[1:], breaks, "right"), minlength=len(offsets) - 1) + 1)
    first = np.r_[True, text[1:] != text[:-1]]
    last = np.r_[text[1:] != text[:-1], True]
    ends = np.where(last, offsets[text + 1], np.r_[starts[1:] - 1, offsets[-1]])
    ws, we, _ = tv.find_words(data, offsets, tv.NOT_SPACE)
    words = tv.span_hashes(tv.LOWER[data], ws, we)
    low, high = np.searchsorted(ws, starts), np.searchsorted(ws, ends)
    count = high - low
    line = np.repeat(np.arange(len(starts)), count)
    again = np.zeros(len(words) + 1)
    if len(words) > 1:
        again[2:] = np.cumsum((words[1:] == words[:-1]) & (line[1:] == line[:-1]))
    order = np.lexsort((words, line))
    fresh = np.ones(len(words), dtype=bool)
    if len(words) > 1:
        a, b = order[1:], order[:-1]
        fresh[1:] = (words[a] != words[b]) | (line[a] != line[b])
    distinct = np.bincount(line[order][fresh], minlength=len(starts))
    spans = np.r_[0, np.cumsum(we - ws)]
    chars = spans[high] - spans[low]
    own = np.zeros((len(starts), OWN))
    for k, table in enumerate(CLASSES):
        total = np.r_[np.uint32(0), np.cumsum(table[data], dtype=np.uint32)]
        own[:, k] = (total[ends] - total[starts]) / np.maximum(chars, 1)
    many = np.maximum(count, 1)
    own[:, 4] = 1 - distinct / many * (count > 0) - (count == 0)
    own[:, 5] = (again[high] - again[np.minimum(low + 1, high)]) / many
    own[:, 6] = np.log1p(count) / 5
    own[:, 7] = np.minimum(chars / many, 40) / 10
    whole = tv.span_hashes(data, starts, ends)
    key = np.lexsort((np.arange(len(starts)), whole, text))
    seen = np.zeros(len(starts), dtype=bool)
    seen[key[1:]] = (whole[key[1:]] == whole[key[:-1]]) & (text[key[1:]] == text[key[:-1]])
    own[:, 8] = seen & (count > 0)
    lent = own[:, LENT]
    before, after = np.zeros_like(lent), np.zeros_like(lent)
    before[1:] = lent[:-1]
    after[:-1] = lent[1:]
    before[first] = 0
    after[last] = 0
    features = np.hstack([np.ones((len(starts), 1)), own, before, after, first[:, None], last[:, None]])
    return features, np.maximum(ends - starts, 1).astype(float), text


@dataclass
class Chain:
    """Emission weights of a good line against a bad one, transition scores, and the scale of the document score."""

    weights: np.ndarray
    moves: np.ndarray
    scale: tuple[float, float]

    def score(self, mean: np.ndarray) -> np.ndarray:
        a, b = self.scale
        return 1 / (1 + np.exp(-np.clip(a * logit(mean) + b, -30, 30)))


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def forward_backward(emission: np.ndarray, length: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of a good line [D, T] and expected moves [D, 2, 2] of padded chains."""
    d, t = emission.shape
    local = np.stack([np.zeros_like(emission), emission], axis=-1)
    forward, backward = np.zeros((d, t, 2)), np.zeros((d, t, 2))
    forward[:, 0] = local[:, 0]
    for k in range(1, t):
        step = np.logaddexp.reduce(forward[:, k - 1, :, None] + moves, axis=1) + local[:, k]
        forward[:, k] = step - step.max(axis=1, keepdims=True)
    for k in range(t - 2, -1, -1):
        step = np.logaddexp.reduce(moves + (local[:, k + 1] + backward[:, k + 1])[:, None, :], axis=2)
        step = step - step.max(axis=1, keepdims=True)
        backward[:, k] = np.where((k + 1 < length)[:, None], step, 0.0)
    odds = forward + backward
    good = 1 / (1 + np.exp(np.clip(odds[..., 0] - odds[..., 1], -500, 500)))
    if t == 1:
        return good, np.zeros((d, 2, 2))
    pair = forward[:, :-1, :, None] + moves + (local[:, 1:] + backward[:, 1:])[:, :, None, :]
    pair = np.exp(pair - pair.max(axis=(2, 3), keepdims=True))
    pair /= pair.sum(axis=(2, 3), keepdims=True)
    inside = np.arange(1, t)[None, :] < length[:, None]
    return good, (pair * inside[..., None, None]).sum(axis=1)


def padded(features: np.ndarray, weight: np.ndarray, text: np.ndarray, n: int) -> Iterator[tuple]:
    """(texts, features [D, T, F], weights [D, T], lengths) of texts of about the same number of lines."""
    length = np.bincount(text, minlength=n)
    start = np.r_[0, np.cumsum(length)[:-1]]
    order = np.argsort(length, kind="stable")
    at = 0
    while at < n:
        end = at + 1
        most = max(int(length[order[at]]) * 2, 8)
        while end < n and length[order[end]] <= most:
            end += 1
        who = order[at:end]
        t = int(length[who].max())
        slot = start[who][:, None] + np.minimum(np.arange(t), length[who][:, None] - 1)
        inside = np.arange(t) < length[who][:, None]
        yield who, features[slot] * inside[..., None], weight[slot] * inside, length[who]
        at = end


def document_means(features: np.ndarray, weight: np.ndarray, text: np.ndarray, n: int, model: Chain) -> np.ndarray:
    """Length-weighted mean of the marginals of each text."""
    out = np.zeros(n)
    for who, x, w, length in padded(features, weight, text, n):
        good, _ = forward_backward(x @ model.weights, length, model.moves)
        out[who] = (good * w).sum(axis=1) / w.sum(axis=1)
    return out


def fit(features: np.ndarray, weight: np.ndarray, text: np.ndarray, label: np.ndarray) -> Chain:
    """Maximum likelihood with a ridge; every line bears the label of its document, documents weigh alike."""
    n = len(label)
    model = Chain(np.zeros(WIDTH), np.zeros((2, 2)), (1.0, 0.0))
    if n == 0:
        return model
    batches = list(padded(features, weight, text, n))
    theta = np.zeros(WIDTH + 4)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        slope = -RIDGE * theta * n
        for who, x, _, length in batches:
            good, moved = forward_backward(x @ theta[:WIDTH], length, theta[WIDTH:].reshape(2, 2))
            y = label[who].astype(float)
            share = 1 / length
            inside = np.arange(x.shape[1]) < length[:, None]
            slope[:WIDTH] += np.einsum("dt,dtf->f", (y[:, None] - good) * inside * share[:, None], x)
            seen = np.zeros((len(who), 2, 2))
            seen[np.arange(len(who)), label[who], label[who]] = length - 1
            slope[WIDTH:] += ((seen - moved) * share[:, None, None]).sum(axis=0).ravel()
        slope /= n
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        theta += RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    model = Chain(theta[:WIDTH], theta[WIDTH:].reshape(2, 2), (1.0, 0.0))
    x = logit(document_means(features, weight, text, n, model))
    a, b = 1.0, 0.0
    for _ in range(200):  # the scale that makes the mean a probability of label 1
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        a += 0.05 * (((label - p) * x).mean() - 0.01 * (a - 1))
        b += 0.05 * (label - p).mean()
    return Chain(model.weights, model.moves, (max(a, 0.05), b))


def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, features, weights) of each text of at most ``SAMPLE_LINES`` lines."""
    for batch in batches:
        ids, label, feats, weights, kept = batch.column(0).to_pylist(), batch.column(2).to_pylist(), [], [], []
        for first, end, data, offsets in tv.text_chunks(batch.column(1)):
            f, w, text = line_features(data, offsets)
            cuts = np.searchsorted(text, np.arange(end - first + 1))
            for i in range(end - first):
                if cuts[i + 1] - cuts[i] <= SAMPLE_LINES:
                    kept.append(first + i)
                    feats.append(f[cuts[i] : cuts[i + 1]].astype(np.float32).tobytes())
                    weights.append(w[cuts[i] : cuts[i + 1]].tobytes())
        yield pa.record_batch(
            [pa.array([ids[i] for i in kept], pa.int64()), pa.array([label[i] for i in kept], pa.int32()),
             pa.array(feats, pa.binary()), pa.array(weights, pa.binary())],
            ["doc_id", "label", "features", "weights"],
        )


def held_out(doc_id: Column) -> Column:
    """Rows never learnt from; those without doc_id are among them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame) -> Chain:
    """A model from at most ``SAMPLE_DOCS`` labelled documents outside the held-out fold.

    The sample is the labelled ids of smallest hash, so it is the same at every run; ids whose labels contradict
    each other are left out. Only line features of these documents reach the driver.
    """
    known = (
        pick(labels, doc_id="bigint", quality="int")
        .where("quality IN (0, 1)")
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("label"), F.max("quality").alias("most"))
        .where("label = most")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .select("doc_id", "label")
        .limit(SAMPLE_DOCS)
    )
    texts = pick(docs, doc_id="bigint", text="string").join(F.broadcast(known), "doc_id")  # SAMPLE_DOCS rows
    features = texts.select("doc_id", "text", "label").mapInArrow(
        gather, "doc_id bigint, label int, features binary, weights binary"
    )
    # More rows than ids only where rows repeat an id.
    rows = features.limit(2 * SAMPLE_DOCS).toPandas().sort_values(["doc_id", "features"])
    feats = [np.frombuffer(f, np.float32).reshape(-1, WIDTH) for f in rows["features"]]
    if not feats:
        return fit(np.zeros((0, WIDTH)), np.zeros(0), np.zeros(0, int), np.zeros(0, int))
    text = np.repeat(np.arange(len(feats)), [len(f) for f in feats])
    weights = np.concatenate([np.frombuffer(w) for w in rows["weights"]])
    return fit(np.concatenate(feats).astype(float), weights, text, rows["label"].to_numpy(int))


def scorer(model: Chain):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for first, end, data, offsets in tv.text_chunks(batch.column(batch.num_columns - 1)):
                f, w, text = line_features(data, offsets)
                scores[first:end] = model.score(document_means(f, w, text, end - first, model))
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.record_batch([*kept, pa.array(scores)], [*batch.schema.names[:-1], "score"])

    return run


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs``.

    Lines are labelled good or bad by a linear-chain conditional random field with features of the line and of
    its neighbours; forward-backward marginals, weighted by line length, give the document's mean, which a logistic
    scale fitted on the same sample turns into ``score``. ``predicted`` is 1 from 0.3 on. Inputs are the text alone.
    The sample of labelled rows is bounded (``SAMPLE_DOCS``); every whole text is scored where it lies, without a shuffle.

    Null or empty text is one empty line and gets a score too. Repeated rows get equal scores. Without
    labels every score is 0.5. Other columns are ignored.
    """
    model = train(docs, labels)
    texts = pick(docs, doc_id="bigint", text="string").select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    scored = texts.mapInArrow(scorer(model), "doc_id bigint, held_out boolean, score double")
    return scored.withColumn("predicted", F.when(F.col("score") >= CUTOFF, 1).otherwise(0))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents predicted good, with the columns of documents."""
    model = train(docs, labels)
    named = pick(docs, **DOCUMENT).withColumn("_read", F.col("text"))
    schema = ", ".join(f"{n} {t}" for n, t in DOCUMENT.items()) + ", score double"
    return named.mapInArrow(scorer(model), schema).where(F.col("score") >= CUTOFF).drop("score")


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score_documents(docs, labels)
