"""Quality of a text from its passages: multiple-instance learning with gated attention."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textarrays import LOWER, in_rows, slices, span_hashes, text_bytes, words

PASSAGE_WORDS = 48
FIT_ROWS = 4096
HIDDEN = 16
_HASHED = 16
#: Byte classes: single signs have a class of their own.
_SIGNS = b" \n.,;:!?#$%&*|<>@+-_=()[]\"'/"
_CLASS = np.full(256, len(_SIGNS) + 5, np.int64)
_CLASS[list(_SIGNS)] = np.arange(len(_SIGNS))
_CLASS[97:123] = len(_SIGNS)
_CLASS[65:91] = len(_SIGNS) + 1
_CLASS[48:58] = len(_SIGNS) + 2
_CLASS[128:192] = len(_SIGNS) + 3
_CLASS[192:] = len(_SIGNS) + 4
_CLASSES = len(_SIGNS) + 6
WIDTH = _CLASSES + _HASHED + 4


def passages(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A vector for every passage of some words, and the offset of each row's first passage.

    The vector has the share of each byte class, word length and its spread,
    the share of words that repeat within the passage, and a signed hash of the
    words.  A row without words has one passage of zeros.
    """
    starts, ends, first = words(data, offsets)
    counts = np.diff(first)
    made = np.maximum(1, -(-counts // PASSAGE_WORDS))
    bags = np.concatenate([[0], np.cumsum(made)])
    out = np.zeros((bags[-1], WIDTH), np.float32)
    if not len(starts):
        return out, bags
    row = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(starts)) - first[row]
    of = bags[row] + place // PASSAGE_WORDS
    cuts = np.flatnonzero(place % PASSAGE_WORDS == 0)
    ids = of[cuts]
    until = np.append(starts[cuts[1:]], len(data))
    last = np.append(row[cuts[1:]] != row[cuts[:-1]], True)
    until = np.where(last, offsets[row[cuts] + 1], until)
    length = until - starts[cuts]
    within = np.repeat(np.arange(len(cuts)), length)
    shift = np.repeat(starts[cuts] - np.concatenate([[0], np.cumsum(length)[:-1]]), length)
    kinds = _CLASS[data[np.arange(len(within)) + shift]]
    shares = np.bincount(within * _CLASSES + kinds, minlength=len(cuts) * _CLASSES).reshape(-1, _CLASSES)
    out[ids, :_CLASSES] = np.sqrt(shares / length[:, None])
    n = np.bincount(of, minlength=len(out)).astype(np.float64)
    size = (ends - starts).astype(np.float64)
    mean = np.bincount(of, size, len(out)) / np.maximum(n, 1)
    spread = np.sqrt(np.maximum(np.bincount(of, size**2, len(out)) / np.maximum(n, 1) - mean**2, 0))
    hashes = span_hashes(LOWER[data], starts, ends)
    order = np.lexsort((hashes, of))
    again = np.zeros(len(order))
    again[1:] = (of[order][1:] == of[order][:-1]) & (hashes[order][1:] == hashes[order][:-1])
    repeats = np.bincount(of[order], again, len(out)) / np.maximum(n, 1)
    out[:, _CLASSES] = mean / 8
    out[:, _CLASSES + 1] = spread / 8
    out[:, _CLASSES + 2] = repeats
    out[:, _CLASSES + 3] = n / PASSAGE_WORDS
    slot = (hashes & np.uint64(_HASHED - 1)).astype(np.int64)
    sign = np.where(hashes >> np.uint64(63), 1.0, -1.0)
    signed = np.bincount(of * _HASHED + slot, sign, len(out) * _HASHED).reshape(-1, _HASHED)
    out[:, _CLASSES + 4 :] = signed / np.sqrt(np.maximum(n, 1))[:, None]
    return out, bags


@dataclass
class Model:
    """Weights of the encoder, the two attention gates and the output."""

    weights: dict[str, np.ndarray]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _start(seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float64)
    return {
        "encode": draw(WIDTH, HIDDEN), "shift": np.zeros(HIDDEN), "tanh": draw(HIDDEN, HIDDEN),
        "gate": draw(HIDDEN, HIDDEN), "attend": draw(HIDDEN, 1), "out": draw(HIDDEN, 1), "bias": np.zeros(1),
    }


def _in_order(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """``x @ w``, summed for every row in the same order however many rows there are."""
    out = np.zeros((len(x), w.shape[1]))
    for j in range(len(w)):
        out += x[:, j : j + 1] * w[j].astype(np.float64)
    return out


def _forward(w: dict[str, np.ndarray], x: np.ndarray, bags: np.ndarray, times=np.matmul) -> dict[str, np.ndarray]:
    bag = np.repeat(np.arange(len(bags) - 1), np.diff(bags))
    h = np.tanh(times(x, w["encode"]) + w["shift"])
    t, g = np.tanh(times(h, w["tanh"])), _sigmoid(times(h, w["gate"]))
    e = times(t * g, w["attend"])[:, 0]
    e = np.exp(e - np.maximum.reduceat(e, bags[:-1])[bag])
    a = e / np.add.reduceat(e, bags[:-1])[bag]
    z = np.add.reduceat(h * a[:, None], bags[:-1], axis=0)
    p = _sigmoid(times(z, w["out"])[:, 0] + w["bias"][0])
    return {"bag": bag, "h": h, "t": t, "g": g, "a": a, "z": z, "p": p}


def _gradients(w: dict[str, np.ndarray], x: np.ndarray, bags: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    f = _forward(w, x, bags)
    bag, h, t, g, a = f["bag"], f["h"], f["t"], f["g"], f["a"]
    d = ((f["p"] - y) / len(y))[:, None]
    dz = d @ w["out"].T
    dh = dz[bag] * a[:, None]
    da = (dz[bag] * h).sum(1)
    de = a * (da - np.add.reduceat(a * da, bags[:-1])[bag])
    dq = de[:, None] @ w["attend"].T
    dt, dg = dq * g * (1 - t**2), dq * t * g * (1 - g)
    dh = (dh + dt @ w["tanh"].T + dg @ w["gate"].T) * (1 - h**2)
    return {
        "encode": x.T @ dh, "shift": dh.sum(0), "tanh": h.T @ dt, "gate": h.T @ dg,
        "attend": ((t * g) * de[:, None]).sum(0)[:, None], "out": f["z"].T @ d, "bias": d.sum(0),
    }


def fit(x: np.ndarray, bags: np.ndarray, y: np.ndarray, epochs: int = 30, batch: int = 64, seed: int = 5) -> Model:
    """Weights from passages of labelled texts, by Adam on the log loss."""
    w, rng = _start(seed), np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for i in range(0, len(order), batch):
            some = order[i : i + batch]
            sizes = (bags[1:] - bags[:-1])[some]
            own = np.concatenate([[0], np.cumsum(sizes)])
            rows = np.repeat(bags[some] - own[:-1], sizes) + np.arange(own[-1])
            step += 1
            for k, d in _gradients(w, x[rows], own, y[some]).items():
                d = d + 1e-4 * w[k]
                first[k] = 0.9 * first[k] + 0.1 * d
                second[k] = 0.999 * second[k] + 0.001 * d * d
                rate = 0.01 * (1 - epoch / epochs) + 0.0005
                w[k] = w[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Model({k: v.astype(np.float32) for k, v in w.items()})


def _encode_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        for low, high in slices(texts):
            x, bags = passages(*text_bytes(texts.slice(low, high - low)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("label").slice(low, high - low), in_rows(x.reshape(-1), bags * WIDTH, pa.float32())],
                ["label", "passages"],
            )


def learn(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """A model from ``label`` (0 or 1) of documents, joined on doc_id.

    At most ``fit_rows`` labelled rows are used, those with the smallest hash of
    their id; this bounds what reaches the driver.  Null labels and ids are
    left out.  Without labels the model scores everything alike.
    """
    chosen = (
        labels.filter("doc_id is not null and label is not null").select("doc_id", F.col("label").cast("double"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(fit_rows)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "label")
    found = rows.mapInArrow(_encode_task, "label double, passages array<float>").toArrow().combine_chunks()
    y = found.column("label").to_numpy()
    if not len(y):
        return Model({k: np.zeros_like(v, dtype=np.float32) for k, v in _start(0).items()})
    lists = found.column("passages").chunk(0) if found.column("passages").num_chunks else pa.array([], pa.list_(pa.float32()))
    x = lists.flatten().to_numpy().reshape(-1, WIDTH).astype(np.float64)
    bags = np.concatenate([[0], np.cumsum(np.diff(lists.offsets.to_numpy()) // WIDTH)])
    order = np.lexsort((x[bags[:-1]].sum(1), y, np.diff(bags)))  # the same whatever order the rows came in
    sizes = np.diff(bags)[order]
    own = np.concatenate([[0], np.cumsum(sizes)])
    rows_in = np.repeat(bags[:-1][order] - own[:-1], sizes) + np.arange(own[-1])
    return fit(x[rows_in], own, y[order])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score``, the probability of label 1, from the attention-weighted passages of the whole text.

    Null and empty texts are scored as one empty passage.  Equal texts have equal
    scores wherever they stand.  A column named score is replaced; all other
    columns and equal rows are kept.
    """

    def run(texts: pa.Array) -> pa.Array:
        out = [np.zeros(0)]
        for low, high in slices(texts):
            x, bags = passages(*text_bytes(texts.slice(low, high - low)))
            out.append(_forward(model.weights, x, bags, _in_order)["p"])
        return pa.array(np.concatenate(out).astype(np.float64))

    return docs.withColumn("score", F.arrow_udf(run, "double")(F.col("text")))
