"""Language proportions of a text: a mixture of n-gram models fitted by expectation-maximisation."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textarrays import LOWER, slices, text_bytes

BUCKETS = 1 << 14
ROUNDS = 8
MORE_ROUNDS = 3
#: Overlapping trigrams repeat each other's evidence; a trigram counts as a third of an observation.
WEIGHT = 1 / 3
UNKNOWN = "und"

_LETTER = np.zeros(256, bool)
_LETTER[list(range(97, 123)) + list(range(128, 256))] = True


@dataclass
class Model:
    """Languages in code point order and the probability of each n-gram bucket in each of them."""

    langs: list[str]
    prob: np.ndarray  # buckets x languages


def _letters(data: np.ndarray) -> np.ndarray:
    """Lower-case bytes, also for letters of Latin-1; whatever is no letter becomes a space."""
    low = LOWER[data]
    after = np.zeros(len(data), bool)
    after[1:] = data[:-1] == 0xC3
    upper = after & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)
    low = np.where(upper, low + np.uint8(0x20), low)
    return np.where(_LETTER[low], low, np.uint8(0x20))


def ngrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct trigram buckets of each row, how often each occurs, and the offset of each row.

    A trigram is a byte of a letter with its neighbours; the ends of a row count as spaces.
    """
    low = _letters(data).astype(np.uint32)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    left, right = np.full(len(low), 32, np.uint32), np.full(len(low), 32, np.uint32)
    left[1:], right[:-1] = low[:-1], low[1:]
    inner = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(low))]
    left[inner], right[inner - 1] = 32, 32
    here = low != 32
    code = ((left << 16) | (low << 8) | right)[here]
    bucket = ((code * np.uint32(2654435761)) >> np.uint32(18)).astype(np.int64)
    ends = np.searchsorted(row[here], np.arange(len(offsets)))
    found, times, sizes = [], [], [0]
    for i in range(len(offsets) - 1):
        counts = np.bincount(bucket[ends[i] : ends[i + 1]])
        at = np.flatnonzero(counts)
        found.append(at)
        times.append(counts[at])
        sizes.append(sizes[-1] + len(at))
    none = np.zeros(0, np.int64)
    return np.concatenate(found or [none]), np.concatenate(times or [none]), np.array(sizes)


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-gram counts of one task by language."""
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        texts, langs = batch.column("text"), batch.column("lang").to_pylist()
        for low, high in slices(texts):
            bucket, times, sizes = ngrams(*text_bytes(texts.slice(low, high - low)))
            for i, lang in enumerate(langs[low:high]):
                at = slice(sizes[i], sizes[i + 1])
                totals.setdefault(lang, np.zeros(BUCKETS, np.int64))[bucket[at]] += times[at]
    for lang, counts in totals.items():
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(counts[at])],
            ["lang", "bucket", "n"],
        )


def learn(labelled: DataFrame, smooth: float = 0.5) -> Model:
    """N-gram models from ``text`` and ``lang`` of all rows with both; counted and summed by Spark.

    The model has a fixed number of buckets per language, so what reaches the
    driver depends on the number of languages only.
    """
    rows = labelled.filter("text is not null and lang is not null").select("text", "lang")
    counts = (
        rows.mapInArrow(_count_task, "lang string, bucket int, n bigint")
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    )
    names = counts.column("lang").to_pylist()
    langs = sorted(set(names))
    table = np.full((BUCKETS, len(langs)), smooth)
    where = {lang: i for i, lang in enumerate(langs)}
    np.add.at(
        table, (counts.column("bucket").to_numpy(), np.array([where[x] for x in names], int)),
        counts.column("n").to_numpy(),
    )
    return Model(langs, (table / table.sum(0, keepdims=True)).astype(np.float32))


def _fit(prob: np.ndarray, times: np.ndarray, sizes: np.ndarray, share: np.ndarray, rounds: int):
    """Proportions and log-likelihood of each row after some rounds of expectation-maximisation.

    Languages are the first axis of ``prob`` and ``share``, so every step runs along the n-grams.
    """
    each = np.diff(sizes)
    some = np.flatnonzero(each > 0)
    total = np.ones(len(each), np.float32)
    total[some] = np.add.reduceat(times, sizes[some])
    weight = times.astype(np.float32)
    for _ in range(rounds):
        joint = prob * np.repeat(share, each, axis=1)
        joint *= weight / np.maximum(joint.sum(0), np.float32(1e-30))
        share = np.zeros_like(share)
        share[:, some] = np.add.reduceat(joint, sizes[some], axis=1)
        share /= total
    fit = np.zeros(len(each))
    mixed = np.maximum((prob * np.repeat(share, each, axis=1)).sum(0), np.float32(1e-30))
    fit[some] = np.add.reduceat(times * np.log(mixed), sizes[some])
    return share, fit


def proportions(model: Model, bucket: np.ndarray, times: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Language proportions of each row over the language set of highest penalised likelihood.

    Starting from all languages, the one with the smallest proportion is left
    out until one is left; each language costs half a logarithm of the number
    of observations.
    """
    n, k = len(sizes) - 1, len(model.langs)
    if not k or not len(bucket):
        return np.zeros((n, k), np.float32)
    prob = np.ascontiguousarray(model.prob[bucket].T)
    share, fit = _fit(prob, times, sizes, np.full((k, n), 1 / k, np.float32), ROUNDS)
    seen = np.concatenate([[0], np.cumsum(times)])[sizes]
    cost = 0.5 * np.log(np.maximum((seen[1:] - seen[:-1]) * WEIGHT, 2))
    best, value = share.copy(), WEIGHT * fit - cost * (share > 0).sum(0)
    for left in range(k - 1, 0, -1):
        weak = np.where(share > 0, share, np.inf).argmin(0)
        more = np.flatnonzero((share > 0).sum(0) > left)
        share = share.copy()
        share[weak[more], more] = 0
        share /= np.maximum(share.sum(0), np.float32(1e-30))
        share, fit = _fit(prob, times, sizes, share, MORE_ROUNDS)
        now = WEIGHT * fit - cost * (share > 0).sum(0)
        better = now > value
        best[:, better], value = share[:, better], np.maximum(value, now)
    return best.T


def _has_letter(texts: pa.Array, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    letters = np.concatenate([[0], np.cumsum((LOWER[data] >= 97) & (LOWER[data] <= 122))])
    other = np.concatenate([[0], np.cumsum(data >= 128)])
    found = letters[offsets[1:]] > letters[offsets[:-1]]
    for i in np.flatnonzero(~found & (other[offsets[1:]] > other[offsets[:-1]])):
        found[i] = any(map(str.isalpha, texts[int(i)].as_py()))
    return found


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred, score and languages.

    ``lang_pred`` is the language with the largest proportion (the first by
    code point if several have it), ``score`` its proportion, ``languages`` the
    chosen set with the proportions, largest first.  Text that is null or has
    no letter gives ``und``, 0 and no languages; so does a model without
    languages.  Only the text is looked at.  Columns of those three names are
    replaced; all others and equal rows are kept.
    """
    kind = pa.struct([
        ("lang", pa.string()), ("score", pa.float64()),
        ("languages", pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))),
    ])

    def run(texts: pa.Array) -> pa.Array:
        out = []
        for low, high in slices(texts):
            part = texts.slice(low, high - low).fill_null("")
            data, offsets = text_bytes(part)
            known = _has_letter(part, data, offsets)
            shares = proportions(model, *ngrams(data, offsets))
            for i in range(len(part)):
                order = [j for j in np.argsort(-shares[i], kind="stable") if shares[i, j] > 0]
                if not known[i] or not order:
                    out.append({"lang": UNKNOWN, "score": 0.0, "languages": []})
                    continue
                top = [{"lang": model.langs[j], "share": float(min(1.0, shares[i, j]))} for j in order]
                out.append({"lang": top[0]["lang"], "score": top[0]["share"], "languages": top})
        return pa.array(out, kind)

    udf = F.arrow_udf(run, "struct<lang:string,score:double,languages:array<struct<lang:string,share:double>>>")
    name = max(docs.columns, key=len) + "_"
    found = docs.withColumn(name, udf(F.col("text")))
    return found.withColumns({
        "lang_pred": F.col(name)["lang"], "score": F.col(name)["score"], "languages": F.col(name)["languages"]
    }).drop(name)
