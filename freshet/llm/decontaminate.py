"""Benchmark decontamination: pieces of each item are found exactly, and the places verified by edit distance."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import ArrowUDFType

ERROR = 0.08
MIN_CHARS = 24
BLOCK_CHARS = 4_000_000


def normal(text: str | None) -> str:
    """Lower case with single spaces."""
    return " ".join((text or "").lower().split())


def cut(item: str, errors: int) -> list[tuple[int, str]]:
    """``errors + 1`` pieces of nearly equal length with their places.

    If the item occurs with at most ``errors`` edits, at least one piece occurs unchanged.
    """
    n, k = len(item), errors + 1
    edges = [i * n // k for i in range(k + 1)]
    return [(a, item[a:b]) for a, b in zip(edges, edges[1:], strict=False)]


def best_match(pattern: dict[str, int], size: int, text: str, most: int) -> tuple[int, int] | None:
    """Smallest edit distance of the pattern to a part of ``text``, and where that part ends.

    Myers' bit-parallel rows: one bit per pattern character holds whether the
    column's value goes up or down; the score of the last row is followed.
    None if the distance is above ``most``.
    """
    full, top = (1 << size) - 1, 1 << (size - 1)
    up, down, score = full, 0, size
    best = (most + 1, -1)
    for i, c in enumerate(text):
        eq = pattern.get(c, 0)
        vertical = eq | down
        same = (((eq & up) + up) ^ up) | eq
        grow = down | (full & ~(same | up))
        shrink = up & same
        if grow & top:
            score += 1
        elif shrink & top:
            score -= 1
        grow, shrink = (grow << 1) & full, (shrink << 1) & full
        up = shrink | (full & ~(vertical | grow))
        down = grow & vertical
        if score < best[0]:
            best = (score, i + 1)
    return best if best[1] >= 0 else None


def masks(item: str) -> dict[str, int]:
    """For each character, the bits of its places in the item."""
    out: dict[str, int] = {}
    for i, c in enumerate(item):
        out[c] = out.get(c, 0) | 1 << i
    return out


class Matcher:
    """All items of one block: an automaton of their pieces, and what verification needs."""

    def __init__(self, items: list[tuple[int | None, str]], error: float, min_chars: int = 0):
        self.items = items
        self.errors = [0 if len(t) < min_chars else int(len(t) * error) for _, t in items]
        self.short = [len(t) < min_chars for _, t in items]
        self.bits: dict[int, tuple[dict[str, int], dict[str, int]]] = {}
        wanted: dict[str, list[tuple[int, int]]] = {}
        for i, (_, item) in enumerate(items):
            for at, piece in cut(item, self.errors[i]):
                wanted.setdefault(piece, []).append((i, at))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in wanted.items():
            self.automaton.add_word(piece, (len(piece), owners))
        if wanted:
            self.automaton.make_automaton()

    def find(self, text: str | None) -> list[tuple[int | None, int, int, int]]:
        """(item id, distance, start, end) of the best place of each item in the normalised text."""
        text = normal(text)
        if not text or not len(self.automaton):
            return []
        windows: dict[int, list[list[int]]] = {}
        exact: dict[int, tuple[int | None, int, int, int]] = {}
        for last, (size, owners) in self.automaton.iter(text):
            for i, at in owners:
                if self.short[i]:
                    start = last + 1 - size
                    if i not in exact and not text[max(0, start - 1) : start].isalnum() and not text[last + 1 : last + 2].isalnum():
                        exact[i] = (self.items[i][0], 0, start, last + 1)
                    continue
                k, n = self.errors[i], len(self.items[i][1])
                start = last + 1 - size - at
                low, high = max(0, start - k), min(len(text), start + n + k)
                open_ = windows.setdefault(i, [])
                if open_ and low <= open_[-1][1]:
                    open_[-1][0], open_[-1][1] = min(low, open_[-1][0]), max(high, open_[-1][1])
                else:
                    open_.append([low, high])
        return [*exact.values(), *(hit for i, open_ in windows.items() if (hit := self._best(i, text, open_)))]

    def _best(self, i: int, text: str, windows: list[list[int]]) -> tuple[int, int, int, int] | None:
        item_id, item = self.items[i]
        if i not in self.bits:
            self.bits[i] = (masks(item), masks(item[::-1]))
        forward, backward = self.bits[i]
        best = None
        for low, high in windows:
            found = best_match(forward, len(item), text[low:high], self.errors[i] if best is None else best[1] - 1)
            if found:
                distance, end = found[0], low + found[1]
                back = best_match(backward, len(item), text[max(0, end - len(item) - distance) : end][::-1], distance)
                best = (item_id, distance, end - back[1], end)
        return best


def find_leaks(docs: DataFrame, items: DataFrame, error: float = ERROR, min_chars: int = MIN_CHARS) -> DataFrame:
    """Places where a document holds a benchmark item: doc_id, item_id, distance, start, end.

    Both texts are compared in lower case with single spaces, and start and end
    count characters of that form.  An item is held if some part of the text
    differs from it by at most ``error`` times its length in edits; the row
    tells the closest place, the first of several.  Items shorter than
    ``min_chars`` are held only where they stand unchanged between characters
    that are no letters or digits.  Items without an id are looked for like others and
    reported with a null id; those without any character are held by nothing.

    Items go to the tasks in blocks of at most about :data:`BLOCK_CHARS`
    characters, one pass over the documents per block, so neither driver nor
    tasks hold more than one block.  Null and empty texts hold nothing and are
    held by nothing; repeated rows of either table give repeated rows.
    """
    parts = []
    for hits in _blocks(items, error, min_chars):
        parts.append(docs.select("doc_id", hits.alias("hits")).select("doc_id", F.inline("hits")))
    return reduce(DataFrame.unionByName, parts)


def drop_leaks(docs: DataFrame, items: DataFrame, error: float = ERROR, min_chars: int = MIN_CHARS) -> DataFrame:
    """Rows of ``docs`` whose text holds no item; all columns, repeated rows and null texts are kept."""
    for hits in _blocks(items, error, min_chars):
        docs = docs.filter(F.size(hits) == 0)
    return docs


def _blocks(items: DataFrame, error: float, min_chars: int) -> Iterator[Column]:
    """For each block of items, the matches in ``text`` as an array of structs."""
    items = items.filter("text is not null").select("item_id", "text")
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = int(chars // BLOCK_CHARS) + 1
    numbered = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    for b in range(blocks):
        part = [(r.item_id, normal(r.text)) for r in numbered.filter(F.col("block") == b).collect()]
        part = sorted((x for x in part if x[1]), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        yield _matches(part, error, min_chars)(F.col("text"))


def _matches(items: list[tuple[int | None, str]], error: float, min_chars: int):
    """A column function that looks for the items of one block; the automaton is built once per task."""
    kind = pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
    names = ("item_id", "distance", "start", "end")

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        matcher = Matcher(items, error, min_chars)
        for batch in texts:
            yield pa.array([
                [dict(zip(names, hit, strict=True)) for hit in matcher.find(text.as_py())] for text in batch
            ], pa.list_(kind))

    return F.arrow_udf(run, "array<struct<item_id:bigint,distance:int,start:int,end:int>>", ArrowUDFType.SCALAR_ITER)
