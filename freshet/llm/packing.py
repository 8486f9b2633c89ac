"""Token sequences packed from documents by linear grouping.

Lengths are whole numbers up to the capacity, so a table of how many pieces have
each length is small however many pieces there are.  The plan is made from that
table alone; pieces then find their places by arithmetic on their numbers.

* Large pieces are put in order of length and divided into groups of equally
  many; each counts as long as the longest of its group.
* The few rounded lengths give a small cutting-stock problem.  It is solved by
  generating configurations (which lengths share a sequence); whole multiples are
  taken from the fractional optimum and the rest is fitted one by one.
* Each place of a configuration takes an actual piece of its group.
* Small pieces are fitted best into the room that the actual pieces leave, the
  largest first, again worked out on counts of equal gaps and equal lengths.
"""

from __future__ import annotations

import json
import os
import re
from bisect import bisect_left, insort
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..runtime import durable
from .textarrays import slices

#: Pieces longer than this share of the capacity are large.  Lower shares leave fewer pieces for the best fit: on 10,000
#: documents 1/8 takes 0.56 %, 1/4 0.30 % and 1/3 0.08 % more sequences than the ids fill.
LARGE_SHARE = 1 / 3
#: Groups of large pieces.
GROUPS = 96
#: Pivots of the configuration problem; the solution is valid after any number.
PIVOTS = 4000
#: Bytes of a text that are split into words at a time, and of the words kept with their ids in a worker.
CHUNK_BYTES, KEPT_BYTES, LONGEST_KEPT = 1_000_000, 80_000_000, 64

_workers: dict = {}


#: The splitting of tokenizers that lower-case and never join letters with anything else.
LETTERS_APART = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""
APART_STEPS = ["NFC", "Replace", "Lowercase"]
LATIN = re.compile("[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+")
#: Byte-level vocabularies write bytes without a visible Latin-1 character as the characters from 256 on.
BYTE_CHARACTERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174))}


class _Words(dict):
    """Ids of words, worked out when first asked for; of older words those asked for again are kept.

    A word of Latin letters is one piece for the tokenizer's model, which is given its
    bytes as the characters that stand for them; a point or comma after a letter is
    a piece of its own; other words go through the whole tokenizer.
    """

    def __init__(self, tokenizer):
        self.tokenizer, self.model = tokenizer, tokenizer.model
        self.older: dict[bytes, bytes] = {}
        self.bytes = 0

    def _encode(self, word: bytes) -> bytes:
        if word[-1:] in (b".", b",") and word[-2:-1].isalpha():
            return self[word[:-1]] + self[word[-1:]]
        if word.isalpha():  # of bytes: ASCII letters only
            ids = [t.id for t in self.model.tokenize(word.lower().decode())]
        elif LATIN.fullmatch(text := word.decode()):
            ids = [t.id for t in self.model.tokenize(text.lower().encode().decode("latin-1").translate(BYTE_CHARACTERS))]
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self._encode(word)
        if len(word) <= LONGEST_KEPT:
            if self.bytes > KEPT_BYTES:
                self.older = dict(self)
                self.clear()
                self.bytes = 0
            self[word] = ids
            self.bytes += len(word) + len(ids) + 150
        return ids

    def ids(self, text: bytes) -> bytes:
        return b"".join(b"".join(map(self.__getitem__, words)) for words in _word_lists(text))


class _Whole:
    """Ids of whole texts, for any tokenizer."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer

    def ids(self, text: bytes) -> bytes:
        return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, "<u4").tobytes()


def _worker(path: str) -> _Words | _Whole:
    """The encoder of a tokenizer file, kept for the next task of the process."""
    if path not in _workers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        config = json.loads(tokenizer.to_str())
        steps = [x["type"] for x in (config["normalizer"] or {}).get("normalizers", [])]
        splits = [x.get("pattern") for x in (config["pre_tokenizer"] or {}).get("pretokenizers", [])]
        apart = steps == APART_STEPS and splits[:1] == [{"Regex": LETTERS_APART}] and len(splits) == 2 and config["model"]["type"] == "BPE"
        _workers[path] = _Words(tokenizer) if apart else _Whole(tokenizer)
    return _workers[path]


def _word_lists(text: bytes) -> Iterator[list[bytes]]:
    """Words between ASCII white space, of one stretch of the text at a time."""
    start = 0
    while len(text) - start > CHUNK_BYTES:
        end = start + CHUNK_BYTES
        while end < len(text) and text[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        yield text[start:end].split()
        start = end
    yield text[start:].split()


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, text: str = "text") -> DataFrame:
    """Token pieces of every document: its other columns, ``piece``, ``start``, ``length`` and ``ids``.

    A document's ids are those that the tokenizer file ``tokenizer`` gives for the
    whole text, without added tokens, and then ``end_id``; a null text is an empty
    one.  Only a longer document is cut, into pieces of ``capacity`` ids, of which
    the last may be shorter.  ``ids`` holds them as little-endian 32-bit numbers.
    A tokenizer that by its configuration never joins letters with anything else
    (:data:`LETTERS_APART`) encodes words between ASCII white space on their own and
    remembers them; any other one encodes each text as a whole.
    Rows are independent: repeated and null ids are rows like all others, and an
    empty table gives no rows.  Columns named like the new ones are refused.
    """
    others = [f for f in docs.schema.fields if f.name != text]
    new = ["piece", "start", "length", "ids"]
    if set(new) & {f.name for f in others}:
        raise ValueError(f"columns may not be named {new}")
    out = T.StructType([
        T.StructField("row", T.StructType(others)), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
    ])
    last = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _worker(tokenizer)
        for batch in batches:
            for a, b in slices(batch.column("text")):
                part = batch.slice(a, b - a)
                rows, piece, start, cut = [], [], [], []
                for i, value in enumerate(part.column("text").cast(pa.binary()).to_pylist()):
                    ids = words.ids(value or b"") + last
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        rows.append(i)
                        piece.append(k)
                        start.append(at // 4)
                        cut.append(ids[at : at + 4 * capacity])
                yield pa.RecordBatch.from_arrays([
                    part.column("row").take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array([len(c) // 4 for c in cut], pa.int64()), pa.array(cut, pa.binary()),
                ], ["row", "piece", "start", "length", "ids"])

    row = F.struct(*[F.col(f.name) for f in others])
    pieces = docs.select(row.alias("row"), F.col(text).alias("text")).mapInArrow(run, out)
    return pieces.select(*[F.col("row")[f.name].alias(f.name) for f in others], *new)


def configurations(sizes: Sequence[int], demand: Sequence[int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """How many sequences hold which sizes: (count, {index of the size: pieces of it}), as few sequences as found.

    Sizes are distinct and larger than 0.  Configurations come from the linear
    relaxation by column generation; each new one is the best by a knapsack over
    the shadow prices.
    """
    k = len(sizes)
    if not k:
        return []
    sizes, demand = np.array(sizes), np.array(demand, float)
    most = int(capacity // sizes.min())

    def best(price: np.ndarray) -> np.ndarray:
        value, picked = np.zeros(capacity + 1), []
        for _ in range(most):
            better, pick = value.copy(), np.full(capacity + 1, -1)
            for i in np.flatnonzero(price > 1e-12):
                offer = value[: capacity + 1 - sizes[i]] + price[i]
                win = offer > better[sizes[i] :] + 1e-12
                better[sizes[i] :][win] = offer[win]
                pick[sizes[i] :][win] = i
            picked.append(pick)
            value = better
        column, room = np.zeros(k), capacity
        for pick in reversed(picked):
            if pick[room] >= 0:
                column[pick[room]] += 1
                room -= sizes[pick[room]]
        return column

    basis = np.diag(capacity // sizes).astype(float)
    inverse = np.linalg.inv(basis)
    for pivot in range(PIVOTS):
        price = inverse.sum(axis=0)
        column = best(price)
        if price @ column <= 1 + 1e-7:
            break
        amount, change = inverse @ demand, inverse @ column
        ratio = np.full(k, np.inf)
        ratio[change > 1e-9] = np.maximum(amount[change > 1e-9], 0) / change[change > 1e-9]
        out = int(ratio.argmin())
        basis[:, out] = column
        if pivot % 50 == 49:
            inverse = np.linalg.inv(basis)
        else:
            pivot_row = inverse[out] / change[out]
            inverse -= np.outer(change, pivot_row)
            inverse[out] = pivot_row
    left = np.array([int(d) for d in demand])
    columns, found = basis.T.astype(int), []
    for count, column in zip(np.floor(np.linalg.solve(basis, demand) + 1e-7), columns, strict=True):
        used = np.flatnonzero(column)
        count = max(0, min(int(count), *(int(left[i] // column[i]) for i in used))) if len(used) else 0
        if count:
            left -= count * column
            found.append((count, {int(i): int(column[i]) for i in used}))
    rooms: list[tuple[int, dict[int, int]]] = []
    for i in np.argsort(-sizes, kind="stable"):
        for _ in range(left[i]):
            fits = [r for r in rooms if r[0] >= sizes[i]]
            if fits:
                tight = min(fits, key=lambda r: r[0])
                rooms.remove(tight)
            else:
                tight = (capacity, {})
            rooms.append((int(tight[0] - sizes[i]), {**tight[1], int(i): tight[1].get(int(i), 0) + 1}))
    return found + [(1, held) for _, held in rooms]


def plan_large(lengths: dict[int, int], capacity: int, groups: int) -> tuple[list[tuple[int, int, int]], int]:
    """Where the large pieces go: (first number, first sequence, pieces a sequence) by number, and the sequences used.

    Pieces are numbered from the longest to the shortest; piece r of an entry goes
    to sequence ``first sequence + (r - first number) // pieces``.  Pieces that
    fill a sequence have one each.
    """
    full = lengths.get(capacity, 0)
    order = sorted((n for n in lengths if n < capacity), reverse=True)
    ends = np.cumsum([lengths[n] for n in order]) if order else np.zeros(0, int)
    total = int(ends[-1]) if order else 0
    entries = [(0, 0, 1)] if full else []
    if not total:
        return entries, full
    each = -(-total // groups)
    sizes: list[int] = []
    demand: list[int] = []
    for first in range(0, total, each):
        size = order[int(np.searchsorted(ends, first, "right"))]
        count = min(each, total - first)
        if sizes and sizes[-1] == size:
            demand[-1] += count
        else:
            sizes.append(size)
            demand.append(count)
    cursor = [full + int(x) for x in np.concatenate([[0], np.cumsum(demand)[:-1]])]
    used = full
    for count, held in configurations(sizes, demand, capacity):
        for i, pieces in held.items():
            entries.append((cursor[i], used, pieces))
            cursor[i] += count * pieces
        used += count
    return sorted(entries), used


def plan_small(gaps: dict[int, int], lengths: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int]], int]:
    """Best fit, largest first: (first number, gap, first of the gap, pieces a sequence) by number, and the new sequences.

    Pieces are numbered from the longest to the shortest, sequences with the same
    gap from 0; gap -1 stands for new sequences.  Equal pieces go on filling the
    sequence that one of them was fitted to, since it is then the tightest.
    """
    rooms: dict[int, list[tuple[int, int, int]]] = {g: [(g, 0, n)] for g, n in gaps.items() if g and n}
    known = sorted(rooms)
    entries: list[tuple[int, int, int, int]] = []
    number = opened = 0

    def put(gap: int, room: tuple[int, int, int]) -> None:
        if gap and room[2]:
            if gap not in rooms:
                rooms[gap] = []
                insort(known, gap)
            rooms[gap].append(room)

    for size in sorted(lengths, reverse=True):
        left = lengths[size]
        while left:
            at = bisect_left(known, size)
            if at < len(known):
                gap = known[at]
                origin, first, count = rooms[gap].pop()
                if not rooms[gap]:
                    del rooms[gap], known[at]
            else:
                each = capacity // size
                gap, origin, first, count = capacity, -1, opened, -(-left // each)
                opened += count
            each = gap // size
            whole = min(count, left // each)
            if whole:
                entries.append((number, origin, first, each))
                number += whole * each
                left -= whole * each
                put(gap - each * size, (origin, first, whole))
            rest = count - whole
            if rest and left and left < each:
                entries.append((number, origin, first + whole, left))
                number += left
                put(gap - left * size, (origin, first + whole, 1))
                whole, rest, left = whole + 1, rest - 1, 0
            put(gap, (origin, first + whole, rest))
    return entries, opened


def _numbered(df: DataFrame, key: str, label: str) -> tuple[DataFrame, dict[int, int]]:
    """Rows with ``rank``, their number from 0 among those with the same ``key``, and how many each key has.

    Keys are lengths or gaps, so there are no more of them than the capacity.
    The order is free: a task numbers its own rows, the rows are written once, and
    the counts of earlier slices are added.
    """
    schema = T.StructType([*df.schema.fields, T.StructField("_slice", T.IntegerType()), T.StructField("_own", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), np.zeros(1, np.int64)
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False).astype(np.int64)
            if not len(keys):
                continue
            if keys.max() >= len(seen):
                seen = np.concatenate([seen, np.zeros(keys.max() + 1 - len(seen), np.int64)])
            order = np.argsort(keys, kind="stable")
            first = np.searchsorted(keys[order], keys[order], "left")
            own = np.empty(len(keys), np.int64)
            own[order] = np.arange(len(keys)) - first
            own += seen[keys]
            seen += np.bincount(keys, minlength=len(seen))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(keys), part, np.int32)), pa.array(own)], [*batch.schema.names, "_slice", "_own"]
            )

    rows = durable(df.mapInArrow(run, schema), label)
    counts = rows.groupBy("_slice", key).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    totals = {r[0]: r[1] for r in counts.groupBy(key).agg(F.sum("_rows")).collect()}
    rank = F.col("_own") + F.col("_before")
    return rows.join(counts.drop("_rows"), ["_slice", key]).withColumn("rank", rank).select(*df.columns, "rank"), totals


def _placed(rows: DataFrame, lengths: dict[int, int], entries: list[tuple], columns: Sequence[str]) -> DataFrame:
    """Rows with their ``number`` from the longest to the shortest, and ``to``, the entry that holds it.

    The table of lengths has one entry per length and the plan a few per length.
    """
    longer = np.zeros(max(lengths) + 1, np.int64)
    for size, count in lengths.items():
        longer[:size] += count
    table = np.array(entries, np.int64).reshape(-1, len(columns))

    @F.arrow_udf(T.StructType([T.StructField(c, T.LongType()) for c in ("number", *columns)]))
    def look_up(length: pa.Array, rank: pa.Array) -> pa.Array:
        number = longer[length.to_numpy(zero_copy_only=False)] + rank.to_numpy(zero_copy_only=False)
        at = np.searchsorted(table[:, 0], number, "right") - 1
        return pa.StructArray.from_arrays([pa.array(number), *(pa.array(table[at, i]) for i in range(len(columns)))], ["number", *columns])

    return rows.withColumn("to", look_up("length", "rank"))


def pack(pieces: DataFrame, capacity: int, groups: int = GROUPS) -> DataFrame:
    """All rows with the sequence that holds them, ``sequence_id``, and their place in it, ``offset``.

    ``length`` is a whole number from 1 to ``capacity``; other lengths and nulls
    are refused.  Sequences hold at most ``capacity`` and have no gap before their
    last piece; there are about as few as possible.  Equal rows are pieces of their own;
    an empty table gives no rows.  Other columns are kept, except that columns
    named ``sequence_id`` or ``offset`` are refused.
    """
    if {"sequence_id", "offset"} & set(pieces.columns):
        raise ValueError("columns may not be named sequence_id or offset")
    length = F.col("length").cast("bigint")
    held = F.when(length.between(1, capacity), length).otherwise(F.raise_error(F.lit("length out of range")).cast("bigint"))
    rows = pieces.select(held.alias("length"), F.struct(*pieces.columns).alias("row"))
    rows, lengths = _numbered(rows, "length", "pieces")
    limit = int(capacity * LARGE_SHARE)
    large = {n: c for n, c in lengths.items() if n > limit}
    small = {n: c for n, c in lengths.items() if n <= limit}
    columns = ["length", "row", "sequence_id"]
    parts = []
    gaps: dict[int, int] = {}
    entries, used = plan_large(large, capacity, groups)
    if large:
        laid = _placed(rows.filter(F.col("length") > limit), large, entries, ["first", "sequence", "pieces"])
        laid = laid.withColumn("sequence_id", F.expr("to.sequence + (to.number - to.first) div to.pieces")).select(*columns)
        parts.append(laid)
        if small:
            room = laid.filter(F.col("length") < capacity).groupBy("sequence_id").agg((capacity - F.sum("length")).alias("gap"))
            rooms, gaps = _numbered(room, "gap", "gaps")
    if small:
        entries, _ = plan_small(gaps, small, capacity)
        laid = _placed(rows.filter(F.col("length") <= limit), small, entries, ["first", "gap", "at", "pieces"])
        laid = laid.select("length", "row", F.col("to.gap").alias("gap"), F.expr("to.at + (to.number - to.first) div to.pieces").alias("rank"))
        if gaps:
            laid = laid.join(rooms, ["gap", "rank"], "left")
        else:
            laid = laid.withColumn("sequence_id", F.lit(None).cast("bigint"))
        parts.append(laid.withColumn("sequence_id", F.coalesce("sequence_id", F.col("rank") + used)).select(*columns))
    if not parts:
        return pieces.select("*", F.lit(0).cast("bigint").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")).limit(0)
    packed = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    before = Window.partitionBy("sequence_id").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(before), F.lit(0)).cast("bigint")
    packed = packed.withColumn("offset", offset)
    return packed.select(*[F.col("row")[c].alias(c) for c in pieces.columns], "sequence_id", "offset")
