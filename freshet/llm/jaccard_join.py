"""Size-aware Jaccard join of documents on word shingles: subsets for small sets, inverted lists for large ones."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..runtime import durable
from .linking import components
from .textarrays import LOWER, mix, shingles, slices, span_hashes, text_bytes, words

WORDS = 5
#: Similarity as a fraction, so that every bound is exact in whole numbers.
NUMERATOR, DENOMINATOR = 3, 4
LARGEST_SMALL = 12  # sets above this size are never enumerated
LIST_COST = 4.0  # what a posting costs in list scans, in postings
ORDERED = 1 << 19  # entries of the table of frequent shingles
BINS = 1024  # bins of a set's histogram, which bounds the overlap of two sets
BLOCK_SETS, BLOCK_SHINGLES = 1024, 1 << 20
NO_ID = 2**63 - 1


def overlap(n: int, m: int) -> int:
    """Least common elements of two sets of these sizes that reach the similarity."""
    return -(-NUMERATOR * (n + m) // (NUMERATOR + DENOMINATOR))


def subset_sizes(n: int) -> list[int]:
    """Overlaps that a set of ``n`` can need with a partner of any fitting size."""
    low, high = -(-NUMERATOR * n // DENOMINATOR), DENOMINATOR * n // NUMERATOR
    return sorted({overlap(n, m) for m in range(low, high + 1)})


def prefix(n):
    """How many of its rarest elements a set puts on inverted lists, so that no partner is missed."""
    return n - -(-NUMERATOR * n // DENOMINATOR) + 1


def boundary(sizes: dict[int, int]) -> int:
    """The size up to which sets are enumerated: the one of least cost for these counts of small sets.

    A small set costs its subsets; a large one, and a small one that may have a
    large partner, costs its prefix and the scan of the lists.
    """

    def cost(edge: int) -> float:
        total = 0.0
        for n, count in sizes.items():
            if n <= edge:
                total += count * sum(comb(n, c) for c in subset_sizes(n))
            if n > edge or DENOMINATOR * n // NUMERATOR > edge:
                total += count * prefix(n) * (1 + LIST_COST)
        return total

    return min(range(0, LARGEST_SMALL + 1), key=lambda e: (cost(e), e))


def sets_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted, and their offsets."""
    data, offsets = text_bytes(texts)
    data = LOWER[data]
    starts, ends, first = words(data, offsets)
    return shingles(span_hashes(data, starts, ends), first, WORDS)


def class_keys(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One 64-bit key per set, equal for equal sets; 0 for empty ones."""
    n = np.diff(offsets)
    some = np.flatnonzero(n)
    keys = np.zeros(len(n), np.uint64)
    total = np.add.reduceat(mix(values ^ np.uint64(0xA5A5A5A5)), offsets[some])
    both = np.bitwise_xor.reduceat(values, offsets[some])
    keys[some] = mix(total ^ mix(both + n[some].astype(np.uint64)))
    return keys.view(np.int64)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in slices(batch.column("text")):
            values, offsets = sets_of(batch.column("text").slice(a, b - a))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc").slice(a, b - a), pa.array(np.diff(offsets).astype(np.int64)),
                pa.array(class_keys(values, offsets)),
            ], ["doc", "n", "cls"])


def _frequent_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles that several different sets of a batch of documents share, with the number of these sets."""
    for batch in batches:
        seen, found = np.zeros(0, np.int64), []
        for a, b in slices(batch.column("text")):
            values, offsets = sets_of(batch.column("text").slice(a, b - a))
            keys = class_keys(values, offsets)
            _, at = np.unique(keys, return_index=True)
            new = np.zeros(len(keys), bool)
            new[at] = True
            new &= ~np.isin(keys, seen)
            seen = np.concatenate([seen, keys[new]])
            found.append(values[np.repeat(new, np.diff(offsets))])
        values, times = np.unique(np.concatenate(found or [np.zeros(0, np.uint64)]), return_counts=True)
        some = times >= 3
        yield pa.RecordBatch.from_arrays(
            [pa.array(values[some].view(np.int64)), pa.array(times[some].astype(np.int64))], ["shingle", "n"]
        )


def frequent_shingles(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles of all documents with their counts, at most :data:`ORDERED` of them.

    They only set the order in which a set's elements are chosen for its
    prefix, and any order gives the same links.  Batches count their own
    documents and pass on what at least three sets share; the table holds the
    counts above the smallest power of two that keeps it within its size.
    """
    counts = durable(
        docs.mapInArrow(_frequent_task, "shingle bigint, n bigint").groupBy("shingle").agg(F.sum("n").alias("n")),
        "frequent",
    )
    bins = counts.groupBy(F.floor(F.log2("n")).alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect()
    least, total = 64, 0
    for row in sorted(bins, key=lambda r: -r.bin):
        if total + row.n > ORDERED:
            break
        least, total = row.bin, total + row.n
    table = counts.filter(F.floor(F.log2("n")) >= least).toArrow()
    values = table.column("shingle").to_numpy().view(np.uint64)
    order = np.argsort(values)
    return values[order], table.column("n").to_numpy()[order]


def _postings(values: np.ndarray, offsets: np.ndarray, frequent: np.ndarray, counts: np.ndarray, edge: int):
    """Keys of each set: its rarest elements, its subsets, or both; with the number of the set."""
    n = np.diff(offsets)
    row = np.repeat(np.arange(len(n)), n)
    weight = np.zeros(len(values), np.int64)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, values), len(frequent) - 1)
        weight = np.where(frequent[at] == values, counts[at], 0)
    order = np.argsort(row << 32 | np.minimum(weight, 2**32 - 1), kind="stable")
    place = np.arange(len(values)) - offsets[row]
    large = (n > edge) | (DENOMINATOR * n // NUMERATOR > edge)
    listed = (place < prefix(n)[row]) & large[row]
    keys, owners = [values[order][listed]], [row[listed]]
    for size in np.unique(n[(n > 0) & (n <= edge)]):
        rows = np.flatnonzero(n == size)
        own = values[offsets[rows][:, None] + np.arange(size)]
        for c in subset_sizes(int(size)):
            chosen = own[:, np.array(list(combinations(range(size), c)))]
            key = np.full(chosen.shape[:2], c, np.uint64)
            for j in range(c):
                key = mix(key ^ chosen[:, :, j]) + np.uint64(j)
            keys.append(key.reshape(-1))
            owners.append(np.repeat(rows, key.shape[1]))
    return np.concatenate(keys), np.concatenate(owners)


def _postings_task(frequent: np.ndarray, counts: np.ndarray, edge: int):
    """Postings of each batch: (own, key, cls, centre).

    Sets of a batch that share a key are tied to the smallest of them here, and
    only that one stays under the key (own = key); so a key that very many sets
    share brings one row per batch to its list.  Copies count once.  The centre
    is null for a set that is alone under its key in the batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for a, b in slices(batch.column("text")):
                values, offsets = sets_of(batch.column("text").slice(a, b - a))
                cls = class_keys(values, offsets)
                k, row = _postings(values, offsets, frequent, counts, edge)
                keys.append(k)
                owners.append(cls[row])
            key, cls = np.concatenate(keys).view(np.int64), np.concatenate(owners)
            order = np.argsort(key)
            key, cls = key[order], cls[order]
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            several = ~new
            several[:-1] |= ~new[1:]
            cls[several] = cls[several][np.lexsort((cls[several], key[several]))]
            centre = cls[np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))]
            keep = np.ones(len(key), bool)
            keep[1:] = new[1:] | (cls[1:] != cls[:-1])
            key, cls, centre, new = key[keep], cls[keep], centre[keep], new[keep]
            own = np.where(new, key, mix((cls ^ key).view(np.uint64)).view(np.int64))
            alone = new.copy()
            alone[:-1] &= new[1:]
            for a in range(0, len(key), 200_000):
                b = slice(a, a + 200_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[b]), pa.array(key[b]), pa.array(cls[b]), pa.array(centre[b], mask=alone[b])],
                    ["own", "key", "cls", "centre"],
                )

    return run


def _texts_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts whose set has the wanted key; an id alone may belong to several texts."""
    for batch in batches:
        texts = batch.column("text")
        for a, b in slices(texts):
            part = texts.slice(a, b - a)
            right = class_keys(*sets_of(part)) == batch.column("cls").slice(a, b - a).to_numpy()
            mask = pa.array(right)
            yield pa.RecordBatch.from_arrays(
                [batch.column("cls").slice(a, b - a).filter(mask), part.filter(mask)], ["cls", "text"]
            )


def common(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Common elements, and the sizes of both sets, of each pair of texts."""
    x, xo = sets_of(left)
    y, yo = sets_of(right)
    n, m = np.diff(xo), np.diff(yo)
    row = np.concatenate([np.repeat(np.arange(len(n)), n), np.repeat(np.arange(len(m)), m)])
    value = np.concatenate([x, y])
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    same = (row[1:] == row[:-1]) & (value[1:] == value[:-1])
    return np.stack([np.bincount(row[1:][same], minlength=len(n)), n, m])


def _linked(left: pa.Array, right: pa.Array) -> pa.Array:
    out = [np.zeros(0, bool)]
    for a, b in slices(left):
        c, n, m = common(left.slice(a, b - a), right.slice(a, b - a))
        out.append(DENOMINATOR * c >= NUMERATOR * (n + m - c))
    return pa.array(np.concatenate(out))


def _verified(pairs: DataFrame, sizes: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) of set keys with ``same``: whether their texts reach the similarity."""
    size = lambda name, n: sizes.select(F.col("cls").alias(name), F.col("n").alias(n))
    text = lambda name, t: texts.select(F.col("cls").alias(name), F.col("text").alias(t))
    fitting = pairs.join(size("a", "n"), "a").join(size("b", "m"), "b").filter(
        (DENOMINATOR * F.col("n") >= NUMERATOR * F.col("m")) & (DENOMINATOR * F.col("m") >= NUMERATOR * F.col("n"))
    ).select("a", "b")
    judge = F.arrow_udf(_linked, "boolean")
    both = fitting.join(text("a", "x"), "a").join(text("b", "y"), "b")
    return durable(both.select("a", "b", judge("x", "y").alias("same")), "judged")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """For every row: doc_id, n_shingles and component_id, the smallest doc_id reachable by links.

    A document's set holds its distinct 5-word shingles in lower case (A-Z);
    one with fewer words has its whole sequence as its only element.  Documents
    whose sets have a Jaccard similarity of at least 3/4 are linked.  All links
    count: sets up to a size chosen by cost share a subset as large as the
    overlap they need, all others an element among the rarest quarter, and
    every candidate is verified on the texts.

    Equal sets are one class, so copies cost nothing.  Sets under one key are
    first tied to one centre each, and links with the smallest of its centres are
    found; only pairs of classes that share a key and are not yet connected then
    are compared in full.

    Null and empty texts, and texts without words, have an empty set and are
    linked with nothing.  Rows with a null id get the smallest other id of
    their component, or null.  Other columns are ignored; equal rows give equal
    rows; no rows give none.
    """
    source = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), F.coalesce("text", F.lit("")).alias("text"))
    described = durable(source.mapInArrow(_describe, "doc bigint, n bigint, cls bigint"), "described")
    classes = durable(
        described.filter("n > 0").groupBy("cls").agg(F.min("doc").alias("low"), F.max("n").alias("n")), "classes"
    )
    small = {r.n: r["count"] for r in classes.filter(F.col("n") <= LARGEST_SMALL).groupBy("n").count().collect()}
    frequent, counts = frequent_shingles(source.select("text"))
    listed = source.select("text").mapInArrow(
        _postings_task(frequent, counts, boundary(small)), "own bigint, key bigint, cls bigint, centre bigint"
    )
    whole = Window.partitionBy("own")
    shared = durable(
        listed.withColumns({"least": F.min("cls").over(whole), "most": F.max("cls").over(whole)})
        .filter("centre is not null or least <> most")
        .select("key", "cls", F.when(F.col("own") == F.col("key"), F.col("least")).otherwise(F.col("centre")).alias("centre")),
        "shared",
    )
    wanted = shared.select("cls").distinct().join(classes, "cls").select("cls", F.col("low").alias("doc"))
    texts = durable(
        source.join(wanted, "doc").select("cls", "text").mapInArrow(_texts_task, "cls bigint, text string")
        .dropDuplicates(["cls"]), "texts",
    )
    near = shared.filter("cls <> centre").groupBy(F.col("cls").alias("a")).agg(F.min("centre").alias("b"))
    judged = _verified(near, classes, texts)
    roots = components(judged.filter("same"))
    known = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    roots = components(known.unionByName(_rest(shared, roots, classes, texts)))
    named = _with_root(classes.select("cls", "low"), roots, "cls", "root")
    lowest = named.groupBy("root").agg(F.min("low").alias("component"))
    of_class = named.join(lowest, "root").select("cls", "component")
    shown = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return described.join(of_class, "cls", "left").select(
        shown("doc").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.coalesce(shown("component"), shown("doc")).alias("component_id"),
    )


def _bins(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many elements of each set fall into each bin, up to 255; the rest is told by the size."""
    table = np.empty((len(offsets) - 1, BINS), np.uint8)
    for i in range(0, len(table), 1024):
        x = offsets[i : i + 1025]
        row = np.repeat(np.arange(len(x) - 1), np.diff(x))
        at = row * BINS + (values[x[0] : x[-1]] >> np.uint64(40)).astype(np.int64) % BINS
        table[i : i + 1024] = np.minimum(np.bincount(at, minlength=(len(x) - 1) * BINS), 255).reshape(-1, BINS)
    return table


def _histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in slices(batch.column("text")):
            values, offsets = sets_of(batch.column("text").slice(a, b - a))
            table = _bins(values, offsets).tobytes()
            yield pa.RecordBatch.from_arrays([
                batch.column("cls").slice(a, b - a),
                pa.array([table[i * BINS : (i + 1) * BINS] for i in range(b - a)], pa.binary()),
            ], ["cls", "bins"])


def _fitting(n: np.ndarray, bins: np.ndarray, over: np.ndarray, i, y: np.ndarray) -> np.ndarray:
    """Whether sizes and histograms of sets ``i`` and ``y`` allow the overlap they need."""
    most = np.minimum(bins[i], bins[y]).sum(1, dtype=np.int64) + np.minimum(over[i], over[y])
    return (NUMERATOR + DENOMINATOR) * most >= NUMERATOR * (n[i] + n[y])


def _block_members(family, cls, root, side, n, bins) -> list[tuple[int, int]]:
    """(family, cls) of the sets of one block pair that may be linked with a set of another component."""
    over = n - bins.sum(1, dtype=np.int64)
    left, right = np.flatnonzero(side == side.min()), np.flatnonzero(side == side.max())
    some = np.zeros(len(cls), bool)
    for i in range(0, len(left), 32):
        x, y = left[i : i + 32][:, None], right[None]
        fits = (root[x] != root[y]) & (DENOMINATOR * n[x] >= NUMERATOR * n[y]) & (DENOMINATOR * n[y] >= NUMERATOR * n[x])
        fits &= ~(some[x] & some[y])
        u, v = np.nonzero(fits)
        u, v = left[i + u], right[v]
        for j in range(0, len(u), 5_000):
            a, b = u[j : j + 5_000], v[j : j + 5_000]
            good = _fitting(n, bins, over, a, b)
            some[a[good]] = some[b[good]] = True
    return [(family[0], c) for c in cls[some]]


def _block_links(cls, root, side, sizes, values) -> list[tuple[int, int]]:
    """Links (a, b) that tie the components of one block pair together as all links between them would.

    Each set is compared with all sets of the other block that are in another
    component by then; links found join components at once, so they are fewer
    than the sets.
    """
    n, offsets, found = sizes, np.concatenate([[0], np.cumsum(sizes)]), []
    root = np.unique(root, return_inverse=True)[1]
    code = np.unique(values, return_inverse=True)[1]
    mine = np.zeros(len(values), bool)
    whole, right = side.min() == side.max(), np.flatnonzero(side == side.max())
    bins = _bins(values, offsets) if len(right) > 64 else None
    over = None if bins is None else n - bins.sum(1, dtype=np.int64)
    for i in np.flatnonzero(side == side.min()):
        y = right[right > i] if whole else right
        y = y[(root[y] != root[i]) & (DENOMINATOR * n[y] >= NUMERATOR * n[i]) & (DENOMINATOR * n[i] >= NUMERATOR * n[y])]
        if bins is not None and len(y):
            y = y[_fitting(n, bins, over, i, y)]
        if not len(y):
            continue
        own = code[offsets[i] : offsets[i + 1]]
        mine[own] = True
        ends = np.cumsum(n[y])
        at = np.arange(ends[-1]) + np.repeat(offsets[y] - (ends - n[y]), n[y])
        both = np.add.reduceat(mine[code[at]], ends - n[y], dtype=np.int64)
        mine[own] = False
        y = y[DENOMINATOR * both >= NUMERATOR * (n[i] + n[y] - both)]
        if len(y):
            others, first = np.unique(root[y], return_index=True)
            found += [(cls[i], cls[j]) for j in y[first]]
            root[np.isin(root, others)] = root[i]
    return found


def _bins_of(batch: pa.RecordBatch):
    """What :func:`_block_members` takes of rows a to b, for all rows of a batch."""
    family, cls, root, side, n = (batch.column(c).to_numpy() for c in ("family", "cls", "root", "side", "n"))
    bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, BINS)
    yield 0, batch.num_rows, lambda a, b: [x[a:b] for x in (family, cls, root, side, n, bins)]


def _sets_in(batch: pa.RecordBatch):
    """What :func:`_block_links` takes of rows a to b, a slice of a batch after the other."""
    cls, root, side = (batch.column(c).to_numpy() for c in ("cls", "root", "side"))
    for first, last in slices(batch.column("text")):
        values, offsets = sets_of(batch.column("text").slice(first, last - first))

        def part(a: int, b: int, first=first, values=values, offsets=offsets):
            x = offsets[a - first : b - first + 1]
            return [cls[a:b], root[a:b], side[a:b], np.diff(x), values[x[0] : x[-1]]]

        yield first, last, part


def _blocks_task(read, judge, names: tuple[str, str]):
    """What ``judge`` finds in every block pair; rows come sorted by it, and one block pair at a time is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = lambda group: judge(*map(np.concatenate, zip(*group, strict=True))) if group else []
        shown = lambda x: pa.RecordBatch.from_arrays([pa.array(c) for c in np.array(x, np.int64).reshape(-1, 2).T], [*names])
        held, now = [], None
        for batch in batches:
            place, found = np.stack([batch.column(c).to_numpy() for c in ("family", "low", "high")]), []
            for first, last, part in read(batch):
                change = (place[:, first + 1 : last] != place[:, first : last - 1]).any(0)
                cuts = [first, *(np.flatnonzero(change) + first + 1), last]
                for a, b in zip(cuts, cuts[1:], strict=False):
                    if a == b:
                        continue
                    if tuple(place[:, a]) != now:
                        found += done(held)
                        held, now = [], tuple(place[:, a])
                    held.append(part(a, b))
            yield shown(found)
        yield shown(done(held))

    return run


def _dealt(members: DataFrame, blocks) -> DataFrame:
    """``members`` (family, cls, n, ...) in ``blocks`` per family, once for each pair of blocks with theirs."""
    blocks = members.groupBy("family").agg(blocks.alias("blocks"))
    return (
        members.join(blocks, "family").withColumn("side", F.pmod(F.xxhash64("cls"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(*members.columns, F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "side")
    )


def _rest(shared: DataFrame, roots: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) between classes that share a key and are in different components.

    Keys whose classes are all connected are done.  The classes of the others
    are brought together by the smallest component of the key, dealt into
    blocks of about :data:`BLOCK_SETS`, and each pair of blocks is one small
    group.  Inside it, sizes, components and histograms of the sets rule out
    most classes.  The texts of the others are dealt likewise, in blocks of no
    more than about :data:`BLOCK_SHINGLES` elements, and compared in full.  Of the links, those
    that join components are passed on, so rows grow with the classes, not with their pairs.
    """
    marked = _with_root(shared.select("key", "cls"), roots, "cls", "root").distinct()
    open_keys = marked.groupBy("key").agg(F.min("root").alias("family"), F.max("root").alias("s")).filter("family <> s")
    members = marked.join(open_keys.select("key", "family"), "key").select("family", "cls", "root").distinct()
    members = durable(members.join(classes.select("cls", "n"), "cls"), "open")
    by_count = F.ceil(F.count(F.lit(1)) / BLOCK_SETS)
    own = texts.join(members.select("cls").distinct(), "cls", "left_semi")
    bins = own.select("cls", "text").mapInArrow(_histograms, "cls bigint, bins binary")
    ordered = lambda df: df.repartition("family", "low", "high").sortWithinPartitions("family", "low", "high")
    some = ordered(_dealt(members, by_count).join(bins, "cls")).mapInArrow(
        _blocks_task(_bins_of, _block_members, ("family", "cls")), "family bigint, cls bigint"
    )
    some = durable(some.distinct().join(members, ["family", "cls"]), "some")
    blocks = F.greatest(by_count, F.ceil(F.sum("n") / BLOCK_SHINGLES))
    return ordered(_dealt(some, blocks).join(texts, "cls")).mapInArrow(
        _blocks_task(_sets_in, _block_links, ("a", "b")), "a bigint, b bigint"
    )


def _with_root(df: DataFrame, roots: DataFrame, key: str, name: str) -> DataFrame:
    """``df`` with the component of ``key``; a class without links is its own."""
    known = roots.select(F.col("node").alias(key), F.col("root").alias("_root"))
    return df.join(known, key, "left").withColumn(name, F.coalesce("_root", key)).drop("_root")
