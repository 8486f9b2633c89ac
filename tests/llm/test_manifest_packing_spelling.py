"""The manifest, packing and spelling operators against plain versions, on odd rows and on empty tables."""

import bisect
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from freshet.llm import merkle, packing, spelling
from freshet.llm.catalogue import QUERIES, SQL

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def climb(nodes, fanout):
    """Root of the nodes, and for each its proof as (left, right) texts."""
    proofs, under = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, wider = [], []
        for at in range(0, len(nodes), fanout):
            run = nodes[at : at + fanout]
            for i in range(len(run)):
                for leaf in under[at + i]:
                    proofs[leaf].append(("".join(run[:i]), "".join(run[i + 1 :])))
            above.append(sha("".join(run)))
            wider.append(sum(under[at : at + fanout], []))
        nodes, under = above, wider
    return nodes[0], proofs


def trees(rows, fanout):
    """(doc_id, leaf, subroot, root, proof) of (lang, doc_id, leaf) rows."""
    groups = {}
    for lang, doc_id, leaf in rows:
        groups.setdefault(lang, []).append(((doc_id is not None, doc_id or 0, leaf), doc_id, leaf))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    found = {g: climb([leaf for *_, leaf in sorted(groups[g])], fanout) for g in langs}
    root, over = climb([found[g][0] for g in langs], fanout)
    return [
        (doc_id, leaf, found[g][0], root, tuple(proof + rest))
        for g, rest in zip(langs, over, strict=True)
        for (_, doc_id, leaf), proof in zip(sorted(groups[g]), found[g][1], strict=True)
    ]


def coded(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(r, **change):
    row = {**r.asDict(), **change}
    return sha("".join(coded(row[f]) for f in FIELDS))


# ---------------------------------------------------------------- 11


@pytest.mark.parametrize("fanout, block_rows", [(2, 4096), (2, 4), (3, 9), (5, 1)])
def test_manifest_is_the_plain_tree(spark, small, monkeypatch, fanout, block_rows):
    monkeypatch.setattr(merkle, "BLOCK_ROWS", block_rows)
    docs = small.withColumn("lang", F.when(F.col("doc_id") % 13 != 1, F.col("lang"))).selectExpr(
        "*", "'x' AS g", "'x' AS block", "'x' AS node", "'x' AS place", "'x' AS row"
    )
    want = trees([(r.lang, r.doc_id, leaf_of(r)) for r in docs.select(*FIELDS).collect()], fanout)
    got = merkle.manifest(docs, merkle.row_digest(*FIELDS), "lang", "doc_id", ["doc_id", "g", "block", "row"], fanout)
    assert got.columns == ["doc_id", "g", "block", "row", "leaf", "subroot", "root", "proof"]
    rows = got.withColumn("folded", merkle.fold(F.col("leaf"), F.col("proof"))).collect()
    assert Counter((r.doc_id, r.leaf, r.subroot, r.root, tuple(map(tuple, r.proof))) for r in rows) == Counter(want)
    assert all(r.folded == r.root and r.g == "x" for r in rows)


def test_manifest_of_one_row_and_one_group(spark, docs):
    leaf = merkle.row_digest("doc_id", "text")
    (only,) = merkle.manifest(docs((7, None)), leaf, "lang", "doc_id", ["doc_id"]).collect()
    assert only.leaf == only.subroot == only.root == sha("1:7-") and only.proof == []
    rows = merkle.manifest(docs((1, "é"), (1, "é"), (None, "")), leaf, "lang", "doc_id", ["doc_id"]).collect()
    nodes = [sha("-0:"), sha("1:12:é"), sha("1:12:é")]
    assert {r.root for r in rows} == {sha(sha(nodes[0] + nodes[1]) + sha(nodes[2]))} and len(rows) == 3
    with pytest.raises(ValueError):
        merkle.manifest(docs((1, "a")), leaf, "lang", "doc_id", ["doc_id"], fanout=1)


def test_rounds_depend_on_blocks_not_rows(spark, monkeypatch):
    """A round sends each block ``fanout`` rows, also where the last run of blocks is not full."""
    monkeypatch.setattr(merkle, "BLOCK_ROWS", 2)
    rows = spark.range(11).selectExpr("id AS doc_id", "'en' AS lang")
    got = merkle.manifest(rows, merkle.row_digest("doc_id"), "lang", "doc_id", ["doc_id"]).collect()
    assert len({r.root for r in got}) == 1 and {len(r.proof) for r in got} == {4}
    assert [r.proof[1].right for r in got if r.doc_id == 10] == [""]


def test_op11(spark, small_dir, small):
    want = []
    for i, leaf, sub, root, proof in trees([(r.lang, r.doc_id, leaf_of(r)) for r in small.collect()], 2):
        want.append((i, leaf, sub, root, sha("".join(a + b for a, b in proof)), proof))
    proofs = Counter(w[:5] for w in want)
    got = QUERIES["op11_merkle_manifest"](spark, small_dir).collect()
    assert Counter((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256) for r in got) == proofs
    by_leaf = {leaf_of(r): r for r in small.collect()}
    ways = {w[:5]: w[5] for w in want}
    for r in got:
        row, node = by_leaf[r.leaf], r.leaf
        if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0:
            node = leaf_of(row, n_chars=None if row.n_chars is None else row.n_chars + 1)
        for left, right in ways[tuple(r)[:5]]:
            node = sha(left + node + right)
        assert r.folded_root == node and r.verified == (node == r.root)
    assert {r.verified for r in got} == {True, False}


# ---------------------------------------------------------------- 12


def fitted(rows, capacity):
    """Lengths of each sequence, after checking that offsets have no gap."""
    held = {}
    for sequence, offset, length in rows:
        held.setdefault(sequence, []).append((offset, length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return held


def best_fit(lengths, capacity):
    rooms, used = [], 0
    for length in sorted(lengths, reverse=True):
        at = bisect.bisect_left(rooms, length)
        if at < len(rooms):
            room = rooms.pop(at)
        else:
            room, used = capacity, used + 1
        bisect.insort(rooms, room - length)
    return used


def whole_ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def test_op12(spark, small_dir, small_rows):
    tokenizer, want = Tokenizer.from_file(TOKENIZER), Counter()
    for i, text, *_ in small_rows:
        ids = whole_ids(tokenizer, text)
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[at : at + 4096], "<u4")
            want[i, k, at, len(part), zlib.crc32(part.tobytes())] += 1
    got = QUERIES["op12_pack_sequences"](spark, small_dir).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    held = fitted([(r.sequence_id, r.offset, r.length) for r in got], 4096)
    assert len(held) <= math.ceil(sum(r.length for r in got) / 4096) + 2


@pytest.mark.parametrize("file", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_are_those_of_the_whole_text(spark, docs, file):
    path = public_tokenizers.path(file)
    rng = random.Random(4)
    alphabet = list("aZ9é'.ſΣσŉ漢🙂<|>_-") + [" ", "\n", "\t", "\x0b", "\x0c", "\r", "\x1c", " ", "́", " ", "'s", "<|endoftext|>", ".", ",", "b", "T"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(80))) for _ in range(400)]
    texts += ["".join(map(chr, range(0xC0, 0x100))), "Çà ÉTÉ naïve, Größe. ÀÀ", "".join(rng.choice("ÀÉßÿñÑaZ×÷") for _ in range(300))]
    texts += [None, "", "x" * 3000, ("ab " * 9000), " " * 5000]
    tokenizer = Tokenizer.from_file(path)
    got = packing.token_pieces(docs(*enumerate(texts)), path, 50, 1).orderBy("doc_id", "piece").collect()
    ids = {}
    for r in got:
        part = np.frombuffer(r.ids, "<u4").tolist()
        assert r.start == 50 * r.piece and len(part) == r.length <= 50 and r.score == "x"
        ids.setdefault(r.doc_id, []).extend(part)
    assert ids == {i: whole_ids(tokenizer, t) for i, t in enumerate(texts)}


def test_long_texts_are_split_between_words(monkeypatch):
    text = b"one two  three\nfour" * 50
    whole = [w for words in packing._word_lists(text) for w in words]
    monkeypatch.setattr(packing, "CHUNK_BYTES", 7)
    assert [w for words in packing._word_lists(text) for w in words] == whole == text.split()
    monkeypatch.setattr(packing, "KEPT_BYTES", 300)
    words = packing._Words(Tokenizer.from_file(TOKENIZER))
    ids = np.frombuffer(words.ids(text), "<u4").tolist()
    assert ids == words.tokenizer.encode(text.decode(), add_special_tokens=False).ids


@pytest.mark.parametrize("lengths, capacity", [
    ([7] * 30, 10), ([6, 4] * 40, 10), ([10] * 5 + [1] * 3, 10), ([1], 10), ([4, 3, 3] * 33, 10), ([51, 27, 26, 23, 25, 24] * 50, 100),
    ([random.Random(5).randrange(1, 101) for _ in range(900)], 100), ([random.Random(6).randrange(34, 61) for _ in range(900)], 100),
    ([random.Random(7).randrange(1, 20) for _ in range(900)], 100),
])
def test_packing_is_close_to_the_least(spark, lengths, capacity):
    rows = spark.createDataFrame([(i, n, "a", 1) for i, n in enumerate(lengths)], "id int, length int, row string, rank int").repartition(3)
    got = packing.pack(rows, capacity)
    assert got.columns == ["id", "length", "row", "rank", "sequence_id", "offset"]
    out = got.collect()
    assert sorted((r.id, r.length) for r in out) == list(enumerate(lengths))
    held = fitted([(r.sequence_id, r.offset, r.length) for r in out], capacity)
    assert len(held) <= 1.03 * best_fit(lengths, capacity) + 1


def test_configurations_cover_the_demand():
    rng = random.Random(8)
    for _ in range(20):
        capacity = rng.randrange(50, 400)
        sizes = rng.sample(range(capacity // 5 + 1, capacity), min(12, capacity // 3))
        demand = [rng.randrange(1, 60) for _ in sizes]
        made, used = Counter(), 0
        for count, config in packing.configurations(sizes, demand, capacity):
            assert count > 0 and sum(sizes[i] * n for i, n in config.items()) <= capacity
            used += count
            for i, n in config.items():
                made[i] += count * n
        assert [made[i] for i in range(len(sizes))] == demand
        assert used <= 1.05 * best_fit([s for s, d in zip(sizes, demand, strict=True) for _ in range(d)], capacity) + len(sizes) / 2


def test_packing_refuses_what_does_not_fit(spark):
    for bad in (0, 11, None):
        with pytest.raises(Exception, match="length out of range"):
            packing.pack(spark.createDataFrame([(bad,), (3,)], "length int"), 10).collect()
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(1, 2)], "length int, offset int"), 10)


# ---------------------------------------------------------------- 13


def plain_variants(words, factor=5):
    letters = sorted(set("".join(words)))
    near = {}
    for w in words:
        around = {w[:i] + w[i + 1 :] for i in range(len(w))}
        for c in letters:
            around |= {w[:i] + c + w[i:] for i in range(len(w) + 1)} | {w[:i] + c + w[i + 1 :] for i in range(len(w))}
        near[w] = {x for x in around if x != w and x in words}
    form = {}
    for w, others in near.items():
        if others:
            first = min(others, key=lambda x: (-words[x], x))
            if words[first] >= factor * words[w]:
                form[w] = first

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()}


def test_op13(spark, small_dir, small_rows):
    counts = Counter()
    for i, text, *_ in small_rows:
        for run in re.findall("[a-zÀ-ÿ]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            h = 1 if i is None else zlib.crc32(f"{i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    want = plain_variants({w: n for w, n in counts.items() if len(w) >= 6 and n >= 5})
    got = QUERIES["op13_spelling_variants"](spark, small_dir).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want) > 100


def test_variants_of_dense_words(spark):
    """Anagrams, repeated letters, shifted halves, chains of forms and ties."""
    rng = random.Random(3)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(1, 9))): rng.choice([1, 2, 5, 10, 30, 200, 3000]) for _ in range(1500)}
    words |= {"aaaaaaaa": 1, "aaaaaaa": 5, "aaaaaa": 30, "aaaaa": 400, "zebra": 2, "zebrá": 10, "zebrä": 10}
    df = spark.createDataFrame([(w, n, "x", "x") for w, n in words.items()], "word string, n bigint, root string, key string")
    got = {tuple(r) for r in spelling.group_variants(df).collect()}
    assert got == plain_variants(words)
    split = df.withColumn("n", F.lit(1).cast("bigint")).unionByName(df.withColumn("n", F.col("n") - 1)).unionByName(
        spark.createDataFrame([(None, 3, "x", "x"), ("zero", 0, "x", "x"), ("none", None, "x", "x")], df.schema)
    )
    assert {tuple(r) for r in spelling.group_variants(split).collect()} == got
    assert spelling.group_variants(df.limit(0)).count() == 0


def test_signatures_are_not_broadcast(spark, tmp_path):
    """A small table of words has twelve rows a word in the joins, however small Spark thinks it is."""
    words = [(f"{a}{b}rd{c}s", 5) for a in "abcdw" for b in "eioxy" for c in "klmn"]
    spark.createDataFrame(words, "word string, n bigint").write.parquet(f"{tmp_path}/words")
    pairs = spelling.near_pairs(spark.read.parquet(f"{tmp_path}/words"))
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and plan.count("SortMergeJoin") >= 2
    assert pairs.count() == 20 * 5 * 4 // 2 + 25 * 4 * 3 // 2 + 20 * 5 * 4 // 2


# ---------------------------------------------------------------- SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, name):
    duck = duckdb.connect()
    duck.execute("create view documents as select * from '/root/testdata/sf0.001/documents.parquet'")
    result = duck.execute(SQL[name])
    columns = [d[0] for d in result.description]
    got = QUERIES[name](spark, "/root/testdata/sf0.001")
    assert sorted(columns) == sorted(got.columns)
    assert Counter(map(tuple, got.select(*columns).collect())) == Counter(result.fetchall())
