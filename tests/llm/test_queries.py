"""Every query on the smallest tables with odd rows added, against plain results; and on empty tables."""

import math
from collections import Counter

import pytest

import corpus_pipeline
from freshet.llm.catalogue import QUERIES

from . import plain


@pytest.fixture(scope="module")
def run(spark, small_dir):
    kept = {}

    def rows(name):
        if name not in kept:
            kept[name] = QUERIES[name](spark, small_dir).collect()
        return kept[name]

    return rows


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_no_rows(spark, empty_dir, name):
    assert QUERIES[name](spark, empty_dir).count() == 0


def test_op1(run, small_rows):
    sets = [plain.word_set(t) for _, t, _, _ in small_rows]
    root = plain.components(sets, plain.near)
    low = {}
    for (i, *_), r in zip(small_rows, root, strict=True):
        low[r] = min((x for x in (low.get(r), i) if x is not None), default=None)
    want = Counter((i, len(s), low[r]) for (i, *_), s, r in zip(small_rows, sets, root, strict=True))
    assert Counter(tuple(r)[:3] for r in run("op1_near_duplicates")) == want


def test_op2(run, small_rows):
    want = Counter()
    for (i, *_), (n, known, train, base) in zip(small_rows, plain.base_scores([r[:2] for r in small_rows]), strict=True):
        want[i, plain.rest(i, 7) == 2, n, known, train, round(base, 3)] += 1
    got = run("op2_language_model")
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 3)) for r in got) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_op3(run, spark, small_dir, small_rows):
    items = spark.read.parquet(f"{small_dir}/benchmark.parquet").collect()
    want = {(i, b.item_id) for i, t, _, _ in small_rows for b in items if t and b.text in t}
    assert want <= {(r.doc_id, r.item_id) for r in run("op3_decontaminate")} and want


@pytest.mark.parametrize("name, spans, kinds", [
    ("op4_personal_data", plain.personal, plain.KINDS), ("op7_secret_scan", plain.secrets, ["assign", "access", "hex"]),
])
def test_op4_and_op7(run, small_rows, name, spans, kinds):
    want = Counter()
    for i, t, _, _ in small_rows:
        found = spans(t)
        want[i, *(sum(s[1] == k for s in found) for k in range(len(kinds))), plain.digest(found, kinds)] += 1
    assert Counter((r.doc_id, *(r[f"n_{k}"] for k in kinds), r.base_sha256) for r in run(name)) == want


def test_op5(run, small_rows):
    lang = {i: x for i, _, x, _ in small_rows if i is not None and i < 900000}
    got = [r for r in run("op5_language") if r.held_out and r.doc_id in lang]
    assert sum(r.lang_pred == lang[r.doc_id] for r in got) >= 0.97 * len(got) > 0
    assert {r.doc_id: r.lang_pred for r in run("op5_language")}[900004] == "und"
    assert Counter((r.doc_id, r.held_out) for r in run("op5_language")) == Counter((i, plain.rest(i, 5) == 0) for i, *_ in small_rows)


def test_op6(run, small_rows):
    want = Counter()
    for i, t, _, _ in small_rows:
        n, *rest = plain.rules(t)
        want[i, n, *rest, n < 50 or 100 * rest[-1] > 50 * n] += 1
    got = run("op6_quality_rules")
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter(tuple(r[c] for c in names) for r in got) == want
    assert not any(r.kept and r.base_failed for r in got)


def test_op8(run, spark, small_dir, small_rows):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{small_dir}/labels.parquet").collect()}
    got = run("op8_quality")
    held = [r for r in got if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.8 * len(held) > 0
    assert Counter((r.doc_id, r.held_out) for r in got) == Counter((i, plain.rest(i, 4) == 2) for i, *_ in small_rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)


def test_op9(run, small_rows):
    got = run("op9_line_dedup")
    assert Counter(r.doc_id for r in got) == Counter(i for i, *_ in small_rows)
    seen, before = Counter(), set()
    normal = lambda x: " ".join(plain.lower(x).split())
    for i, t, _, _ in small_rows:
        before |= {normal(x) for x in (t or "").split("\n")}
    for r in {(r.doc_id, r.text): r for r in got}.values():
        seen.update(x for x in map(normal, (r.text or "").split("\n")) if x)
    assert max(seen.values()) == 1 and set(seen) <= before


def test_op10(run, small_rows):
    sizes = Counter()
    for _, t, _, s in small_rows:
        sizes[s] += len(plain.WORD.findall(t or ""))
    want = plain.targets(dict(sizes))
    rows = Counter((i, len(plain.WORD.findall(t or "")), sizes[s], round(want[s], 6)) for i, t, _, s in small_rows)
    got = run("op10_mix_sources")
    assert Counter((r.doc_id, r.size, r.source_size, round(r.target, 6)) for r in got) == rows
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    assert abs(sum(r.taken for r in got) - sum(want.values())) <= 64 * len(want)


def test_pipeline(spark, small_dir, small, empty_dir):
    docs, last = spark.read.parquet(f"{small_dir}/documents.parquet"), None
    for name, stage in corpus_pipeline.STAGES:
        out = spark.createDataFrame(stage(spark, docs, small_dir).collect(), stage(spark, docs, small_dir).schema)
        if name != "mix":
            assert out.columns == docs.columns and out.count() <= docs.count()
        docs, last = out, name
    assert last == "mix" and all(r.taken <= 2 * r.size for r in docs.collect())
    assert corpus_pipeline.run(spark, empty_dir).count() == 0


def test_pipeline_keeps_one_row_of_each_group(spark, docs):
    word = lambda name: " ".join(f"{name}{i}" for i in range(30))
    a, b, c, clean = word("a"), word("b"), word("c"), word("clean")
    rows = [(1, a), (1, a), (2, a), (None, a), (None, b), (None, b), (3, c), (4, c), (4, clean), (5, None), (5, "")]
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    kept = Counter((r.doc_id, r.text) for r in stage(spark, docs(*rows), "").collect())
    assert kept == Counter([(1, a), (None, b), (3, c), (4, clean), (5, None), (5, "")])
