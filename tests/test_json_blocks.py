"""Large JSON documents in many splits give the records that a plain parser gives."""

import json
import random
import re
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from freshet.catalogue import shapes
from freshet.functions.geometry import area_parts
from freshet.sources import json_blocks

NASTY = ['}', '{"a": [', '\\', '\\"', '"}', 'é漢🙂', ']', '},{', '\n', '\\\\"', "", '"features": [', ' ']


def value(rng, depth=0):
    kind = rng.randrange(7 if depth < 3 else 4)
    if kind == 0:
        return "".join(rng.choice(NASTY) for _ in range(rng.randrange(4)))
    if kind < 4:
        return [rng.randrange(1000), None, rng.random()][kind - 1]
    if kind == 4:
        return [value(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {rng.choice(["a", "data", "features", "}", '"k"', "x\\"]) + str(i): value(rng, depth + 1) for i in range(rng.randrange(4))}


@pytest.fixture
def small_splits(spark):
    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        spark.conf.set("spark.sql.files.minPartitionNum", "1")

    yield use
    for name in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum"):
        spark.conf.unset(f"spark.sql.files.{name}")


def documents(rng, records):
    other = [{"n": -1}, {"data": [{"n": -2}]}]
    return {
        "": records,
        "data": {"meta": {"data": other, "n": 5}, "first": other, "data": records, "last": other, "end": {"data": other}},
        "result.items": {"items": other, "result": {"info": {"a": {}}, "items": records, "more": other}, "other": {"items": other}},
    }


@pytest.mark.parametrize("path", ["", "data", "result.items"])
@pytest.mark.parametrize("indent", [None, 1])
def test_records_of_split_documents(spark, tmp_path, small_splits, path, indent):
    rng = random.Random(len(path) + bool(indent))
    want = {}
    for name in ("a", "b"):
        records = [{"n": i, "v": value(rng), "w": {"z": [value(rng)]}} for i in range(60)]
        if name == "b":
            records = [{}, *records, {"flat": 1}, {"flat": 2}]
        text = json.dumps(documents(rng, records)[path], indent=indent, ensure_ascii=rng.random() < 0.5)
        (tmp_path / f"{name}.json").write_text(text, encoding="utf-8")
        want[name] = records
    for size in (97, 1000, 100_000_000):
        small_splits(size)
        got = json_blocks.json_records(spark, str(tmp_path), path)
        found = {"a": {}, "b": {}}
        for r in got.collect():
            found[r.file[-6]][r.position] = json.loads(r.text)
        assert {k: [v[i] for i in range(len(v))] for k, v in found.items()} == want


def test_one_document_has_several_tasks(spark, tmp_path, small_splits):
    (tmp_path / "d.json").write_text(json.dumps({"data": [{"n": i, "t": "}" * (i % 5)} for i in range(5000)]}))
    small_splits(4096)
    assert json_blocks._pieces(spark, str(tmp_path)).rdd.getNumPartitions() > 10
    rows = json_blocks.read_json_document(spark, str(tmp_path), "n int, t string").collect()
    assert sorted((r.n, r.t) for r in rows) == [(i, "}" * (i % 5)) for i in range(5000)]


def test_odd_documents(spark, tmp_path):
    texts = ['', '[]', '{"data": []}', '{"data": null}', '{"data": [null, 3, {"n": 1}, "}", {"n": "x"}]}', '{"data": {"n": 9}}', '{"other": [{"n": 8}]}']
    for i, text in enumerate(texts):
        (tmp_path / f"{i}.json").write_text(text)
    got = json_blocks.json_records(spark, str(tmp_path), "data").collect()
    assert sorted(json.loads(r.text)["n"] for r in got if r.file.endswith("4.json") and '"x"' not in r.text) == [1]
    assert {r.file[-6:] for r in got} == {"4.json"} and len(got) == 2
    assert sorted(map(repr, json_blocks.read_json_document(spark, str(tmp_path), "n int").collect())) == ["Row(n=1)", "Row(n=None)"]


def test_features_of_one_collection(spark, tmp_path, small_splits):
    box = [[[0, 0], [1, 0], [1, 1], [0, 0]]]
    features = [
        {"type": "Feature", "properties": {"name": f"}}{i}"}, "geometry": {"type": "MultiPolygon", "coordinates": [box] * (i % 3 + 1)} if i % 4 else None}
        for i in range(200)
    ]
    (tmp_path / "g.json").write_text(json.dumps({"type": "FeatureCollection", "features": features, "crs": {"properties": {"name": "x"}}}))
    small_splits(500)
    got = json_blocks.read_geojson_document(spark, str(tmp_path), "name string").withColumn("n", F.size(area_parts(F.col("geometry"))))
    rows = sorted((r.position, r.file, r.name, r.n) for r in got.collect())
    assert rows == [(i, "g.json", f"}}{i}", i % 3 + 1 if i % 4 else None) for i in range(200)]


def test_blocks_of_one_split_are_bounded(spark, tmp_path, monkeypatch):
    records = [{"i": i, "note": '}{"' * (i % 3)} for i in range(40)]
    (tmp_path / "one.json").write_text(json.dumps({"page": {"data": [1]}, "data": records}))
    monkeypatch.setattr(json_blocks, "_BLOCK", 4)
    pieces = json_blocks._pieces(spark, str(tmp_path))
    assert not {"plain", "bare0", "bare1"} & set(pieces.columns)
    assert max(r["count"] for r in pieces.groupBy("file", "split").count().collect()) <= 4
    got = json_blocks.json_records(spark, str(tmp_path), "data").orderBy("position").collect()
    assert [json.loads(r.text) for r in got] == records and [r.position for r in got] == list(range(40))


def test_one_document_is_packed_by_many_tasks_in_order(spark):
    lines = spark.createDataFrame([(i // 2, f"{{{i}}}") for i in range(3000, -1, -1)], "k bigint, text string").repartition(7)
    path = shapes._one_document(spark, lines, "k", "<", ">", "packed_test")
    parts = [f for f in Path(path.removeprefix("file:")).iterdir() if f.name.startswith("part-")]
    text = parts[0].read_text()
    found = [int(x) for x in re.findall(r"\{(\d+)\}", text)]
    assert len(parts) == 1 and text.startswith("<[null") and text.rstrip().endswith("]>")
    assert sorted(found) == list(range(3001)) and [i // 2 for i in found] == sorted(i // 2 for i in found)
    batch = pa.record_batch({"at": pa.array([1, 2, 9]), "value": pa.array(["a", None, "c"])})
    packed = list(shapes._packed(iter([batch])))
    assert [(b["first"].to_pylist(), b["last"].to_pylist()) for b in packed] == [([1], [9])]
    assert [b["value"].to_pylist() for b in shapes._unpacked(iter(packed))] == [["a  c"]]
