"""Readers on small files written by the test."""

import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from freshet.sources import archives, documents, paged, tables, text, web
from freshet.sources.grids import grid_to_cells


def test_delimited_prunes_columns(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text("id,name,lat\n1,x,2.5\n2,\"y, z\",\n")
    df = text.read_delimited(spark, str(tmp_path), "id int, name string, lat double", ["name", "lat"])
    assert rows(df) == [("x", 2.5), ("y, z", None)]
    assert "id" not in df._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]


def test_whitespace_skips_headings_per_file(spark, tmp_path, rows):
    (tmp_path / "a.txt").write_text("title 2 3\nmore 1 1\n1990  1.5   2\n# c 1\nshort\n1991 2 3\n")
    (tmp_path / "b.txt").write_text("x y z\nx y z\nHDR 1 2\n 1992 4 5 \n")
    df = text.read_whitespace(spark, str(tmp_path), ["y", "a", "b"], skip_lines=2, comment="#", header_prefix="HDR")
    assert rows(df) == [("1990", "1.5", "2"), ("1991", "2", "3"), ("1992", "4", "5")]


def test_line_numbers_of_split_files(spark, tmp_path):
    for name in "ab":
        (tmp_path / f"{name}.txt").write_text("".join(f"{name}{i}\n" for i in range(3000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        df = text.numbered_lines(spark, str(tmp_path))
        assert df.select("value").rdd.getNumPartitions() > 4
        wrong = df.filter(F.substring("value", 2, 9).cast("bigint") != F.col("line_no"))
        assert df.count() == 6000 and wrong.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_tsv_is_tagged_with_its_file(spark, tmp_path, rows):
    (tmp_path / "ev1.tab").write_text("id\tv\n1\ta\n")
    (tmp_path / "ev2.tab").write_text("id\tv\n2\tb\n")
    df = text.read_tsv_with_file_id(spark, str(tmp_path), "id int, v string")
    assert rows(df) == [(1, "a", "ev1"), (2, "b", "ev2")]


def test_json_lines_count_bad_ones(spark, tmp_path, rows):
    (tmp_path / "a.json").write_text('[\n{"a": 1},\n{"a": 2}, \nbroken\n]\n')
    good, bad = text.read_ndjson(spark, str(tmp_path), "a int", strip_trailing_comma=True)
    assert rows(good) == [(1,), (2,)]
    assert rows(bad, "bad_lines") == [(1,)]


def test_json_records_and_geojson(spark, tmp_path, rows):
    (tmp_path / "r.json").write_text(json.dumps({"data": [{"id": 1, "f": {"n": "x"}}, {"id": 2}]}, indent=1))
    df = documents.read_json_records(spark, str(tmp_path / "r.json"), "id int, f struct<n: string>")
    assert rows(df, "id", "f.n") == [(1, "x"), (2, None)]
    deep = {"a": {"b": [{"id": 5}]}}
    (tmp_path / "d.json").write_text(json.dumps(deep))
    assert rows(documents.read_json_records(spark, str(tmp_path / "d.json"), "id int", "a.b")) == [(5,)]
    features = {"features": [{"geometry": {"type": "Point", "coordinates": [1, 2, 3]}, "properties": {"m": 4.5}}] * 2}
    (tmp_path / "g.json").write_text(json.dumps(features))
    geo = documents.read_geojson(spark, str(tmp_path / "g.json"), "m double")
    assert rows(geo, "file", "position", "m", "geometry.coordinates") == [
        ("g.json", 0, 4.5, [1.0, 2.0, 3.0]), ("g.json", 1, 4.5, [1.0, 2.0, 3.0]),
    ]


def test_xml_matches_local_names(spark, tmp_path, rows):
    (tmp_path / "f.xml").write_text(
        '<rss xmlns:geo="http://g"><channel><item><title>A (B)</title><geo:point>1 2</geo:point></item>'
        "<item><title>C</title></item></channel></rss>"
    )
    df = documents.read_xml_records(spark, str(tmp_path / "f.xml"), "item", "title string, point string")
    assert rows(df) == [("A (B)", "1 2"), ("C", None)]


def test_archives_inside_archives(spark, tmp_path, rows):
    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("deep/x_CS.txt", "id\tv\n1\ta\n")
        z.writestr("deep/x_ML1.txt", "id\tv\n2\tb\n")
    with zipfile.ZipFile(tmp_path / "out.zip", "w") as z:
        z.writestr("in.zip", inner.getvalue())
        z.writestr("note.md", "n")
    members = archives.expand_archives(spark, str(tmp_path / "out.zip"), suffix=".txt", tags=["CS", "ML2"])
    assert rows(members, "member") == [("in.zip/deep/x_CS.txt",)]
    assert rows(archives.member_rows(members, "id int, v string")) == [("x_CS", 1, "a")]
    assert archives.expand_archives(spark, str(tmp_path / "out.zip"), nested=False).count() == 2


@pytest.mark.parametrize("stop, pages", [(True, [1, 2]), (False, [1, 2, 4])])
def test_pages_end_at_an_empty_one(spark, tmp_path, stop, pages):
    for n, ids in ((1, [1, 2]), (2, [3]), (3, []), (4, [9])):
        (tmp_path / f"page-{n}.json").write_text(json.dumps([{"page": n}, [{"id": i} for i in ids]]))
    df = paged.read_pages(spark, str(tmp_path), "id int", "1", stop_at_empty=stop)
    assert sorted({r["page"] for r in df.collect()}) == pages
    assert paged.read_pages(spark, str(tmp_path), "id int", "1", min_page=2, max_page=2).count() == 1


def test_links_and_tables(spark, rows):
    html = (
        '<a href="/d/b_1.nc">1</a><a href="/d/b_2.nc">2</a><a href="x.txt">3</a>'
        '<table id="other"><tr><td>no</td></tr></table>'
        '<table class="c" id="t"><tr><th>A</th><th>B</th></tr><tr><td> <b>1</b> </td><td>x\ny</td></tr><tr><td>2</td></tr></table>'
    )
    df = spark.createDataFrame([(1, html), (2, "<p>none</p>")], "id int, html string")
    links = web.html_links(df, "html", prefix="/d", suffix=".nc")
    assert rows(links) == [(1, 0, "/d/b_1.nc"), (1, 1, "/d/b_2.nc")]
    assert rows(web.link_status(links, df, "id")) == [(1, "ambiguous", None), (2, "none", None)]
    assert rows(web.html_table_rows(df, "html", ["a", "b"], "t")) == [(1, 1, "1", "x\ny"), (1, 2, "2", None)]


def test_links_in_all_forms_and_nested_tables(spark, rows):
    html = (
        "<A HREF='/1'>x</a><a\nclass=\"a href='/no'\" href = /2>y</a><a data-href=/no>z</a><a href=\"/3?a=1&amp;b=2\"/>"
        "<!-- <a href='/no'> --><script>'<a href=\"/no\">'</script><a name=k></a><area href='/no'><a href=''>e</a>"
        "<table id=t><thead><tr><th>h</table><TABLE ID=u><tr><td>1<td>a &lt; b &#233;<tr><td colspan=2>2"
        "<table id=t><tr><td>in</td></tr></table>more</td></tr></TABLE><table><tr><td>open"
    )
    df = spark.createDataFrame([(1, html), (2, "<p>none</p>"), (3, None), (4, "<table id=u>")], "id int, html string")
    assert [r[2] for r in rows(web.html_links(df, "html"))] == ["/1", "/2", "/3?a=1&b=2", ""]
    assert rows(web.html_tables(df, "html", "u")) == [(1, 0, 0, ["1", "a < b é"]), (1, 0, 1, ["2 in more"])]
    assert rows(web.html_tables(df, "html")) == [
        (1, 0, 0, ["h"]), (1, 1, 0, ["1", "a < b é"]), (1, 1, 1, ["2 in more"]), (1, 2, 0, ["open"]),
    ]
    assert web.html_tables(df, "html", "none").count() == 0


def test_pages_as_a_stream_go_on_where_they_stopped(spark, tmp_path, rows):
    from freshet.streaming import streams

    out, check, seen = str(tmp_path / "out"), str(tmp_path / "check"), []
    landed = tmp_path / "in"
    landed.mkdir()
    for new in ({1: [{"id": 1, "n": {"a": 1}}], 3: [{"id": 9}]}, {}, {2: [], 4: [{"id": "x", "n": 5}, 7]}):
        for number, records in new.items():
            (landed / f"{number}.json").write_text(json.dumps({"meta": 0, "data": records}))
        stream = paged.stream_pages(spark, str(landed), "id int, n string", "data", min_page=1)
        streams.run_available(stream, out, check)
        seen.append(rows(spark.read.schema(stream.schema).parquet(out)))
    assert seen[0] == seen[1] == [(1, 0, 1, '{"a": 1}')]
    assert seen[2] == [(1, 0, 1, '{"a": 1}'), (3, 0, 9, None), (4, 0, None, "5"), (4, 1, None, None)]


def test_dated_files_and_dimensions(spark, tmp_path, rows):
    for name in ("v_20240102.bin", "v_20240301.bin", "other.bin"):
        (tmp_path / name).write_bytes(b"123")
    files = tables.list_dated_files(spark, str(tmp_path), r"v_(\d{8})", "yyyyMMdd")
    assert files.count() == 2 and tables.newest_file(files).first()["path"].endswith("v_20240301.bin")
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "dim.csv").write_text("code,name\nA,x\nA,x\nB,y\n")
    assert rows(tables.read_dim(spark, str(tmp_path / "d"), "code string, name string", "code")) == [("A", "x"), ("B", "y")]


def test_grid_cells_have_centres(spark, rows):
    df = spark.createDataFrame(
        [("v", [[float(r * 4 + c) for c in range(4)] for r in range(3)], (0.0, -30.0, 40.0, 30.0))],
        "var string, data array<array<double>>, bounds struct<west: double, south: double, east: double, north: double>",
    )
    got = rows(grid_to_cells(df, "data"))
    assert len(got) == 12 and got[0] == ("v", 0, 0, 20.0, 5.0, 0.0) and got[-1] == ("v", 2, 3, -20.0, 35.0, 11.0)
