from pyspark.sql import functions as F

from sparkloom.operators import grid as G
from sparkloom.sources import files as S


def test_text_tables_keep_or_blank_words_for_missing(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\nNA,1.50\n,x y\n")
    kept = sorted(map(tuple, S.text_table(spark, str(tmp_path / "t.csv")).collect()))
    assert kept == [("", "x y"), ("NA", "1.50")]
    assert sorted(map(tuple, S.text_table(spark, str(tmp_path / "t.csv"), na_as_blank=True).collect())) == [("", "1.50"), ("", "x y")]


def test_inventory_and_reference_order(spark, tmp_path):
    for name in ("a.csv", "b.PDF", ".hidden.csv", "note.txt"):
        (tmp_path / name).write_text("x")
    found = S.reference_files(S.inventory(spark, str(tmp_path), ("csv", "pdf"))).orderBy("place", "path").collect()
    assert [r.path.rsplit("/", 1)[1] for r in found] == ["a.csv", "b.PDF"] and all(r.length == 1 and r.readable for r in found)


def test_matrix_cells_make_bands(spark, tmp_path):
    (tmp_path / "m.csv").write_text("x,1,,5\ny,2,,6\n,,,\nz,3,,\n")
    cells = S.matrix_cells(spark, str(tmp_path / "m.csv"))
    boxes = {(r.r1, r.r2, r.c1, r.c2, r.cells) for r in G.bands(cells).collect()}
    assert boxes == {(1, 2, 1, 2, 4), (1, 2, 4, 4, 2)} | {(r.r1, r.r2, r.c1, r.c2, r.cells) for r in G.bands(cells).filter("r1 > 2").collect()}
    parts = G.components(cells)
    assert parts.agg(F.sum(F.col("c2") - F.col("c1") + 1)).first()[0] == cells.filter("trim(value) <> ''").count()


def test_rows_have_the_cells_that_they_have(spark, tmp_path):
    (tmp_path / "w.csv").write_text('a,b\n1,2,3,4\n\n"x\ny","q ""z"", w"\n')
    cells = sorted((r.r, r.c, r.value) for r in S.matrix_cells(spark, str(tmp_path / "w.csv")).collect())
    assert cells == [(1, 1, "a"), (1, 2, "b"), (2, 1, "1"), (2, 2, "2"), (2, 3, "3"), (2, 4, "4"), (4, 1, "x\ny"), (4, 2, 'q "z", w')]
    (tmp_path / "k.csv").write_bytes("한글,b".encode("cp949"))
    assert [r.value for r in S.matrix_cells(spark, str(tmp_path / "k.csv")).orderBy("c").collect()] == ["한글", "b"]
    (tmp_path / "e.csv").write_text("")
    assert S.matrix_cells(spark, str(tmp_path / "e.csv")).count() == 0
    assert S.text_table(spark, str(tmp_path / "e.csv")).columns == []


def test_written_cells_come_back_whole(spark, tmp_path):
    rows = [("a", "x\ny"), ("b", "q"), ('"', 'she said "no", twice\n\n'), ("", "\\"), (",", " s ")]
    S.write_table(spark.createDataFrame(rows, "k string, v string"), str(tmp_path / "out"), ["k", "v"])
    assert sorted(map(tuple, S.text_table(spark, str(tmp_path / "out")).collect())) == sorted(rows)


def test_flat_entries_are_entries(spark):
    body = '{"fig 1": {"source_page": 3, "x": {"p": 1}}, "fig 2": {"caption": null}, "dir": {"fig 3": {"path": "p"}, "note": "n", "_y": {}}, "fig 4": {"path": "p"}, "_z": {"caption": ""}, "n": 3}'
    got = S.mapping_entries(spark.createDataFrame([(body,)], "body string"), "body").collect()
    assert sorted((r.folder, r.item) for r in got) == [("", "fig 1"), ("", "fig 2"), ("dir", "fig 3")]


def test_nested_and_listed_mappings(spark):
    nested = spark.createDataFrame([('{"f": {"i": {"p": 1}, "_x": {}}, "_g": {"j": {}}}',)], "body string")
    assert [(r.folder, r.item) for r in S.mapping_entries(nested, "body").collect()] == [("f", "i")]
    listed = spark.createDataFrame([('{"a": ["x", "y"], "b": "z"}',)], "body string")
    assert sorted((r.item, r.block) for r in S.listed_blocks(listed, "body").collect()) == [("a", "x"), ("a", "y"), ("b", "z")]


def test_union_sinks_and_lines(spark, tmp_path):
    a, b = spark.createDataFrame([("1", "2")], "x string, y string"), spark.createDataFrame([("3",)], "x string")
    both = S.union_with_source([("a.csv", a), ("b.csv", b)])
    assert sorted(map(tuple, both.select("x", "y", "source_file").collect())) == [("1", "2", "a.csv"), ("3", "", "b.csv")]
    S.write_table(both, str(tmp_path / "out"), ["y", "missing", "x"])
    assert sorted(map(tuple, S.text_table(spark, str(tmp_path / "out")).collect())) == [("", "", "3"), ("2", "", "1")]
    kept = S.write_partitions(both, str(tmp_path / "parts"), F.lit("source"), "x")
    assert sorted((r.x, r.rows) for r in kept.collect()) == [("1", 1), ("3", 1)]
    S.write_report(both.select("x"), str(tmp_path / "report"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "report")).collect()) == ['{"x":"1"}', '{"x":"3"}']
    lines = S.numbered_lines(spark.createDataFrame([(1, "a  b\n\n c")], "id int, text string"))
    assert [(r.line_no, r.line) for r in lines.orderBy("line_no").collect()] == [(1, "a b"), (3, "c")]
