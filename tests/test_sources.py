import html
import os
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reviewmart.session import staging_path
from reviewmart.sources import csv_files as C
from reviewmart.sources import csv_records as R
from reviewmart.sources.pages import extract_page_reviews, unescape


def write(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")
    return str(folder / name)


QUOTED = 'id,review\n1,"two\nlines, and a ""quote"""\n2,plain\n3,\n'


def test_csv_cells_may_hold_line_breaks_and_quotes(spark, tmp_path):
    path = write(tmp_path, "a.csv", QUOTED)
    rows = C.read_reviews_csv(spark, path).orderBy("id").collect()
    assert [r.review for r in rows] == ['two\nlines, and a "quote"', "plain", None]


def test_stray_quotes_and_line_breaks_read_alike_at_any_size(spark, tmp_path):
    path = write(tmp_path, "a.csv", 'id,t,u,v\n1,a"b,"c\nd",e"f\n')
    schema = "id int, t string, u string, v string"
    wanted = [(1, 'a"b', "c\nd", 'e"f')]
    assert [tuple(r) for r in C.read_reviews_csv(spark, path, schema).collect()] == wanted
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8")
    try:
        assert [tuple(r) for r in C.read_reviews_csv(spark, path, schema).collect()] == wanted
        flat = write(tmp_path / "y", "b.csv", 'id,review\n1,"a ""b"", c"\n2,d\n')
        split = C.read_reviews_csv(spark, flat, "id int, review string", multi_line=False)
        assert split.rdd.getNumPartitions() > 1
        assert [tuple(r) for r in split.orderBy("id").collect()] == [(1, 'a "b", c'), (2, "d")]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_csv_round_trip_keeps_every_text(spark):
    texts = ["  padded  ", "   ", "tab\t", 'a "b"', "x\ny", "back\\slash", "c, d", "é ü", None, "end\\"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, review string")
    path = staging_path(spark, "csv")
    C.write_reviews_csv(df, path)
    back = C.read_reviews_csv(spark, path, "id int, review string").orderBy("id").collect()
    assert [r.review for r in back] == texts


def test_dataset_folder(spark, tmp_path):
    write(tmp_path, "b.csv", "text\nsecond\n")
    write(tmp_path, "a.csv", "text\nfirst\n")
    write(tmp_path, "0.txt", "text\nother\n")
    folder = str(tmp_path)
    assert [r[0] for r in C.read_dataset_dir(spark, folder, "first").collect()] == ["first"]
    both = C.read_dataset_dir(spark, folder).collect()
    assert sorted(r[0] for r in both) == ["first", "second"]
    os.makedirs(tmp_path / "empty")
    with pytest.raises(FileNotFoundError):
        C.read_dataset_dir(spark, str(tmp_path / "empty"))
    with pytest.raises(ValueError):
        C.read_dataset_dir(spark, folder, "last")


@pytest.mark.parametrize(
    "schema, found",
    [
        ("id int, Context string, Review string", "Context"),
        ("id int, `Customer Feedback` int, name string", "Customer Feedback"),
        ("id int, name string, place string", "name"),
        ("id int, n int", None),
        ("id int, `my.TEXT` string", "my.TEXT"),
    ],
)
def test_text_column_detection(spark, schema, found):
    df = spark.createDataFrame([], schema)
    assert C.detect_text_column(df) == found
    if found is None:
        with pytest.raises(ValueError):
            C.select_text(df)
    else:
        assert C.select_text(df).columns == ["review_text"]


def extracted(spark, page, per_page=None):
    df = spark.createDataFrame([(1, "http://x", page)], "page_id long, url string, html string")
    return [r.review_text for r in extract_page_reviews(df, per_page).orderBy("pos").collect()]


LONG = "This paragraph is clearly longer than forty characters, is it not?"


def test_review_spans_win_over_paragraphs(spark):
    page = f'<p>{LONG}</p><span class="a" data-hook="review-body"> Short one </span><p>{LONG}</p>'
    assert extracted(spark, page) == ["Short one"]


def test_review_spans_hold_nested_markup(spark):
    page = (
        "<SPAN data-hook='review-body'><span>Good <b>sound</b></span><br> &amp; cheap</span> tail"
        '<span data-hook=review-body>Second</span><span data-hook="other">no</span>'
        '<span data-hook="review-body">  </span>'
    )
    assert extracted(spark, page) == ["Good sound & cheap", "Second"]


def test_blank_spans_do_not_bring_paragraphs_back(spark):
    assert extracted(spark, f'<span data-hook="review-body"> </span><p>{LONG}</p>') == []


def test_paragraph_rules(spark):
    page = (
        f"<html><script>'<p>{LONG}</p>'</script><style>p{{}}</style><!-- <p>{LONG}</p> -->"
        f"<p>{'x' * 40}</p><p class='a'>{'y' * 41}</p><pre>{LONG}</pre>"
        f"<P>open {LONG}<p>{' ' * 41}</p><article><p>{LONG}</article>{LONG}</html>"
    )
    assert extracted(spark, page) == ["y" * 41, f"open {LONG}", LONG]


def test_cap_per_page_keeps_the_first(spark):
    page = "".join(f"<p>{i:03d} {LONG}</p>" for i in range(70))
    assert extracted(spark, page, 50) == [f"{i:03d} {LONG}" for i in range(50)]
    assert len(extracted(spark, page)) == 70


def test_unescape_agrees_with_python(spark):
    texts = [
        "a &amp; b", "&amp;lt;", "&lt;b&gt;", "&quot;&apos;&#39;&#x27;&#X41;", "&eacute;&nbsp;&hellip;",
        "AT&T &unknown; &", "&#128512;&#233;", "no entity", "&&amp;&", "",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").orderBy("i")
    found = [r[0] for r in df.select(unescape(F.col("t"))).collect()]
    assert found == [html.unescape(t) for t in texts]


def placed(spark, path, columns, size):
    """Rows of a file in order, read in splits of ``size`` bytes, and the number of tasks."""
    settings = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = R.read_csv_records(spark, [path], columns)
        tasks = spark.read.text(path).rdd.getNumPartitions()
        return [tuple(r)[3:] for r in rows.orderBy(*R.PLACE).collect()], tasks
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_do_not_depend_on_splits(spark, tmp_path, end):
    rng = random.Random(3)
    inside = ["a", "b", "\n", '""', ",", "\r\n", " ", "é", "\n\n"]
    plain = ["", "x", 'a"b', '5" pipe', ' "no cell"', '""', "back\\slash", "  pad "]

    def cell():
        quoted = '"' + "".join(rng.choice(inside) for _ in range(rng.randint(0, 12))) + '"'
        return quoted if rng.random() < 0.5 else rng.choice(plain)

    lines = ['id,"re\nview",note', *(f"{i},{cell()},{cell()}" for i in range(50)), "", '51,"' + "long\n" * 60 + '",z']
    path = str(tmp_path / "a.csv")
    with open(path, "w", newline="", encoding="utf-8") as file:
        file.write(end.join(lines))
    columns = R.read_header(spark, path)
    assert columns == ["id", "re\nview", "note"]

    def bare(rows):
        # Of CR LF, one task keeps the CR after an unquoted cell, and a line of nothing else.
        return [(*r[:-1], (r[-1] or "").removesuffix("\r") or None) for r in rows if r[0] != "\r"]

    # What one task makes of the whole file.
    whole = C.read_reviews_csv(spark, path, "id string, review string, note string")
    wanted = bare(tuple(r) for r in whole.collect())
    assert len(wanted) == 51
    for size in ("200", "61"):
        found, tasks = placed(spark, path, columns, size)
        assert bare(found) == wanted and tasks > 5


def test_headers_get_names(spark, tmp_path):
    path = write(tmp_path, "a.csv", "\ufeff,Text,text\n1,2,3\n")
    assert R.read_header(spark, path) == ["_c0", "Text1", "text2"]
    assert R.read_header(spark, write(tmp_path, "b.csv", "")) == []
    assert placed(spark, path, ["_c0", "Text1", "text2"], "1m")[0] == [("1", "2", "3")]


def test_a_folder_of_differing_files(spark, tmp_path):
    write(tmp_path, "1.csv", "id,review\n1,good\n")
    write(tmp_path, "2.csv", "review,id\nbad,2\n")
    write(tmp_path, "3.csv", "x,review,y\n9,fine,8\n")
    write(tmp_path, "4.csv", "")
    folder = str(tmp_path)
    files = C.dataset_files(spark, folder)
    for multi_line in (True, False):
        texts = C.read_texts(spark, files, multi_line).orderBy(*R.PLACE)
        assert [r.review_text for r in texts.collect()] == ["good", "bad", "fine"]
        rows = C.read_dataset_dir(spark, folder, schema="id int, review string, y int", multi_line=multi_line)
        assert sorted(tuple(r) for r in rows.collect() if r.id) == [(1, "good", None), (2, "bad", None)]
        assert [tuple(r) for r in rows.collect() if r.id is None] == [(None, "fine", 8)]


def test_text_columns_without_a_telling_name(spark, tmp_path):
    write(tmp_path, "1.csv", "id,words\n1,some\n")
    write(tmp_path, "2.csv", "body,id\nmore,2\n")
    files = C.dataset_files(spark, str(tmp_path))
    assert sorted(r.review_text for r in C.read_texts(spark, files).collect()) == ["more", "some"]
    write(tmp_path, "3.csv", "id,n\n1,2\n")
    with pytest.raises(ValueError):
        C.read_texts(spark, C.dataset_files(spark, str(tmp_path)))


def test_plain_csv_lines_are_not_looked_at_one_by_one(monkeypatch):
    """Nor changed: a carriage return at the end goes, empty lines give no record."""
    looked = []
    ends_inside = R._ends_inside
    monkeypatch.setattr(R, "_ends_inside", lambda line, inside: looked.append(line) or ends_inside(line, inside))
    plain = ['1,"late, bad"', "2,nice", '"","",x\r', "", "\r", 'a,"b"\r\r'] * 500
    # A quote inside an unquoted cell is a character; a doubled one and a line break need a closer look.
    hard = ['3,a"b', '4,"say ""no"""', '5,"two', 'lines, ""both""",x', '6,"y, z"']

    def batches(lines, **more):
        n = len(lines)
        columns = {"value": lines, "_file": ["f"] * n, "_start": [7] * n, **{k: [v] * n for k, v in more.items()}}
        return iter([pa.RecordBatch.from_pydict(columns)])

    (effect,) = [r for b in R._effects(batches(plain)) for r in b.to_pylist()]
    assert (effect["after_outside"], effect["after_inside"]) == (False, False)
    records = [r for b in R._records(batches(plain, inside=False)) for r in b.to_pylist()]
    assert [r["record"] for r in records] == ['1,"late, bad"', "2,nice", '"","",x', 'a,"b"\r'] * 500
    assert [r["_position"] for r in records] == list(range(2000)) and {r["kind"] for r in records} == {R._WHOLE}
    assert len(looked) < 10
    mixed = [r["record"] for b in R._records(batches(hard + plain[:2], inside=False)) for r in b.to_pylist()]
    assert mixed == [*hard[:2], "\n".join(hard[2:4]), hard[4], *plain[:2]]
