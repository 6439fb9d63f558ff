import datetime as dt
import io
import os
import zipfile
from decimal import Decimal
from functools import partial

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapweave import schemas
from snapweave.plans import extract
from snapweave.plans.registry import new_links
from snapweave.sources import archives, documents, links, sinks, tables, xml
from snapweave.streaming.ingest import ingest_files, pending

RECORD = (
    '<Документ ВидСубМСП="2" КатСубМСП="1" ДатаВклМСП="10.08.2018" ДатаСост="10.02.2019">'
    '<ИПВклМСП ИННФЛ="00000000000{n}"><ФИОИП Имя="А" Фамилия="Б"/></ИПВклМСП>'
    '<СведМН КодРегион="52"><Регион Наим="НИЖЕГОРОДСКАЯ" Тип="ОБЛАСТЬ"/></СведМН>'
    '<СвОКВЭД><СвОКВЭДОсн КодОКВЭД="{code}"/></СвОКВЭД></Документ>'
)


def registry_xml(name, codes, encoding="utf-8"):
    records = "".join(RECORD.format(n=i, code=c) for i, c in enumerate(codes))
    text = f'<?xml version="1.0" encoding="{encoding}"?><Файл ИдФайл="{name}" КолДок="{len(codes)}">{records}</Файл>'
    return text.encode(encoding)


def write_zip(path, **members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for name, content in members.items():
            out.writestr(name.replace("_", "."), content)


# ---- CSV -----------------------------------------------------------------------------------------------

SCHEMA = T.StructType([
    T.StructField("id", T.ByteType()), T.StructField("name", T.StringType()), T.StructField("day", T.DateType()),
])


def test_csv_folder_file_and_nothing(spark, rows, tmp_path):
    (tmp_path / "data-1.csv").write_text('id,name,day\n1,"a ""b""",10.02.2019\n2,NA,\nx,,\n')
    (tmp_path / "other.csv").write_text("id,name,day\n9,z,10.02.2019\n")

    def read(path):
        return rows(tables.read_csv(spark, str(path), SCHEMA, dateFormat="dd.MM.yyyy"))

    assert read(tmp_path) == [(1, 'a "b"', dt.date(2019, 2, 10)), (2, None, None), (None, None, None)]
    assert read(tmp_path / "other.csv") == [(9, "z", dt.date(2019, 2, 10))]
    assert read(tmp_path / "missing") == [] and read(tmp_path / "missing.csv") == []
    (tmp_path / "empty").mkdir()
    assert read(tmp_path / "empty") == []
    (tmp_path / "notes.txt").write_text("id\n1\n")
    assert read(tmp_path / "notes.txt") == []


def test_csv_export_and_back(spark, rows, tmp_path):
    df = spark.createDataFrame([(1, 'x "y", z', dt.date(2020, 1, 2)), (2, None, None)], SCHEMA)
    target = str(tmp_path / "deep" / "out.csv")
    sinks.write_csv(df, target, sort_by=["id"])
    assert rows(tables.read_csv(spark, target, SCHEMA)) == rows(df)
    sinks.write_csv(df, target, clear=False)
    assert tables.read_csv(spark, target, SCHEMA).count() == 4
    sinks.write_csv(df, target)
    assert tables.read_csv(spark, target, SCHEMA).count() == 2


def test_sorted_partitioned_parquet(spark, tmp_path):
    df = spark.range(100).select((99 - F.col("id")).alias("id"), (F.col("id") % 3).alias("year"))
    target = str(tmp_path / "t")
    sinks.write_parquet(df, target, partition_by=["year"], sort_by=["id"])
    back = spark.read.parquet(f"{target}/year=1")
    assert back.count() == 33
    ranges = (
        back.groupBy(F.input_file_name()).agg(F.min("id").alias("a"), F.max("id").alias("b")).orderBy("a").collect()
    )
    assert all(x.b < y.a for x, y in zip(ranges, ranges[1:]))


def test_lookup_tables_below_each_other(spark, rows, tmp_path):
    (tmp_path / "a.csv").write_text("region,oktmo\nx,01\n")
    (tmp_path / "b.csv").write_text("oktmo,region,extra\n02,y,q\n")
    got = tables.read_lookup(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    assert rows(got, "region", "oktmo", "extra") == [("x", "01", None), ("y", "02", "q")]


# ---- XML ------------------------------------------------------------------------------------------------


def test_repeated_and_missing_elements(spark):
    elements = {"@К": "k", "А/@Х": "x", "А/Б/@У": "y"}
    texts = [
        ("one", '<Ф><Документ К=" 1 "><А Х="p"><Б У="u"/></А></Документ></Ф>'),
        ("many", '<Ф><Документ К="2"><А Х="p"><Б У="u"/><Б/></А><А Х="q"><Б У="w"/></А></Документ></Ф>'),
        ("bare", '<Ф><Документ/><Прочее К="9"/></Ф>'),
        ("none", "<Ф></Ф>"),
        ("null", '<Ф><Документ К="null"><А Х=""/></Документ></Ф>'),
        ("cut", '<Ф><Документ К="3"/><Документ'),
        ("text", "nothing"),
        ("blank", ""),
    ]
    df = spark.createDataFrame(texts, "name string, xml string")
    good, bad = extract.read_texts(df, elements)
    assert {r["name"]: (r.k, r.x, r.y) for r in good.collect()} == {
        "one": (" 1 ", "p", "u"), "many": ("2", "p,q", "u,w"), "bare": (None, None, None), "null": ("null", "", None),
    }
    assert sorted(r["name"] for r in bad.collect()) == ["blank", "cut", "text"]


def test_only_mapped_paths_are_parsed():
    got = xml.record_schema({"@А": "a", "Б/@В": "b", "Б/Г/@Д": "d"})
    assert got.simpleString() == "struct<_А:string,Б:array<struct<_В:string,Г:array<struct<_Д:string>>>>>"


def test_typed_values(spark):
    df = spark.createDataFrame([("12.50", "31.12.2018"), ("x", "2018-12-31")], "revenue string, data_date string")
    schema = T.StructType([f for f in schemas.REVEXP.fields if f.name in ("revenue", "data_date")])
    got = xml.typed(df, schema, schemas.INPUT_DATE_FORMAT).collect()
    assert [tuple(r) for r in got] == [(Decimal("12.50"), dt.date(2018, 12, 31)), (None, None)]


# ---- archives -------------------------------------------------------------------------------------------


@pytest.fixture()
def zips(tmp_path):
    folder = tmp_path / "zips with space"
    folder.mkdir()
    write_zip(
        folder / "data-1.zip",
        a_xml=registry_xml("F1", ["47.11", "49.4"]),
        b_xml=registry_xml("F2", ["10.1"], "windows-1251"),
        readme_txt="no",
    )
    write_zip(folder / "data-2.zip", c_xml=registry_xml("F3", ["47"]), bad_xml=b"<cut", d_txt="no")
    (folder / "loose.xml").write_bytes(registry_xml("F9", ["1"]))
    return str(folder)


def test_members(spark, rows, zips):
    listed = archives.manifest(archives.list_archives(spark, zips))
    assert rows(listed, "member", "position") == [("a.xml", 0), ("b.xml", 1), ("bad.xml", 1), ("c.xml", 0)]


def test_extract_registry(spark, rows, zips):
    got = extract.extract(spark, zips, "sme")
    assert set(got.columns) == {*schemas.SME.names, "archive"}
    assert rows(got, "archive", "ind_tin", "activity_code_main", "file_id", "doc_cnt") == [
        ("data-1.zip", "000000000000", "10.1", "F2", 1),
        ("data-1.zip", "000000000000", "47.11", "F1", 2),
        ("data-1.zip", "000000000001", "49.4", "F1", 2),
        ("data-2.zip", "000000000000", "47", "F3", 1),
    ]
    first = got.filter("activity_code_main = '47.11'").first()
    assert (first.kind, first.region_code, first.region_name) == (2, 52, "НИЖЕГОРОДСКАЯ")
    assert (first.reestr_date, first.data_date) == (dt.date(2018, 8, 10), dt.date(2019, 2, 10))
    assert first.patronymic is None and first.org_name is None
    _, rejects = extract.extract_archives(archives.list_archives(spark, zips), "sme")
    assert [r.member for r in rejects.collect()] == ["bad.xml"]


def test_extract_codes(spark, rows, zips):
    classifier = spark.createDataFrame(
        [("G", "47"), ("G", "47.11"), ("C", "10.1")], "group string, code string"
    )

    def kept(*codes):
        got = extract.extract(spark, zips, "sme", codes=codes, classifier=classifier)
        return [r[0] for r in rows(got, "activity_code_main")]

    assert kept("47") == ["47", "47.11"]
    assert kept("47", "49.4") == ["47", "47.11", "49.4"]
    assert kept("C") == ["10.1"]


def test_small_documents_give_the_same_rows(spark, rows, zips):
    whole = extract.extract(spark, zips, "sme")
    split = extract.extract(spark, zips, "sme", document_bytes=1, partition_bytes=1)
    assert rows(split) == rows(whole)
    listed = archives.manifest(archives.list_archives(spark, zips))
    texts = archives.member_texts(listed, schemas.RECORD_TAG, document_bytes=1)
    assert rows(texts, "member", "part") == [("a.xml", 0), ("a.xml", 1), ("b.xml", 0), ("bad.xml", 0), ("c.xml", 0)]


def test_member_stretch_and_other_elements(spark, rows, zips):
    paths = archives.list_archives(spark, zips)
    first, _ = extract.extract_archives(paths, "sme", members=slice(0, 1))
    assert rows(first, "file_id") == [("F1",), ("F1",), ("F3",)]
    second, _ = extract.extract_archives(paths, "sme", members=slice(1, None, 2))
    assert rows(second, "file_id") == [("F2",)]
    narrow, _ = extract.extract_archives(
        paths, "sme", elements={"ИПВклМСП/@ИННФЛ": "ind_tin", "СвОКВЭД/СвОКВЭДОсн/@КодОКВЭД": "activity_code_main"},
        provenance=False,
    )
    assert set(narrow.columns) == {"ind_tin", "activity_code_main", "archive"}


@pytest.mark.parametrize(
    "taken", [slice(-2, None), slice(None, -1), slice(None, None, 3), slice(None, None, -2), slice(5, 1, -2),
              slice(-3, 100), slice(4, 2), slice(-100, 2), slice(9, None, -1), 0, -1, 2, 7, -8],
)
def test_member_slices(spark, tmp_path, taken):
    for n in (0, 1, 6):
        write_zip(tmp_path / f"z{n}.zip", **{f"m{i}_xml": registry_xml(f"{n}-{i}", ["1"]) for i in range(n)})
    expected = []
    for n in (0, 1, 6):
        positions = list(range(n))
        held = positions[taken] if isinstance(taken, slice) else [i for i in positions if i == (taken if taken >= 0 else n + taken)]
        expected += [f"{n}-{i}" for i in held]
    got, _ = extract.extract_archives(archives.list_archives(spark, str(tmp_path)), "sme", members=taken)
    assert sorted(r.file_id for r in got.collect()) == sorted(expected)


def cut(data, size=1 << 20, record="Документ"):
    def read(hold):
        return list(documents.documents(lambda: io.BytesIO(data), record, size, hold=hold))

    try:
        once = read(True)
    except documents.DAMAGED:
        once = None
    if once is None:
        return read(False)
    assert once == read(False)
    return once


def test_encodings():
    text = '<Ф Я="ё"><Документ К="ю"/></Ф>'
    assert cut(text.encode()) == cut(text.encode("utf-8-sig")) == cut(text.encode("utf-16")) == [text]
    assert cut(('<?xml version="1.0" encoding="windows-1251"?>' + text).encode("cp1251")) == [text]


def test_records_at_any_depth_and_as_written():
    text = """<Ф a=">"><!-- <Документ К="no"/> --><Г><Документ К='1>"'><А/>т&amp;<![CDATA[</Документ>]]></Документ ></Г>
    <Документ><Документ/></Документ><ДокументИное/></Ф>"""
    whole = ["""<Документ К='1>"'><А/>т&amp;<![CDATA[</Документ>]]></Документ >""", "<Документ/>", "<Документ><Документ/></Документ>"]
    assert cut(text.encode()) == ['<Ф a=">">' + "".join(whole) + "</Ф>"]
    assert cut(text.encode(), 1) == [f'<Ф a=">">{w}</Ф>' for w in whole]
    assert cut(b"<a/>") == [] and cut("<Документ/>".encode()) == ["<Документ><Документ/></Документ>"]


def test_a_default_namespace_hides_records():
    assert cut('<Ф xmlns="urn:x"><Документ/></Ф>'.encode()) == []


def test_records_across_blocks(monkeypatch):
    monkeypatch.setattr(documents, "_BLOCK", 7)
    text = '<Ф К="1">' + "".join(f'<Документ Н="{i}"><Б/></Документ> <В/>' for i in range(50)) + "</Ф>"
    got = "".join(cut(text.encode("utf-8"), 100))
    assert [f'Н="{i}"' in got for i in range(50)] == [True] * 50
    assert cut(("<?xml version='1.0' encoding='utf-16'?>" + text).encode("utf-16"), 1 << 20) == cut(text.encode(), 1 << 20)


@pytest.mark.parametrize("damage", [b"tail", b"<b/>", b"\xff", b"<", b""])
def test_damage_anywhere_refuses_the_whole_file(damage):
    good = "<Ф><Документ/></Ф>".encode()
    with pytest.raises(documents.DAMAGED):
        cut(good + damage if damage else good[:-1])


def test_damaged_archives_are_rejects(spark, rows, tmp_path):
    write_zip(tmp_path / "good.zip", a_xml=registry_xml("F1", ["1"]), b_xml=registry_xml("F2", ["1"]) + b"x")
    (tmp_path / "no.zip").write_bytes(b"not an archive")
    with zipfile.ZipFile(tmp_path / "torn.zip", "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("c.xml", registry_xml("F3", ["1"] * 500))
    data = bytearray((tmp_path / "torn.zip").read_bytes())
    data[80:120] = b"\xff" * 40
    (tmp_path / "torn.zip").write_bytes(data)
    good, bad = extract.extract_archives(archives.list_archives(spark, str(tmp_path)), "sme")
    assert rows(good, "file_id") == [("F1",)]
    found = bad.selectExpr("substring_index(path, '/', -1) AS archive", "member")
    assert rows(found) == [("good.zip", "b.xml"), ("no.zip", None), ("torn.zip", "c.xml")]


@pytest.mark.parametrize("way", [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2, zipfile.ZIP_LZMA])
def test_damaged_members_of_every_kind_are_rejects(spark, rows, tmp_path, way):
    """An altered and an encrypted member are refused, and those around them are read."""
    path = tmp_path / "some.zip"
    with zipfile.ZipFile(path, "w", way) as archive:
        for name in ("a", "bad", "secret", "z"):
            archive.writestr(f"{name}.xml", registry_xml(f"F-{name}", [str(i) for i in range(300)]))
        archive.getinfo("secret.xml").flag_bits |= 1
        bad = archive.getinfo("bad.xml")
    data = bytearray(path.read_bytes())
    middle = bad.header_offset + 40 + bad.compress_size // 2
    data[middle : middle + 16] = bytes(255 - b for b in data[middle : middle + 16])
    path.write_bytes(data)
    good, refused = extract.extract_archives(archives.list_archives(spark, str(tmp_path)), "sme")
    assert sorted(set(rows(good, "file_id"))) == [("F-a",), ("F-z",)]
    assert rows(refused, "member") == [("bad.xml",), ("secret.xml",)]


def test_storage_that_fails_is_no_damage():
    """An error of the file system must not pass for a damaged archive."""

    class Broken:
        def read(self, *size):
            raise OSError("connection reset")

        def tell(self):
            return 0

        def close(self):
            pass

    with pytest.raises(archives.StorageError):
        archives._Seekable(Broken()).read(1)
    assert not issubclass(archives.StorageError, documents.DAMAGED)


def test_unknown_dataset(spark, zips):
    with pytest.raises(ValueError, match="dataset"):
        extract.extract(spark, zips, "egrul")


def test_facts_have_no_provenance(spark, rows, tmp_path):
    write_zip(
        tmp_path / "r.zip",
        a_xml='<Файл ИдФайл="F"><Документ ДатаСост="31.12.2018" ДатаДок="15.10.2019"><СведНП ИННЮЛ="77"/>'
        '<СведДохРасх СумДоход="43949000.00" СумРасход="1"/></Документ></Файл>'.encode(),
    )
    got = extract.extract(spark, str(tmp_path), "revexp")
    assert rows(got, *schemas.REVEXP.names) == [
        ("77", Decimal("43949000.00"), Decimal("1.00"), dt.date(2018, 12, 31), dt.date(2019, 10, 15))
    ]


# ---- incremental ingest --------------------------------------------------------------------------------------


def test_extract_new(spark, tmp_path):
    source, target, ledger = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ledger")
    source.mkdir()

    def run(**options):
        return extract.extract_new(spark, str(source), target, ledger, "sme", **options)

    assert run() is None
    assert extract.extract_new(spark, str(tmp_path / "missing"), target, ledger, "sme") is None
    for i in range(5):
        write_zip(source / f"s{i}.zip", a_xml=registry_xml(f"F{i}", ["47"]))
    assert run() == 5
    for i in range(5, 10):
        write_zip(source / f"s{i}.zip", a_xml=registry_xml(f"F{i}", ["47", "10"]))
    write_zip(source / "empty.zip", a_txt="no")
    assert run(files_per_batch=2) == 6
    assert run() == 0
    gathered = extract.read_extracted(spark, target, "sme")
    assert gathered.count() == 15 and gathered.columns == schemas.SME.names
    write_zip(source / "old.zip", a_xml=registry_xml("F10", ["47"]), b_xml=b"<cut")
    (source / "none.zip").write_bytes(b"no archive")
    os.utime(source / "old.zip", (1, 1_000_000_000))
    assert run() == 2
    assert extract.read_extracted(spark, target, "sme").count() == 16
    refused = extract.read_rejects(spark, target)
    assert sorted((r.path.rpartition("/")[2], r.member) for r in refused.collect()) == [("none.zip", None), ("old.zip", "b.xml")]
    assert run(clear=True) == 13
    assert extract.read_extracted(spark, target, "sme").count() == 16
    assert extract.read_rejects(spark, target).count() == 2


def test_nothing_extracted_yet(spark, tmp_path):
    assert extract.read_extracted(spark, str(tmp_path / "no"), "empl").columns == schemas.EMPL.names


def test_ingest_files_once(spark, rows, tmp_path):
    inbox, target, ledger = (str(tmp_path / n) for n in ("inbox", "target", "ledger"))
    schema = spark.range(1).schema

    def run():
        return ingest_files(
            spark, inbox, target, ledger, format="parquet", schema=schema,
            transform=lambda df: df.withColumn("half", F.col("id") % 2), partition_by="half",
        )

    spark.range(0, 10).write.parquet(inbox)
    assert run() == 10
    spark.range(10, 14).write.mode("append").parquet(inbox)
    assert run() == 4 and run() == 0
    assert rows(spark.read.parquet(target), "id") == [(i,) for i in sorted(range(14), key=lambda i: repr((i,)))]


def test_ingest_counts_every_batch_and_takes_old_files(spark, tmp_path):
    inbox, target, ledger = (str(tmp_path / n) for n in ("inbox", "target", "ledger"))
    for i in range(110):
        (tmp_path / "inbox").mkdir(exist_ok=True)
        (tmp_path / "inbox" / f"f{i}.csv").write_text(f"{i}\n{i}\n")
    options = {"format": "csv", "schema": T.StructType([T.StructField("id", T.LongType())])}
    assert ingest_files(spark, inbox, target, ledger, files_per_batch=1, **options) == 220
    (tmp_path / "inbox" / "late.csv").write_text("7\n")
    os.utime(tmp_path / "inbox" / "late.csv", (1, 1_000_000_000))
    assert ingest_files(spark, inbox, target, ledger, **options) == 1
    assert spark.read.parquet(target).count() == 221


def test_pending(spark, rows):
    files = spark.createDataFrame([("a",), ("b",)], "path string")
    seen = spark.createDataFrame([("a",), ("a",)], "path string")
    assert rows(pending(files, seen)) == [("b",)]


# ---- links ----------------------------------------------------------------------------------------------------


def dataset_page(title8="Гиперссылка (URL) на набор", number="16"):
    return f"""<html><table class="other"><tr><td>8</td><td>x</td><td><a href="no">n</a></td></tr></table>
    <TABLE width=1 class="tbl border_table"><tr><th>N</th><th>a</th></tr>
    <tr><td>1</td><td>short</td></tr><tr><td>nr</td><td>a</td><td><a href="no">n</a></td></tr>
    <tr class=x><td> 8 </td><td><b>{title8}</b></td><td><a target=_blank href=" http://h/one.zip?a=1&amp;b=2 ">1</a></td></tr>
    <tr><td>9</td><td>t</td><td><a href="no">n</a></td></tr>
    <tr><td>{number}</td><td>Гиперссылки (URL) на предыдущие релизы набора данных</td>
    <td><a href='http://h/two.zip'>2</a><br><a name=q>none</a><a href=http://h/three.zip>3</a></td></tr></TABLE></html>"""


def test_dataset_links(spark):
    pages = [("good", dataset_page()), ("title", dataset_page(title8="x")), ("number", dataset_page(number="17")), ("none", "<p>")]
    df = spark.createDataFrame(pages, "page string, html string")
    got = links.dataset_links(df, schemas.DATASET_PAGE_ROWS).collect()
    assert [(r.page, r.link) for r in got] == [
        ("good", "http://h/one.zip?a=1&b=2"), ("good", "http://h/two.zip"), ("good", "http://h/three.zip"),
    ]


@pytest.mark.parametrize(
    "change",
    [
        lambda p: '<table class="border_table-nav"><tr><td>8</td><td>x</td><td></td></tr></table>' + p,
        lambda p: p.replace("<td>t</td>", "<td><table><tr><td>8</td><td>z</td><td></td></tr></table></td>"),
        lambda p: p.replace("(URL) на предыдущие", "&#40;URL&#41; на предыдущие"),
        lambda p: "<!-- <table class=border_table><tr><td>1</td></tr></table> -->" + p,
        lambda p: p.replace("<a target=_blank href=", '<!-- <a href="http://h/old.zip"> --><a data-href="no" href='),
        lambda p: p.replace("</td>", "").replace("</tr>", ""),
    ],
)
def test_dataset_links_on_ordinary_html(spark, change):
    df = spark.createDataFrame([(change(dataset_page()),)], "html string")
    got = [r.link for r in links.dataset_links(df, schemas.DATASET_PAGE_ROWS).collect()]
    assert got == ["http://h/one.zip?a=1&b=2", "http://h/two.zip", "http://h/three.zip"]


def test_links_are_those_of_anchors(spark):
    html = """<a data-href="no" title='href="no"' HREF = one>1</a><!-- <a href="no"> --><area href="no">
    <a
    href='two'>2</a><abbr href="no"><a href="x&amp;y">3</a>"""
    df = spark.createDataFrame([(html,)], "html string")
    assert [r.link for r in links.extract_links(df).collect()] == ["one", "two", "x&y"]


def test_new_links(spark):
    df = spark.createDataFrame([("good", dataset_page())], "page string, html string")
    held = spark.createDataFrame([("/d/two.zip",), ("/d/x.zip",)], "path string")
    assert sorted(r.link for r in new_links(df, held).collect()) == ["http://h/one.zip?a=1&b=2", "http://h/three.zip"]


def test_a_repaired_archive_replaces_what_it_gave(spark, rows, tmp_path):
    """By content: other members, a mended file, a file that was no archive, a name that has to be escaped."""
    source, target, ledger = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ledger")
    source.mkdir()

    def run():
        return extract.extract_new(spark, str(source), target, ledger, "sme", by_content=True)

    def found():
        return rows(extract.read_extracted(spark, target, "sme"), "file_id"), rows(extract.read_rejects(spark, target), "member")

    write_zip(source / "a=1 %.zip", a_xml=registry_xml("F1", ["1"]), b_xml=registry_xml("F2", ["1"]) + b"x")
    write_zip(source / "b.zip", c_xml=registry_xml("F3", ["1", "2"]))
    (source / "c.zip").write_bytes(b"not an archive")
    assert run() == 3
    assert found() == ([("F1",), ("F3",), ("F3",)], [("b.xml",), (None,)])
    assert run() == 0
    write_zip(source / "a=1 %.zip", a_xml=registry_xml("F1", ["1"]), b_xml=registry_xml("F2", ["1"]))
    write_zip(source / "c.zip", d_xml=registry_xml("F4", ["1"]))
    assert run() == 2
    assert found() == ([("F1",), ("F2",), ("F3",), ("F3",), ("F4",)], [])
    write_zip(source / "b.zip", c_xml=registry_xml("F5", ["1"]))
    assert run() == 1 and run() == 0
    assert found() == ([("F1",), ("F2",), ("F4",), ("F5",)], [])


# ---- text that does not fit its type -------------------------------------------------------------------------


def test_rescued_cells(spark, rows, tmp_path):
    """Text that does not fit is kept by column, whole lines of another length too; fitting rows keep nothing."""
    (tmp_path / "data-1.csv").write_text("id,n,day\n1,5,2020-01-31\n2,five,2020-01-32\n3,NA,\n4,7\n5,8,2020-01-01,more\n")
    schema = T.StructType.fromDDL("id string, n int, day date")
    got = tables.read_csv(spark, str(tmp_path), schema, rescue="odd")
    plain = tables.read_csv(spark, str(tmp_path), schema)
    assert rows(got.drop("odd")) == rows(plain)
    assert {r["id"]: r["odd"] for r in got.collect()} == {
        "1": None, "2": {"n": "five", "day": "2020-01-32"}, "3": None, "4": {"line": "4,7"}, "5": {"line": "5,8,2020-01-01,more"},
    }
    assert rows(xml.quarantine(got, "odd", "id")) == [
        ("2", "day", "2020-01-32"), ("2", "n", "five"), ("4", "line", "4,7"), ("5", "line", "5,8,2020-01-01,more"),
    ]
    assert tables.read_csv(spark, str(tmp_path / "none"), schema, rescue="odd").count() == 0


def test_rescued_attributes(spark):
    df = spark.createDataFrame([("1", "x", "31.12.2020"), ("2", "7", "2020"), ("3", None, None)], "id string, n string, day string")
    schema = T.StructType.fromDDL("id string, n int, day date")
    got = {r["id"]: r["odd"] for r in xml.typed(df, schema, "dd.MM.yyyy", "odd").collect()}
    assert got == {"1": {"n": "x"}, "2": {"day": "2020"}, "3": None}
    assert xml.typed(df, schema, "dd.MM.yyyy").columns == ["id", "n", "day"]


def test_the_list_of_an_archive_is_read_once_a_task(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    opened, plain = str(tmp_path / "opened"), archives._open
    for name in "ab":
        write_zip(tmp_path / "in" / f"{name}.zip", **{f"{name}{n}_xml": registry_xml(f"F{n}", ["47.11"]) for n in range(60)})
    listed = archives.manifest(archives.list_archives(spark, str(tmp_path / "in"))).collect()
    members = spark.createDataFrame(listed, "path string, member string, position int, bytes long")

    def noted(path):
        with open(opened, "a") as out:
            out.write("x")
        return plain(path)

    monkeypatch.setattr(archives, "_open", noted)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        texts = archives.member_texts(members, schemas.RECORD_TAG).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(t.member for t in texts) == sorted(r.member for r in listed)
    # rows of the two archives may take turns within a task
    assert len(open(opened).read()) <= 2 * 2 * spark.sparkContext.defaultParallelism


ODD_FILES = [
    "<a/>", "<a b='1'></a>", "", "<a>", "<a><r/></a>", "<a><r/><b><r x='>'>t</r ></b></a>", "<a><r><r/></r></a>",
    "<a><!-- <r/> --><r/></a>", "<a><![CDATA[<r/>]]><r>1</r></a>", "<a><?p <r/>?><r>2</r></a>", "<?p <r/>?><a><r/></a>",
    "<?xml version='1.0'?><a><r/></a>", "<?xml version='1.0'?>\n<!DOCTYPE a><a><r/></a>", "\ufeff<a><r/></a>",
    "<a xmlns='u'><r/></a>", "<a xmlns:n='u'><n:r/><r/></a>", "<a><xml:r/><r/></a>", "<a><n:r/></a>", "<r/>", "<r><x/></r>",
    "<r><r/></r>", "<a><rr/><r-a/><r\n b='/'/></a>", "<a><r b=\"'>\"/><r>\"</r></a>", "<a><r></a></r>", "<a><r/></a><a/>",
    "<a/ >", "<a><r/ ></a>", "<a><r b='<r/>'/></a>", "<?xml version='1.0' encoding='utf-8' ?><a c='d'\t/>",
    "<?xml version='1.0'?><?q <r/>?><a><r/></a>", "<a>&lt;r/&gt;<r>&amp;</r>&x;</a>", "<a>]]><r/></a>", " <a><r/></a>",
    "<?xml-s a='<r/>'?><a><r/></a>", "<a><r/></a>\n",
]


@pytest.mark.parametrize("text", ODD_FILES)
@pytest.mark.parametrize("encoding", ["utf-8", "utf-16"])
def test_held_files_are_cut_as_streams_are(text, encoding):
    def cut(**how):
        try:
            return list(documents.documents(lambda: io.BytesIO(text.encode(encoding)), "r", 1, **how))
        except documents.DAMAGED:
            return "damaged"

    assert cut(hold=True) == cut(hold=False)


def test_a_plain_held_file_needs_no_events(monkeypatch):
    monkeypatch.setattr(documents, "_cut", None)
    opened = partial(io.BytesIO, "<Файл n='1'><Док a='>'/>x<Док>1</Док></Файл>".encode())
    assert list(documents.documents(opened, "Док", hold=True)) == ["<Файл n='1'><Док a='>'/><Док>1</Док></Файл>"]


def test_a_document_is_parsed_once(spark, capsys):
    texts = spark.createDataFrame([(1, "<a><r n='1'/></a>"), (2, "<a>")], "id int, xml string")
    rows, rejects = extract.read_texts(texts, {"@n": "n"}, record="r")
    for df, got in ((rows, [("1", 1)]), (rejects, [(2,)])):
        df.explain()
        assert capsys.readouterr().out.count("from_xml(") == 1
        assert [tuple(r) for r in df.collect()] == got


def test_members_are_dealt_evenly_and_opened_by_their_place(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    for n in range(40):
        write_zip(tmp_path / "in" / f"{n}.zip", **{f"m{i}_xml": registry_xml(f"F{i}", ["47.11"]) for i in range(5)})
    with zipfile.ZipFile(tmp_path / "in" / "twice.zip", "w") as out, pytest.warns(UserWarning):
        for text in ("<a><Документ b='1'/></a>", "<a><Документ b='2'/></a>"):
            out.writestr("m.xml", text)
    listed = archives.directory(archives.list_archives(spark, str(tmp_path / "in"))).cache()
    tasks, plain = spark.sparkContext.defaultParallelism, archives._open

    def unlisted(path, reader=zipfile.ZipFile):
        if reader is zipfile.ZipFile:
            raise AssertionError("the list was read again")
        return plain(path, reader)

    assert listed.count() == 202
    monkeypatch.setattr(archives, "_open", unlisted)
    texts = archives.member_texts(listed, schemas.RECORD_TAG).withColumn("task", F.spark_partition_id()).collect()
    assert len(texts) == 202
    # as Python opens them by their name
    assert [t.xml for t in texts if t.path.endswith("twice.zip")] == ["<a><Документ b='2'/></a>"] * 2
    counts = [sum(t.task == n for t in texts) for n in range(tasks)]
    assert max(counts) - min(counts) <= 3
