import datetime as dt
import zipfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from snapweave import schemas
from snapweave.plans import aggregate, geocode
from snapweave.plans.registry import process
from snapweave.sources.tables import empty_table

DAYS = [dt.date(2019, 2, 10), dt.date(2019, 5, 10), dt.date(2020, 11, 10)]


def snapshot(day, **given):
    row = dict.fromkeys(schemas.SME.names)
    row.update(kind=1, category=1, data_date=day, region_name="Тверская", activity_code_main="47.1", **{})
    row.update(given)
    return tuple(row[c] for c in schemas.SME.names)


def history(**by_day):
    """Snapshots d1, d2, d3 of one entity, each with its columns."""
    return [snapshot(DAYS[int(d[1]) - 1], **columns) for d, columns in by_day.items()]


@pytest.fixture(scope="module")
def aggregated(spark):
    same = dict(org_tin="77", org_name="Ромашка")
    data = [
        *history(d1=same, d2={**same, "region_name": "ТВЕРСКАЯ", "org_name": "ромашка"}, d3=same),
        *history(d1={"ind_tin": "1", "kind": 2}, d2={"ind_tin": "1", "kind": 2, "category": 2}),
        *history(d1={"org_tin": "88"}, d2={"org_tin": "88", "org_number": "R8"}, d3={"org_tin": "88", "org_number": "R8"}),
        *history(d1={"org_tin": "12345678901"}),
        *history(d1={"org_tin": "91", "region_name": "Республика Крым"}),
        *history(d1={"org_tin": "92", "region_name": None}),
        *history(d1={"org_tin": "93", "city_type": "г"}, d2={"org_tin": "93", "city_type": "город"}),
    ]
    return aggregate.aggregate_sme(spark.createDataFrame(data, schemas.SME))


def test_aggregate_sme(aggregated):
    assert aggregated.columns == schemas.SME_AGGREGATED.names
    got = {}
    for r in aggregated.orderBy("tin", "start_date").collect():
        got.setdefault(r.tin, []).append(r)
    assert set(got) == {"0000000077", "000000000001", "0000000088", "1234567890", "0000000093"}
    (one,) = got["0000000077"]
    assert (one.org_name, one.region_name, one.start_date, one.end_date) == ("РОМАШКА", "ТВЕРСКАЯ", DAYS[0], DAYS[2])
    first, second = got["000000000001"]
    assert (first.category, first.end_date, second.category, second.end_date) == (1, DAYS[1], 2, DAYS[1])
    # the number itself is compared as it came, and filled in backwards
    assert [(r.reg_number, r.start_date) for r in got["0000000088"]] == [("R8", DAYS[0]), ("R8", DAYS[1])]
    # types of address parts are not part of the state
    assert len(got["0000000093"]) == 1


def test_null_regions_can_stay(spark):
    df = spark.createDataFrame(history(d1={"org_tin": "92", "region_name": None}), schemas.SME)
    assert aggregate.aggregate_sme(df).count() == 0
    assert aggregate.aggregate_sme(df, keep_null_region=True).count() == 1
    assert aggregate.aggregate_sme(df, excluded=()).count() == 1


def facts(spark):
    def row(tin, revenue, year, month):
        return (tin, Decimal(revenue), Decimal(1), dt.date(year, 12, 31), dt.date(year + 1, month, 15))

    return spark.createDataFrame(
        [row("77", 5, 2018, 10), row("77", 7, 2018, 11), row("77", 9, 2019, 10), row("1", 3, 2019, 10), row("5", 2, 2019, 10)],
        schemas.REVEXP,
    )


def test_aggregate_facts(spark, rows, aggregated):
    every = aggregate.aggregate_revexp(facts(spark))
    assert every.columns == schemas.REVEXP_AGGREGATED.names
    assert rows(every, "tin", "year", F.col("revenue").cast("int")) == [
        ("0000000001", 2019, 3), ("0000000005", 2019, 2), ("0000000077", 2018, 7), ("0000000077", 2019, 9),
    ]
    known = aggregate.aggregate(facts(spark), "revexp", aggregated)
    assert rows(known, "tin", "year") == [("0000000077", 2018), ("0000000077", 2019)]


def test_aggregate_by_name(spark):
    for name in schemas.DATASETS:
        empty = aggregate.aggregate(empty_table(spark, schemas.EXTRACTED[name]), name)
        assert empty.columns == schemas.AGGREGATED[name].names and empty.count() == 0
    with pytest.raises(ValueError, match="dataset"):
        aggregate.aggregate(spark.range(1), "egrul")


# ---- geocode -------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def lookups(spark):
    def frame(header, *rows):
        return spark.createDataFrame([tuple(r) for r in rows], ", ".join(f"{c} string" for c in header.split()))

    return geocode.GeoLookups(
        abbreviations=frame(
            "type_id name name_full",
            ("1", "обл", "Область"), ("2", "г", "Город"), ("3", "р-н", "Район"), ("4", "с", "Село"), ("5", "д", "Деревня"),
        ),
        regions=frame(
            "code name short_name iso_code",
            ("69", "Тверская область", "Тверская", "RU-TVE"),
            ("77", "Москва", "Москва", "RU-MOW"),
            ("42", "Кемеровская область - Кузбасс", "Кемеровская область - Кузбасс", "RU-KEM"),
        ),
        cities=frame(
            "region area area_type city city_type settlement settlement_type oktmo geo_lat geo_lon",
            ("Тверская", None, None, "Тверь", "г", None, None, "01", "56.85", "35.9"),
            ("Тверская", "Старицкий", "р-н", "Старица", "г", None, None, "02", "56.5", "34.9"),
            ("Тверская", "Осташков", "г", None, None, None, None, "03", "57.1", "33.1"),
            ("Москва", None, None, None, None, None, None, "45", "55.7", "37.6"),
            ("Москва", None, None, "Зеленоград", "г", None, None, "46", "55.9", "37.1"),
        ),
        settlements=frame(
            "id region municipality settlement type oktmo longitude_dd latitude_dd",
            ("1", "Тверская область", "Старицкий район", "Берново", "с", "11", "34.5", "56.6"),
            ("2", "Тверская область", "Старицкий район", "Ёлкино", "д", "12", "34.1", "56.1"),
            ("3", "Тверская область", "Калининский район", "Ёлкино", "д", "13", "35.1", "56.2"),
            ("4", "Тверская область", "Калининский район", "Ивановка", "д", "14", "35.2", "56.3"),
            ("5", "Тверская область", "Калининский район", "Ивановка", "с", "15", "35.3", "56.4"),
            ("6", "Тверская область", "Торжок", "Пески", "с", "16", "34.9", "57.0"),
        ),
    )


def address(**given):
    row = dict.fromkeys(schemas.ADDRESS_COLUMNS)
    row.update(region_name="ТВЕРСКАЯ", region_type="ОБЛАСТЬ")
    row.update(given)
    return tuple(row[c] for c in schemas.ADDRESS_COLUMNS)


ADDRESSES = {
    "all parts": (address(district_name="СТАРИЦКИЙ", district_type="РАЙОН", settlement_name="БЕРНОВО", settlement_type="СЕЛО"), "11"),
    "dotted type": (address(district_name="Старицкий", district_type="р-н.", settlement_name="елкино", settlement_type="д."), "12"),
    "other type": (address(district_name="КАЛИНИНСКИЙ", district_type="РАЙОН", settlement_name="ЕЛКИНО", settlement_type="СЕЛО"), "13"),
    "city name": (address(city_name="ТОРЖОК", settlement_name="ПЕСКИ", settlement_type="СЕЛО"), "16"),
    "region only": (address(settlement_name="БЕРНОВО"), "11"),
    "by type": (address(settlement_name="ИВАНОВКА", settlement_type="С"), "15"),
    "ambiguous": (address(settlement_name="ИВАНОВКА"), None),
    "city": (address(city_name="ТВЕРЬ", city_type="ГОРОД"), "01"),
    "city in area": (address(district_name="СТАРИЦКИЙ", district_type="РАЙОН", city_name="СТАРИЦА"), "02"),
    "area is a city": (address(city_name="ОСТАШКОВ"), "03"),
    "federal city": (address(region_name="МОСКВА", region_type="ГОРОД"), "45"),
    "unknown place": (address(settlement_name="НИГДЕ"), None),
    "fuzzy region": (address(region_name="Кемеровская", region_type="обл."), None),
    "no region": (address(region_name=None, region_type=None, city_name="ТВЕРЬ"), None),
}


def test_geocode_standalone(spark, lookups):
    schema = "label string, " + ", ".join(f"{c} string" for c in schemas.ADDRESS_COLUMNS) + ", region_code string"
    data = [(label, *a, "?") for label, (a, _) in ADDRESSES.items()] * 2
    got = geocode.geocode(spark.createDataFrame(data, schema), lookups)
    assert set(got.columns) == {"label", *schemas.GEO_COLUMNS}
    rows = got.collect()
    assert len(rows) == 2 * len(ADDRESSES)
    by_label = {r.label: r for r in rows}
    assert {label: r.oktmo for label, r in by_label.items()} == {label: o for label, (_, o) in ADDRESSES.items()}

    def place(label):
        r = by_label[label]
        return r.region_code, r.region, r.area, r.settlement, r.settlement_type, r.lat

    assert place("all parts") == ("69", "Тверская область", "Старицкий район", "Берново", "с", 56.6)
    assert place("city") == ("69", "Тверская область", None, "Тверь", "г", 56.85)
    assert place("city in area")[2:5] == ("Старицкий район", "Старица", "г")
    assert place("area is a city")[2:5] == (None, "Осташков", "г")
    assert place("federal city")[:4] == ("77", "Москва", None, "Москва")
    assert place("unknown place") == ("69", "Тверская область", None, None, None, None)
    assert place("fuzzy region")[:2] == ("42", "Кемеровская область - Кузбасс")
    assert by_label["no region"].region_iso_code is None


def test_optional_types_and_mandatory_names(spark, lookups):
    names = [c for c in schemas.ADDRESS_COLUMNS if c.endswith("_name")]
    df = spark.createDataFrame([("Тверская область", None, "Тверь", None)], ", ".join(f"{c} string" for c in names))
    assert geocode.geocode(df, lookups).first().oktmo == "01"
    with pytest.raises(ValueError, match="city_name"):
        geocode.geocode(df.drop("city_name"), lookups)


def test_modes():
    assert geocode.detect_mode(schemas.SME_AGGREGATED.names) == "chain"
    assert geocode.detect_mode(["tin", *schemas.ADDRESS_COLUMNS]) == "standalone"


def test_geocode_chain_merges_intervals(spark, rows, lookups):
    def row(start, end, **given):
        columns = dict.fromkeys(schemas.SME_AGGREGATED.names)
        columns.update(zip(schemas.ADDRESS_COLUMNS, address(city_name="ТВЕРЬ", city_type="ГОРОД")))
        columns.update(kind=1, category=1, tin="t", start_date=DAYS[start], end_date=DAYS[end])
        columns.update(given)
        return tuple(columns[c] for c in schemas.SME_AGGREGATED.names)

    df = spark.createDataFrame(
        [row(0, 1), row(1, 2, city_type="Г"), row(2, 2, category=2)], schemas.SME_AGGREGATED
    )
    got = geocode.geocode(df, lookups)
    assert got.columns == schemas.SME_GEOCODED.names
    assert [got.schema[f.name].dataType for f in schemas.SME_GEOCODED] == [f.dataType for f in schemas.SME_GEOCODED]
    assert rows(got, "category", "settlement", "start_date", "end_date") == [
        (1, "Тверь", DAYS[0], DAYS[2]), (2, "Тверь", DAYS[2], DAYS[2]),
    ]


def test_region_names(spark, lookups):
    df = spark.createDataFrame([("Тверская обл",), ("69",), ("МОСКВА ГОРОД",), ("Атлантида",), (None,)], "region string")
    got = geocode.normalize_regions(df, "region", lookups.regions)
    assert sorted(r.region_code or "" for r in got.collect()) == ["", "", "69", "69", "77"]


# ---- the whole way -------------------------------------------------------------------------------------------------


def test_process(spark, tmp_path, lookups):
    def archive(folder, name, text):
        (tmp_path / folder).mkdir(exist_ok=True)
        with zipfile.ZipFile(tmp_path / folder / name, "w") as out:
            out.writestr("part.xml", text)

    def registry(day, category):
        return (
            f'<Файл ИдФайл="F{day}" КолДок="1"><Документ ВидСубМСП="1" КатСубМСП="{category}" ДатаСост="{day}">'
            '<ОргВклМСП НаимОрг="ООО" ИННЮЛ="0000000077"/><СведМН КодРегион="69"><Регион Наим="Тверская" Тип="обл"/>'
            '<Город Наим="Тверь" Тип="г"/></СведМН><СвОКВЭД><СвОКВЭДОсн КодОКВЭД="47.11"/></СвОКВЭД></Документ></Файл>'
        )

    archive("sme", "a.zip", registry("10.02.2019", 1))
    archive("sme", "b.zip", registry("10.05.2020", 2))
    archive(
        "revexp", "a.zip",
        '<Файл><Документ ДатаСост="31.12.2019" ДатаДок="01.10.2020"><СведНП ИННЮЛ="77"/>'
        '<СведДохРасх СумДоход="10.50" СумРасход="2"/></Документ></Файл>',
    )
    archive(
        "empl", "a.zip",
        '<Файл><Документ ДатаСост="31.12.2020" ДатаДок="01.10.2021"><СведНП ИННЮЛ="77"/><СведССЧР КолРаб="4"/></Документ></Файл>',
    )
    folders = {n: str(tmp_path / n) for n in ("sme", "revexp", "empl")}
    classifier = spark.createDataFrame([("G", "47.11")], "group string, code string")

    def run(codes):
        panel = process(spark, folders, lookups, str(tmp_path / f"work-{codes[0]}"), codes=codes, classifier=classifier)
        columns = ["year", "category", "settlement", "revenue", "employees_count"]
        return panel.columns, sorted(tuple(r) for r in panel.select(*columns).collect())

    columns, got = run(["G"])
    assert columns[:2] == ["tin", "year"] and columns[-3:] == ["revenue", "expenditure", "employees_count"]
    assert got == [
        (2019, 1, "Тверь", Decimal("10.50"), None), (2020, 1, "Тверь", None, 4), (2020, 2, "Тверь", None, 4),
    ]
    assert run(["49"])[1] == []
