"""Tables of the registry: schemas, element maps and the column lists of each stage.

Strings keep leading zeros, money is exact, coordinates are double.
"""

from __future__ import annotations

from pyspark.sql import types as T

DATASETS = ("sme", "revexp", "empl")
INPUT_DATE_FORMAT = "dd.MM.yyyy"

_S, _B, _I, _D = T.StringType(), T.ByteType(), T.IntegerType(), T.DateType()
_MONEY = T.DecimalType(18, 2)


def _struct(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


# ---- fixed values: the input format and the published column lists -------------------------

RECORD_TAG = "Документ"
FILE_ATTRIBUTES = {"@ИдФайл": "file_id", "@КолДок": "doc_cnt"}

ELEMENTS = {
    "sme": {
        "@ВидСубМСП": "kind",
        "@КатСубМСП": "category",
        "@ДатаВклМСП": "reestr_date",
        "@ДатаСост": "data_date",
        "ИПВклМСП/@ИННФЛ": "ind_tin",
        "ИПВклМСП/@ОГРНИП": "ind_number",
        "ИПВклМСП/ФИОИП/@Имя": "first_name",
        "ИПВклМСП/ФИОИП/@Фамилия": "last_name",
        "ИПВклМСП/ФИОИП/@Отчество": "patronymic",
        "ОргВклМСП/@НаимОрг": "org_name",
        "ОргВклМСП/@НаимОргСокр": "org_short_name",
        "ОргВклМСП/@ИННЮЛ": "org_tin",
        "ОргВклМСП/@ОГРН": "org_number",
        "СведМН/@КодРегион": "region_code",
        "СведМН/Регион/@Наим": "region_name",
        "СведМН/Регион/@Тип": "region_type",
        "СведМН/Район/@Наим": "district_name",
        "СведМН/Район/@Тип": "district_type",
        "СведМН/Город/@Наим": "city_name",
        "СведМН/Город/@Тип": "city_type",
        "СведМН/НаселПункт/@Наим": "settlement_name",
        "СведМН/НаселПункт/@Тип": "settlement_type",
        "СвОКВЭД/СвОКВЭДОсн/@КодОКВЭД": "activity_code_main",
    },
    "revexp": {
        "СведНП/@ИННЮЛ": "org_tin",
        "СведДохРасх/@СумДоход": "revenue",
        "СведДохРасх/@СумРасход": "expenditure",
        "@ДатаСост": "data_date",
        "@ДатаДок": "doc_date",
    },
    "empl": {
        "СведНП/@ИННЮЛ": "org_tin",
        "СведССЧР/@КолРаб": "employees_count",
        "@ДатаСост": "data_date",
        "@ДатаДок": "doc_date",
    },
}

NAME_COLUMNS = ["first_name", "last_name", "patronymic", "org_name", "org_short_name"]
ADDRESS_COLUMNS = [
    "region_name", "region_type", "district_name", "district_type",
    "city_name", "city_type", "settlement_name", "settlement_type",
]
EXCLUDED_REGIONS = ["Крым", "Севастополь", "Донецкая", "Луганская", "Запорожская", "Херсонская"]
TRACKED_COLUMNS = [
    "kind", "category", "tin", "reg_number",
    "first_name", "last_name", "patronymic", "org_name", "org_short_name",
    "region_name", "district_name", "city_name", "settlement_name", "activity_code_main",
]
SIGNATURE_COLUMNS = [
    "tin", "reg_number", "kind", "category",
    "first_name", "last_name", "patronymic", "org_name", "org_short_name", "activity_code_main",
]
GEO_COLUMNS = [
    "region_iso_code", "region_code", "region", "area", "settlement", "settlement_type",
    "oktmo", "lat", "lon",
]
FEDERAL_CITIES = ["Москва", "Санкт-Петербург"]
REGION_TYPE_WORDS = [
    "область", "республика", "город", "край", "автономный округ", "автономная область",
    "обл", "г", "респ", "ао",
]
DATASET_PAGE_ROWS = {
    8: "Гиперссылка (URL) на набор",
    16: "Гиперссылки (URL) на предыдущие релизы набора данных",
}

SME = _struct(
    ("kind", _B), ("category", _B), ("reestr_date", _D), ("data_date", _D),
    ("ind_tin", _S), ("ind_number", _S),
    *[(c, _S) for c in NAME_COLUMNS],
    ("org_tin", _S), ("org_number", _S), ("region_code", _B),
    *[(c, _S) for c in ADDRESS_COLUMNS],
    ("activity_code_main", _S), ("file_id", _S), ("doc_cnt", _I),
)
REVEXP = _struct(
    ("org_tin", _S), ("revenue", _MONEY), ("expenditure", _MONEY), ("data_date", _D), ("doc_date", _D),
)
EMPL = _struct(("org_tin", _S), ("employees_count", _I), ("data_date", _D), ("doc_date", _D))
EXTRACTED = {"sme": SME, "revexp": REVEXP, "empl": EMPL}

SME_AGGREGATED = _struct(
    ("kind", _B), ("category", _B), ("tin", _S), ("reg_number", _S),
    *[(c, _S) for c in NAME_COLUMNS],
    ("region_code", _B),
    *[(c, _S) for c in ADDRESS_COLUMNS],
    ("activity_code_main", _S), ("start_date", _D), ("end_date", _D),
)
REVEXP_AGGREGATED = _struct(("tin", _S), ("year", _I), ("revenue", _MONEY), ("expenditure", _MONEY))
EMPL_AGGREGATED = _struct(("tin", _S), ("year", _I), ("employees_count", _I))
AGGREGATED = {"sme": SME_AGGREGATED, "revexp": REVEXP_AGGREGATED, "empl": EMPL_AGGREGATED}

SME_GEOCODED = _struct(
    ("tin", _S), ("reg_number", _S), ("kind", _B), ("category", _B),
    *[(c, _S) for c in NAME_COLUMNS],
    ("activity_code_main", _S),
    *[(c, T.DoubleType() if c in ("lat", "lon") else _S) for c in GEO_COLUMNS],
    ("start_date", _D), ("end_date", _D),
)

# ---- end of fixed values ---------------------------------------------------------------------


def check_dataset(dataset: str) -> str:
    """Fail early on a table family that does not exist."""
    if dataset not in DATASETS:
        raise ValueError(f"unknown source dataset {dataset!r}, expected one of {list(DATASETS)}")
    return dataset
