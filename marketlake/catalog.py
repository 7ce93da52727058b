"""Dataset catalogue and its Spark forms.

The catalogue is configuration: a few dozen rows that never grow with the
data, so its frames are safe to broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The exchange datasets (item, frequency, first date, configured
# sub-table titles, one-letter code), as configured for the collector.
EXCHANGE_CATALOGUE = [
    ("每日收盤行情", "D", "2004-2-11",
     ["價格指數(臺灣證券交易所)", "價格指數(跨市場)", "價格指數(臺灣指數公司)", "報酬指數(臺灣證券交易所)",
      "報酬指數(跨市場)", "報酬指數(臺灣指數公司)", "大盤統計資訊", "每日收盤行情", "漲跌證券數合計"], "A"),
    ("信用交易統計", "D", "2001-1-1", ["融資融券彙總", "信用交易統計"], "B"),
    ("市場成交資訊", "ME", "1990-1-4", ["市場成交資訊"], "C"),
    ("三大法人買賣金額統計表", "D", "2004-4-7", ["三大法人買賣金額統計表"], "D"),
    ("三大法人買賣超日報", "D", "2012-5-2", ["三大法人買賣超日報"], "E"),
    ("個股日本益比、殖利率及股價淨值比", "D", "2012-5-2", ["個股日本益比、殖利率及股價淨值比"], "F"),
    ("信用額度總量管制餘額表", "D", "2005-7-1", ["信用額度總量管制餘額表"], "G"),
    ("當日沖銷交易標的及成交量值", "D", "2014-1-6", ["當日沖銷交易統計資訊", "當日沖銷交易標的及成交量值"], "H"),
    ("每月當日沖銷交易標的及統計", "ME", "2014-1-6", ["每月當日沖銷交易標的及統計"], "I"),
    ("外資及陸資投資持股統計", "D", "2004-2-11", ["外資及陸資投資持股統計"], "J"),
    ("發行量加權股價指數歷史資料", "D", "1999-1-5", ["發行量加權股價指數歷史資料"], "K"),
]

# Grouped headers, column ranges [start, end) per group.
FIELD_SPANS = {
    "融資融券彙總": [("股票", 0, 2), ("融資", 2, 8), ("融券", 8, 14), ("其他", 14, 16)],
    "信用額度總量管制餘額表": [("股票", 0, 2), ("融券", 2, 8), ("借券賣出", 8, 14), ("其他", 14, 15)],
}

# Key aliases of a raw document's sub-table blocks.
MAIN_BLOCK_ALIASES = {
    "fields": ["fields"],
    "data": ["data"],
    "title": ["title", "subtitle"],
    "groups": ["groups"],
    "notes": ["notes"],
}
CREDIT_BLOCK_ALIASES = {
    "fields": ["creditFields"],
    "data": ["creditList"],
    "title": ["creditTitle"],
    "notes": ["creditNotes"],
}

# Columns dropped from every cleaned table.
DROP_COLUMNS = ["漲跌(+/-)"]

# Security-list market models and the ISIN slice [start, stop)
# (0-based) that yields the local code.
ISIN_CODE_SLICE = {1: (5, 9), 2: (5, 9), 3: (5, 10), 4: (5, 11), 5: (5, 9), 6: (5, 10),
                   7: (5, 11), 8: (5, 9), 9: (5, 11), 10: (5, 9), 11: (5, 11), 12: (5, 11)}

# Folders never treated as datasets when scanning landed documents.
EXCLUDED_SOURCE_DIRS = ["log", "productlist"]

CATALOGUE_SCHEMA = "item string, freq string, datemin string, subtitle array<string>, code string"


def catalogue_frame(spark: SparkSession, rows: Sequence[tuple] = EXCHANGE_CATALOGUE) -> DataFrame:
    """Raw catalogue as a frame (item, freq, datemin text, subtitle[], code)."""
    rows = [tuple(r) + (None,) * (5 - len(r)) for r in rows]
    return spark.createDataFrame(rows, CATALOGUE_SCHEMA)


def _lenient_date(c):
    # 'yyyy-M-d' with or without zero padding; anything else -> NULL
    return F.coalesce(F.try_to_date(c, "yyyy-M-d"), F.try_to_date(c, "yyyy/M/d"))


def expected_items(catalogue: DataFrame) -> DataFrame:
    """Item, freq, datemin (DATE, NULL when unparsable), n_expected_subitems, code."""
    return catalogue.select(
        "item", "freq", _lenient_date(F.col("datemin")).alias("datemin"),
        F.coalesce(F.size("subtitle"), F.lit(0)).cast("int").alias("n_expected_subitems"),
        "code")


def dim_subtitle(catalogue: DataFrame) -> DataFrame:
    """(item, subtitle_pos, subtitle) - one row per configured sub-table."""
    return catalogue.select("item", F.posexplode("subtitle").alias("subtitle_pos", "subtitle"))


# Global header rename applied to every landed table (P1), in
# the order configured for the collector.
GLOBAL_RENAME = {
    "指數代號及名稱": "名稱",
    "STO代號及名稱": "名稱",
    "每日收盤行情(全部)": "每日收盤行情",
    "公開發行日": "發行日",
    "上市日": "發行日",
    "登錄日": "發行日",
    "掛牌日": "發行日",
    "價格指數(跨市場)": "價格指數_跨市場",
    "價格指數(臺灣指數公司)": "價格指數_臺灣指數公司",
    "報酬指數(臺灣證券交易所)": "報酬指數_臺灣證券交易所",
    "報酬指數(跨市場)": "報酬指數_跨市場",
    "報酬指數(臺灣指數公司)": "報酬指數_臺灣指數公司",
    "價格指數(臺灣證券交易所)": "價格指數_臺灣證券交易所",
    "上市認購(售)權證": "上市認購售權證",
    "上櫃認購(售)權證": "上櫃認購售權證",
    "認購(售)權證": "認購售權證",
    "臺灣存託憑證(TDR)": "台灣存託憑證",
    "受益證券-不動產投資信託": "受益證券_不動產投資信託",
    "國際證券辨識號碼(ISIN Code)": "ISINCode",
    "受益證券-資產基礎證券": "受益證券_資產基礎證券",
    "黃金期貨(USD)": "黃金期貨USD",
    "成交金額(元)": "成交金額_元",
    "成交股數(股)": "成交股數_股",
    "漲跌百分比(%)": "漲跌百分比%",
    "自營商買進股數(自行買賣)": "自營商買進股數_自行買賣",
    "自營商賣出股數(自行買賣)": "自營商賣出股數_自行買賣",
    "自營商買賣超股數(自行買賣)": "自營商買賣超股數_自行買賣",
    "自營商買進股數(避險)": "自營商買進股數_避險",
    "自營商賣出股數(避險)": "自營商賣出股數_避險",
    "自營商買賣超股數(避險)": "自營商買賣超股數_避險",
    "殖利率(%)": "殖利率%",
    "外陸資買進股數(不含外資自營商)": "外陸資買進股數_不含外資自營商",
    "外陸資賣出股數(不含外資自營商)": "外陸資賣出股數_不含外資自營商",
    "外陸資買賣超股數(不含外資自營商)": "外陸資買賣超股數_不含外資自營商",
    "現金(券)償還": "現金券償還",
    "證券代號": "代號",
    "股票代號": "代號",
    "指數代號": "代號",
    "證券名稱": "名稱",
    "股票名稱": "名稱",
    "有價證券名稱": "名稱",
    "有價證券代號及名稱": "名稱",
    "報酬指數": "名稱",
    "指數": "名稱",
    "成交統計": "名稱",
    "類型": "名稱",
    "項目": "名稱",
    "單位名稱": "名稱",
    "日期": "date",
    "融資(交易單位)": "融資_交易單位",
    "融券(交易單位)": "融券_交易單位",
    "融資金額(仟元)": "融資金額仟元",
}

# Per-dataset header rename (P2), (item, sub-table) -> {old: new}.
DATASET_RENAME = {
    ("信用額度總量管制餘額表", "信用額度總量管制餘額表"): {
        "借券賣出_賣出": "借券賣出_當日賣出",
        "借券賣出_庫存異動": "借券賣出_當日還券",
        "借券賣出_今日餘額": "借券賣出_當日餘額",
        "借券賣出_可使用額度": "借券賣出_次一營業日可限額",
    },
    ("三大法人買賣超日報", "三大法人買賣超日報"): {
        "外資買進股數": "外陸資買進股數_不含外資自營商",
        "外資賣出股數": "外陸資賣出股數_不含外資自營商",
        "外資買賣超股數": "外陸資買賣超股數_不含外資自營商",
        "自營商買進股數": "自營商買進股數_自行買賣",
        "自營商賣出股數": "自營商賣出股數_自行買賣",
    },
}

# Numeric columns per (item, sub-table), under their final names.
_INDEX_COLUMNS = ["收盤指數", "漲跌點數", "漲跌百分比%"]
_DAY_TRADE_TOTALS = [
    "當日沖銷交易總成交股數", "當日沖銷交易總成交股數占市場比重%", "當日沖銷交易總買進成交金額",
    "當日沖銷交易總買進成交金額占市場比重%", "當日沖銷交易總賣出成交金額", "當日沖銷交易總賣出成交金額占市場比重%"]
NUMERIC_COLUMNS = {
    ("每日收盤行情", "每日收盤行情"): [
        "成交股數", "成交筆數", "成交金額", "開盤價", "最高價", "最低價", "收盤價", "漲跌價差", "最後揭示買價",
        "最後揭示買量", "最後揭示賣價", "最後揭示賣量", "本益比"],
    ("每日收盤行情", "報酬指數_臺灣證券交易所"): _INDEX_COLUMNS,
    ("每日收盤行情", "報酬指數_臺灣指數公司"): _INDEX_COLUMNS,
    ("每日收盤行情", "價格指數_臺灣證券交易所"): _INDEX_COLUMNS,
    ("每日收盤行情", "大盤統計資訊"): ["成交金額_元", "成交股數_股", "成交筆數"],
    ("每日收盤行情", "價格指數_跨市場"): _INDEX_COLUMNS,
    ("每日收盤行情", "價格指數_臺灣指數公司"): _INDEX_COLUMNS,
    ("每日收盤行情", "報酬指數_跨市場"): _INDEX_COLUMNS,
    ("信用交易統計", "融資融券彙總"): [
        "資券互抵", "融資_買進", "融資_賣出", "融資_現金償還", "融資_前日餘額", "融資_今日餘額", "融資_次一營業日餘額",
        "融資_限額", "融券_現券償還", "融券_買進", "融券_賣出", "融券_前日餘額", "融券_今日餘額", "融券_限額",
        "融券_次一營業日餘額"],
    ("信用交易統計", "信用交易統計"): ["買進", "賣出", "現金券償還", "前日餘額", "今日餘額"],
    ("市場成交資訊", "市場成交資訊"): ["成交股數", "成交金額", "成交筆數", "發行量加權股價指數", "漲跌點數"],
    ("三大法人買賣金額統計表", "三大法人買賣金額統計表"): ["買進金額", "賣出金額", "買賣差額"],
    ("三大法人買賣超日報", "三大法人買賣超日報"): [
        "外陸資買進股數_不含外資自營商", "外陸資賣出股數_不含外資自營商", "外陸資買賣超股數_不含外資自營商",
        "外資自營商買進股數", "外資自營商賣出股數", "外資自營商買賣超股數", "外資買進股數", "外資賣出股數",
        "外資買賣超股數", "投信買進股數", "投信賣出股數", "投信買賣超股數", "自營商買進股數", "自營商賣出股數",
        "自營商買賣超股數", "三大法人買賣超股數", "自營商買進股數_自行買賣", "自營商賣出股數_自行買賣",
        "自營商買賣超股數_自行買賣", "自營商買進股數_避險", "自營商賣出股數_避險", "自營商買賣超股數_避險"],
    ("個股日本益比、殖利率及股價淨值比", "個股日本益比、殖利率及股價淨值比"): ["本益比", "殖利率%", "股價淨值比"],
    ("信用額度總量管制餘額表", "信用額度總量管制餘額表"): [
        "融券_前日餘額", "融券_賣出", "融券_買進", "融券_現券", "融券_今日餘額", "融券_限額", "融券_次一營業日限額",
        "借券賣出_前日餘額", "借券賣出_當日賣出", "借券賣出_當日還券", "借券賣出_當日調整", "借券賣出_當日餘額",
        "借券賣出_次一營業日可限額", "借券賣出_賣出", "借券賣出_庫存異動", "借券賣出_今日餘額", "借券賣出_可使用額度"],
    ("當日沖銷交易標的及成交量值", "當日沖銷交易統計資訊"): _DAY_TRADE_TOTALS,
    ("當日沖銷交易標的及成交量值", "當日沖銷交易標的及成交量值"): [
        "當日沖銷交易成交股數", "當日沖銷交易買進成交金額", "當日沖銷交易賣出成交金額"],
    ("每月當日沖銷交易標的及統計", "每月當日沖銷交易標的及統計"): _DAY_TRADE_TOTALS,
    ("外資及陸資投資持股統計", "外資及陸資投資持股統計"): [
        "外資及陸資尚可投資股數", "全體外資及陸資持有股數", "外資及陸資共用法令投資上限比率", "陸資法令投資上限比率",
        "發行股數", "外資及陸資尚可投資比率", "全體外資及陸資持股比率", "外資尚可投資股數", "全體外資持有股數",
        "外資尚可投資比率", "全體外資持股比率", "法令投資上限比率"],
    ("發行量加權股價指數歷史資料", "發行量加權股價指數歷史資料"): ["開盤指數", "最高指數", "最低指數", "收盤指數"],
}
