"""Declared tables, raw datasets and fixed vendor names."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import types as T

# --- Fixed values: factor codes of the risk model, in alphabetical order -------------------------
FACTORS: tuple[str, ...] = tuple(
    """
    USSLOWL_AERODEF USSLOWL_AIRLINES USSLOWL_ALUMSTEL USSLOWL_APPAREL USSLOWL_AUTO USSLOWL_BANKS
    USSLOWL_BETA USSLOWL_BEVTOB USSLOWL_BIOLIFE USSLOWL_BLDGPROD USSLOWL_CHEM USSLOWL_CNSTENG
    USSLOWL_CNSTMACH USSLOWL_CNSTMATL USSLOWL_COMMEQP USSLOWL_COMPELEC USSLOWL_COMSVCS
    USSLOWL_CONGLOM USSLOWL_CONTAINR USSLOWL_COUNTRY USSLOWL_DISTRIB USSLOWL_DIVFIN
    USSLOWL_DIVYILD USSLOWL_EARNQLTY USSLOWL_EARNYILD USSLOWL_ELECEQP USSLOWL_ELECUTIL
    USSLOWL_FOODPROD USSLOWL_FOODRET USSLOWL_GASUTIL USSLOWL_GROWTH USSLOWL_HLTHEQP
    USSLOWL_HLTHSVCS USSLOWL_HOMEBLDG USSLOWL_HOUSEDUR USSLOWL_INDMACH USSLOWL_INSURNCE
    USSLOWL_INTERNET USSLOWL_LEISPROD USSLOWL_LEISSVCS USSLOWL_LEVERAGE USSLOWL_LIFEINS
    USSLOWL_LIQUIDTY USSLOWL_LTREVRSL USSLOWL_MEDIA USSLOWL_MGDHLTH USSLOWL_MGMTQLTY
    USSLOWL_MIDCAP USSLOWL_MOMENTUM USSLOWL_MULTUTIL USSLOWL_OILGSCON USSLOWL_OILGSDRL
    USSLOWL_OILGSEQP USSLOWL_OILGSEXP USSLOWL_PAPER USSLOWL_PHARMA USSLOWL_PRECMTLS
    USSLOWL_PROFIT USSLOWL_PROSPECT USSLOWL_PSNLPROD USSLOWL_REALEST USSLOWL_RESTAUR
    USSLOWL_RESVOL USSLOWL_ROADRAIL USSLOWL_SEMICOND USSLOWL_SEMIEQP USSLOWL_SIZE
    USSLOWL_SOFTWARE USSLOWL_SPLTYRET USSLOWL_SPTYCHEM USSLOWL_SPTYSTOR USSLOWL_TELECOM
    USSLOWL_TRADECO USSLOWL_TRANSPRT USSLOWL_VALUE USSLOWL_WIRELESS
    """.split()
)

# --- Fixed values: vendor file column -> table column --------------------------------------------
VENDOR_COLUMNS: dict[str, str] = {
    "!Barrid": "barrid",
    "Price": "price",
    "Capt": "market_cap",
    "PriceSource": "price_source",
    "Currency": "currency",
    "DlyReturn%": "return",
    "SpecificReturn": "specific_return",
    "DataDate": "date",
    "AssetIDType": "asset_id_type",
    "AssetID": "assetid",
    "StartDate": "start_date",
    "EndDate": "end_date",
    "Name": "name",
    "Instrument": "instrument",
    "IssuerID": "issuerid",
    "ISOCountryCode": "iso_country_code",
    "ISOCurrencyCode": "iso_currency_code",
    "RootID": "rootid",
    "Yield%": "yield",
    "TotalRisk%": "total_risk",
    "SpecRisk%": "specific_risk",
    "HistBeta": "historical_beta",
    "PredBeta": "predicted_beta",
    "Factor": "factor",
    "Exposure": "exposures",
    "!Factor1": "factor_1",
    "Factor2": "factor_2",
    "VarCovar": "covariance",
    "BidAskSpread": "bid_ask_spread",
    "DailyVolume": "daily_volume",
    "ADBAS_30": "average_daily_bid_ask_spread_30",
    "ADBAS_60": "average_daily_bid_ask_spread_60",
    "ADBAS_90": "average_daily_bid_ask_spread_90",
    "ADTV_30": "average_daily_volume_30",
    "ADTV_60": "average_daily_volume_60",
    "ADTV_90": "average_daily_volume_90",
    "!Factor": "factor",
    "DlyReturn": "return",
}

# --- Fixed values: index file column -> table column ---------------------------------------------
INDEX_COLUMNS: dict[str, str] = {"russell2000": "russell_2000", "russell1000": "russell_1000"}

# --- Fixed values: last line of every vendor file, date text layout, identifier kinds ------------
END_OF_FILE = "[End of File]"
VENDOR_DATE = "yyyyMMdd"
CUSIP_KIND = "CUSIP"
LOCAL_ID_KIND = "LOCALID"
HOME_COUNTRY = "USA"
HOME_PREFIX = "US"
MATRIX_INSTRUMENTS = ("STOCK", "ETF", "ADR")
LOOKBACK_SESSIONS = 60
RISK_MODEL_START = date(1995, 7, 31)
PRICE_HISTORY_START = date(1925, 1, 1)


@dataclass(frozen=True)
class TableSpec:
    """A keyed, year-partitioned table: name, schema (without ``year``) and key columns."""

    name: str
    schema: T.StructType
    keys: tuple[str, ...]

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    def widened(self, extra: list[T.StructField]) -> TableSpec:
        """The spec with columns it lacks appended; growth is always explicit."""
        known = set(self.columns)
        return replace(self, schema=T.StructType(self.schema.fields + [f for f in extra if f.name not in known]))


_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
}


def schema_of(text: str) -> T.StructType:
    """``"name type, name type"`` to a schema; works before a session exists."""
    fields = (part.split() for part in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


def table(name: str, keys: str, columns: str) -> TableSpec:
    return TableSpec(name, schema_of(columns), tuple(keys.split()))


def _factor_ddl() -> str:
    return ", ".join(f"{f} double" for f in FACTORS)


# --- Fixed values: stored tables ------------------------------------------------------------------
ASSETS = table(
    "assets",
    "date barrid",
    """
    date date, rootid string, barrid string, issuerid string, instrument string, name string,
    cusip string, ticker string, price double, return double, specific_return double,
    market_cap double, price_source string, currency string, iso_country_code string,
    iso_currency_code string, yield double, total_risk double, specific_risk double,
    historical_beta double, predicted_beta double, russell_1000 boolean, russell_2000 boolean,
    in_universe boolean, daily_volume double, average_daily_volume_30 double,
    average_daily_volume_60 double, average_daily_volume_90 double, bid_ask_spread double,
    average_daily_bid_ask_spread_30 double, average_daily_bid_ask_spread_60 double,
    average_daily_bid_ask_spread_90 double
    """,
)
EXPOSURES = table("exposures", "date barrid", f"date date, barrid string, {_factor_ddl()}")
COVARIANCES = table("covariances", "date factor_1", f"date date, factor_1 string, {_factor_ddl()}")
FACTOR_RETURNS = table("factors", "date", f"date date, {_factor_ddl()}")
#: Last known index flags of each asset at the end of a run: where the next one goes on. Not one of the declared tables.
INDEX_STATE = table("index_state", "date barrid", "date date, barrid string, russell_1000 boolean, russell_2000 boolean")
CRSP_EVENTS = table(
    "crsp_events", "date permno", "date date, permno bigint, ticker string, shrcd bigint, exchcd bigint"
)
CRSP_MONTHLY = table(
    "crsp_monthly",
    "date permno",
    "date date, permno bigint, cusip string, ret double, retx double, prc double, vol bigint, shrout bigint",
)
CRSP_DAILY = table(
    "crsp_daily",
    "date permno",
    """
    date date, permno bigint, cusip string, ret double, retx double, prc double, vol bigint,
    openprc double, askhi double, bidlo double, shrout bigint
    """,
)
SIGNALS = table(
    "signals", "date barrid name", "date date, barrid string, name string, signal double, score double, alpha double"
)
ACTIVE_WEIGHTS = table(
    "active_weights", "date barrid signal", "date date, barrid string, signal string, weight double"
)
COMPOSITE_ALPHAS = table(
    "composite_alphas", "date barrid name", "date date, barrid string, name string, alpha double"
)
TABLES: dict[str, TableSpec] = {
    t.name: t
    for t in (
        ASSETS, EXPOSURES, COVARIANCES, FACTOR_RETURNS, CRSP_EVENTS, CRSP_MONTHLY, CRSP_DAILY,
        SIGNALS, ACTIVE_WEIGHTS, COMPOSITE_ALPHAS,
    )
}
DATABASES = ("research", "production", "development")


#: Where a row of an archive stands: its archive, member, and rows before it there. In this order later rows correct earlier ones.
ARRIVAL = ("_archive", "_member", "_line")


@dataclass(frozen=True)
class DatasetSpec:
    """Where a raw dataset lies inside the archive tree and how its text is laid out.

    ``history_many`` marks years spread over several archives, found by name, not one per year.
    """

    name: str
    daily_folder: str
    daily_zip: str
    member: str
    skip_lines: int
    raw: T.StructType
    history_folder: str | None = None
    history_zip: str | None = None
    history_many: bool = False

    def daily_archive(self, session: date) -> str:
        return f"{self.daily_folder}/{self.daily_zip}_{session:%y%m%d}.zip"

    def daily_member(self, session: date) -> str:
        return f"{self.member}.{session:%Y%m%d}"

    def history_archives(self, year: int) -> str:
        """Glob of the archives that hold one year."""
        if self.history_zip is None:
            raise ValueError(f"{self.name} has no history archives")
        stem = f"{self.history_zip}_{year}"
        return f"{self.history_folder}/" + (f"*{stem}*" if self.history_many else f"{stem}.zip")

    def moved(self, **changes) -> DatasetSpec:
        return replace(self, **changes)


# --- Fixed values: raw columns and archive locators -----------------------------------------------
_HISTORY = "history/usslow/sm/daily"
RETURNS_DATA = DatasetSpec(
    "returns", "us/usslow", "SMD_USSLOWL_100", "USSLOW_Daily_Asset_Price", 1,
    schema_of(
        "!Barrid string, Price double, Capt double, PriceSource string, Currency string, "
        "DlyReturn% double, DataDate string"
    ),
    _HISTORY, "SMD_USSLOW_100_D",
)
SPECIFIC_RETURNS_DATA = DatasetSpec(
    "specific_returns", "us/usslow", "SMD_USSLOWL_100", "USSLOW_100_Asset_DlySpecRet", 2,
    schema_of("!Barrid string, SpecificReturn double, DataDate string"),
    _HISTORY, "SMD_USSLOW_100_D",
)
RISK_DATA = DatasetSpec(
    "risk", "us/usslow", "SMD_USSLOWL_100", "USSLOWL_100_Asset_Data", 2,
    schema_of(
        "!Barrid string, Yield% double, TotalRisk% double, SpecRisk% double, HistBeta double, "
        "PredBeta double, DataDate string"
    ),
    _HISTORY, "SMD_USSLOWL_100_D", True,
)
VOLUME_DATA = DatasetSpec(
    "volume", "bime", "SMD_USSLOW_Market_Data", "USSLOW_Market_Data", 1,
    schema_of(
        "!Barrid string, DailyVolume double, ADTV_30 double, ADTV_60 double, ADTV_90 double, "
        "BidAskSpread double, ADBAS_30 double, ADBAS_60 double, ADBAS_90 double, DataDate string"
    ),
    _HISTORY, "SMD_USSLOW_100_D",
)
IDENTITY_DATA = DatasetSpec(
    "identity", "bime", "SMD_USSLOW_XSEDOL_ID", "USA_Asset_Identity", 1,
    schema_of(
        "!Barrid string, Name string, Instrument string, IssuerID string, ISOCountryCode string, "
        "ISOCurrencyCode string, RootID string, StartDate string, EndDate string"
    ),
)
IDS_DATA = DatasetSpec(
    "ids", "bime", "SMD_USSLOW_XSEDOL_ID", "USA_XSEDOL_Asset_ID", 1,
    schema_of("!Barrid string, AssetIDType string, AssetID string, StartDate string, EndDate string"),
)
COVARIANCE_DATA = DatasetSpec(
    "covariances", "us/usslow", "SMD_USSLOWL_100", "USSLOWL_100_Covariance", 2,
    # text, not double: the values may be padded with blanks
    schema_of("!Factor1 string, Factor2 string, VarCovar string, DataDate string"),
    _HISTORY, "SMD_USSLOWL_100_D", True,
)
EXPOSURE_DATA = DatasetSpec(
    "exposures", "us/usslow", "SMD_USSLOWL_100", "USSLOWL_100_Asset_Exposure", 2,
    schema_of("!Barrid string, Factor string, Exposure double, DataDate string"),
    _HISTORY, "SMD_USSLOWL_100_D", True,
)
FACTOR_RETURN_DATA = DatasetSpec(
    "factor_returns", "bime", "SMD_USSLOWL_100", "USSLOWL_100_DlyFacRet", 2,
    schema_of("!Factor string, DlyReturn double, DataDate string"),
)
# The matrix job reads the model files from another folder, and a second archive for funds.
_ETF_ZIP = "SMD_USSLOWL_100_ETF"
MATRIX_EXPOSURE_DATA = (
    EXPOSURE_DATA.moved(daily_folder="bime"),
    EXPOSURE_DATA.moved(daily_folder="bime", daily_zip=_ETF_ZIP, member="USSLOWL_ETF_100_Asset_Exposure"),
)
MATRIX_RISK_DATA = (
    RISK_DATA.moved(daily_folder="bime"),
    RISK_DATA.moved(daily_folder="bime", daily_zip=_ETF_ZIP, member="USSLOWL_ETF_100_Asset_Data"),
)
MATRIX_COVARIANCE_DATA = COVARIANCE_DATA.moved(daily_folder="bime")
