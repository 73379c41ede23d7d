"""Reference tables: merchant categories, currencies, exchange rates, card issuers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudspark import schemas

# Mcc, description, category, high risk.
MCC_ROWS = [
    ("0000", "Unknown", "UNKNOWN", False),
    ("4111", "Transport / Commuter", "TRANSPORT", False),
    ("4814", "Telecom Services", "TELECOM", False),
    ("4829", "Wire Transfer", "FINANCIAL", True),
    ("5311", "Department Stores", "RETAIL", False),
    ("5411", "Grocery Stores", "GROCERY", False),
    ("5541", "Service Stations", "FUEL", False),
    ("5732", "Electronics Stores", "ELECTRONICS", False),
    ("5812", "Restaurants", "FOOD_BEVERAGE", False),
    ("5814", "Fast Food Restaurants", "FOOD_BEVERAGE", False),
    ("5912", "Drug Stores / Pharmacies", "HEALTH", False),
    ("5933", "Pawn Shops", "RETAIL", True),
    ("5999", "Miscellaneous Retail", "OTHER", False),
    ("6011", "ATM / Cash Dispensing", "ATM", True),
    ("6012", "Financial Institutions", "FINANCIAL", False),
    ("7011", "Hotels / Lodging", "TRAVEL", False),
    ("7995", "Gambling", "GAMBLING", True),
]

# ISO number, ISO letters, name, region.
CURRENCY_ROWS = [
    ("124", "CAD", "Canadian Dollar", "NORTH_AMERICA"),
    ("156", "CNY", "Chinese Yuan", "ASIA"),
    ("356", "INR", "Indian Rupee", "ASIA"),
    ("404", "KES", "Kenyan Shilling", "AFRICA"),
    ("566", "NGN", "Nigerian Naira", "AFRICA"),
    ("646", "RWF", "Rwandan Franc", "AFRICA"),
    ("710", "ZAR", "South African Rand", "AFRICA"),
    ("784", "AED", "UAE Dirham", "MIDDLE_EAST"),
    ("800", "UGX", "Ugandan Shilling", "AFRICA"),
    ("826", "GBP", "British Pound", "EUROPE"),
    ("834", "TZS", "Tanzanian Shilling", "AFRICA"),
    ("840", "USD", "US Dollar", "NORTH_AMERICA"),
    ("936", "GHS", "Ghanaian Cedi", "AFRICA"),
    ("978", "EUR", "Euro", "EUROPE"),
]

# Default rates to the US dollar.
FX_ROWS = [
    ("AED", 0.272),
    ("CAD", 0.74),
    ("CNY", 0.138),
    ("EUR", 1.09),
    ("GBP", 1.27),
    ("GHS", 0.083),
    ("INR", 0.012),
    ("KES", 0.0077),
    ("NGN", 0.00065),
    ("RWF", 0.00073),
    ("TZS", 0.00038),
    ("UGX", 0.00027),
    ("USD", 1.0),
    ("ZAR", 0.055),
]

# BIN, brand, type, country, issuer, prepaid.
BIN_ROWS = [
    ("411111", "VISA", "CREDIT", "US", "Test Bank", False),
    ("498765", "VISA", "DEBIT", "KE", "KCB Bank", False),
    ("512345", "MASTERCARD", "DEBIT", "KE", "Equity Bank", False),
    ("639301", "VISA", "PREPAID", "KE", "Safaricom M-Pesa", True),
]


def mcc_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(MCC_ROWS, schemas.MCC)


def currency_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CURRENCY_ROWS, schemas.CURRENCY)


def bin_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(BIN_ROWS, schemas.BIN)


def fx_table(spark: SparkSession, live: DataFrame | None = None) -> DataFrame:
    """Default rates, each replaced by the live rate of its currency where one is given.

    ``live`` has ``currency_alpha, fx_rate_to_usd`` and optionally ``as_of`` (the newest wins).
    Only the known currencies are kept, so the result never has more rows than the defaults.
    """
    defaults = spark.createDataFrame(FX_ROWS, schemas.FX)
    if live is None:
        return defaults
    usable = live.where(F.col("fx_rate_to_usd").isNotNull())
    newest = (
        F.max_by("fx_rate_to_usd", "as_of") if "as_of" in live.columns else F.max("fx_rate_to_usd")
    )
    rates = usable.groupBy("currency_alpha").agg(newest.alias("_live"))
    return defaults.join(rates, "currency_alpha", "left").select(
        "currency_alpha", F.coalesce("_live", "fx_rate_to_usd").alias("fx_rate_to_usd")
    )


class ReferenceTables:
    """The four tables of one run.

    ``refresh_fx`` reads the live rates again; streaming jobs call it per micro-batch, so a started
    query sees new rates. ``mcc``, ``currency`` and ``bins`` may be replaced by larger tables; a
    table that is not one of the fixed ones is joined without a broadcast hint.
    """

    def __init__(
        self,
        spark: SparkSession,
        live_rates=None,
        mcc: DataFrame | None = None,
        currency: DataFrame | None = None,
        bins: DataFrame | None = None,
    ):
        self._spark, self._live_rates = spark, live_rates
        self.fixed = {
            name
            for name, given in (("mcc", mcc), ("currency", currency), ("bins", bins))
            if given is None
        } | {"fx"}
        self.mcc = mcc_table(spark) if mcc is None else mcc
        self.currency = currency_table(spark) if currency is None else currency
        self.bins = bin_table(spark) if bins is None else bins
        self.fx = self.refresh_fx()

    def refresh_fx(self) -> DataFrame:
        live = self._live_rates() if callable(self._live_rates) else self._live_rates
        self.fx = fx_table(self._spark, live)
        return self.fx


def read_schema_text(spark: SparkSession, directory: str, provider: str) -> str | None:
    """Text of ``<provider>_tokenised.avsc`` in a directory of any Spark file system, else null."""
    path = f"{directory.rstrip('/')}/{provider.lower()}_tokenised.avs[c]"
    try:
        rows = spark.read.text(path, wholetext=True).take(1)
    except Exception as problem:  # a glob without a match is an analysis error
        if "PATH_NOT_FOUND" in str(problem):
            return None
        raise
    return rows[0][0] if rows else None
