"""Payments and ZIP lookup derived from the TPC-H-like ``orders`` and ``nation`` tables.

There is no public payment table with these columns, so every order becomes one payment: integer
arithmetic on its key picks each text from a pool of telling values or generates one. The select
lists below are plain SQL that Spark and DuckDB read alike, so both sides see the same input.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payscope import fixed_values as V
from payscope.sources.schema import EBPP_COLUMN, ID, NUMERIC_COLUMNS, PRICING_COLUMN

LONG_NAME = "Maximiliana Wolfeschlegelsteinhausen Bergerdorff the Elder One"
LONG_ADDRESS = "Building Seven Northern Industrial Park " * 3 + "Behind The Old Mill On The River Side"
LONG_USER = "averyveryverylongusernameofatleast35"
LONG_CHANNEL = "Some Very Long Channel Description That Nobody Uses Now"
LONG_MCC = "Miscellaneous And Specialty Retail Stores And Services For Garden Tools And Outdoor Living " * 2

# column -> (modulus, pool in index order, SQL for keys past the pool)
TEXT_POOLS = {
    "Payment_CustomerName": (
        31,
        [
            None, "", "test", "John Doe", "ACME LLC", "Blue Water Co. Inc.", "qwerty asdf",
            "J Smith", "Jane D", "bob", "al", "ANNA BELL", "anna bell", "O'Neil-Jr.", "R2 D2",
            "Widget 77 LTD", "Demo Account", "Bob Bob", "Two  Spaces", LONG_NAME, "M@ry Jones",
            "\t Tab Lead", "1234 Holdings PLC",
        ],
        "'Customer#' || lpad(CAST(c AS STRING), 9, '0')",
    ),
    "Address1": (
        29,
        [
            None, "", "123 MAIN ST", "PO BOX 12", "Box 7", "1 Test Rd", "99999",
            "12 Elm St, Reno NV 89501", "500 Oak Ave Suite 200", "regus center 5th floor",
            "asdf lane 1", "9 Pine~Way", "77 LAKE DR, DOVER DE 19901-1234", "Unit 4 Foo Corp",
            LONG_ADDRESS,
        ],
        "CAST(k AS STRING) || ' Oak Street, Town 1' || lpad(CAST(k % 10000 AS STRING), 4, '0')",
    ),
    "EmailAddress": (
        37,
        [
            None, "", "admin@mailinator.com", "john.smith99@gmail.com", "12345678@yahoo.com",
            "abc@x", "no-at-sign", "test@example.com", "a@b@c.com", "we!rd@hotmail.com",
            "user.name@corp.org", "sales@outlook.com", "joe@yopmail.com",
            LONG_USER + "@icloud.com", " Upper.Case@AOL.com ",
        ],
        "'user' || CAST(c AS STRING) || '@mail' || CAST(k % 9 AS STRING) || '.example.com'",
    ),
    "RemoteIP": (
        41,
        [
            None, "", "127.0.0.1", "192.168.1.1", "10.0.0.5", "172.20.1.1", "1.2.3.4", "8.8.8.8",
            "131.132.133.134", "9.9.5.5", "999.1.1.1", "224.0.0.1", "250.1.1.1", "0.0.0.0",
            "fe80::1234", "junk", "1.2.3", "203.0.113.9", "1.1.1.1",
        ],
        "CAST(k % 223 + 1 AS STRING) || '.' || CAST(k % 256 AS STRING) || '.'"
        " || CAST(k % 251 AS STRING) || '.' || CAST(k % 253 AS STRING)",
    ),
    "Cardnumber": (
        43,
        [
            None, "", "4111-1111-1111-1111", "4485913000000123", "5555555555554444",
            "2221001234567890", "378282246310005", "377012345678901", "30569309025904",
            "6011111111111117", "6441234123412341", "3530111333300000", "0000000000", "12", "N/A",
            "9912345", "4111111", "4859130000000123",
        ],
        "'4' || lpad(CAST(k AS STRING), 15, '7')",
    ),
    "PaymentSourceDesc": (
        23,
        [
            None, "", "Auto Pay", "IVR", "POS", "Shopping Cart", "Webservices", "Pay By Text",
            "Agent Connect", "Cloud Payments", "CSR - One Time Pay", "Test", "Web 2", "X!",
            "Customer Portal", "asdf", LONG_CHANNEL,
        ],
        "'Express Payments'",
    ),
    "MCC_DESCRIPTION": (
        19,
        [
            None, "", "Tax Payments", "FINES", "Testing Laboratories ( Non-Medical)",
            "Business Services, Not Elsewhere Classified", "Legal Services and Attorneys",
            "FINANCIAL INSTITUTIONS – MERCHANDISE AND SERVICES", "Shop 24/7", "Connecting Things",
            "Dev Shop One", LONG_MCC, "Automobile Parking Lots and Garages",
        ],
        "'Electric, Gas, Sanitary and Water Utilities'",
    ),
    "Partner": (
        17,
        [
            None, "", "Oracle", "SAP Cloud", "Tyler Munis", "Harris AS400", "Central Square",
            "Muni-Link Batch", "In-House", "Custom Real-Time", "Demo Sample", "XY",
            "Acme Water Utility", "Insurity Insurance",
        ],
        "'Plain Partner'",
    ),
    EBPP_COLUMN: (
        47,
        [
            None, "", "UNKNOWN", "JetPay", "Wells Fargo", "Kubra", "BofA Velocity",
            "In-House Gateway", "Foo Pay", "No EBPP Today", "Pilot Temp", "Inhouse X",
            "Springfield County",
        ],
        "'Paymentus'",
    ),
    PRICING_COLUMN: (
        13,
        [None, "", "Absorb", "hybrid", " SUBMIT ", "No Pricing", "Flat"],
        "'Absorb'",
    ),
    "Zip": (
        53,
        [None, "", "90210", "00000", "12345", "10007-1234", " 10014 ", "zzzzz"],
        "CAST(10000 + 7 * (k % 25) AS STRING)",
    ),
    "State": (11, [None, "CA", "NY", "TX"], "'NV'"),
    "DurbinRegulated": (3, [None, "Y"], "'N'"),
}
# Every fixed value a feature looks for, so that all of them occur in the derived data.
FIXED_LISTS = {
    "Payment_CustomerName": V.NAME_TEST_LITERALS + V.NAME_TEST_WORDS,
    "Address1": tuple(f"1 {word} Rd, {state}" for word, state in zip(
        (*V.ADDRESS_TEST_WORDS, "plain"), V.ADDRESS_RISK_STATES)),
    "EmailAddress": tuple(f"jo.public@{d}" for d in V.EMAIL_FREE_DOMAINS + V.EMAIL_DISPOSABLE_DOMAINS)
    + tuple(f"{role}@corp.example.org" for role in V.EMAIL_ROLES + V.EMAIL_TEST_WORDS)
    + tuple(f"office@{word.lower()}.example.org" for word in V.EMAIL_COMPANY_WORDS),
    "RemoteIP": V.IP_TEST_ADDRESSES,
    "Cardnumber": V.CARD_TEST_NUMBERS
    + tuple(f"{start:0<16}" for start in V.CARD_BUSINESS_BINS + V.CARD_BUSINESS_PREFIXES),
    "PaymentSourceDesc": tuple(n for names in V.CHANNEL_GROUPS.values() for n in names)
    + V.CHANNEL_BUSINESS + V.CHANNEL_CONSUMER + V.CHANNEL_TEST_WORDS,
    "MCC_DESCRIPTION": V.MCC_HIGH_RISK + V.MCC_STANDARD + V.MCC_BUSINESS + V.MCC_GOVERNMENT
    + V.MCC_TEST_TEXTS,
    "Partner": V.PARTNER_ENTERPRISE + V.PARTNER_MID_TIER + V.PARTNER_CUSTOM + V.PARTNER_MUNICIPAL
    + V.PARTNER_INSURANCE + V.PARTNER_UTILITY + V.PARTNER_TEST + V.PARTNER_LEGACY + V.PARTNER_MODERN
    + V.PARTNER_BATCH + V.PARTNER_REAL_TIME,
    EBPP_COLUMN: V.EBPP_KNOWN + V.EBPP_TIER1 + V.EBPP_TIER2 + V.EBPP_TIER3 + V.EBPP_INHOUSE_TEXTS
    + V.EBPP_GOVERNMENT_TEXTS + V.EBPP_TEMPORARY_TEXTS,
    "Zip": V.ZIP_DEFAULTS,
}
# Rare values on fixed keys, the same at every scale.
RARE = {
    "PaymentSourceDesc": ((101, 102, 103), "Kiosk"),
    "MCC_DESCRIPTION": ((104, 105), "Rare Thing"),
    "Partner": ((106, 107), "Tiny Partner"),
}
SWITCH_POOLS = {
    "BillerPaysIX": 5,
    "InterchangePaidbyIC_Current": 7,
    "InterchangePaidbyIC_Monthly": 79,
    "IC Bank on TD": 83,
}


def sql_text(value: str | None) -> str:
    if value is None:
        return "NULL"
    parts = ["'" + part.replace("'", "''") + "'" for part in value.split("\t")]
    return " || chr(9) || ".join(parts)


def _pooled(column: str) -> str:
    modulus, pool, otherwise = TEXT_POOLS[column]
    listed = list(dict.fromkeys(FIXED_LISTS.get(column, ())))
    if listed:
        # About half of the keys past the pool; a modulus without common factors meets all keys alike.
        spread_over = 2 * len(listed) + 1
        while gcd(spread_over, modulus) > 1:
            spread_over += 2
        values = " ".join(f"WHEN {i} THEN {sql_text(v)}" for i, v in enumerate(listed))
        otherwise = f"CASE k % {spread_over} {values} ELSE {otherwise} END"
    cases = " ".join(f"WHEN {i} THEN {sql_text(v)}" for i, v in enumerate(pool))
    pooled = f"CASE k % {modulus} {cases} ELSE {otherwise} END"
    if column in RARE:
        keys, value = RARE[column]
        listed = ", ".join(map(str, keys))
        pooled = f"CASE WHEN k IN ({listed}) THEN {sql_text(value)} ELSE {pooled} END"
    return pooled


def payment_expressions() -> dict[str, str]:
    """SQL expression of every payment column over ``k`` (order), ``c`` (customer), ``d`` (day)."""
    columns = {
        ID: "'P' || CAST(k AS STRING)",
        "BillerID": "'B' || CAST(k % 97 AS STRING)",
        "TDNum": "'T' || CAST(k % 89 AS STRING)",
        "CustomerID": "CAST(c AS STRING)",
        **{column: _pooled(column) for column in TEXT_POOLS},
        "CALCULATIONTYPE": "'C' || CAST(k % 4 AS STRING)",
        "InterchangeQualCode": "'Q' || CAST(k % 6 AS STRING)",
        "BillingLatitude": (
            "CASE WHEN k % 59 = 0 THEN NULL WHEN k % 61 = 0 THEN CAST(0 AS DOUBLE)"
            " WHEN k % 67 = 0 THEN CAST(95 AS DOUBLE) ELSE CAST(k % 181 - 90 AS DOUBLE) END"
        ),
        "BillingLongitude": (
            "CASE WHEN k % 59 = 0 THEN NULL WHEN k % 61 = 0 THEN CAST(0 AS DOUBLE)"
            " WHEN k % 67 = 0 THEN CAST(10 AS DOUBLE) ELSE CAST(k % 361 - 180 AS DOUBLE) END"
        ),
        "PaymentAmount": (
            "CASE WHEN k % 71 = 0 THEN NULL ELSE CAST(k % 2003 AS DECIMAL(18, 2)) END"
        ),
        "PaymentDate": "CASE WHEN k % 73 = 0 THEN NULL ELSE d END",
        "SettledDate": "CASE WHEN k % 73 = 0 THEN NULL ELSE d END",
        **{
            column: f"CASE k % {m} WHEN 0 THEN NULL WHEN 1 THEN TRUE ELSE FALSE END"
            for column, m in SWITCH_POOLS.items()
        },
        **{
            column: f"CAST((k % 1000) * {i} AS DECIMAL(18, 6))"
            for i, column in enumerate(NUMERIC_COLUMNS, start=1)
        },
    }
    return columns


def ruca_expressions() -> dict[str, str]:
    """SQL expression of every lookup column over ``n`` (nation)."""
    return {
        "ZIP_CODE": (
            "CAST(10000 + 7 * n AS STRING) || CASE WHEN n % 5 = 0 THEN '-0001' ELSE '' END"
        ),
        "RUCA1": "CAST(n % 12 AS INT)",
        "RUCA2": "CAST(n % 12 AS DOUBLE) + CAST(0.5 AS DOUBLE)",
        "STATE": "CASE n % 3 WHEN 0 THEN NULL WHEN 1 THEN 'CA' ELSE 'NV' END",
    }


def payments(
    spark: SparkSession, sf_dir: str, duplicates: bool = False, null_ids: bool = False
) -> DataFrame:
    """One payment per order; ``duplicates`` adds a second copy of three ids with another partner,
    ``null_ids`` three payments without an id."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr(
        "o_orderkey AS k", "o_custkey AS c", "o_orderdate AS d"
    )
    columns = payment_expressions()
    df = spread(orders, "k").selectExpr([f"{e} AS `{c}`" for c, e in columns.items()])
    if duplicates:
        second = {**columns, "Partner": "'Second Partner'"}
        copies = orders.where("k IN (1, 2, 3)")
        df = df.unionByName(copies.selectExpr([f"{e} AS `{c}`" for c, e in second.items()]))
    if null_ids:
        without = {**columns, ID: "CAST(NULL AS STRING)"}
        more = orders.where("k IN (4, 5, 6)")
        df = df.unionByName(more.selectExpr([f"{e} AS `{c}`" for c, e in without.items()]))
    return df


def spread(df: DataFrame, key: str) -> DataFrame:
    """Spreads a scan that has fewer splits than the session has cores.

    A small test file is one split, and the feature expressions would run on one core.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, F.col(key)) if df.rdd.getNumPartitions() < cores else df


def ruca(spark: SparkSession, sf_dir: str, repeated: bool = False) -> DataFrame:
    """One lookup row per nation; ``repeated`` lists nation 2 twice."""
    nations = spark.read.parquet(f"{sf_dir}/nation.parquet").selectExpr("n_nationkey AS n")
    if repeated:
        nations = nations.unionByName(nations.where("n = 2"))
    return nations.selectExpr([f"{e} AS `{c}`" for c, e in ruca_expressions().items()])
