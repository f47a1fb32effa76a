"""Billing location: rurality of the ZIP, coordinates, state mismatch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payscope import fixed_values as V
from payscope.functions import rules as R
from payscope.functions import text as X
from payscope.operators.family import Family
from payscope.sources.schema import ID

LOOKUP = {
    "ruca_zip_5digit": "__geo_ruca_zip_5digit",
    "ZIP_CODE": "__geo_original_ruca_zip",
    "RUCA1": "__geo_RUCA1",
    "RUCA2": "__geo_RUCA2",
    "STATE": "__geo_zip_state",
}


def join_lookup(payments: DataFrame, ruca: DataFrame, dedupe: bool = False) -> DataFrame:
    """Adds the lookup columns of each payment's five-character ZIP.

    A ZIP that the lookup repeats repeats the payment, unless ``dedupe`` keeps the first entry per
    ZIP. The lookup is one row per ZIP code; Spark broadcasts it if its size allows and otherwise
    shuffles both sides, where the adaptive skew join splits a busy ZIP.
    """
    lookup = ruca.withColumn("ruca_zip_5digit", X.zip5(F.col("ZIP_CODE"))).where(
        F.col("ruca_zip_5digit") != ""
    )
    if dedupe:
        others = [c for c in LOOKUP if c != "ruca_zip_5digit"]
        first = F.min(F.struct(*others)).alias("first")
        lookup = lookup.groupBy("ruca_zip_5digit").agg(first).select("ruca_zip_5digit", "first.*")
    lookup = lookup.select([F.col(c).alias(name) for c, name in LOOKUP.items()])
    lookup = lookup.withColumn("__geo_side", F.lit(0).cast("long"))
    located = payments.withColumn("__geo_zip_5digit", X.zip5(F.col("Zip")))
    # Payments whose ZIP can match nothing enter the join under spread-out sides.
    can_match = F.col("__geo_zip_5digit") != ""
    side = F.when(can_match, F.lit(0).cast("long")).otherwise(
        F.xxhash64(*[f"`{c}`" for c in payments.columns]).bitwiseOR(F.lit(1).cast("long"))
    )
    on = (F.col("__geo_zip_5digit") == F.col("__geo_ruca_zip_5digit")) & (
        F.col("__geo_payment_side") == F.col("__geo_side")
    )
    return (
        located.withColumn("__geo_payment_side", side).join(lookup, on, "left")
        .drop("__geo_side", "__geo_payment_side")
    )


def _layers(c, match, options):
    lat, lon, zip_text = F.col("BillingLatitude"), F.col("BillingLongitude"), F.col("Zip")
    bands = [(c.RUCA1.between(low, high), label, s) for low, high, label, s in V.RURALITY_BANDS]
    unknown, unknown_score = V.RURALITY_UNKNOWN
    (core, _, _), (commuting, _, _), (micro, _, _), (town, _, _), (rural, _, _) = bands
    mismatch = F.col("State") != c.zip_state
    high_value_rural = rural & (F.col("PaymentAmount") > 1000)
    near_zero = lat.between(-0.001, 0.001) & lon.between(-0.001, 0.001)
    flags = {
        "area_type": R.first_match([(b, label) for b, label, _ in bands], unknown),
        "is_metropolitan_core": R.flag(core),
        "is_metro_commuting": R.flag(commuting),
        "is_micropolitan": R.flag(micro),
        "is_small_town": R.flag(town),
        "is_rural": R.flag(rural),
        "high_value_rural_transaction": R.flag(high_value_rural),
        "state_zip_mismatch": R.flag(mismatch),
        "geo_risk_score": R.first_match([(b, s) for b, _, s in bands], unknown_score)
        + R.weighted_score(
            [
                (lat.isNull() | lon.isNull(), 8),
                (zip_text.isNull() | (F.trim(zip_text) == ""), 7),
                ((lat < -90) | (lat > 90) | (lon < -180) | (lon > 180), 9),
                (near_zero, 10),
                (zip_text.isin(*V.ZIP_DEFAULTS), 7),
                (high_value_rural, 5),
                (mismatch, 6),
            ]
        ),
    }
    return [{}, {}, flags]


_OUTPUTS = {
    "original_zip": "Zip",
    "zip_5digit": "zip_5digit",
    "ruca_zip_5digit": "ruca_zip_5digit",
    "BillingLatitude": "BillingLatitude",
    "BillingLongitude": "BillingLongitude",
    "transaction_state": "State",
    "original_ruca_zip": "original_ruca_zip",
    "RUCA1": "RUCA1",
    "RUCA2": "RUCA2",
    "zip_state": "zip_state",
    **{
        name: name
        for name in (
            "area_type", "is_metropolitan_core", "is_metro_commuting", "is_micropolitan",
            "is_small_town", "is_rural", "high_value_rural_transaction", "state_zip_mismatch",
            "geo_risk_score",
        )
    },
}

GEO = Family(
    name="geo",
    inputs=(ID, "Zip", "State", "BillingLatitude", "BillingLongitude", "PaymentAmount"),
    layers=_layers,
    outputs={ID: ID, **_OUTPUTS},
    final_outputs=_OUTPUTS,
    score="geo_risk_score",
)
