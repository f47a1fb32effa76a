"""Software partner: tier, industry, system hints, volume, partners per payment id.

The partner text is used as it is: NULL and blank differ here, and substrings are case-sensitive.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from payscope import fixed_values as V
from payscope.functions import rules as R
from payscope.functions.text import contains_any
from payscope.operators.family import Family, same_names
from payscope.operators.frequency import KeyStats
from payscope.sources.schema import ID

SOURCE = "Partner"

# NULL partners share the key '' and count nothing; all others get a leading '='.
VOLUME = KeyStats(
    "partner",
    key=lambda: F.coalesce(F.concat(F.lit("="), F.col(SOURCE)), F.lit("")),
    counted=lambda key: F.col(SOURCE).isNotNull(),
    columns=("__partner_partner_transaction_count",),
)
PER_ID = KeyStats(
    "payment_id",
    key=lambda: F.col(ID),
    measures=lambda key: {"__partner_distinct_partners_per_id": F.count_distinct(SOURCE)},
    columns=("__partner_distinct_partners_per_id",),
    spread=False,
)


def _layers(c, match, options):
    partner = F.col(SOURCE)

    def has(texts):
        return R.flag(contains_any(partner, texts))

    flags = {
        "partner_missing": R.flag(partner.isNull() | (F.trim(partner) == "")),
        "partner_name_too_short": R.flag(F.length(partner) < 3),
        "is_test_partner": has(V.PARTNER_TEST),
        "legacy_system": has(V.PARTNER_LEGACY),
        "modern_system": has(V.PARTNER_MODERN),
        "batch_system": has(V.PARTNER_BATCH),
        "real_time_system": has(V.PARTNER_REAL_TIME),
        "is_enterprise_partner": has(V.PARTNER_ENTERPRISE),
        "is_mid_tier_partner": has(V.PARTNER_MID_TIER),
        "is_custom_solution": has(V.PARTNER_CUSTOM),
        "partner_industry": R.first_match(
            [
                (contains_any(partner, V.PARTNER_MUNICIPAL), "Municipal"),
                (contains_any(partner, V.PARTNER_INSURANCE), "Insurance"),
                (contains_any(partner, V.PARTNER_UTILITY), "Utility"),
            ],
            "Other",
        ),
        "low_volume_partner": R.flag(c.partner_transaction_count < 10),
        "multiple_partners_same_id": R.flag(c.distinct_partners_per_id > 1),
    }
    tiers = [
        (R.on(c.is_enterprise_partner), "Enterprise", 2),
        (R.on(c.is_mid_tier_partner), "Mid-tier", 5),
        (R.on(c.is_custom_solution), "Custom", 8),
    ]
    score = {
        "partner_category": R.first_match([(t, label) for t, label, _ in tiers], "Other"),
        "partner_risk_score": R.first_match([(t, base) for t, _, base in tiers], 6)
        + R.weighted_score(
            [
                (R.on(c.partner_missing), 10),
                (R.on(c.partner_name_too_short), 5),
                # Two of the four test words only.
                (contains_any(partner, V.PARTNER_TEST_SCORED), 10),
                (R.on(c.legacy_system), 4),
                (R.on(c.modern_system), -2),
                (R.on(c.low_volume_partner), 3),
                (R.on(c.multiple_partners_same_id), 6),
            ]
        ),
    }
    return [{}, {}, flags, {}, score]


_FEATURES = (
    "partner_category", "partner_industry", "partner_missing", "partner_name_too_short",
    "is_test_partner", "legacy_system", "modern_system", "batch_system", "real_time_system",
    "is_enterprise_partner", "is_mid_tier_partner", "is_custom_solution",
    "partner_transaction_count", "low_volume_partner", "distinct_partners_per_id",
    "multiple_partners_same_id", "partner_risk_score",
)

PARTNER = Family(
    name="partner",
    inputs=(ID, SOURCE),
    layers=_layers,
    stats=(VOLUME, PER_ID),
    outputs=same_names(ID, SOURCE, *_FEATURES),
    final_outputs=same_names(SOURCE, *(f for f in _FEATURES if f != "batch_system")),
    score="partner_risk_score",
)
