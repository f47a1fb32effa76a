"""Merchant category: risk lists, unusual and test texts, rarity."""

from __future__ import annotations

from pyspark.sql import functions as F

from payscope import fixed_values as V
from payscope.functions import rules as R
from payscope.functions import text as X
from payscope.operators.family import Family, same_names
from payscope.operators.frequency import KeyStats, unless_blank
from payscope.sources.schema import ID

SOURCE = "MCC_DESCRIPTION"
CUSTOMER = "CustomerID"
AMOUNT = "PaymentAmount"


def _clean():
    return X.coalesce_trim(F.col(SOURCE))


def _measures(key):
    # In the input's own decimal type: the reader refuses amounts of other types.
    no_amount = F.lit(0).cast("decimal(18,2)")
    amount = F.coalesce(F.col(AMOUNT), no_amount)
    return {
        "__mcc_mcc_frequency": F.count(F.when(unless_blank(key), 1)),
        "__mcc_distinct_customers": F.count_distinct(F.when(key != "", F.col(CUSTOMER))),
        "__mcc_total_amount": F.sum(F.when(key != "", amount).otherwise(no_amount)),
    }


STATS = KeyStats(
    "mcc",
    key=lambda: F.upper(_clean()),
    measures=_measures,
    columns=("__mcc_mcc_frequency", "__mcc_distinct_customers", "__mcc_total_amount"),
)


def _flag_layers(c, match):
    """The part of the family that needs no statistics."""
    text = {"mcc_clean": _clean()}
    forms = {
        "mcc_normalized": F.upper(c.mcc_clean),
        "mcc_length": F.length(c.mcc_clean),
        "missing_mcc": R.flag(c.mcc_clean == ""),
    }
    flags = {
        "is_high_risk_mcc": R.flag(c.mcc_normalized.isin(*V.MCC_HIGH_RISK)),
        "is_standard_mcc": R.flag(c.mcc_normalized.isin(*V.MCC_STANDARD)),
        "is_business_related_mcc": R.flag(c.mcc_normalized.isin(*V.MCC_BUSINESS)),
        "is_government_related": R.flag(c.mcc_normalized.isin(*V.MCC_GOVERNMENT)),
        "is_nec_category": R.flag(X.contains_any(c.mcc_normalized, V.MCC_NEC_TEXTS)),
        "is_all_caps": R.flag((c.mcc_clean == c.mcc_normalized) & (c.mcc_clean != "")),
        "has_special_chars": R.flag(match.regex(c.mcc_clean, V.MCC_SPECIAL_PATTERN)),
        "mcc_too_short": R.flag((c.mcc_length < 10) & ~R.on(c.missing_mcc)),
        "mcc_too_long": R.flag(c.mcc_length > 100),
        "is_test_mcc": R.flag(match.any_run(c.mcc_normalized, V.MCC_TEST_TEXTS)),
    }
    derived = {
        "is_unusual_mcc": R.flag(~R.on(c.is_standard_mcc) & ~R.on(c.missing_mcc)),
        "has_numbers_not_business": R.flag(
            match.regex(c.mcc_clean, "[0-9]") & ~R.on(c.is_business_related_mcc)
        ),
    }
    return [text, forms, flags, derived]


def _layers(c, match, options):
    business = R.on(c.is_business_related_mcc)
    risky = R.on(c.is_high_risk_mcc) | R.on(c.is_government_related)
    score = {
        "is_rare_mcc": R.flag(c.mcc_frequency < 5),
        "mcc_risk_score": R.weighted_score(
            [
                (R.on(c.has_numbers_not_business), R.lighter_if(business, 1, 3)),
                (R.on(c.has_special_chars), R.lighter_if(business, 1, 2)),
                (R.on(c.is_high_risk_mcc), 4),
                (R.on(c.is_government_related), 3),
                (R.on(c.missing_mcc), 10),
                (R.on(c.mcc_too_short), 3),
                (R.on(c.mcc_too_long), 1),
                (R.on(c.is_all_caps), 2),
                (R.on(c.is_test_mcc), 10),
                (R.on(c.is_unusual_mcc), 3),
                (R.on(c.is_nec_category), 2),
                (c.mcc_frequency < 5, 6),
                ((c.distinct_customers < 3) & (c.mcc_frequency > 0), 4),
            ]
        ),
        # Type 3 cannot occur: every risky value is also an unusual one.
        "mcc_type": R.first_match(
            [
                (
                    R.on(c.missing_mcc) | R.on(c.is_test_mcc) | R.on(c.mcc_too_short),
                    "Type 1",
                ),
                (
                    risky
                    & (
                        R.on(c.has_numbers_not_business)
                        | R.on(c.has_special_chars)
                        | R.on(c.is_unusual_mcc)
                    ),
                    "Type 2",
                ),
                (risky, "Type 3"),
            ],
            "Type 4",
        ),
    }
    category = {"mcc_risk_category": R.risk_bucket(c.mcc_risk_score)}
    return [*_flag_layers(c, match), score, category]


MCC = Family(
    name="mcc",
    inputs=(ID, SOURCE, CUSTOMER, AMOUNT),
    layers=_layers,
    stats=(STATS,),
    outputs={
        ID: ID,
        "raw_mcc": SOURCE,
        **same_names(
            "mcc_clean", "missing_mcc", "is_high_risk_mcc", "is_business_related_mcc",
            "is_government_related", "is_nec_category", "is_unusual_mcc",
            "has_numbers_not_business", "has_special_chars", "mcc_too_short", "is_test_mcc",
            "mcc_frequency", "distinct_customers", "total_amount", "is_rare_mcc",
            "mcc_risk_score", "mcc_risk_category", "mcc_type",
        ),
    },
    final_outputs={},
    score="mcc_risk_score",
)

# The combined table holds the flags of this family only, so it needs no statistics there.
MCC_FLAGS = Family(
    name="mcc",
    inputs=(ID, SOURCE),
    layers=lambda c, match, options: _flag_layers(c, match),
    outputs={},
    final_outputs={
        "raw_mcc": SOURCE,
        **same_names(
            "mcc_clean", "missing_mcc", "mcc_length", "mcc_normalized", "is_high_risk_mcc",
            "is_standard_mcc", "is_business_related_mcc", "is_government_related",
            "is_nec_category", "is_unusual_mcc", "is_all_caps",
        ),
        "MCC_has_numbers_not_business": "has_numbers_not_business",
        **same_names("has_special_chars", "mcc_too_short", "mcc_too_long", "is_test_mcc"),
    },
)
