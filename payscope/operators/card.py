"""Card number: network, length, test numbers, digit patterns, repeats."""

from __future__ import annotations

from pyspark.sql import functions as F

from payscope import fixed_values as V
from payscope.functions import rules as R
from payscope.functions import text as X
from payscope.operators.family import Family, same_names
from payscope.operators.frequency import KeyStats
from payscope.sources.schema import ID

SOURCE = "Cardnumber"


def _clean():
    return X.coalesce_trim(F.col(SOURCE))


# Texts without digits ("N/A") count under the empty key, where missing cards find them.
STATS = KeyStats(
    "card",
    key=lambda: X.strip_nondigit(_clean()),
    counted=lambda key: _clean() != "",
    columns=("__card_card_frequency",),
)


def _network(c):
    def starts(n, values):
        return F.left(c.digits, F.lit(n)).isin(*values)

    return R.first_match(
        [
            (c.digits.startswith("4"), "Visa"),
            (
                starts(2, ("51", "52", "53", "54", "55"))
                | c.bin_number.between("222100", "272099"),
                "Mastercard",
            ),
            (starts(2, ("34", "37")), "American Express"),
            (
                starts(2, ("36", "38", "39"))
                | starts(3, ("300", "301", "302", "303", "304", "305")),
                "Diners Club",
            ),
            (
                c.digits.startswith("6011")
                | c.digits.startswith("65")
                | F.left(c.digits, F.lit(3)).between("644", "649"),
                "Discover",
            ),
            (c.digits.startswith("35"), "JCB"),
        ],
        "Unknown",
    )


def _layers(c, match, options):
    text = {"clean": _clean()}
    digits = {"digits": X.strip_nondigit(c.clean)}
    parts = {
        "missing_card": R.flag(c.clean == ""),
        "card_digits_length": F.length(c.digits),
        "is_numeric_only": R.flag(c.digits != ""),
        "bin_number": F.left(c.digits, F.lit(6)),
        "masked_card_number": F.when(
            F.length(c.digits) > 4, X.mask_all_but_last(c.digits, 4)
        ).otherwise(c.clean),
        "is_test_card": R.flag(c.digits.isin(*V.CARD_TEST_NUMBERS)),
        "has_repeated_digits": R.flag(match.any_run(c.digits, V.CARD_REPEATED_RUNS)),
        "has_sequential_digits": R.flag(match.any_run(c.digits, V.CARD_SEQUENTIAL_RUNS)),
        # Letters looked for among digits: never set, kept because the definition says so.
        "has_keyboard_pattern": R.flag(match.any_run(c.digits, V.CARD_KEYBOARD_RUNS)),
        "single_digit_card": R.flag(c.digits.rlike(V.CARD_ONE_DIGIT_PATTERN)),
        "multiple_transactions_same_card": R.flag(c.card_frequency > 1),
    }
    network = {
        "card_network": _network(c),
        "is_business_card": R.flag(
            c.bin_number.isin(*V.CARD_BUSINESS_BINS)
            | F.left(c.digits, F.lit(4)).isin(*V.CARD_BUSINESS_PREFIXES)
        ),
    }
    business = R.on(c.is_business_card)
    patterned = R.on(c.has_repeated_digits) | R.on(c.has_sequential_digits)
    checks = {
        "invalid_length_for_network": R.first_match(
            [
                (c.card_network == name, R.flag(~c.card_digits_length.isin(*lengths)))
                for name, lengths in V.CARD_LENGTHS.items()
            ],
            0,
        ),
        "has_patterns_not_business": R.flag(patterned & ~business),
        **R.one_hot(c.card_network, V.CARD_ONE_HOT),
    }
    score = {
        "card_risk_score": R.weighted_score(
            [
                (R.on(c.has_repeated_digits), R.lighter_if(business, 1, 8)),
                (R.on(c.has_sequential_digits), R.lighter_if(business, 1, 8)),
                (R.on(c.missing_card), 10),
                (~R.on(c.is_numeric_only) & ~R.on(c.missing_card), 10),
                (R.on(c.invalid_length_for_network), 9),
                (R.on(c.is_test_card), 10),
                (R.on(c.single_digit_card), 10),
                (R.on(c.has_patterns_not_business), 3),
                (R.on(c.has_keyboard_pattern), 8),
                (c.card_network == "Unknown", 7),
                (c.card_frequency > 10, 6),
            ]
        ),
        "card_type": R.first_match(
            [
                (
                    R.on(c.missing_card)
                    | ~R.on(c.is_numeric_only)
                    | R.on(c.invalid_length_for_network)
                    | R.on(c.single_digit_card),
                    "Type 1",
                ),
                (R.on(c.is_test_card) | R.on(c.has_patterns_not_business), "Type 2"),
                (patterned & business, "Type 3"),
            ],
            "Type 4",
        ),
    }
    category = {"card_risk_category": R.risk_bucket(c.card_risk_score)}
    return [text, digits, parts, network, checks, score, category]


_SHAPE = (
    "masked_card_number", "missing_card", "card_digits_length", "is_numeric_only", "card_network",
    "bin_number", "is_business_card", "is_test_card", "has_repeated_digits",
    "has_sequential_digits", "has_keyboard_pattern", "invalid_length_for_network",
    "has_patterns_not_business", "single_digit_card", "card_frequency",
    "multiple_transactions_same_card", "card_risk_score", "card_risk_category",
)
_RENAMED = {
    "has_keyboard_pattern": "CreditCard_has_keyboard_pattern",
    "has_patterns_not_business": "CreditCard_has_patterns_not_business",
}
FULL_NUMBER = "full_card_number"

CARD = Family(
    name="card",
    inputs=(ID, SOURCE),
    layers=_layers,
    stats=(STATS,),
    outputs={ID: ID, FULL_NUMBER: SOURCE, **same_names(*_SHAPE, "card_type")},
    final_outputs={
        FULL_NUMBER: SOURCE,
        **{_RENAMED.get(f, f): f for f in (*_SHAPE, *V.CARD_ONE_HOT, "card_type")},
    },
    score="card_risk_score",
)
