"""Street address: shape, PO boxes, test and placeholder texts, risk states, repeats."""

from __future__ import annotations

from pyspark.sql import functions as F

from payscope import fixed_values as V
from payscope.functions import rules as R
from payscope.functions import text as X
from payscope.operators.family import Family, same_names
from payscope.operators.frequency import KeyStats, unless_blank
from payscope.sources.schema import ID

SOURCE = "Address1"


def _norm():
    return X.collapse_ws(X.coalesce_trim(F.col(SOURCE)))


STATS = KeyStats(
    "address",
    key=lambda: F.upper(_norm()),
    counted=unless_blank,
    columns=("__address_address_frequency",),
)


def _layers(c, match, options):
    text = {"norm": _norm()}
    forms = {
        "upper": F.upper(c.norm),
        "lower": F.lower(c.norm),
        "address_length": F.length(c.norm),
        "address_word_count": X.word_count(c.norm),
    }
    flags = {
        "missing_address": R.flag(c.norm == ""),
        "address_too_short": R.flag((c.norm != "") & (c.address_length < 10)),
        "address_too_long": R.flag(c.address_length > 150),
        "too_few_words": R.flag(c.address_word_count < 3),
        "is_po_box": R.flag(match.regex(c.upper, V.ADDRESS_PO_BOX_PATTERN, ["BOX"])),
        "has_test_address_keyword": R.flag(match.any_word(c.lower, V.ADDRESS_TEST_WORDS)),
        "is_generic_address": R.flag(match.regex(c.norm, V.ADDRESS_GENERIC_PATTERN, ["MAIN ST"])),
        "has_invalid_chars": R.flag(match.regex(c.norm, V.ADDRESS_INVALID_PATTERN)),
        "all_caps": R.flag(match.cased_like(c.norm, c.upper)),
        "has_high_risk_state": R.flag(match.any_word(c.upper, V.ADDRESS_RISK_STATES)),
        "potential_virtual_office": R.flag(
            match.regex(
                c.lower, V.ADDRESS_VIRTUAL_OFFICE_PATTERN, V.ADDRESS_VIRTUAL_OFFICE_NEEDS
            )
        ),
        "numbers_only": R.flag(match.regex(c.norm, r"^\d+\z")),
        "has_zip_format": R.flag(match.regex(c.norm, V.ADDRESS_ZIP_PATTERN)),
        "has_keyboard_pattern": R.flag(match.any_word(c.lower, V.KEYBOARD_RUNS)),
        "has_numbers_not_business": R.flag(
            match.regex(c.norm, "[0-9]")
            & ~match.regex(c.upper, V.ADDRESS_COMPANY_PATTERN, V.ADDRESS_COMPANY_NEEDS)
        ),
        "high_frequency_address": R.flag(c.address_frequency > 10),
    }
    score = {
        "address_risk_score": R.weighted_score(
            [
                (R.on(c.missing_address), 8),
                (R.on(c.address_too_short), 4),
                (R.on(c.address_too_long), 1),
                (R.on(c.too_few_words), 3),
                (R.on(c.is_po_box), 3),
                (R.on(c.has_test_address_keyword), 8),
                (R.on(c.is_generic_address), 5),
                (R.on(c.has_invalid_chars), 3),
                (R.on(c.all_caps), 1),
                (R.on(c.has_high_risk_state), 2),
                (R.on(c.potential_virtual_office), 4),
                (R.on(c.numbers_only), 6),
                (R.on(c.has_keyboard_pattern), 7),
                (~R.on(c.has_zip_format), 2),
                (R.on(c.has_numbers_not_business), 3),
                (R.on(c.high_frequency_address), 4),
            ]
        )
    }
    category = {"address_risk_category": R.risk_bucket(c.address_risk_score)}
    return [text, forms, flags, {}, score, category]


_FEATURES = (
    "address_length", "missing_address", "address_too_short", "address_too_long",
    "address_word_count", "too_few_words", "is_po_box", "has_test_address_keyword",
    "is_generic_address", "has_invalid_chars", "all_caps", "has_high_risk_state",
    "potential_virtual_office", "numbers_only", "has_zip_format", "has_keyboard_pattern",
    "has_numbers_not_business", "address_frequency", "high_frequency_address",
    "address_risk_score", "address_risk_category",
)
_RENAMED = {
    "has_keyboard_pattern": "Address_has_keyboard_pattern",
    "has_numbers_not_business": "Address_has_numbers_not_business",
}

ADDRESS = Family(
    name="address",
    inputs=(ID, SOURCE),
    layers=_layers,
    stats=(STATS,),
    outputs=same_names(ID, SOURCE, *_FEATURES),
    final_outputs={_RENAMED.get(f, f): f for f in (SOURCE, *_FEATURES)},
    score="address_risk_score",
)
