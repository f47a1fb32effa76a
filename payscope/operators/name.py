"""Payer name: shape, test names, company forms, repeats."""

from __future__ import annotations

from pyspark.sql import functions as F

from payscope import fixed_values as V
from payscope.functions import rules as R
from payscope.functions import text as X
from payscope.operators.family import Family, same_names
from payscope.operators.frequency import KeyStats
from payscope.sources.schema import ID

SOURCE = "Payment_CustomerName"


def _norm():
    return X.collapse_ws(X.coalesce_trim(F.col(SOURCE)))


# Blank names are counted too.
STATS = KeyStats(
    "name",
    key=lambda: F.upper(_norm()),
    counted=lambda key: F.lit(True),
    columns=("__name_name_frequency",),
)


def _layers(c, match, options):
    text = {"norm": _norm()}
    forms = {
        "upper": F.upper(c.norm),
        "lower": F.lower(c.norm),
        "first_name": X.first_word(c.norm),
        "last_name": X.last_word(c.norm),
        "name_length": F.length(c.norm),
        "name_word_count": X.word_count(c.norm),
    }
    flags = {
        "name_too_short": R.flag((c.norm != "") & (c.name_length < 4)),
        "name_too_long": R.flag(c.name_length > 50),
        "single_word_name": R.flag(c.name_word_count == 1),
        "is_all_caps": R.flag(match.cased_like(c.norm, c.upper)),
        "is_all_lowercase": R.flag(match.cased_like(c.norm, c.lower)),
        "is_business_entity": R.flag(match.regex(c.upper, V.NAME_COMPANY_PATTERN, V.NAME_COMPANY_NEEDS)),
        "is_test_name": R.flag(c.lower.isin(*V.NAME_TEST_LITERALS)),
        "contains_test_keyword": R.flag(match.any_word(c.lower, V.NAME_TEST_WORDS)),
        "has_special_chars": R.flag(match.regex(c.norm, V.NAME_SPECIAL_PATTERN)),
        "has_numbers": R.flag(match.regex(c.norm, "[0-9]")),
        "has_keyboard_pattern": R.flag(match.any_run(c.lower, V.KEYBOARD_RUNS)),
        "first_last_name_same": R.flag(c.first_name == c.last_name),
        "single_letter_first": R.flag(F.length(c.first_name) == 1),
        "single_letter_last": R.flag(F.length(c.last_name) == 1),
        "multiple_transactions_same_name": R.flag(c.name_frequency > 1),
    }
    company = R.on(c.is_business_entity)
    derived = {
        "has_numbers_not_business": R.flag(~company & R.on(c.has_numbers)),
        "potential_shell": R.flag(company & (c.name_word_count <= 2)),
    }
    score = {
        "name_risk_score": R.weighted_score(
            [
                (R.on(c.name_too_short), R.lighter_if(company, 1, 3)),
                (R.on(c.single_word_name), R.lighter_if(company, 1, 4)),
                (R.on(c.potential_shell), 7),
                (R.on(c.name_too_long), 1),
                (R.on(c.is_all_caps), 2),
                (R.on(c.is_test_name), 10),
                (R.on(c.contains_test_keyword), 7),
                (R.on(c.has_special_chars), 2),
                (R.on(c.has_numbers_not_business), 3),
                (R.on(c.has_keyboard_pattern), 8),
                (R.on(c.first_last_name_same), 4),
                (R.on(c.single_letter_first), 3),
                (R.on(c.single_letter_last), 3),
            ]
        )
    }
    return [text, forms, flags, derived, score, {"name_risk_category": R.risk_bucket(c.name_risk_score)}]


_FEATURES = (
    "name_length", "name_too_short", "name_too_long", "name_word_count", "single_word_name",
    "is_all_caps", "is_all_lowercase", "is_business_entity", "is_test_name",
    "contains_test_keyword", "has_special_chars", "has_numbers", "first_name", "last_name",
    "name_frequency", "multiple_transactions_same_name", "has_numbers_not_business",
    "has_keyboard_pattern", "potential_shell", "first_last_name_same", "single_letter_first",
    "single_letter_last", "name_risk_score", "name_risk_category",
)
_RENAMED = {
    "is_all_caps": "Name_is_all_caps",
    "has_special_chars": "Name_has_special_chars",
    "has_keyboard_pattern": "Name_has_keyboard_pattern",
}

NAME = Family(
    name="name",
    inputs=(ID, SOURCE),
    layers=_layers,
    stats=(STATS,),
    outputs=same_names(ID, SOURCE, *_FEATURES),
    final_outputs={_RENAMED.get(f, f): f for f in (SOURCE, *_FEATURES)},
    score="name_risk_score",
)
