"""Email address: format, provider, user name, reuse."""

from __future__ import annotations

from pyspark.sql import functions as F

from payscope import fixed_values as V
from payscope.functions import rules as R
from payscope.functions import text as X
from payscope.operators.family import Family, same_names
from payscope.operators.frequency import KeyStats, unless_blank
from payscope.sources.schema import ID

SOURCE = "EmailAddress"


def _norm():
    return F.lower(X.coalesce_trim(F.col(SOURCE)))


STATS = KeyStats(
    "email",
    key=_norm,
    counted=unless_blank,
    columns=("__email_email_frequency",),
)


def _layers(c, match, options):
    text = {"email_clean": _norm()}
    parts = {
        "username": F.split_part(c.email_clean, F.lit("@"), F.lit(1)),
        "domain": F.split_part(c.email_clean, F.lit("@"), F.lit(2)),
    }
    flags = {
        "missing_email": R.flag(c.email_clean == ""),
        "is_valid_format": R.flag(match.regex(c.email_clean, V.EMAIL_FORMAT_PATTERN)),
        # Upper-case words on a lower-case domain: never set, kept because the definition says so.
        "is_business_domain": R.flag(match.any_word(c.domain, V.EMAIL_COMPANY_WORDS)),
        "is_gmail": R.flag(c.domain.endswith("gmail.com")),
        "is_yahoo": R.flag(c.domain.endswith("yahoo.com")),
        "is_hotmail": R.flag(c.domain.endswith("hotmail.com")),
        "is_outlook": R.flag(c.domain.endswith("outlook.com")),
        "is_free_email": R.flag(match.any_run(c.domain, V.EMAIL_FREE_DOMAINS)),
        "is_disposable_email": R.flag(match.any_run(c.domain, V.EMAIL_DISPOSABLE_DOMAINS)),
        "username_length": F.length(c.username),
        "missing_username": R.flag(c.username == ""),
        "short_username": R.flag(F.length(c.username) < 6),
        "long_username": R.flag(F.length(c.username) > 30),
        "username_has_numbers": R.flag(match.regex(c.username, "[0-9]")),
        "username_only_numbers": R.flag(match.regex(c.username, r"^[0-9]+\z")),
        "has_test_keyword": R.flag(match.any_word(c.email_clean, V.EMAIL_TEST_WORDS)),
        "has_sequential_pattern": R.flag(match.any_run(c.username, V.EMAIL_RUNS)),
        "username_has_special_chars": R.flag(match.regex(c.username, V.EMAIL_USER_SPECIAL_PATTERN)),
        "is_role_account": R.flag(c.username.isin(*V.EMAIL_ROLES)),
        "reused_email": R.flag(c.email_frequency > 5),
    }
    derived = {
        "has_numbers_not_business": R.flag(
            R.on(c.username_has_numbers) & ~R.on(c.is_business_domain)
        ),
    }
    score = {
        "email_risk_score": R.weighted_score(
            [
                (R.on(c.missing_email), 10),
                (~R.on(c.is_valid_format) & ~R.on(c.missing_email), 8),
                (R.on(c.is_disposable_email), 9),
                (R.on(c.short_username), 3),
                (R.on(c.username_only_numbers), 4),
                (R.on(c.has_test_keyword), 7),
                (R.on(c.has_sequential_pattern), 4),
                (R.on(c.is_role_account), 5),
                (R.on(c.reused_email), 6),
                (R.on(c.has_numbers_not_business), 3),
                (R.on(c.username_has_special_chars), 2),
            ]
        )
    }
    category = {"email_risk_category": R.risk_bucket(c.email_risk_score)}
    return [text, parts, flags, derived, score, category]


_FEATURES = (
    "email_clean", "missing_email", "is_valid_format", "username", "domain", "is_business_domain",
    "is_gmail", "is_yahoo", "is_hotmail", "is_outlook", "is_free_email", "is_disposable_email",
    "username_length", "missing_username", "short_username", "long_username",
    "username_has_numbers", "username_only_numbers", "has_test_keyword", "has_sequential_pattern",
    "username_has_special_chars", "is_role_account", "has_numbers_not_business",
    "email_frequency", "reused_email", "email_risk_score", "email_risk_category",
)
_RENAMED = {"has_numbers_not_business": "email_has_numbers_not_business"}

EMAIL = Family(
    name="email",
    inputs=(ID, SOURCE),
    layers=_layers,
    stats=(STATS,),
    outputs=same_names(ID, SOURCE, *_FEATURES),
    final_outputs={_RENAMED.get(f, f): f for f in (SOURCE, *_FEATURES)},
    score="email_risk_score",
)
