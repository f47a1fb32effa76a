"""Payment channel: group, standard names, test names, rarity, outliers inside the group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payscope import fixed_values as V
from payscope.functions import rules as R
from payscope.functions import text as X
from payscope.operators.family import Family, same_names
from payscope.operators.frequency import ROWS, KeyStats
from payscope.sources.schema import ID

SOURCE = "PaymentSourceDesc"
CUSTOMER = "CustomerID"
STANDARD = tuple(name for names in V.CHANNEL_GROUPS.values() for name in names)
NO_DIGIT_RISK_GROUPS = ("API & Cloud Integrations", "Agent Assisted")


def _clean():
    return X.coalesce_trim(F.col(SOURCE))


def payment_group(channel_upper):
    return R.first_match(
        [(channel_upper.isin(*names), group) for group, names in V.CHANNEL_GROUPS.items()],
        V.CHANNEL_GROUP_OTHER,
    )


def channel_stats(rows: DataFrame, stats: KeyStats) -> DataFrame:
    """Row and customer counts of every channel and of the group it belongs to.

    Rows are first combined per channel and customer; both levels are counted from that, so the
    payments are read and shuffled once. The group side has one row per group, eight at most. The
    blank channel counts nothing, but its rows still see the counts of group ``Other``.
    """
    channel = F.col(stats.key_column)
    pairs = (
        rows.withColumn(stats.key_column, stats.key())
        .groupBy(stats.key_column, CUSTOMER)
        .agg(F.count(F.lit(1)).alias(ROWS))
    )
    customer = F.when(channel != "", F.col(CUSTOMER))
    counted = F.when(channel != "", F.col(ROWS)).otherwise(F.lit(0).cast("long"))
    by_channel = pairs.groupBy(stats.key_column).agg(
        F.sum(ROWS).alias(ROWS),
        F.sum(counted).alias("__channel_channel_frequency"),
        F.count(customer).alias("__channel_distinct_customers"),
    )
    by_group = (
        pairs.select(
            payment_group(channel).alias("__group"), customer.alias("__customer"),
            counted.alias("__counted"),
        )
        .groupBy("__group", "__customer")
        .agg(F.sum("__counted").alias("__counted"))
        .groupBy("__group")
        .agg(
            F.sum("__counted").alias("__channel_group_frequency"),
            F.count("__customer").alias("__channel_group_distinct_customers"),
        )
    )
    return (
        by_channel.withColumn("__group", payment_group(channel))
        .join(F.broadcast(by_group), "__group")
        .drop("__group")
    )


STATS = KeyStats(
    "channel",
    key=lambda: F.upper(_clean()),
    build=channel_stats,
    columns=(
        "__channel_channel_frequency",
        "__channel_distinct_customers",
        "__channel_group_frequency",
        "__channel_group_distinct_customers",
    ),
)


def _layers(c, match, options):
    text = {"channel_clean": _clean()}
    forms = {
        "upper": F.upper(c.channel_clean),
        "missing_channel": R.flag(c.channel_clean == ""),
        "has_digit": match.regex(c.channel_clean, "[0-9]"),
    }
    flags = {
        "payment_group": payment_group(c.upper),
        "is_business_channel": R.flag(c.upper.isin(*V.CHANNEL_BUSINESS)),
        "is_consumer_channel": R.flag(c.upper.isin(*V.CHANNEL_CONSUMER)),
        "is_standard_channel": R.flag(c.upper.isin(*STANDARD)),
        "is_test_channel": R.flag(match.any_word(c.upper, V.CHANNEL_TEST_WORDS)),
        "has_special_chars": R.flag(match.regex(c.channel_clean, V.CHANNEL_SPECIAL_PATTERN)),
        # No letter is needed here: '123' counts as all caps.
        "is_all_caps": R.flag((c.channel_clean == c.upper) & (c.channel_clean != "")),
        "channel_too_short": R.flag(
            (F.length(c.channel_clean) < 3) & ~R.on(c.missing_channel)
        ),
        "channel_too_long": R.flag(F.length(c.channel_clean) > 50),
        "has_keyboard_pattern": R.flag(
            match.any_word(F.lower(c.channel_clean), V.KEYBOARD_RUNS)
        ),
        "is_rare_channel": R.flag(c.channel_frequency < 5),
    }
    business = R.on(c.is_business_channel)
    other = c.payment_group == V.CHANNEL_GROUP_OTHER
    derived = {
        "is_custom_channel": R.flag(~R.on(c.is_standard_channel) & ~R.on(c.missing_channel)),
        "has_numbers_with_group_context": R.flag(
            c.has_digit & ~c.payment_group.isin(*NO_DIGIT_RISK_GROUPS)
        ),
        "has_numbers_not_business": R.flag(c.has_digit & ~business),
        "is_group_outlier": R.flag(
            (c.channel_frequency * 10 < c.group_frequency) & (c.channel_frequency < 10) & ~other
        ),
    }
    score = {
        "channel_risk_score": R.weighted_score(
            [
                (R.on(c.channel_too_short), R.lighter_if(business, 1, 3)),
                (R.on(c.is_custom_channel), R.lighter_if(business, 2, 5)),
                (other, 4),
                (other & R.on(c.is_custom_channel), 3),
                (R.on(c.missing_channel), 10),
                (R.on(c.channel_too_long), 1),
                (R.on(c.is_all_caps), 2),
                (R.on(c.is_test_channel), 10),
                (R.on(c.has_special_chars), 2),
                (R.on(c.has_keyboard_pattern), 8),
                (R.on(c.has_numbers_with_group_context), 3),
                (R.on(c.is_rare_channel), 6),
                ((c.distinct_customers < 3) & (c.channel_frequency > 0), 4),
                (R.on(c.is_group_outlier), 5),
            ]
        ),
        "channel_type": R.first_match(
            [
                (R.on(c.missing_channel) | R.on(c.is_test_channel), "Type 1"),
                (
                    (
                        R.on(c.is_custom_channel)
                        | R.on(c.has_numbers_with_group_context)
                        | R.on(c.has_keyboard_pattern)
                        | R.on(c.is_group_outlier)
                    )
                    & (c.payment_group != "API & Cloud Integrations"),
                    "Type 2",
                ),
                (
                    (R.on(c.is_custom_channel) | c.has_digit | R.on(c.has_keyboard_pattern))
                    & c.payment_group.isin(*NO_DIGIT_RISK_GROUPS),
                    "Type 3",
                ),
            ],
            "Type 4",
        ),
    }
    category = {"channel_risk_category": R.risk_bucket(c.channel_risk_score)}
    return [text, forms, flags, derived, score, category]


_FEATURES = (
    "channel_clean", "payment_group", "missing_channel", "is_business_channel",
    "is_consumer_channel", "is_standard_channel", "is_test_channel", "is_custom_channel",
    "has_special_chars", "is_all_caps", "has_numbers_not_business",
    "has_numbers_with_group_context", "channel_too_short", "channel_too_long",
    "has_keyboard_pattern", "channel_frequency", "distinct_customers", "is_rare_channel",
    "group_frequency", "group_distinct_customers", "is_group_outlier", "channel_risk_score",
    "channel_risk_category", "channel_type",
)
_RENAMED = {
    "has_special_chars": "Payment_has_special_chars",
    "is_all_caps": "Payment_is_all_caps",
    "has_numbers_not_business": "Payment_has_numbers_not_business",
    "has_keyboard_pattern": "Payment_has_keyboard_pattern",
}

CHANNEL = Family(
    name="channel",
    inputs=(ID, SOURCE, CUSTOMER),
    layers=_layers,
    stats=(STATS,),
    outputs={ID: ID, "raw_channel": SOURCE, **same_names(*_FEATURES)},
    final_outputs={"raw_channel": SOURCE, **{_RENAMED.get(f, f): f for f in _FEATURES}},
    score="channel_risk_score",
)
