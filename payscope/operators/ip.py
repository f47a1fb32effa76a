"""Remote IP address: format, ranges, octet patterns, address class, repeats."""

from __future__ import annotations

from pyspark.sql import functions as F

from payscope import fixed_values as V
from payscope.functions import rules as R
from payscope.functions import text as X
from payscope.functions.numbers import try_to_number
from payscope.operators.family import Family, same_names
from payscope.operators.frequency import KeyStats, unless_blank
from payscope.sources.schema import ID

SOURCE = "RemoteIP"


def _clean():
    return X.coalesce_trim(F.col(SOURCE))


STATS = KeyStats(
    "ip",
    key=_clean,
    counted=unless_blank,
    columns=("__ip_ip_frequency",),
)


def _layers(c, match, options):
    text = {"ip_clean": _clean()}
    octets = {
        f"octet{i}": try_to_number(F.split_part(c.ip_clean, F.lit("."), F.lit(i)))
        for i in (1, 2, 3, 4)
    }
    # These six stay BOOLEAN in the output.
    ranges = {
        "is_valid_ipv4_format": match.regex(c.ip_clean, V.IP_V4_PATTERN),
        "is_ipv6_format": match.any_run(c.ip_clean, [":"]),
        "is_private_ip": match.regex(c.ip_clean, V.IP_PRIVATE_PATTERN),
        "is_business_ip": match.regex(c.ip_clean, V.IP_BUSINESS_PATTERN),
        "is_localhost": match.regex(c.ip_clean, V.IP_LOCALHOST_PATTERN),
        "is_test_ip": c.ip_clean.isin(*V.IP_TEST_ADDRESSES),
    }
    octet = (c.octet1, c.octet2, c.octet3, c.octet4)
    out_of_range = octet[0].isNull() | ~octet[0].between(0, 255)
    for o in octet[1:]:
        out_of_range = out_of_range | o.isNull() | ~o.between(0, 255)
    flags = {
        "missing_ip": R.flag(c.ip_clean == ""),
        "has_patterns_not_business": R.flag(
            match.any_run(c.ip_clean, V.IP_DIGIT_RUNS) & ~c.is_private_ip & ~c.is_business_ip
        ),
        "invalid_octet_range": R.flag(c.is_valid_ipv4_format & out_of_range),
        "sequential_octets": R.flag(
            (octet[1] == octet[0] + 1) & (octet[2] == octet[1] + 1) & (octet[3] == octet[2] + 1)
        ),
        "identical_octets": R.flag(
            (octet[0] == octet[1]) & (octet[1] == octet[2]) & (octet[2] == octet[3])
        ),
        "paired_octets": R.flag((octet[0] == octet[1]) & (octet[2] == octet[3])),
        "ip_address_type": R.first_match(
            [(octet[0].between(low, high), label) for low, high, label in V.IP_CLASSES],
            V.IP_CLASS_UNKNOWN,
        ),
        "high_frequency_ip": R.flag(c.ip_frequency > 5),
    }
    kind = c.ip_address_type
    by_type = {
        "is_public_type3": R.flag((kind == "Type 3") & ~c.is_private_ip),
        "suspicious_type1": R.flag((kind == "Type 1") & R.on(c.has_patterns_not_business)),
        "unusual_ip_class": R.flag(kind.isin("Type 4", "Type 5")),
        **R.one_hot(
            kind, {**{f"IS_Type_{i}": f"Type {i}" for i in range(1, 6)},
                   "IS_Unknown_Invalid": V.IP_CLASS_UNKNOWN},
        ),
        "ip_classification": R.first_match(
            [
                (
                    R.on(c.missing_ip)
                    | ~(c.is_valid_ipv4_format | c.is_ipv6_format)
                    | R.on(c.invalid_octet_range)
                    | c.is_localhost,
                    "Invalid IP",
                ),
                (
                    (R.on(c.sequential_octets) | R.on(c.identical_octets) | R.on(c.paired_octets))
                    & ~c.is_business_ip,
                    "Suspicious Pattern",
                ),
            ],
            kind,
        ),
    }
    score = {
        "ip_risk_score": R.weighted_score(
            [
                (R.on(c.missing_ip), 10),
                (~c.is_valid_ipv4_format & ~c.is_ipv6_format & ~R.on(c.missing_ip), 8),
                (R.on(c.invalid_octet_range), 8),
                (c.is_localhost, 9),
                (R.on(c.sequential_octets), R.lighter_if(c.is_business_ip, 2, 7)),
                (R.on(c.identical_octets), R.lighter_if(c.is_business_ip, 1, 5)),
                (R.on(c.paired_octets), R.lighter_if(c.is_business_ip, 1, 3)),
                (R.on(c.unusual_ip_class), 6),
                (R.on(c.is_public_type3), 2),
                (kind == V.IP_CLASS_UNKNOWN, 7),
                (R.on(c.has_patterns_not_business), 3),
                # The flag turns on above 5, the score only above 10.
                (c.ip_frequency > 10, 5),
            ]
        )
    }
    category = {"ip_risk_category": R.risk_bucket(c.ip_risk_score)}
    return [text, {**octets, **ranges}, flags, by_type, score, category]


_SHAPE = (
    "ip_clean", "missing_ip", "is_valid_ipv4_format", "is_ipv6_format", "is_private_ip",
    "is_business_ip", "is_localhost", "is_test_ip", "sequential_octets", "identical_octets",
    "paired_octets", "has_patterns_not_business", "ip_address_type",
)
_ONE_HOT = (
    "IS_Type_1", "IS_Type_2", "IS_Type_3", "IS_Type_4", "IS_Type_5", "IS_Unknown_Invalid",
)
_RISK = (
    "is_public_type3", "suspicious_type1", "unusual_ip_class", "ip_frequency",
    "high_frequency_ip", "ip_risk_score", "ip_risk_category", "ip_classification",
)
_RENAMED = {"has_patterns_not_business": "ip_has_patterns_not_business"}

IP = Family(
    name="ip",
    inputs=(ID, SOURCE),
    layers=_layers,
    stats=(STATS,),
    outputs={ID: ID, "raw_ip": SOURCE, **same_names(*_SHAPE, *_RISK)},
    final_outputs={
        "raw_ip": SOURCE,
        **{_RENAMED.get(f, f): f for f in (*_SHAPE, *_ONE_HOT, *_RISK)},
    },
    score="ip_risk_score",
)
