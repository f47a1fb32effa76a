"""Hand-derived values of single payments."""

from datetime import date, datetime

import pytest

from payscope import Options, family_features
from payscope.sources.schema import EBPP_COLUMN, ID

GOLDEN = [
    ("name", "Payment_CustomerName", "test", {"name_risk_score": 25, "name_risk_category": "High"}),
    ("name", "Payment_CustomerName", "ACME LLC", {"name_risk_score": 9, "name_risk_category": "Medium"}),
    ("name", "Payment_CustomerName", None,
     {"name_risk_score": 0, "name_risk_category": "Very Low", "first_name": None}),
    ("name", "Payment_CustomerName", "\t Lead", {"first_name": None, "last_name": "Lead"}),
    ("email", "EmailAddress", None, {"email_risk_score": 13, "email_risk_category": "Medium"}),
    ("email", "EmailAddress", "admin@mailinator.com",
     {"email_risk_score": 17, "email_risk_category": "High"}),
    ("email", "EmailAddress", "john.smith99@gmail.com",
     {"email_risk_score": 3, "email_risk_category": "Very Low"}),
    ("email", "EmailAddress", "a@b@c.com", {"username": "a", "domain": "b"}),
    ("address", "Address1", None, {"address_risk_score": 13, "address_risk_category": "Medium"}),
    ("ip", "RemoteIP", None,
     {"ip_risk_score": 17, "ip_risk_category": "High", "ip_classification": "Invalid IP"}),
    ("ip", "RemoteIP", "1.2.3.4",
     {"ip_risk_score": 7, "ip_risk_category": "Low", "ip_classification": "Suspicious Pattern"}),
    ("ip", "RemoteIP", "127.0.0.1",
     {"ip_risk_score": 9, "ip_classification": "Invalid IP", "ip_address_type": "Loopback"}),
    ("ip", "RemoteIP", "999.1.1.1", {"ip_risk_score": 15, "ip_classification": "Invalid IP"}),
    ("ip", "RemoteIP", "192.168.1.1",
     {"ip_risk_score": 0, "ip_risk_category": "Very Low", "ip_classification": "Type 3"}),
    ("ip", "RemoteIP", "1e2.2.3.4", {"ip_address_type": "Unknown/Invalid"}),
    ("card", "Cardnumber", None,
     {"card_risk_score": 17, "card_risk_category": "High", "card_type": "Type 1",
      "masked_card_number": ""}),
    ("card", "Cardnumber", "4111-1111-1111-1111",
     {"card_risk_score": 21, "card_risk_category": "High", "card_type": "Type 2",
      "masked_card_number": "************1111"}),
    ("channel", "PaymentSourceDesc", None,
     {"channel_risk_score": 20, "channel_risk_category": "High", "channel_type": "Type 1"}),
    ("partner", "Partner", None, {"partner_risk_score": 19, "partner_category": "Other"}),
    ("ebpp", EBPP_COLUMN, "UNKNOWN",
     {"ebpp_risk_score": 6, "ebpp_replacement_recommendation": "High Priority Replacement"}),
    ("ebpp", EBPP_COLUMN, "JETPAY",
     {"ebpp_risk_score": 3, "ebpp_replacement_recommendation": "Consider Replacement"}),
    ("ebpp", EBPP_COLUMN, "WELLS FARGO",
     {"ebpp_risk_score": -2, "ebpp_replacement_recommendation": "No Action Needed"}),
    ("ebpp", EBPP_COLUMN, "FOO",
     {"ebpp_risk_score": 7, "ebpp_replacement_recommendation": "High Priority Replacement"}),
]



@pytest.mark.parametrize("case", range(len(GOLDEN)), ids=[f"{g[0]}-{g[2]}" for g in GOLDEN])
def test_golden(make_payments, case):
    family, column, value, expected = GOLDEN[case]
    (row,) = family_features(make_payments([{column: value}]), family).collect()
    assert {k: row[k] for k in expected} == expected


def test_busy_channel_and_category(make_payments):
    rows = [
        {"PaymentSourceDesc": "IVR", "MCC_DESCRIPTION": "TAX PAYMENTS", "CustomerID": str(i % 3)}
        for i in range(6)
    ]
    payments = make_payments(rows)
    channel = family_features(payments, "channel").first()
    assert (channel.channel_risk_score, channel.channel_type) == (2, "Type 4")
    assert channel.distinct_customers == 3
    mcc = family_features(payments, "mcc").first()
    assert (mcc.mcc_risk_score, mcc.mcc_risk_category, mcc.mcc_type) == (12, "Medium", "Type 2")


def test_known_partner(make_payments):
    row = family_features(make_payments([{"Partner": "Oracle"}] * 10), "partner").first()
    assert (row.partner_risk_score, row.partner_category) == (2, "Enterprise")


def test_default_zip(make_payments, make_ruca):
    payments = make_payments([{"Zip": "90210", "State": "CA"}])
    ruca = make_ruca([("90210-0001", 1, 1.0, "CA")])
    row = family_features(payments, "geo", ruca).first()
    assert (row.geo_risk_score, row.zip_5digit, row.is_metropolitan_core) == (13, "90210", 1)


def test_vintage_counts_boundaries(make_payments):
    payments = make_payments([{"PaymentDate": datetime(2024, 1, 31)}])
    row = family_features(payments, "master", options=Options(as_of=date(2024, 2, 1))).first()
    assert (row.Vintage_Months, row.Vintage_Years) == (1, 0)


def test_text_cards_share_the_bucket_of_missing_cards(make_payments):
    payments = make_payments([{"Cardnumber": "N/A"}, {"Cardnumber": "none"}, {}])
    rows = family_features(payments, "card").collect()
    assert [r.card_frequency for r in rows] == [2, 2, 2]


def test_blank_names_count_and_blank_emails_do_not(make_payments):
    payments = make_payments([{}, {"Payment_CustomerName": " ", "EmailAddress": ""}])
    assert {r.name_frequency for r in family_features(payments, "name").collect()} == {2}
    assert {r.email_frequency for r in family_features(payments, "email").collect()} == {0}


def test_full_match_wants_the_whole_text(make_payments):
    payments = make_payments([{"Payment_CustomerName": "demo"}, {"Payment_CustomerName": "a demo"}])
    search = family_features(payments, "name").orderBy(ID).collect()
    full = family_features(payments, "name", options=Options(match="full")).orderBy(ID).collect()
    assert [r.contains_test_keyword for r in search] == [1, 1]
    assert [r.contains_test_keyword for r in full] == [1, 0]


def test_card_number_is_hidden_by_default(make_payments):
    payments = make_payments([{"Cardnumber": "4111111111111111"}])
    assert "full_card_number" not in family_features(payments, "card").columns
    shown = family_features(payments, "card", options=Options(expose_card_number=True))
    assert shown.first().full_card_number == "4111111111111111"


def test_every_fixed_value_occurs_in_the_derived_data(spark, sf_dir):
    """And the lists keep their lengths: a value lost on both sides would go unseen."""
    from payscope import fixed_values as V
    from payscope.sources import derived

    payments = derived.payments(spark, sf_dir.replace("sf0.001", "sf0.01"))
    for column, values in derived.FIXED_LISTS.items():
        have = {r[0] for r in payments.select(f"`{column}`").distinct().collect()}
        assert not set(values) - have, column
    assert [
        len(x) for x in (
            V.EBPP_KNOWN, V.EBPP_TIER1, V.EBPP_TIER2, V.EBPP_TIER3, V.MCC_HIGH_RISK, V.MCC_STANDARD,
            V.CARD_BUSINESS_BINS, V.CARD_BUSINESS_PREFIXES, V.CARD_TEST_NUMBERS,
            V.EMAIL_FREE_DOMAINS, V.EMAIL_DISPOSABLE_DOMAINS, V.CHANNEL_BUSINESS, V.CHANNEL_CONSUMER,
            V.PARTNER_ENTERPRISE, V.PARTNER_MID_TIER, V.NAME_TEST_LITERALS,
        )
    ] == [113, 13, 20, 25, 10, 13, 24, 8, 9, 11, 10, 9, 11, 9, 11, 15]
