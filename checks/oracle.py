"""DuckDB statements the Spark results are checked against.

Written apart from the Spark code, in another shape: flags are casts of predicates, scores are sums
of weights times flags, statistics are plain GROUP BY joins. Only the fixed values (word lists,
patterns) and the recipe that derives payments from ``orders`` are shared.
"""

from __future__ import annotations

from payscope import fixed_values as V
from payscope.sources import derived
from payscope.sources.schema import BOOLEAN_COLUMNS, EBPP_COLUMN, ID, PASS_THROUGH, PRICING_COLUMN

AS_OF = "DATE '2002-01-15'"
EBPP = f'"{EBPP_COLUMN}"'
PRICE = f'"{PRICING_COLUMN}"'


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def names(values) -> str:
    return ", ".join(q(v) for v in values)


def cols(values) -> str:
    return ", ".join(f'"{v}"' for v in values)


def bit(condition: str) -> str:
    return f"COALESCE(CAST(({condition}) AS INT), 0)"


class Rx:
    """Pattern predicates: search by default, whole text with ``full``."""

    def __init__(self, full: bool = False):
        self.function = "regexp_full_match" if full else "regexp_matches"

    def __call__(self, text: str, pattern: str) -> str:
        return bit(f"{self.function}({text}, {q(pattern)})")

    def bool(self, text: str, pattern: str) -> str:
        return f"{self.function}({text}, {q(pattern)})"

    def words(self, text: str, values) -> str:
        return self(text, r"\b(" + "|".join(values) + r")\b")

    def runs(self, text: str, values) -> str:
        return self(text, "(" + "|".join(v.replace(".", r"\.") for v in values) + ")")


def inside(text: str, values) -> str:
    return bit(f"list_bool_or([contains({text}, x) FOR x IN [{names(values)}]])")


def band(score: str) -> str:
    return (
        f"CASE WHEN {score} > 15 THEN 'High' WHEN {score} > 7 THEN 'Medium'"
        f" WHEN {score} > 3 THEN 'Low' ELSE 'Very Low' END"
    )


def _select(columns: dict[str, str], wanted, rows: str) -> str:
    chosen = columns if wanted is None else {c: columns[c] for c in wanted}
    return "SELECT " + ", ".join(f'{e} AS "{c}"' for c, e in chosen.items()) + f" FROM {rows}"


def payments_cte(wanted=None, duplicates: bool = False, null_ids: bool = False) -> str:
    columns = derived.payment_expressions()
    rows = "(SELECT o_orderkey AS k, o_custkey AS c, o_orderdate AS d FROM orders)"
    text = _select(columns, wanted, rows)
    if duplicates:
        columns["Partner"] = "'Second Partner'"
        text += " UNION ALL " + _select(columns, wanted, rows) + " WHERE k IN (1, 2, 3)"
    if null_ids:
        columns = {**derived.payment_expressions(), ID: "CAST(NULL AS STRING)"}
        text += " UNION ALL " + _select(columns, wanted, rows) + " WHERE k IN (4, 5, 6)"
    return f"payments AS ({text})"


def ruca_cte(repeated: bool = False) -> str:
    nations = "SELECT n_nationkey AS n FROM nation"
    if repeated:
        nations += " UNION ALL SELECT n_nationkey FROM nation WHERE n_nationkey = 2"
    return f"ruca AS ({_select(derived.ruca_expressions(), None, f'({nations})')})"


# --- one relation per family: all its columns, with the payment id ----------------------------


def name_rel(rx: Rx) -> str:
    return f"""
    SELECT *,
      (3 - 2 * is_business_entity) * name_too_short + (4 - 3 * is_business_entity) * single_word_name
      + 7 * potential_shell + name_too_long + 2 * is_all_caps + 10 * is_test_name
      + 7 * contains_test_keyword + 2 * has_special_chars + 3 * has_numbers_not_business
      + 8 * has_keyboard_pattern + 4 * first_last_name_same + 3 * single_letter_first
      + 3 * single_letter_last AS name_risk_score,
      {band("name_risk_score")} AS name_risk_category
    FROM (
      SELECT *,
        {bit("norm <> '' AND name_length < 4")} AS name_too_short,
        {bit("name_length > 50")} AS name_too_long,
        {bit("name_word_count = 1")} AS single_word_name,
        {rx("norm", "[A-Za-z]")} * {bit("norm = up")} AS is_all_caps,
        {rx("norm", "[A-Za-z]")} * {bit("norm = low")} AS is_all_lowercase,
        {rx("up", V.NAME_COMPANY_PATTERN)} AS is_business_entity,
        {bit(f"low IN ({names(V.NAME_TEST_LITERALS)})")} AS is_test_name,
        {rx.words("low", V.NAME_TEST_WORDS)} AS contains_test_keyword,
        {rx("norm", V.NAME_SPECIAL_PATTERN)} AS has_special_chars,
        {rx("norm", "[0-9]")} AS has_numbers,
        (1 - is_business_entity) * has_numbers AS has_numbers_not_business,
        {rx.runs("low", V.KEYBOARD_RUNS)} AS has_keyboard_pattern,
        is_business_entity * {bit("name_word_count <= 2")} AS potential_shell,
        {bit("first_name = last_name")} AS first_last_name_same,
        {bit("length(first_name) = 1")} AS single_letter_first,
        {bit("length(last_name) = 1")} AS single_letter_last,
        {bit("name_frequency > 1")} AS multiple_transactions_same_name
      FROM (
        SELECT *, upper(norm) AS up, lower(norm) AS low,
          CAST(length(norm) AS INT) AS name_length,
          CAST(len(regexp_extract_all(norm, '\\S+')) AS INT) AS name_word_count,
          nullif(regexp_extract(norm, '^\\S+'), '') AS first_name,
          nullif(regexp_extract(norm, '\\S+$'), '') AS last_name
        FROM (SELECT *,
          regexp_replace(trim(coalesce("Payment_CustomerName", '')), '\\s+', ' ', 'g') AS norm
          FROM payments)
      )
      JOIN (
        SELECT upper(regexp_replace(trim(coalesce("Payment_CustomerName", '')), '\\s+', ' ', 'g'))
            AS name_key, count(*) AS name_frequency
        FROM payments GROUP BY 1
      ) ON up = name_key
    )"""


def address_rel(rx: Rx) -> str:
    return f"""
    SELECT *,
      8 * missing_address + 4 * address_too_short + address_too_long + 3 * too_few_words
      + 3 * is_po_box + 8 * has_test_address_keyword + 5 * is_generic_address
      + 3 * has_invalid_chars + all_caps + 2 * has_high_risk_state + 4 * potential_virtual_office
      + 6 * numbers_only + 7 * has_keyboard_pattern + 2 * (1 - has_zip_format)
      + 3 * has_numbers_not_business + 4 * high_frequency_address AS address_risk_score,
      {band("address_risk_score")} AS address_risk_category
    FROM (
      SELECT *, CAST(length(norm) AS INT) AS address_length,
        {bit("norm = ''")} AS missing_address,
        {bit("address_length BETWEEN 1 AND 9")} AS address_too_short,
        {bit("address_length > 150")} AS address_too_long,
        CAST(len(regexp_extract_all(norm, '\\S+')) AS INT) AS address_word_count,
        {bit("address_word_count <= 2")} AS too_few_words,
        {rx("up", V.ADDRESS_PO_BOX_PATTERN)} AS is_po_box,
        {rx.words("low", V.ADDRESS_TEST_WORDS)} AS has_test_address_keyword,
        {rx("norm", V.ADDRESS_GENERIC_PATTERN)} AS is_generic_address,
        {rx("norm", V.ADDRESS_INVALID_PATTERN)} AS has_invalid_chars,
        {rx("norm", "[A-Za-z]")} * {bit("norm = up")} AS all_caps,
        {rx.words("up", V.ADDRESS_RISK_STATES)} AS has_high_risk_state,
        {rx("low", V.ADDRESS_VIRTUAL_OFFICE_PATTERN)} AS potential_virtual_office,
        {rx("norm", "[0-9]+") if rx.function == "regexp_full_match" else rx("norm", "^[0-9]+$")}
          AS numbers_only,
        {rx("norm", V.ADDRESS_ZIP_PATTERN)} AS has_zip_format,
        {rx.words("low", V.KEYBOARD_RUNS)} AS has_keyboard_pattern,
        {rx("norm", "[0-9]")} * (1 - {rx("up", V.ADDRESS_COMPANY_PATTERN)})
          AS has_numbers_not_business,
        coalesce(counted, 0) AS address_frequency,
        {bit("address_frequency > 10")} AS high_frequency_address
      FROM (
        SELECT *, upper(norm) AS up, lower(norm) AS low FROM (
          SELECT *, regexp_replace(trim(coalesce("Address1", '')), '\\s+', ' ', 'g') AS norm
          FROM payments)
      )
      LEFT JOIN (
        SELECT upper(regexp_replace(trim("Address1"), '\\s+', ' ', 'g')) AS address_key,
          count(*) AS counted
        FROM payments WHERE trim("Address1") <> '' GROUP BY 1
      ) ON up = address_key
    )"""


def email_rel(rx: Rx) -> str:
    return f"""
    SELECT *,
      10 * missing_email + 8 * (1 - is_valid_format) * (1 - missing_email)
      + 9 * is_disposable_email + 3 * short_username + 4 * username_only_numbers
      + 7 * has_test_keyword + 4 * has_sequential_pattern + 5 * is_role_account + 6 * reused_email
      + 3 * has_numbers_not_business + 2 * username_has_special_chars AS email_risk_score,
      {band("email_risk_score")} AS email_risk_category
    FROM (
      SELECT *, {bit("email_clean = ''")} AS missing_email,
        {rx("email_clean", V.EMAIL_FORMAT_PATTERN)} AS is_valid_format,
        {rx.words("domain", V.EMAIL_COMPANY_WORDS)} AS is_business_domain,
        {bit("domain LIKE '%gmail.com'")} AS is_gmail,
        {bit("domain LIKE '%yahoo.com'")} AS is_yahoo,
        {bit("domain LIKE '%hotmail.com'")} AS is_hotmail,
        {bit("domain LIKE '%outlook.com'")} AS is_outlook,
        {rx.runs("domain", V.EMAIL_FREE_DOMAINS)} AS is_free_email,
        {rx.runs("domain", V.EMAIL_DISPOSABLE_DOMAINS)} AS is_disposable_email,
        CAST(length(username) AS INT) AS username_length,
        {bit("username_length = 0")} AS missing_username,
        {bit("username_length <= 5")} AS short_username,
        {bit("username_length >= 31")} AS long_username,
        {rx("username", "[0-9]")} AS username_has_numbers,
        {bit("regexp_full_match(username, '[0-9]+')")} AS username_only_numbers,
        {rx.words("email_clean", V.EMAIL_TEST_WORDS)} AS has_test_keyword,
        {rx.runs("username", V.EMAIL_RUNS)} AS has_sequential_pattern,
        {rx("username", V.EMAIL_USER_SPECIAL_PATTERN)} AS username_has_special_chars,
        {rx("username", "^(" + "|".join(V.EMAIL_ROLES) + ")$")} AS is_role_account,
        username_has_numbers * (1 - is_business_domain) AS has_numbers_not_business,
        coalesce(counted, 0) AS email_frequency,
        {bit("email_frequency > 5")} AS reused_email
      FROM (
        SELECT *, split_part(email_clean, '@', 1) AS username,
          split_part(email_clean, '@', 2) AS domain
        FROM (SELECT *, lower(trim(coalesce("EmailAddress", ''))) AS email_clean FROM payments)
      )
      LEFT JOIN (
        SELECT lower(trim("EmailAddress")) AS email_key, count(*) AS counted
        FROM payments WHERE trim("EmailAddress") <> '' GROUP BY 1
      ) ON email_clean = email_key
    )"""


def ip_rel(rx: Rx) -> str:
    octets = ", ".join(
        f"CASE WHEN regexp_full_match(split_part(ip_clean, '.', {i}), ' *[+-]?[0-9]+ *')"
        f" THEN TRY_CAST(trim(split_part(ip_clean, '.', {i})) AS HUGEINT) END AS o{i}"
        for i in (1, 2, 3, 4)
    )
    ok = " AND ".join(f"coalesce(o{i} BETWEEN 0 AND 255, FALSE)" for i in (1, 2, 3, 4))
    hot = "(1 - CAST(is_business_ip AS INT))"
    return f"""
    SELECT *,
      10 * missing_ip
      + 8 * {bit("NOT is_valid_ipv4_format AND NOT is_ipv6_format AND missing_ip = 0")}
      + 8 * invalid_octet_range + 9 * CAST(is_localhost AS INT)
      + (2 + 5 * {hot}) * sequential_octets + (1 + 4 * {hot}) * identical_octets
      + (1 + 2 * {hot}) * paired_octets + 6 * unusual_ip_class + 2 * is_public_type3
      + 7 * "IS_Unknown_Invalid" + 3 * has_patterns_not_business
      + 5 * {bit("ip_frequency > 10")} AS ip_risk_score,
      {band("ip_risk_score")} AS ip_risk_category
    FROM (
      SELECT *,
        {", ".join(f'''{bit(f"ip_address_type = 'Type {i}'")} AS "IS_Type_{i}"''' for i in range(1, 6))},
        {bit(f"ip_address_type = '{V.IP_CLASS_UNKNOWN}'")} AS "IS_Unknown_Invalid",
        "IS_Type_3" * {bit("NOT is_private_ip")} AS is_public_type3,
        "IS_Type_1" * has_patterns_not_business AS suspicious_type1,
        greatest("IS_Type_4", "IS_Type_5") AS unusual_ip_class,
        coalesce(counted, 0) AS ip_frequency,
        {bit("ip_frequency > 5")} AS high_frequency_ip,
        CASE WHEN missing_ip = 1 OR (NOT is_valid_ipv4_format AND NOT is_ipv6_format)
               OR invalid_octet_range = 1 OR is_localhost THEN 'Invalid IP'
             WHEN NOT is_business_ip
               AND sequential_octets + identical_octets + paired_octets > 0
               THEN 'Suspicious Pattern'
             ELSE ip_address_type END AS ip_classification
      FROM (
        SELECT *,
          {rx("ip_clean", "|".join(V.IP_DIGIT_RUNS))}
            * {bit("NOT is_private_ip AND NOT is_business_ip")} AS has_patterns_not_business,
          {bit(f"is_valid_ipv4_format AND NOT ({ok})")} AS invalid_octet_range,
          {bit("o2 - o1 = 1 AND o3 - o2 = 1 AND o4 - o3 = 1")} AS sequential_octets,
          {bit("o1 = o2 AND o1 = o3 AND o1 = o4")} AS identical_octets,
          {bit("o1 = o2 AND o3 = o4")} AS paired_octets,
          CASE WHEN o1 IS NULL OR o1 <= 0 OR o1 > 255 THEN '{V.IP_CLASS_UNKNOWN}'
               WHEN o1 < 127 THEN 'Type 1' WHEN o1 = 127 THEN 'Loopback'
               WHEN o1 < 192 THEN 'Type 2' WHEN o1 < 224 THEN 'Type 3'
               WHEN o1 < 240 THEN 'Type 4' ELSE 'Type 5' END AS ip_address_type
        FROM (
          SELECT *, {bit("ip_clean = ''")} AS missing_ip,
            {rx.bool("ip_clean", V.IP_V4_PATTERN)} AS is_valid_ipv4_format,
            {rx.bool("ip_clean", ":")} AS is_ipv6_format,
            {rx.bool("ip_clean", V.IP_PRIVATE_PATTERN)} AS is_private_ip,
            {rx.bool("ip_clean", V.IP_BUSINESS_PATTERN)} AS is_business_ip,
            {rx.bool("ip_clean", V.IP_LOCALHOST_PATTERN)} AS is_localhost,
            {rx.bool("ip_clean", "|".join("^" + a.replace(".", "[.]") + "$" for a in V.IP_TEST_ADDRESSES))}
              AS is_test_ip,
            {octets}
          FROM (SELECT *, "RemoteIP" AS raw_ip, trim(coalesce("RemoteIP", '')) AS ip_clean
                FROM payments)
        )
      )
      LEFT JOIN (
        SELECT trim("RemoteIP") AS ip_key, count(*) AS counted
        FROM payments WHERE trim("RemoteIP") <> '' GROUP BY 1
      ) ON ip_clean = ip_key
    )"""


def card_rel(rx: Rx) -> str:
    length_bad = " OR ".join(
        f"(card_network = '{n}' AND card_digits_length NOT IN ({', '.join(map(str, ls))}))"
        for n, ls in V.CARD_LENGTHS.items()
    )
    one_hot = ", ".join(f"""{bit(f"card_network = '{n}'")} AS "{c}" """ for c, n in V.CARD_ONE_HOT.items())
    return f"""
    SELECT *,
      (8 - 7 * is_business_card) * (has_repeated_digits + has_sequential_digits)
      + 10 * missing_card + 10 * (1 - is_numeric_only) * (1 - missing_card)
      + 9 * invalid_length_for_network + 10 * is_test_card + 10 * single_digit_card
      + 3 * has_patterns_not_business + 8 * has_keyboard_pattern + 7 * "IS_Unknown"
      + 6 * {bit("card_frequency > 10")} AS card_risk_score,
      {band("card_risk_score")} AS card_risk_category,
      CASE WHEN missing_card + (1 - is_numeric_only) + invalid_length_for_network
             + single_digit_card > 0 THEN 'Type 1'
           WHEN is_test_card + has_patterns_not_business > 0 THEN 'Type 2'
           WHEN is_business_card * (has_repeated_digits + has_sequential_digits) > 0 THEN 'Type 3'
           ELSE 'Type 4' END AS card_type
    FROM (
      SELECT *, {one_hot},
        {bit(length_bad)} AS invalid_length_for_network,
        greatest(has_repeated_digits, has_sequential_digits) * (1 - is_business_card)
          AS has_patterns_not_business,
        {bit("digits <> '' AND digits = repeat(digits[1], length(digits))")} AS single_digit_card,
        coalesce(counted, 0) AS card_frequency,
        {bit("card_frequency > 1")} AS multiple_transactions_same_card
      FROM (
        SELECT *, {bit("clean = ''")} AS missing_card,
          CAST(length(digits) AS INT) AS card_digits_length,
          {bit("length(digits) > 0")} AS is_numeric_only,
          digits[:6] AS bin_number,
          CASE WHEN length(digits) > 4 THEN repeat('*', length(digits) - 4) || right(digits, 4)
               ELSE clean END AS masked_card_number,
          CASE WHEN digits LIKE '4%' THEN 'Visa'
               WHEN regexp_matches(digits, '^5[1-5]')
                 OR (bin_number >= '222100' AND bin_number <= '272099') THEN 'Mastercard'
               WHEN regexp_matches(digits, '^3[47]') THEN 'American Express'
               WHEN regexp_matches(digits, '^(3[689]|30[0-5])') THEN 'Diners Club'
               WHEN regexp_matches(digits, '^(6011|65|64[4-9])') THEN 'Discover'
               WHEN digits LIKE '35%' THEN 'JCB' ELSE 'Unknown' END AS card_network,
          {bit(f"bin_number IN ({names(V.CARD_BUSINESS_BINS)}) OR digits[:4] IN ({names(V.CARD_BUSINESS_PREFIXES)})")}
            AS is_business_card,
          {bit(f"digits IN ({names(V.CARD_TEST_NUMBERS)})")} AS is_test_card,
          {rx.runs("digits", V.CARD_REPEATED_RUNS)} AS has_repeated_digits,
          {rx.runs("digits", V.CARD_SEQUENTIAL_RUNS)} AS has_sequential_digits,
          {rx.runs("digits", V.CARD_KEYBOARD_RUNS)} AS has_keyboard_pattern
        FROM (
          SELECT *, "Cardnumber" AS full_card_number, trim(coalesce("Cardnumber", '')) AS clean,
            regexp_replace(trim(coalesce("Cardnumber", '')), '[^0-9]', '', 'g') AS digits
          FROM payments)
      )
      LEFT JOIN (
        SELECT regexp_replace("Cardnumber", '[^0-9]', '', 'g') AS card_key, count(*) AS counted
        FROM payments WHERE trim("Cardnumber") <> '' GROUP BY 1
      ) ON digits = card_key
    )"""


def group_of(channel: str) -> str:
    whens = " ".join(
        f"WHEN {channel} IN ({names(members)}) THEN {q(group)}"
        for group, members in V.CHANNEL_GROUPS.items()
    )
    return f"CASE {whens} ELSE 'Other' END"


def channel_rel(rx: Rx) -> str:
    return f"""
    SELECT *,
      (3 - 2 * is_business_channel) * channel_too_short
      + (5 - 3 * is_business_channel) * is_custom_channel
      + (4 + 3 * is_custom_channel) * other + 10 * missing_channel + channel_too_long
      + 2 * is_all_caps + 10 * is_test_channel + 2 * has_special_chars + 8 * has_keyboard_pattern
      + 3 * has_numbers_with_group_context + 6 * is_rare_channel
      + 4 * {bit("distinct_customers < 3 AND channel_frequency > 0")}
      + 5 * is_group_outlier AS channel_risk_score,
      {band("channel_risk_score")} AS channel_risk_category,
      CASE WHEN missing_channel + is_test_channel > 0 THEN 'Type 1'
           WHEN payment_group <> 'API & Cloud Integrations'
             AND is_custom_channel + has_numbers_with_group_context + has_keyboard_pattern
               + is_group_outlier > 0 THEN 'Type 2'
           WHEN quiet_group = 1 AND is_custom_channel + digit + has_keyboard_pattern > 0
             THEN 'Type 3'
           ELSE 'Type 4' END AS channel_type
    FROM (
      SELECT *, {bit("payment_group = 'Other'")} AS other,
        {bit("payment_group IN ('API & Cloud Integrations', 'Agent Assisted')")} AS quiet_group,
        {rx("channel_clean", "[0-9]")} AS digit,
        {bit("channel_clean = ''")} AS missing_channel,
        {bit(f"up IN ({names(V.CHANNEL_BUSINESS)})")} AS is_business_channel,
        {bit(f"up IN ({names(V.CHANNEL_CONSUMER)})")} AS is_consumer_channel,
        is_business_channel + is_consumer_channel AS is_standard_channel,
        {rx.words("up", V.CHANNEL_TEST_WORDS)} AS is_test_channel,
        (1 - is_standard_channel) * (1 - missing_channel) AS is_custom_channel,
        {rx("channel_clean", "[^[:alnum:][:space:]\\-_]")} AS has_special_chars,
        {bit("channel_clean <> '' AND channel_clean = up")} AS is_all_caps,
        digit * (1 - is_business_channel) AS has_numbers_not_business,
        digit * (1 - quiet_group) AS has_numbers_with_group_context,
        {bit("length(channel_clean) IN (1, 2)")} AS channel_too_short,
        {bit("length(channel_clean) > 50")} AS channel_too_long,
        {rx.words("lower(channel_clean)", V.KEYBOARD_RUNS)} AS has_keyboard_pattern,
        coalesce(n, 0) AS channel_frequency, coalesce(customers, 0) AS distinct_customers,
        {bit("channel_frequency < 5")} AS is_rare_channel,
        coalesce(group_n, 0) AS group_frequency,
        coalesce(group_customers, 0) AS group_distinct_customers,
        {bit("n < 10 AND 10 * n < group_n AND payment_group <> 'Other'")} AS is_group_outlier
      FROM (
        SELECT *, {group_of("up")} AS payment_group FROM (
          SELECT *, "PaymentSourceDesc" AS raw_channel,
            trim(coalesce("PaymentSourceDesc", '')) AS channel_clean,
            upper(trim(coalesce("PaymentSourceDesc", ''))) AS up
          FROM payments)
      )
      LEFT JOIN (
        SELECT upper(trim("PaymentSourceDesc")) AS channel_key, count(*) AS n,
          count(DISTINCT "CustomerID") AS customers
        FROM payments WHERE trim("PaymentSourceDesc") <> '' GROUP BY 1
      ) ON up = channel_key
      LEFT JOIN (
        SELECT {group_of('upper(trim("PaymentSourceDesc"))')} AS group_key, count(*) AS group_n,
          count(DISTINCT "CustomerID") AS group_customers
        FROM payments WHERE trim("PaymentSourceDesc") <> '' GROUP BY 1
      ) ON payment_group = group_key
    )"""


def mcc_rel(rx: Rx) -> str:
    return f"""
    SELECT *,
      (3 - 2 * is_business_related_mcc) * has_numbers_not_business
      + (2 - is_business_related_mcc) * has_special_chars + 4 * is_high_risk_mcc
      + 3 * is_government_related + 10 * missing_mcc + 3 * mcc_too_short + mcc_too_long
      + 2 * is_all_caps + 10 * is_test_mcc + 3 * is_unusual_mcc + 2 * is_nec_category
      + 6 * is_rare_mcc + 4 * {bit("distinct_customers < 3 AND mcc_frequency > 0")}
      AS mcc_risk_score,
      {band("mcc_risk_score")} AS mcc_risk_category,
      CASE WHEN missing_mcc + is_test_mcc + mcc_too_short > 0 THEN 'Type 1'
           WHEN is_high_risk_mcc + is_government_related = 0 THEN 'Type 4'
           WHEN has_numbers_not_business + has_special_chars + is_unusual_mcc > 0 THEN 'Type 2'
           ELSE 'Type 3' END AS mcc_type
    FROM (
      SELECT *, {bit("mcc_clean = ''")} AS missing_mcc,
        CAST(length(mcc_clean) AS INT) AS mcc_length,
        {bit(f"mcc_normalized IN ({names(V.MCC_HIGH_RISK)})")} AS is_high_risk_mcc,
        {bit(f"mcc_normalized IN ({names(V.MCC_STANDARD)})")} AS is_standard_mcc,
        {bit(f"mcc_normalized IN ({names(V.MCC_BUSINESS)})")} AS is_business_related_mcc,
        {bit(f"mcc_normalized IN ({names(V.MCC_GOVERNMENT)})")} AS is_government_related,
        {bit("mcc_normalized LIKE '%NEC%' OR mcc_normalized LIKE '%NOT ELSEWHERE CLASSIFIED%'")}
          AS is_nec_category,
        (1 - is_standard_mcc) * (1 - missing_mcc) AS is_unusual_mcc,
        {bit("mcc_clean <> '' AND mcc_clean = mcc_normalized")} AS is_all_caps,
        {rx("mcc_clean", "[0-9]")} * (1 - is_business_related_mcc) AS has_numbers_not_business,
        {rx("mcc_clean", V.MCC_SPECIAL_PATTERN)} AS has_special_chars,
        {bit("mcc_length BETWEEN 1 AND 9")} AS mcc_too_short,
        {bit("mcc_length > 100")} AS mcc_too_long,
        {rx.runs("mcc_normalized", V.MCC_TEST_TEXTS)} AS is_test_mcc,
        coalesce(n, 0) AS mcc_frequency, coalesce(customers, 0) AS distinct_customers,
        CAST(coalesce(paid, 0) AS DECIMAL(28, 2)) AS total_amount,
        {bit("mcc_frequency < 5")} AS is_rare_mcc
      FROM (
        SELECT *, "MCC_DESCRIPTION" AS raw_mcc, trim(coalesce("MCC_DESCRIPTION", '')) AS mcc_clean,
          upper(trim(coalesce("MCC_DESCRIPTION", ''))) AS mcc_normalized
        FROM payments)
      LEFT JOIN (
        SELECT upper(trim("MCC_DESCRIPTION")) AS mcc_key, count(*) AS n,
          count(DISTINCT "CustomerID") AS customers, sum(coalesce("PaymentAmount", 0)) AS paid
        FROM payments WHERE trim("MCC_DESCRIPTION") <> '' GROUP BY 1
      ) ON mcc_normalized = mcc_key
    )"""


def partner_rel(rx: Rx) -> str:
    return f"""
    SELECT *,
      CASE partner_category WHEN 'Enterprise' THEN 2 WHEN 'Mid-tier' THEN 5 WHEN 'Custom' THEN 8
           ELSE 6 END
      + 10 * partner_missing + 5 * partner_name_too_short
      + 10 * {inside('"Partner"', V.PARTNER_TEST_SCORED)} + 4 * legacy_system
      - 2 * modern_system + 3 * low_volume_partner + 6 * multiple_partners_same_id
      AS partner_risk_score
    FROM (
      SELECT *,
        {inside('"Partner"', V.PARTNER_ENTERPRISE)} AS is_enterprise_partner,
        {inside('"Partner"', V.PARTNER_MID_TIER)} AS is_mid_tier_partner,
        {inside('"Partner"', V.PARTNER_CUSTOM)} AS is_custom_solution,
        CASE WHEN is_enterprise_partner = 1 THEN 'Enterprise'
             WHEN is_mid_tier_partner = 1 THEN 'Mid-tier'
             WHEN is_custom_solution = 1 THEN 'Custom' ELSE 'Other' END AS partner_category,
        CASE WHEN {inside('"Partner"', V.PARTNER_MUNICIPAL)} = 1 THEN 'Municipal'
             WHEN {inside('"Partner"', V.PARTNER_INSURANCE)} = 1 THEN 'Insurance'
             WHEN {inside('"Partner"', V.PARTNER_UTILITY)} = 1 THEN 'Utility'
             ELSE 'Other' END AS partner_industry,
        {bit('''coalesce(trim("Partner"), '') = '' ''')} AS partner_missing,
        {bit('length("Partner") <= 2')} AS partner_name_too_short,
        {inside('"Partner"', V.PARTNER_TEST)} AS is_test_partner,
        {inside('"Partner"', V.PARTNER_LEGACY)} AS legacy_system,
        {inside('"Partner"', V.PARTNER_MODERN)} AS modern_system,
        {inside('"Partner"', V.PARTNER_BATCH)} AS batch_system,
        {inside('"Partner"', V.PARTNER_REAL_TIME)} AS real_time_system,
        coalesce(n, 0) AS partner_transaction_count,
        {bit("partner_transaction_count < 10")} AS low_volume_partner,
        coalesce(partners, 0) AS distinct_partners_per_id,
        {bit("distinct_partners_per_id > 1")} AS multiple_partners_same_id
      FROM payments
      LEFT JOIN (SELECT "Partner" AS partner_key, count(*) AS n FROM payments GROUP BY 1)
        ON "Partner" = partner_key
      LEFT JOIN (SELECT "{ID}" AS id_key, count(DISTINCT "Partner") AS partners
                 FROM payments GROUP BY 1) ON "{ID}" = id_key
    )"""


def geo_rel(rx: Rx) -> str:
    strip = "regexp_replace({}, '[^A-Za-z0-9]', '', 'g')[:5]"
    return f"""
    SELECT *,
      CASE WHEN is_metropolitan_core = 1 THEN 'Metropolitan Core (Urban)'
           WHEN is_metro_commuting = 1 THEN 'Metropolitan Commuting (Suburban)'
           WHEN is_micropolitan = 1 THEN 'Micropolitan'
           WHEN is_small_town = 1 THEN 'Small Town'
           WHEN is_rural = 1 THEN 'Rural' ELSE 'Unknown' END AS area_type,
      8 * {bit('"BillingLatitude" IS NULL OR "BillingLongitude" IS NULL')}
      + 7 * {bit('''coalesce(trim(original_zip), '') = '' ''')}
      + 9 * {bit('abs("BillingLatitude") > 90 OR abs("BillingLongitude") > 180')}
      + 10 * {bit('abs("BillingLatitude") <= 0.001 AND abs("BillingLongitude") <= 0.001')}
      + 7 * {bit(f"original_zip IN ({names(V.ZIP_DEFAULTS)})")}
      + CASE WHEN is_metropolitan_core = 1 THEN -2 WHEN is_metro_commuting = 1 THEN -1
             WHEN is_micropolitan = 1 THEN 0 WHEN is_small_town = 1 THEN 2
             WHEN is_rural = 1 THEN 3 ELSE 4 END
      + 5 * high_value_rural_transaction + 6 * state_zip_mismatch AS geo_risk_score
    FROM (
      SELECT "{ID}", "Zip" AS original_zip, {strip.format('"Zip"')} AS zip_5digit,
        ruca_zip_5digit, "BillingLatitude", "BillingLongitude", "State" AS transaction_state,
        original_ruca_zip, "RUCA1", "RUCA2", zip_state,
        {bit('"RUCA1" = 1')} AS is_metropolitan_core,
        {bit('"RUCA1" IN (2, 3)')} AS is_metro_commuting,
        {bit('"RUCA1" IN (4, 5, 6)')} AS is_micropolitan,
        {bit('"RUCA1" IN (7, 8, 9)')} AS is_small_town,
        {bit('"RUCA1" = 10')} AS is_rural,
        is_rural * {bit('"PaymentAmount" > 1000')} AS high_value_rural_transaction,
        {bit('"State" <> zip_state')} AS state_zip_mismatch
      FROM payments
      LEFT JOIN (
        SELECT {strip.format('"ZIP_CODE"')} AS ruca_zip_5digit, "ZIP_CODE" AS original_ruca_zip,
          "RUCA1", "RUCA2", "STATE" AS zip_state FROM ruca
      ) ON {strip.format('"Zip"')} = ruca_zip_5digit
      WHERE "Zip" IS NOT NULL
    )"""


def ebpp_rel(rx: Rx) -> str:
    return f"""
    SELECT *,
      7 * is_unknown_ebpp - 2 * ebpp_tier1 + 3 * ebpp_tier3 + 4 * is_inhouse_gateway
      + 6 * is_temp_provider AS ebpp_risk_score,
      CASE WHEN ebpp_risk_score <= 0 THEN 'No Action Needed' WHEN ebpp_risk_score < 3 THEN 'Monitor'
           WHEN ebpp_risk_score < 6 THEN 'Consider Replacement'
           ELSE 'High Priority Replacement' END AS ebpp_replacement_recommendation
    FROM (
      SELECT *, {EBPP} AS original_ebpp,
        1 - {bit(f"ebpp_clean IN ({names(V.EBPP_KNOWN)})")} AS is_unknown_ebpp,
        {bit(f"ebpp_clean IN ({names(V.EBPP_TIER1)})")} AS ebpp_tier1,
        {bit(f"ebpp_clean IN ({names(V.EBPP_TIER2)})")} AS ebpp_tier2,
        {bit(f"ebpp_clean IN ({names(V.EBPP_TIER3)})")} AS ebpp_tier3,
        {inside("ebpp_clean", V.EBPP_INHOUSE_TEXTS)} AS is_inhouse_gateway,
        {inside("ebpp_clean", V.EBPP_GOVERNMENT_TEXTS)} AS is_gov_provider,
        greatest({inside("ebpp_clean", V.EBPP_TEMPORARY_TEXTS)},
          {bit(f"ebpp_clean IN ({names(V.EBPP_TEMPORARY_NAMES)})")}) AS is_temp_provider
      FROM (SELECT *, upper(trim(coalesce({EBPP}, ''))) AS ebpp_clean FROM payments)
    )"""


def pricing_rel(rx: Rx) -> str:
    one_hot = ", ".join(f"{bit(f'norm = {q(v)}')} AS {c}" for c, v in V.PRICING_MODELS.items())
    total = " - ".join(V.PRICING_MODELS)
    return f"""
    SELECT "{ID}", {PRICE} AS original_pricing_model, {one_hot},
      {bit("norm = ''")} AS pricing_model_missing,
      1 - pricing_model_missing - {total} AS pricing_model_other
    FROM (SELECT *, upper(trim(coalesce({PRICE}, ''))) AS norm FROM payments)"""


def master_rel(rx: Rx) -> str:
    switches = ", ".join(
        f'{bit(f"{c!r}".replace(chr(39), chr(34)))} AS "{n}"'
        for n, c in zip(
            ("is_BillerPaysIX", "is_InterchangePaidbyIC_Current", "is_InterchangePaidbyIC_Monthly",
             "is_IC_Bank_On_TD"),
            BOOLEAN_COLUMNS,
        )
    )
    return f"""
    SELECT {cols(PASS_THROUGH)},
      CAST(date_diff('month', "PaymentDate", {AS_OF}) AS INT) AS "Vintage_Months",
      CAST(date_diff('year', "PaymentDate", {AS_OF}) AS INT) AS "Vintage_Years",
      {bit('''"DurbinRegulated" = 'Y' ''')} AS is_durbin_regulated, {switches}
    FROM payments"""


RELATIONS = {
    "master": master_rel,
    "name": name_rel,
    "email": email_rel,
    "address": address_rel,
    "ip": ip_rel,
    "card": card_rel,
    "channel": channel_rel,
    "mcc": mcc_rel,
    "partner": partner_rel,
    "geo": geo_rel,
    "ebpp": ebpp_rel,
    "pricing": pricing_rel,
}


def family_sql(
    name: str, outputs, full: bool = False, where: str = "", tail: str = "", null_ids: bool = False,
    extra: str = "",
) -> str:
    """Statement for one family; ``outputs`` are the columns in order, ``extra`` goes behind them."""
    ctes = payments_cte(null_ids=null_ids)
    if name == "geo":
        ctes += ", " + ruca_cte()
    if name == "ebpp":
        where = f"WHERE {EBPP} IS NOT NULL"
    return f"WITH {ctes} SELECT {cols(outputs)}{extra} FROM ({RELATIONS[name](Rx(full))}) {where} {tail}"


def combined_sql(
    families, full=False, duplicates=False, repeated=False, drop=(), null_ids=False
) -> str:
    """All families joined by payment id, as separate relations.

    ``families`` holds (name, {output: column of the relation}) in output order.
    """
    rx = Rx(full)
    parts = [payments_cte(duplicates=duplicates, null_ids=null_ids), ruca_cte(repeated)]
    select, joins = [], ""
    for i, (name, outputs) in enumerate(families):
        renamed = ", ".join(f'"{c}" AS "{o}"' for o, c in outputs.items() if o != ID)
        parts.append(f'f{i} AS (SELECT "{ID}" AS id{i}, {renamed} FROM ({RELATIONS[name](rx)}))')
        select += [f'f{i}."{o}"' for o in outputs if o != ID and o not in drop]
        joins += f" LEFT JOIN f{i} ON id0 = id{i}" if i else "f0"
    return f'WITH {", ".join(parts)} SELECT id0 AS "{ID}", {", ".join(select)} FROM {joins}'
