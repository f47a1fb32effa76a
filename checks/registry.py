"""Every registered query: the Spark call and, where SQL can say it, the DuckDB statement."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import oracle as O
from payscope import FAMILIES, Options, assemble_features, family_features, tune
from payscope.functions import numbers as N
from payscope.functions import rules as R
from payscope.functions import text as X
from payscope.operators import frequency, profile
from payscope.operators.card import FULL_NUMBER
from payscope.operators.channel import STATS as CHANNEL_STATS
from payscope.operators.channel import payment_group
from payscope.operators.families import COMBINED, by_score, top_k
from payscope.operators.geo import join_lookup
from payscope.operators.partner import PER_ID, VOLUME
from payscope.sources import derived
from payscope.sources.schema import EBPP_COLUMN, ID, PRICING_COLUMN
from payscope.sources.tables import read_payments, read_ruca, scratch_path, write_features
from payscope import fixed_values as V

Query = Callable[[SparkSession, str], DataFrame]
AS_OF = date(2002, 1, 15)
BASE = Options(as_of=AS_OF, expose_card_number=True)
# Low enough to split the keys of the small test tables into hot and other ones.
SPLIT = Options(as_of=AS_OF, expose_card_number=True, hot_rows=200)
FULL_MATCH = Options(as_of=AS_OF, expose_card_number=True, match="full")

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(query: Query) -> Query:
        QUERIES[name] = lambda spark, sf: query(tune(spark), sf)
        if sql is not None:
            ORACLE[name] = sql
        return query

    return add


def over_payments(name: str, sql: str):
    """Registers a query over payments; ``{p}`` in the SQL is the payments CTE."""

    def add(query: Callable[[DataFrame], DataFrame]):
        QUERIES[name] = lambda spark, sf: query(derived.payments(tune(spark), sf))
        ORACLE[name] = sql.replace("{p}", "WITH " + O.payments_cte())
        return query

    return add


# --- families ---------------------------------------------------------------------------------


def _family(name: str, options: Options, ordered: bool = False) -> Query:
    def query(spark, sf):
        ruca = derived.ruca(spark, sf) if name == "geo" else None
        return family_features(derived.payments(spark, sf), name, ruca, options, ordered)

    return query


for _name, _fam in FAMILIES.items():
    register(f"{_name}_features", O.family_sql(_name, _fam.outputs))(_family(_name, BASE))
    if _fam.stats:
        register(f"{_name}_features_split", O.family_sql(_name, _fam.outputs))(
            _family(_name, SPLIT)
        )
for _name in ("name", "address", "email", "ip", "card", "channel", "mcc"):
    register(
        f"{_name}_features_full_match", O.family_sql(_name, FAMILIES[_name].outputs, full=True)
    )(_family(_name, FULL_MATCH))

# --- the combined table -----------------------------------------------------------------------

# Columns of the oracle relations behind the combined outputs.
_COMBINED_SQL = [
    (f.name, {o: o for o in f.final_outputs} if f.name in ("geo", "pricing", "master")
     else dict(f.final_outputs))
    for f in COMBINED
]


def _combined(
    options: Options, mode: str, duplicates=False, repeated=False, null_ids=False
) -> Query:
    def query(spark, sf):
        payments = derived.payments(spark, sf, duplicates, null_ids)
        return assemble_features(payments, derived.ruca(spark, sf, repeated), options, mode)

    return query


register("assemble_features", O.combined_sql(_COMBINED_SQL))(_combined(BASE, "single"))
register("assemble_features_split", O.combined_sql(_COMBINED_SQL))(_combined(SPLIT, "single"))
register("assemble_features_full_match", O.combined_sql(_COMBINED_SQL, full=True))(
    _combined(FULL_MATCH, "single")
)
register("assemble_features_repeated_zip", O.combined_sql(_COMBINED_SQL, repeated=True))(
    _combined(BASE, "single", repeated=True)
)
register("assemble_features_null_id", O.combined_sql(_COMBINED_SQL, null_ids=True))(
    _combined(SPLIT, "single", null_ids=True)
)
register("left_join_assemble_null_id", O.combined_sql(_COMBINED_SQL, null_ids=True))(
    _combined(BASE, "join", null_ids=True)
)
register(
    "partner_features_null_id", O.family_sql("partner", FAMILIES["partner"].outputs, null_ids=True)
)(
    lambda spark, sf: family_features(
        derived.payments(spark, sf, null_ids=True), "partner", options=SPLIT
    )
)
register("assemble_features_masked", O.combined_sql(_COMBINED_SQL, drop=(FULL_NUMBER,)))(
    _combined(Options(as_of=AS_OF), "single")
)
register(
    "left_join_assemble", O.combined_sql(_COMBINED_SQL, duplicates=True, repeated=True)
)(_combined(BASE, "join", duplicates=True, repeated=True))

# --- sources, sinks, samples, profiles --------------------------------------------------------

_STAMPS = """{p} SELECT * REPLACE (CAST("PaymentDate" AS TIMESTAMP) AS "PaymentDate",
    CAST("SettledDate" AS TIMESTAMP) AS "SettledDate") FROM payments"""


def _declared(payments: DataFrame) -> DataFrame:
    return payments.withColumns(
        {c: F.col(c).cast("timestamp") for c in ("PaymentDate", "SettledDate")}
    )


@over_payments("scan_payments", _STAMPS)
def _scan_payments(p):
    path = scratch_path(p.sparkSession, "payments")
    _declared(p).write.parquet(path)
    return read_payments(p.sparkSession, path)


@over_payments("scan_payments_table", _STAMPS)
def _scan_payments_table(p):
    table = "payments_" + uuid.uuid4().hex
    _declared(p).write.saveAsTable(table)
    return read_payments(p.sparkSession, table=table)


register("scan_ruca", f"WITH {O.ruca_cte()} SELECT * FROM ruca")(derived.ruca)


@register("scan_ruca_parquet", f"WITH {O.ruca_cte()} SELECT * FROM ruca")
def _scan_ruca_parquet(spark, sf):
    path = scratch_path(spark, "ruca")
    derived.ruca(spark, sf).write.parquet(path)
    return read_ruca(spark, path)


@register("sink_features", O.combined_sql(_COMBINED_SQL))
def _sink_features(spark, sf):
    path = scratch_path(spark, "features")
    write_features(_combined(BASE, "single")(spark, sf), path=path)
    return spark.read.parquet(path)


@register("sink_features_table", O.combined_sql(_COMBINED_SQL))
def _sink_features_table(spark, sf):
    table = "features_" + uuid.uuid4().hex
    features = _combined(BASE, "single")(spark, sf)
    write_features(features.limit(1), table=table)
    write_features(features, table=table)
    return spark.table(table)


def _in_sample(fraction: float) -> str:
    return f"""CAST('0x' || md5(coalesce("{ID}", ''))[:{profile.HASH_DIGITS}] AS BIGINT)
        < {profile.sample_limit(fraction)}"""


for _name, _fraction in (("sample_rows", 0.02), ("sample_rows_few", 0.003)):
    over_payments(_name, f"{{p}} SELECT * FROM payments WHERE {_in_sample(_fraction)}")(
        lambda p, fraction=_fraction: profile.sample_rows(p, fraction)
    )
over_payments("preview", f'{{p}} SELECT * FROM payments ORDER BY "{ID}" LIMIT 5')(
    lambda p: profile.preview(p, 5, ID)
)


def _profile_sql(measure: str, label: str) -> str:
    from payscope.sources.schema import BOOLEAN_COLUMNS, NUMERIC_COLUMNS

    types = {
        **{c: "decimal(18,6)" for c in NUMERIC_COLUMNS},
        **{c: "boolean" for c in BOOLEAN_COLUMNS},
        "BillingLatitude": "double",
        "BillingLongitude": "double",
        "PaymentAmount": "decimal(18,2)",
        "PaymentDate": "timestamp_ntz",
        "SettledDate": "timestamp_ntz",
    }
    columns = list(derived.payment_expressions())
    rows = " UNION ALL ".join(
        f"SELECT {i} AS position, {O.q(c)} AS column_name,"
        f" '{types.get(c, 'string')}' AS data_type, {measure.format(c)} AS {label} FROM payments"
        for i, c in enumerate(columns, start=1)
    )
    return "{p} " + rows


over_payments("profile_schema", _profile_sql('count("{}")', "non_null_count"))(
    profile.profile_schema
)
over_payments("profile_nulls", _profile_sql('count(*) - count("{}")', "null_count"))(
    profile.profile_nulls
)
over_payments("profile_unique", '{p} SELECT DISTINCT "MCC_DESCRIPTION" FROM payments')(
    lambda p: profile.profile_unique(p, "MCC_DESCRIPTION")
)
over_payments(
    "profile_unique_qual_code", '{p} SELECT DISTINCT "InterchangeQualCode" FROM payments'
)(lambda p: profile.profile_unique(p, "InterchangeQualCode"))
over_payments(
    "profile_value_counts",
    f'{{p}} SELECT {O.PRICE}, count(*) AS "count" FROM payments GROUP BY 1',
)(lambda p: profile.profile_value_counts(p, PRICING_COLUMN))
# The client-side frame of the sample: here its column profile, computed where the data is.
over_payments(
    "to_frame",
    _profile_sql('count("{}")', "non_null_count").replace(
        "FROM payments", f"FROM payments WHERE {_in_sample(0.02)}"
    ),
)(lambda p: profile.profile_schema(profile.sample_rows(p, 0.02)))

# --- relational operators ---------------------------------------------------------------------

over_payments(
    "project",
    f'{{p}} SELECT "{ID}", "EmailAddress" AS original_email, {O.EBPP} AS original_ebpp'
    " FROM payments",
)(
    lambda p: p.select(
        ID,
        F.col("EmailAddress").alias("original_email"),
        F.col(f"`{EBPP_COLUMN}`").alias("original_ebpp"),
    )
)
over_payments(
    "filter_nonblank",
    f'{{p}} SELECT "{ID}", "Address1" FROM payments WHERE trim("Address1") <> \'\'',
)(lambda p: p.select(ID, "Address1").where(X.coalesce_trim(F.col("Address1")) != ""))
register(
    "filter_zip_notnull",
    f'WITH {O.payments_cte()} SELECT "{ID}", "Zip" FROM payments WHERE "Zip" IS NOT NULL',
)(
    lambda spark, sf: _family("geo", BASE)(spark, sf).select(ID, F.col("original_zip").alias("Zip"))
)
over_payments(
    "filter_ebpp_notnull",
    f'{{p}} SELECT "{ID}", {O.EBPP} FROM payments WHERE {O.EBPP} IS NOT NULL',
)(
    lambda p: family_features(p, "ebpp", options=BASE).select(
        ID, f"`{EBPP_COLUMN}`"
    )
)


def _key_stats(family: str, key: str, columns: dict[str, str]):
    """The engine's own statistics per key value, blank ones left out."""
    stats = FAMILIES[family].stats[0]

    def query(p):
        found = stats.stats(p.select([f"`{c}`" for c in FAMILIES[family].inputs]))
        return found.where(F.col(stats.key_column) != "").select(
            F.col(stats.key_column).alias(key), *[F.col(c).alias(o) for o, c in columns.items()]
        )

    return query


def _attached(stats, inputs, column: str):
    def query(p):
        source = p.select([f"`{c}`" for c in inputs])
        found = frequency.attach(source, source, stats, None)
        return found.select(ID, F.col(stats.columns[0]).alias(column))

    return query


over_payments(
    "left_join_freq",
    f"""{{p}} SELECT "{ID}", coalesce(n, 0) AS ip_frequency FROM payments
    LEFT JOIN (SELECT trim("RemoteIP") AS ip, count(*) AS n FROM payments
               WHERE trim("RemoteIP") <> '' GROUP BY 1) ON trim("RemoteIP") = ip""",
)(_attached(FAMILIES["ip"].stats[0], FAMILIES["ip"].inputs, "ip_frequency"))


@over_payments(
    "left_join_group",
    f"""{{p}}, grouped AS (
      SELECT "{ID}", "CustomerID", "PaymentSourceDesc",
        {O.group_of('upper(trim("PaymentSourceDesc"))')} AS payment_group FROM payments)
    SELECT "{ID}", payment_group, coalesce(n, 0) AS group_frequency,
      coalesce(customers, 0) AS group_distinct_customers
    FROM grouped LEFT JOIN (
      SELECT payment_group AS g, count(*) AS n, count(DISTINCT "CustomerID") AS customers
      FROM grouped WHERE trim("PaymentSourceDesc") <> '' GROUP BY 1) ON payment_group = g""",
)
def _left_join_group(p):
    source = p.select(ID, "PaymentSourceDesc", "CustomerID")
    found = frequency.attach(source, source, CHANNEL_STATS, None)
    channel = F.upper(X.coalesce_trim(F.col("PaymentSourceDesc")))
    return found.select(
        ID,
        payment_group(channel).alias("payment_group"),
        F.col("__channel_group_frequency").alias("group_frequency"),
        F.col("__channel_group_distinct_customers").alias("group_distinct_customers"),
    )


_LOOKUP_SQL = """SELECT "{id}", "Zip", zip5, "RUCA1" FROM (
      SELECT *, regexp_replace("Zip", '[^A-Za-z0-9]', '', 'g')[:5] AS zip5 FROM payments)
    LEFT JOIN {lookup}
    ON zip5 = lookup_zip"""


def _lookup(dedupe: bool) -> Query:
    def query(spark, sf):
        p = derived.payments(spark, sf).select(ID, "Zip")
        found = join_lookup(p, derived.ruca(spark, sf, repeated=True), dedupe)
        return found.select(
            ID, "Zip", F.col("__geo_zip_5digit").alias("zip5"), F.col("__geo_RUCA1").alias("RUCA1")
        )

    return query


_ZIPS = """(SELECT {d} regexp_replace("ZIP_CODE", '[^A-Za-z0-9]', '', 'g')[:5] AS lookup_zip,
      "RUCA1" FROM ruca)"""
for _key, _dedupe in (("left_join_lookup", False), ("left_join_lookup_deduped", True)):
    _zips = _ZIPS.format(d="DISTINCT" if _dedupe else "")
    register(
        _key,
        f"WITH {O.payments_cte()}, {O.ruca_cte(True)} "
        + _LOOKUP_SQL.format(id=ID, lookup=_zips),
    )(_lookup(_dedupe))


over_payments(
    "scalar_subquery_count",
    f"""{{p}} SELECT "{ID}",
      (SELECT count(*) FROM payments b WHERE b."Partner" = a."Partner") AS same_partner
    FROM payments a""",
)(_attached(VOLUME, [ID, "Partner"], "same_partner"))
register(
    "scalar_subquery_distinct",
    f"""WITH {O.payments_cte(duplicates=True)} SELECT "{ID}",
      (SELECT count(DISTINCT b."Partner") FROM payments b WHERE b."{ID}" = a."{ID}") AS partners
    FROM payments a""",
)(
    lambda spark, sf: _attached(PER_ID, [ID, "Partner"], "partners")(
        derived.payments(spark, sf, duplicates=True)
    )
)
register(
    "scalar_subquery_distinct_null_id",
    f"""WITH {O.payments_cte(null_ids=True)} SELECT "{ID}",
      (SELECT count(DISTINCT b."Partner") FROM payments b WHERE b."{ID}" = a."{ID}") AS partners
    FROM payments a""",
)(
    lambda spark, sf: _attached(PER_ID, [ID, "Partner"], "partners")(
        derived.payments(spark, sf, null_ids=True)
    )
)
over_payments(
    "agg_count",
    """{p} SELECT lower(trim("EmailAddress")) AS email_key, count(*) AS email_frequency
    FROM payments WHERE trim("EmailAddress") <> '' GROUP BY 1""",
)(_key_stats("email", "email_key", {"email_frequency": "__email_email_frequency"}))
over_payments(
    "agg_count_distinct",
    """{p} SELECT upper(trim("PaymentSourceDesc")) AS channel, count(*) AS channel_frequency,
      count(DISTINCT "CustomerID") AS distinct_customers
    FROM payments WHERE trim("PaymentSourceDesc") <> '' GROUP BY 1""",
)(
    _key_stats(
        "channel", "channel",
        {"channel_frequency": "__channel_channel_frequency",
         "distinct_customers": "__channel_distinct_customers"},
    )
)
over_payments(
    "agg_sum",
    """{p} SELECT upper(trim("MCC_DESCRIPTION")) AS mcc,
      CAST(sum(coalesce("PaymentAmount", 0)) AS DECIMAL(28, 2)) AS total_amount
    FROM payments WHERE trim("MCC_DESCRIPTION") <> '' GROUP BY 1""",
)(_key_stats("mcc", "mcc", {"total_amount": "__mcc_total_amount"}))


# The position of a row in the sorted output: partition by partition, row by row.
def _sorted(name: str) -> Query:
    def query(spark, sf):
        path = scratch_path(spark, "sorted")
        _family(name, BASE, ordered=True)(spark, sf).select(
            "*", F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().alias("__row")
        ).write.parquet(path)
        rows = spark.read.parquet(path)
        sizes = {r[0]: r[1] for r in rows.groupBy("__part").count().collect()}
        before, offsets = 0, []
        for part in sorted(sizes):
            offsets.append((part, before))
            before += sizes[part]
        base = spark.createDataFrame(offsets or [(0, 0)], "__part int, __before long")
        within = F.col("__row") - F.shiftleft(F.col("__part").cast("long"), 33)
        return rows.join(F.broadcast(base), "__part").withColumn(
            "position", F.col("__before") + within + 1
        ).drop("__part", "__row", "__before")

    return query


for _name, _fam in FAMILIES.items():
    if _fam.score:
        register(
            "sort_score" if _name == "email" else f"sort_score_{_name}",
            O.family_sql(
                _name, _fam.outputs,
                extra=f', row_number() OVER (ORDER BY {_fam.score} DESC, "{ID}") AS position',
            ),
        )(_sorted(_name))
register(
    "limit_rows",
    O.family_sql(
        "address", FAMILIES["address"].outputs, tail=f'ORDER BY address_risk_score DESC, "{ID}" LIMIT 100'
    ),
)(lambda spark, sf: top_k(_family("address", BASE)(spark, sf), "address_risk_score", 100))


# The band is taken of a score computed in the same row.
_ALIASED = ("channel_risk_score", "channel_risk_category")
register("lateral_alias", O.family_sql("channel", (ID, *_ALIASED)))(
    lambda spark, sf: _family("channel", BASE)(spark, sf).select(ID, *_ALIASED)
)


# --- scalar functions -------------------------------------------------------------------------


def function(name: str, outputs: dict[str, tuple], where: str = "payments"):
    """Registers a scalar function: output -> (Spark column, DuckDB expression)."""

    def query(p):
        return p.select(ID, *[spark().alias(o) for o, (spark, _) in outputs.items()])

    select = ", ".join(f"{sql} AS {o}" for o, (_, sql) in outputs.items())
    over_payments(name, f'{{p}} SELECT "{ID}", {select} FROM {where}')(query)


def col(name: str):
    return F.col(f"`{name}`")


_SEARCH, _FULL = X.Matcher("search"), X.Matcher("full")
_NAME = """regexp_replace(trim(coalesce("Payment_CustomerName", '')), '\\s+', ' ', 'g')"""


def _clean_name():
    return X.collapse_ws(X.coalesce_trim(col("Payment_CustomerName")))


function(
    "fn_coalesce_trim",
    {"v": (lambda: X.coalesce_trim(col("Zip")), """trim(coalesce("Zip", ''))""")},
)
function(
    "fn_collapse_ws",
    {"v": (lambda: X.collapse_ws(col("Payment_CustomerName")),
           """regexp_replace("Payment_CustomerName", '\\s+', ' ', 'g')""")},
)
function(
    "fn_strip_nondigit",
    {"v": (lambda: X.strip_nondigit(col("Cardnumber")),
           """regexp_replace("Cardnumber", '[^0-9]', '', 'g')""")},
)
function(
    "fn_strip_nonalnum",
    {
        "v": (lambda: X.strip_nonalnum(col("Zip")),
              """regexp_replace("Zip", '[^A-Za-z0-9]', '', 'g')"""),
        "five": (lambda: X.zip5(col("Zip")),
                 """regexp_replace("Zip", '[^A-Za-z0-9]', '', 'g')[:5]"""),
    },
)
function(
    "fn_regexp_like",
    {
        "found": (lambda: _SEARCH.regex(col("Address1"), r"\d{5}"),
                  """regexp_matches("Address1", '\\d{5}')"""),
        "whole": (lambda: _FULL.regex(col("Address1"), r"\d{5}"),
                  """regexp_full_match("Address1", '\\d{5}')"""),
    },
)
function(
    "fn_regexp_count",
    {
        "matches": (lambda: F.regexp_count(col("Address1"), F.lit(r"\S+")),
                    """CAST(len(regexp_extract_all("Address1", '\\S+')) AS INT)"""),
        "words": (lambda: X.word_count(_clean_name()),
                  f"CAST(len(regexp_extract_all({_NAME}, '\\S+')) AS INT)"),
    },
)
function(
    "fn_regexp_substr",
    {
        "first_match": (lambda: F.regexp_substr(_clean_name(), F.lit(r"^\S+")),
                        f"nullif(regexp_extract({_NAME}, '^\\S+'), '')"),
        "first_word": (lambda: X.first_word(_clean_name()),
                       f"nullif(regexp_extract({_NAME}, '^\\S+'), '')"),
        "last_word": (lambda: X.last_word(_clean_name()),
                      f"nullif(regexp_extract({_NAME}, '\\S+$'), '')"),
    },
)
function(
    "fn_split_part",
    {
        f"part{i}": (lambda i=i: F.split_part(col("EmailAddress"), F.lit("@"), F.lit(i)),
                     f"""split_part("EmailAddress", '@', {i})""")
        for i in (1, 2, 3)
    },
)
function(
    "fn_try_to_number",
    {
        "v": (lambda: N.try_to_number(F.split_part(col("RemoteIP"), F.lit("."), F.lit(1))),
              """CASE WHEN regexp_full_match(split_part("RemoteIP", '.', 1), ' *[+-]?[0-9]+ *')
              THEN TRY_CAST(split_part("RemoteIP", '.', 1) AS DECIMAL(38, 0)) END"""),
    },
)
function(
    "fn_upper_lower_length",
    {
        "up": (lambda: F.upper("Address1"), 'upper("Address1")'),
        "low": (lambda: F.lower("Address1"), 'lower("Address1")'),
        "n": (lambda: F.length("Address1"), 'CAST(length("Address1") AS INT)'),
    },
)
function("fn_upper", {"v": (lambda: F.upper("MCC_DESCRIPTION"), 'upper("MCC_DESCRIPTION")')})
function("fn_lower", {"v": (lambda: F.lower("EmailAddress"), 'lower("EmailAddress")')})
function(
    "fn_length",
    {"v": (lambda: F.length("MCC_DESCRIPTION"), 'CAST(length("MCC_DESCRIPTION") AS INT)')},
)
function("fn_left", {"v": (lambda: F.left("Cardnumber", F.lit(6)), 'left("Cardnumber", 6)')})
function("fn_right", {"v": (lambda: F.right("Cardnumber", F.lit(4)), 'right("Cardnumber", 4)')})
function(
    "fn_repeat_concat",
    {
        "v": (lambda: X.mask_all_but_last(X.strip_nondigit(X.coalesce_trim(col("Cardnumber"))), 4),
              """repeat('*', length(d) - 4) || right(d, 4)"""),
    },
    where="""(SELECT *, regexp_replace(coalesce("Cardnumber", ''), '[^0-9]', '', 'g') AS d
              FROM payments)""",
)
function(
    "fn_like",
    {
        "inside": (lambda: R.flag(X.contains_any(col("Partner"), ["Munis", "Water"])),
                   O.bit('''"Partner" LIKE '%Munis%' OR "Partner" LIKE '%Water%' ''')),
        "ends": (lambda: R.flag(col("EmailAddress").endswith("yahoo.com")),
                 O.bit('''"EmailAddress" LIKE '%yahoo.com' ''')),
    },
)
function(
    "fn_in",
    {"v": (lambda: R.flag(F.upper(X.coalesce_trim(col(EBPP_COLUMN))).isin(*V.EBPP_TIER1)),
           O.bit(f"upper(trim({O.EBPP})) IN ({O.names(V.EBPP_TIER1)})"))},
)
function(
    "fn_not_in",
    {"v": (lambda: R.flag(~F.upper(X.coalesce_trim(col(EBPP_COLUMN))).isin(*V.EBPP_KNOWN)),
           O.bit(f"upper(trim(coalesce({O.EBPP}, ''))) NOT IN ({O.names(V.EBPP_KNOWN)})"))},
)
function(
    "fn_between",
    {
        "number": (lambda: R.flag(col("BillingLatitude").between(-10, 10)),
                   O.bit('"BillingLatitude" >= -10 AND "BillingLatitude" <= 10')),
        "text": (lambda: R.flag(col("Cardnumber").between("222100", "272099")),
                 O.bit("""'222100' <= "Cardnumber" AND "Cardnumber" <= '272099' """)),
    },
)
function(
    "fn_case",
    {"v": (lambda: R.first_match([(col("PaymentAmount") > 1000, "large"),
                                  (col("PaymentAmount") > 100, "middle")], "small"),
           """CASE WHEN "PaymentAmount" > 1000 THEN 'large'
              WHEN "PaymentAmount" > 100 THEN 'middle' ELSE 'small' END""")},
)
function(
    "fn_datediff",
    {
        "months": (lambda: N.months_crossed(col("PaymentDate"), F.lit(AS_OF)),
                   f"""CAST(date_diff('month', "PaymentDate", {O.AS_OF}) AS INT)"""),
        "years": (lambda: N.years_crossed(col("PaymentDate"), F.lit(AS_OF)),
                  f"""CAST(date_diff('year', "PaymentDate", {O.AS_OF}) AS INT)"""),
    },
)
function(
    "fn_current_date",
    {"is_past": (lambda: R.flag(col("PaymentDate") <= N.day_of(None)),
                 O.bit('"PaymentDate" <= current_date'))},
)
function(
    "fn_bool_eq",
    {"v": (lambda: R.flag(col("IC Bank on TD")), O.bit('"IC Bank on TD" = TRUE'))},
)
function(
    "fn_risk_bucket",
    {"v": (lambda: R.risk_bucket(F.length(X.coalesce_trim(col("Zip"))) * 2),
           O.band("""(length(trim(coalesce("Zip", ''))) * 2)"""))},
)
