"""All feature families, and the plan of one family on its own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payscope.operators import frequency
from payscope.operators.address import ADDRESS
from payscope.operators.card import CARD, FULL_NUMBER
from payscope.operators.channel import CHANNEL
from payscope.operators.ebpp import EBPP
from payscope.operators.email import EMAIL
from payscope.operators.family import Family
from payscope.operators.geo import GEO, join_lookup
from payscope.operators.ip import IP
from payscope.operators.master import MASTER
from payscope.operators.mcc import MCC, MCC_FLAGS
from payscope.operators.name import NAME
from payscope.operators.partner import PARTNER
from payscope.operators.pricing import PRICING
from payscope.options import Options
from payscope.sources.schema import EBPP_COLUMN, ID

FAMILIES: dict[str, Family] = {
    f.name: f
    for f in (
        MASTER, NAME, EMAIL, ADDRESS, IP, CARD, CHANNEL, MCC, PARTNER, GEO, EBPP, PRICING,
    )
}
# Families of the combined table in output order.
COMBINED: tuple[Family, ...] = (
    MASTER, NAME, EMAIL, ADDRESS, IP, CARD, CHANNEL, MCC_FLAGS, PARTNER, GEO, EBPP, PRICING,
)


def pick_inputs(payments: DataFrame, names) -> DataFrame:
    return payments.selectExpr([f"`{n}`" for n in dict.fromkeys(names)])


def family_features(
    payments: DataFrame,
    name: str,
    ruca: DataFrame | None = None,
    options: Options = Options(),
    ordered: bool = False,
    final: bool = False,
) -> DataFrame:
    """Features of one family, one row per payment.

    Reads only the columns the family needs. ``ordered`` sorts by falling score (a range-partitioned
    sort of all rows); ``final`` gives the columns of the combined table, led by the id.
    """
    if name not in FAMILIES:
        raise ValueError(f"unknown family {name!r}; one of {', '.join(FAMILIES)}")
    family = {f.name: f for f in COMBINED}[name] if final else FAMILIES[name]
    source = pick_inputs(payments, family.inputs)
    rows = source
    if name == "geo":
        rows = rows.where(F.col("Zip").isNotNull())
        if ruca is None:
            raise ValueError("family 'geo' needs the ZIP lookup")
        rows = join_lookup(rows, ruca, options.dedupe_lookup)
    elif name == "ebpp" and not final:
        rows = rows.where(F.col(f"`{EBPP_COLUMN}`").isNotNull())
    for key_stats in family.stats:
        rows = frequency.attach(rows, source, key_stats, options.hot_rows)
    for step in family.steps(options, payments.sparkSession):
        rows = rows.withColumns(step) if step else rows
    columns = family.select(rows.columns, final)
    if final and ID not in family.final_outputs:
        columns = [f"`{ID}`", *columns]
    rows = rows.selectExpr(columns)
    if name == "card" and not options.expose_card_number:
        rows = rows.drop(FULL_NUMBER)
    return by_score(rows, family.score) if ordered and family.score else rows


def by_score(features: DataFrame, score: str) -> DataFrame:
    """All rows by falling score; the id breaks ties."""
    return features.orderBy(F.desc(score), F.asc(ID))


def top_k(features: DataFrame, score: str, k: int) -> DataFrame:
    """The k riskiest rows without sorting the rest."""
    return by_score(features, score).limit(k)
