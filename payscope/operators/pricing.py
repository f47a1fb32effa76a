"""Pricing model: one-hot columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from payscope import fixed_values as V
from payscope.functions import rules as R
from payscope.functions import text as X
from payscope.operators.family import Family, same_names
from payscope.sources.schema import ID, PRICING_COLUMN


def _layers(c, match, options):
    text = {"norm": F.upper(X.coalesce_trim(F.col(f"`{PRICING_COLUMN}`")))}
    flags = {
        **R.one_hot(c.norm, V.PRICING_MODELS),
        "pricing_model_other": R.flag(
            ~c.norm.isin(*V.PRICING_MODELS.values()) & (c.norm != "")
        ),
        "pricing_model_missing": R.flag(c.norm == ""),
    }
    return [text, {}, flags]


_OUTPUTS = {
    "original_pricing_model": PRICING_COLUMN,
    **same_names(*V.PRICING_MODELS, "pricing_model_other", "pricing_model_missing"),
}

PRICING = Family(
    name="pricing",
    inputs=(ID, PRICING_COLUMN),
    layers=_layers,
    outputs={ID: ID, **_OUTPUTS},
    final_outputs=_OUTPUTS,
)
