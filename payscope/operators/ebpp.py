"""Bill-pay provider being replaced: tiers, in-house, government and temporary providers."""

from __future__ import annotations

from pyspark.sql import functions as F

from payscope import fixed_values as V
from payscope.functions import rules as R
from payscope.functions import text as X
from payscope.operators.family import Family, same_names
from payscope.sources.schema import EBPP_COLUMN, ID


def _layers(c, match, options):
    text = {"ebpp_clean": F.upper(X.coalesce_trim(F.col(f"`{EBPP_COLUMN}`")))}
    flags = {
        "is_unknown_ebpp": R.flag(~c.ebpp_clean.isin(*V.EBPP_KNOWN)),
        "ebpp_tier1": R.flag(c.ebpp_clean.isin(*V.EBPP_TIER1)),
        "ebpp_tier2": R.flag(c.ebpp_clean.isin(*V.EBPP_TIER2)),
        "ebpp_tier3": R.flag(c.ebpp_clean.isin(*V.EBPP_TIER3)),
        "is_inhouse_gateway": R.flag(X.contains_any(c.ebpp_clean, V.EBPP_INHOUSE_TEXTS)),
        "is_gov_provider": R.flag(X.contains_any(c.ebpp_clean, V.EBPP_GOVERNMENT_TEXTS)),
        "is_temp_provider": R.flag(
            X.contains_any(c.ebpp_clean, V.EBPP_TEMPORARY_TEXTS)
            | c.ebpp_clean.isin(*V.EBPP_TEMPORARY_NAMES)
        ),
    }
    score = {
        "ebpp_risk_score": R.weighted_score(
            [
                (R.on(c.is_unknown_ebpp), 7),
                (R.on(c.ebpp_tier1), -2),
                (R.on(c.ebpp_tier3), 3),
                (R.on(c.is_inhouse_gateway), 4),
                (R.on(c.is_temp_provider), 6),
            ]
        )
    }
    # 'Monitor' cannot occur with these weights: no sum is 1 or 2.
    advice = {
        "ebpp_replacement_recommendation": R.first_match(
            [
                (c.ebpp_risk_score >= 6, "High Priority Replacement"),
                (c.ebpp_risk_score >= 3, "Consider Replacement"),
                (c.ebpp_risk_score > 0, "Monitor"),
            ],
            "No Action Needed",
        )
    }
    return [text, {}, flags, {}, score, advice]


_FLAGS = (
    "ebpp_clean", "is_unknown_ebpp", "ebpp_tier1", "ebpp_tier2", "ebpp_tier3",
    "is_inhouse_gateway", "is_gov_provider", "is_temp_provider",
)

EBPP = Family(
    name="ebpp",
    inputs=(ID, EBPP_COLUMN),
    layers=_layers,
    outputs=same_names(
        ID, EBPP_COLUMN, *_FLAGS, "ebpp_risk_score", "ebpp_replacement_recommendation"
    ),
    final_outputs={"original_ebpp": EBPP_COLUMN, **same_names(*_FLAGS)},
    score="ebpp_risk_score",
)
