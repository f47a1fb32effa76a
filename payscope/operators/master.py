"""Master columns: pass-through fees and revenue, payment vintage, switches as 0/1."""

from __future__ import annotations

from pyspark.sql import functions as F

from payscope.functions import rules as R
from payscope.functions.numbers import day_of, months_crossed, years_crossed
from payscope.operators.family import Family, same_names
from payscope.sources.schema import BOOLEAN_COLUMNS, ID, PASS_THROUGH

SWITCHES = {
    "is_BillerPaysIX": "BillerPaysIX",
    "is_InterchangePaidbyIC_Current": "InterchangePaidbyIC_Current",
    "is_InterchangePaidbyIC_Monthly": "InterchangePaidbyIC_Monthly",
    "is_IC_Bank_On_TD": "IC Bank on TD",
}


def _layers(c, match, options):
    paid, today = F.col("PaymentDate"), day_of(options.as_of)
    flags = {
        "Vintage_Months": months_crossed(paid, today),
        "Vintage_Years": years_crossed(paid, today),
        "is_durbin_regulated": R.flag(F.col("DurbinRegulated") == "Y"),
        **{name: R.flag(F.col(f"`{switch}`")) for name, switch in SWITCHES.items()},
    }
    return [{}, {}, flags]


_OUTPUTS = same_names(
    *PASS_THROUGH, "Vintage_Months", "Vintage_Years", "is_durbin_regulated", *SWITCHES
)

MASTER = Family(
    name="master",
    inputs=(*PASS_THROUGH, *BOOLEAN_COLUMNS),
    layers=_layers,
    outputs=_OUTPUTS,
    final_outputs=_OUTPUTS,
)
assert _OUTPUTS[ID] == ID
