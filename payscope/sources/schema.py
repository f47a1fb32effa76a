"""Declared schemas of the payment fact table and the ZIP rurality lookup."""

from __future__ import annotations

from pyspark.sql import types as T

ID = "PaymentIDBillerIDMerchantOrder"
EBPP_COLUMN = "What EBPP are we replacing?"
PRICING_COLUMN = "Pricing Model"

TIERS = (1, 2, 3)
TIER_FEES = (
    "Biller Pricing Fee Rate (Tier {n})",
    "Biller Pricing Fee Amount (Tier {n})",
    "Biller Pricing Fee Surcharge (Tier {n})",
    "Biller Pricing Tier Max (Tier {n})",
)

# Numeric columns that pass through to the feature table unchanged, in output order. They come in
# four runs because other pass-through columns stand between them in the output.
FEES_1 = ("ConvenienceFee", "Amount")
FEES_2 = (
    "InterchangeUnitFee",
    "InterchangeFaceVFeePercent",
    "TotalInterchangeAmount",
    "TotalAssessmentAmount",
    "AdjustedInterchangeUnitFee",
    "AdjustedInterchangeFaceVFeePercent",
    "PAYMENTAMOUNT_WITHOUT_CONVENIENCEFEE",
    "NUM_TRANSACTIONS_ON_MERCHANT_ORDER",
    "NUM_MERCHANT_ORDERS",
    "NUM_MERCHANT_ORDERS_NO_SERVICE_FEES",
    "LIC_INT_FIXED",
    "LIC_INT_VARIABLE",
    "LIC_ASSESSMENT_VARIABLE",
    "LIC_PTECH_VARIABLE",
    "LIC_PTECH_FIXED",
    "LIC_TOTAL_FIXED_COSTS",
    "LIC_TOTAL_VARIABLE_COSTS",
    "Service Fee Amount",
    "Service Fee Rate",
    "Service Fee Surcharge",
)
FEES_3 = tuple(fee.format(n=n) for n in TIERS for fee in TIER_FEES)
FEES_4 = (
    "Service Fee Gross Revenue",
    "Biller Paid Gross Revenue",
    "Fixed Gross Revenue",
    "Variable Gross Revenue",
    "Total Gross Revenue",
    "Processing Cost Paid by InvoiceCloud",
    "Total Processing Cost Includes Cost+",
    "Total Net Revenue",
)
NUMERIC_COLUMNS = FEES_1 + FEES_2 + FEES_3 + FEES_4

PASS_THROUGH = (
    (ID, "BillerID", "TDNum", "PaymentDate", "SettledDate", "PaymentAmount")
    + FEES_1
    + ("DurbinRegulated",)
    + FEES_2
    + FEES_3
    + ("CALCULATIONTYPE",)
    + FEES_4
)

TEXT_COLUMNS = (
    "BillerID",
    "TDNum",
    "CustomerID",
    "Payment_CustomerName",
    "Address1",
    "EmailAddress",
    "RemoteIP",
    "Cardnumber",
    "PaymentSourceDesc",
    "MCC_DESCRIPTION",
    "Partner",
    EBPP_COLUMN,
    PRICING_COLUMN,
    "Zip",
    "State",
    "DurbinRegulated",
    "CALCULATIONTYPE",
    "InterchangeQualCode",
)
BOOLEAN_COLUMNS = (
    "BillerPaysIX",
    "InterchangePaidbyIC_Current",
    "InterchangePaidbyIC_Monthly",
    "IC Bank on TD",
)

PAYMENTS = T.StructType(
    [T.StructField(ID, T.StringType(), False)]
    + [T.StructField(c, T.StringType()) for c in TEXT_COLUMNS]
    + [T.StructField(c, T.DoubleType()) for c in ("BillingLatitude", "BillingLongitude")]
    + [T.StructField("PaymentAmount", T.DecimalType(18, 2))]
    + [T.StructField(c, T.TimestampType()) for c in ("PaymentDate", "SettledDate")]
    + [T.StructField(c, T.BooleanType()) for c in BOOLEAN_COLUMNS]
    + [T.StructField(c, T.DecimalType(18, 6)) for c in NUMERIC_COLUMNS]
)

RUCA = T.StructType(
    [
        T.StructField("ZIP_CODE", T.StringType()),
        T.StructField("RUCA1", T.IntegerType()),
        T.StructField("RUCA2", T.DoubleType()),
        T.StructField("STATE", T.StringType()),
    ]
)
