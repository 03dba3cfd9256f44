"""Cleaning of categorical values into fixed domains."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Domains of the cleaned profile columns.
TRUCK_BANDS = [
    "b.1-11 trucks", "c.12-20 trucks", "d.21-50 trucks", "e.51-100 trucks",
    "f.101-250 trucks", "g.251-500 trucks", "h.over 500 trucks", "unknown",
]
SMALL_BANDS = TRUCK_BANDS[0:4]
MEDIUM_BANDS = TRUCK_BANDS[4:6]
LARGE_BANDS = TRUCK_BANDS[6:7]
STATES = ["CA", "TX", "FL", "OH", "IL", "GA", "MO", "NC", "TN", "PA", "UNK"]
BILLING_FREQUENCIES = ["semi-monthly", "daily", "weekly", "monthly", "unknown"]
PAYMENT_METHODS = ["CDN/ACH", "Check", "EBP/FIS", "Wire", "CustACH", "WesternUnion", "unknown"]

# Channel text to class; the first contained text decides.
CHANNEL_CLASSES = [
    ("inbound", "inbound"),
    ("outbound", "outbound"),
    ("field", "field"),
    ("telesales", "outbound"),
    ("regional", "strategic/AM"),
    ("national", "strategic/AM"),
    ("strategic", "strategic/AM"),
    ("account mgmt", "strategic/AM"),
    ("unknown", "unknown"),
]

# Sorted product combinations per bucket; others are OTHERS.
PRODUCT_BUCKETS = {
    "ECASH_ONLY": ["ECASH"],
    "ECASH_COMCHECK": ["ECASH_EXPRESS CHECK"],
    "ECASH_COMCHECK_FUEL": [
        "ECASH_EXPRESS CHECK_FUEL",
        "ECASH_EXPRESS CHECK_FUEL_MASTERCARD",
        "ECASH_EXPRESS CHECK_FUEL_PROPRIETARY",
        "ECASH_EXPRESS CHECK_PROPRIETARY",
    ],
    "ECASH_FUEL": [
        "ECASH_FUEL", "ECASH_FUEL_MASTERCARD", "ECASH_FUEL_PROPRIETARY",
        "ECASH_MASTERCARD", "ECASH_PROPRIETARY",
    ],
    "COMCHECK_ONLY": ["EXPRESS CHECK"],
    "COMCHECK_FUEL": [
        "EXPRESS CHECK_FUEL",
        "EXPRESS CHECK_FUEL_MASTERCARD",
        "EXPRESS CHECK_FUEL_MASTERCARD_PROPRIETARY",
        "EXPRESS CHECK_MASTERCARD",
        "EXPRESS CHECK_FUEL_PROPRIETARY",
        "EXPRESS CHECK_PROPRIETARY",
    ],
    "FUEL_ONLY": [
        "FUEL", "FUEL_MASTERCARD", "FUEL_MASTERCARD_PROPRIETARY", "FUEL_PROPRIETARY",
        "MASTERCARD_PROPRIETARY", "PROPRIETARY", "MASTERCARD",
    ],
}

# Right-closed credit score bins.
CREDIT_GRADES = [
    (300, "Worse"), (579, "Poor"), (669, "Fair"), (739, "Good"), (799, "Very-Good"),
]

# Call types, applied top to bottom.
CALL_TYPES_BEFORE_EFT = {
    "post call survey call back": "survey",
    "post call survey followup": "survey",
    "quarterly survey followup": "survey",
    "locationsite issues": "location site issues",
    "site": "location site issues",
    "nextraq cross sell": "crosssell",
    "ecs cross sell": "crosssell",
    "cardpin maintenance": "card pin maintenance",
    "card denial inquiry": "card pin maintenance",
    "loststolen card": "card pin maintenance",
    "billing & payments": "billing and payments",
    "billing payments": "billing and payments",
    "payment issue": "billing and payments",
    "billing inquiry": "billing and payments",
    "check by phone": "billing and payments",
}
CALL_TYPES_AFTER_EFT = {
    "eft new customer request": "billing and payments",
    "eft setup in process": "billing and payments",
    "eft change bank request": "billing and payments",
    "eft status inquiry": "billing and payments",
    "eft unenroll request": "billing and payments",
    "eft un-enroll request": "billing and payments",
    "collections attempt": "billing and payments",
    "refund request": "billing and payments",
    "serviceaccount disruption": "service account disruption",
    "service interruption": "service account disruption",
    "delinquency": "service account disruption",
    "locked account": "service account disruption",
    "credit inquiry": "credit fraud inquiry",
    "fraud investigation detection": "credit fraud inquiry",
    "fraud inquiry": "credit fraud inquiry",
    "account details & maintenance": "account details and maintenance",
    "account details maintenance": "account details and maintenance",
    "account maintenance": "account details and maintenance",
    "credit line increase": "account details and maintenance",
    "terms and conditions request": "account details and maintenance",
    "term changes": "account details and maintenance",
    "term change": "account details and maintenance",
    "disputed transaction": "transactions",
    "transaction inquiry": "transactions",
    "transaction": "transactions",
    "proprietary transaction": "transactions",
    "mastercard transaction": "transactions",
    "authorization": "transactions",
    "dispute status request": "transactions",
    "ts and cs acceptance test": "ts and cs acceptance",
    "pricing inquiry": "rebates pricing savings",
    "nsf": "billing and payments",
    "close account": "close inquiry",
    "after hours close inquiry": "close inquiry",
}
FEE_SUBTYPES = ["late fee finance charge", "high risk"]
CALL_TYPES_KEPT = [
    "account details and maintenance", "card pin maintenance", "express check",
    "tech support", "billing and payments", "fees", "online system inquiry",
    "transactions", "close inquiry",
]


def in_domain(value: Column, domain: list[str], other: str) -> Column:
    return F.when(value.isin(domain), value).otherwise(F.lit(other))


def truck_band(value: Column) -> Column:
    return in_domain(F.lower(F.coalesce(value, F.lit("unknown"))), TRUCK_BANDS, "others")


def customer_size(band: Column) -> Column:
    return (
        F.when(band.isin(SMALL_BANDS), "small")
        .when(band.isin(MEDIUM_BANDS), "medium")
        .when(band.isin(LARGE_BANDS), "large")
        .otherwise("others")
    )


def state_group(value: Column) -> Column:
    return in_domain(F.upper(F.coalesce(value, F.lit("UNK"))), STATES, "OTHERS")


def billing_frequency(value: Column) -> Column:
    return in_domain(F.lower(F.coalesce(value, F.lit("unknown"))), BILLING_FREQUENCIES, "others")


def payment_group(value: Column) -> Column:
    return in_domain(value, PAYMENT_METHODS, "unknown")


def payment_method(remittance_no: Column) -> Column:
    """Payment method from the remittance number."""
    first = F.left(remittance_no, F.lit(1))
    return (
        F.when(first == "A", "CustACH")
        .when(first == "D", "EBP/FIS")
        .when(first == "Q", "WesternUnion")
        .when(first == "W", "Wire")
        .when(F.substring(remittance_no, 3, 3) == "ACH", "CDN/ACH")
        .otherwise("Check")
    )


def channel_class(primary: Column, fallback: Column) -> Column:
    """Sales channel class; ``Unk`` counts as missing and falls back."""
    text = F.lower(F.coalesce(F.nullif(primary, F.lit("Unk")), fallback, F.lit("unknown")))
    result = F.when(text.contains(CHANNEL_CLASSES[0][0]), CHANNEL_CLASSES[0][1])
    for part, label in CHANNEL_CLASSES[1:]:
        result = result.when(text.contains(part), label)
    return result.otherwise("others")


def credit_grade(score: Column) -> Column:
    grade = F.when(score.isNull() | (score <= -1), "UNK")
    for upper, label in CREDIT_GRADES:
        grade = grade.when(score <= upper, label)
    return grade.otherwise("Excellent")


def product_combination(products: list[Column]) -> Column:
    """Distinct products sorted and joined with ``_``, without non-core and fillers."""
    values = F.array_compact(F.array(*products))
    kept = F.array_remove(F.array_remove(values, "others"), "NON-CORE")
    return F.trim(F.array_join(F.array_sort(F.array_distinct(kept)), "_"))


def product_bucket(combination: Column) -> Column:
    names = iter(PRODUCT_BUCKETS.items())
    label, members = next(names)
    bucket = F.when(combination.isin(members), label)
    for label, members in names:
        bucket = bucket.when(combination.isin(members), label)
    return bucket.otherwise("OTHERS")


def clean_text(value: Column) -> Column:
    """Single spaces, no slashes, no typographic apostrophes, lower case."""
    text = F.regexp_replace(F.coalesce(value, F.lit("")), r"\s+", " ")
    text = F.translate(text, "/’", "")
    return F.lower(F.regexp_replace(text, " +", " "))


def _mapped(value: Column, mapping: dict[str, str]) -> Column:
    literals = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.coalesce(F.try_element_at(literals, value), value)


def call_type(raw_type: Column, raw_subtype: Column) -> tuple[Column, Column]:
    """Grouped call type and cleaned subtype."""
    first = _mapped(clean_text(raw_type), CALL_TYPES_BEFORE_EFT)
    grouped = _mapped(first, CALL_TYPES_AFTER_EFT)
    # The subtype overrides look at the type as it stands at that point of the
    # list: the later override wins, and a type already regrouped no longer matches.
    subtype = (
        F.when(first.contains("nsf"), "nsf")
        .when(first.contains("refund request"), "refund request")
        .when(first.contains("collection"), "collection")
        .when(first.contains("eft"), "eft")
        .otherwise(clean_text(raw_subtype))
    )
    grouped = F.when(subtype.isin(FEE_SUBTYPES), "fees").otherwise(grouped)
    return in_domain(grouped, CALL_TYPES_KEPT, "Others"), subtype
