"""Business rules as data.

Every table below holds fixed values that the results depend on. They are gathered in one
frozen dataclass so that a job can override any of them without touching the operators.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# US dollars per unit of each currency (yen are divided by 150).
FX_TO_USD = {"USD": 1.0, "EUR": 1.1, "GBP": 1.27, "JPY": 1 / 150}

# Currency symbols in the order in which they are looked for.
CURRENCY_SYMBOLS = {"¥": "JPY", "€": "EUR", "£": "GBP", "$": "USD"}

# Scale words and the one-letter suffixes.
SCALE_WORDS = {"thousand": 1e3, "million": 1e6, "billion": 1e9, "trillion": 1e12}
SCALE_LETTERS = {"K": 1e3, "M": 1e6, "B": 1e9, "T": 1e12}

# Revenue texts (lower case) that mean "not reported".
MISSING_REVENUE = (
    "n/a", "na", "not disclosed", "undisclosed", "null", "none", "-", "--", "nan", "missing",
)

# Cell texts that the CSV source reads as empty.
NULL_TOKENS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Source category -> taxonomy group.
CATEGORY_GROUPS = {
    "Artificial Intelligence": "AI_ML",
    "Machine Learning": "AI_ML",
    "AI/ML": "AI_ML",
    "AI & ML": "AI_ML",
    "Cloud Computing": "CLOUD_COMPUTING",
    "Cloud": "CLOUD_COMPUTING",
    "Cloud Services": "CLOUD_COMPUTING",
    "Financial Technology": "FINTECH",
    "FinTech": "FINTECH",
    "Finance": "FINTECH",
    "SaaS": "SOFTWARE",
    "Software": "SOFTWARE",
    "Enterprise Software": "SOFTWARE",
    "Cybersecurity": "CYBERSECURITY",
    "Security": "CYBERSECURITY",
    "InfoSec": "CYBERSECURITY",
    "Data Analytics": "DATA_ANALYTICS",
    "Analytics": "DATA_ANALYTICS",
    "Big Data": "DATA_ANALYTICS",
}
UNKNOWN_CATEGORY = "UNKNOWN"

# Written company name -> canonical name.
COMPANY_ALIASES = {
    "AWS": "Amazon Web Services",
    "Amazon Web Services (AWS)": "Amazon Web Services",
    "Amazon Websevices": "Amazon Web Services",
    "Azure": "Microsoft",
    "Microsoft Azure": "Microsoft",
    "DeepMind": "Google DeepMind",
    "Google Deepmind": "Google DeepMind",
    "Nvidia": "NVIDIA",
    "NVIDIA Corporation": "NVIDIA",
    "Open AI": "OpenAI",
    "OpenAI Inc.": "OpenAI",
    "Databricks Inc.": "Databricks",
    "Snowflake Inc.": "Snowflake",
    "CloudFlare": "Cloudflare",
    "Data Robot": "DataRobot",
    "Mongo DB": "MongoDB",
    "Meta AI Research": "Meta AI",
    "Facebook AI Research": "Meta AI",
    "Stripe Inc.": "Stripe",
    "Palantir Technologies": "Palantir",
    "The Boring Company / SpaceX": "SpaceX",
}

# Names known to have no metadata; only an alias may still resolve them.
UNRESOLVABLE_COMPANIES = (
    "Cohere", "xAI", "Mistral AI", "Perplexity AI", "Hugging Face", "Microsoft Azure", "Azure",
)


@dataclass(frozen=True)
class Rules:
    fx_to_usd: Mapping[str, float] = field(default_factory=lambda: dict(FX_TO_USD))
    missing_revenue: tuple[str, ...] = MISSING_REVENUE
    # "min_is_month": of two tokens that could both be months, the smaller one is the month.
    # "month_first": a leading token that could be a month always is one.
    ambiguous_dates: str = "min_is_month"
    category_groups: Mapping[str, str] = field(default_factory=lambda: dict(CATEGORY_GROUPS))
    company_aliases: Mapping[str, str] = field(default_factory=lambda: dict(COMPANY_ALIASES))
    unresolvable_companies: tuple[str, ...] = UNRESOLVABLE_COMPANIES
    # fixed values: thresholds
    fuzzy_threshold: float = 88.0
    small_below: int = 10_000
    medium_up_to: int = 30_000
    ai_groups: tuple[str, ...] = ("AI_ML",)
    ai_industries: tuple[str, ...] = ("AI/ML", "AI_ML")
    ai_year_from: int = 2022
    ai_year_to: int = 2024
    ai_arr_above: int = 50_000_000


DEFAULT_RULES = Rules()
