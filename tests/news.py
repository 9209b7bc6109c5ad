"""Writes article and company files whose every cell has a known meaning."""

import csv
import datetime as dt
import json

from obslake.rules import CATEGORY_GROUPS
from tests.companies import COMPANIES, COMPANY_NAMES

UNMATCHED = {"Cohere": 8, "xAI": 6, "Mistral AI": 5, "Perplexity AI": 3, "Hugging Face": 3}
ARTICLES, EMPTY, UNDISCLOSED, FAILED_UNMATCHED = 750, 107, 85, 5
COLUMNS = ["article_id", "title", "company_name", "published_date", "category", "revenue",
           "summary", "url", "author", "word_count"]
DATE_STYLES = ["%Y-%m-%d", "%Y-%m-%dT00:00:00Z", "%m/%d/%Y", "%m-%d-%Y", "%d-%m-%Y", "%B %d, %Y",
               "%d %b %Y"]


def money(i, n):
    return [f"${n:,}", f"${n // 10**6}.{n % 10**6:06d}M", f"{n} USD",
            f"${n // 10**6}.{n % 10**6:06d} million", f"${n - 1000} - ${n + 1000}"][i % 5]


def truth():
    """One dict per article with the cells and the meaning of each."""
    unmatched = [name for name, count in UNMATCHED.items() for _ in range(count)]
    rows = []
    for i in range(ARTICLES):
        name = unmatched[i] if i < len(unmatched) else COMPANY_NAMES[i % len(COMPANY_NAMES)]
        # the first failures fall on unmatched companies, the rest on matched ones
        failed = i < FAILED_UNMATCHED or len(unmatched) <= i < len(unmatched) + (
            EMPTY + UNDISCLOSED - FAILED_UNMATCHED)
        day = dt.date(2020, 1, 13) + dt.timedelta(days=2 * i)
        day = day.replace(day=13 + i % 15)  # day 13 or later, so no notation is ambiguous
        amount = 1_000_000 + 1_234_567 * i
        style = DATE_STYLES[i % len(DATE_STYLES)]
        rows.append({
            "company": None if i < len(unmatched) else name, "day": day,
            "amount": None if failed else amount,
            "cells": {
                "article_id": f"ART{i + 1:04d}",
                "title": f'Round "{i}", closed' if i % 9 else f"Line one\nline two {i}",
                "company_name": f" {name} " if i % 4 == 0 else name,
                "published_date": day.strftime(style),
                "category": list(CATEGORY_GROUPS)[i % len(CATEGORY_GROUPS)] if i % 50 else "Other",
                "revenue": money(i, amount) if not failed else "N/A" if i % 2 else "Not disclosed",
                "summary": "" if i % 7 == 0 else f"About {name}, part {i}",
                "url": f"https://example.com/{i}", "author": "NA" if i % 5 == 0 else f"Writer {i}",
                "word_count": str(100 + i),
            },
        })
    return rows


def write_articles(path, cells, columns=COLUMNS):
    with open(path, "w", newline="", encoding="utf-8") as out:
        writer = csv.DictWriter(out, columns)
        writer.writeheader()
        writer.writerows(cells)


def write_companies(path):
    fields = ("founded_year", "headquarters", "employee_count", "industry", "is_public",
              "stock_ticker")
    with open(path, "w", encoding="utf-8") as out:
        json.dump({c[0]: dict(zip(fields, c[1:])) for c in COMPANIES}, out, indent=2)
