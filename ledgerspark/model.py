"""Schemas of the landed inputs and fixed lists of the disclosure domain."""

from __future__ import annotations

FACT_ENTRY = "struct<start:string,end:string,instant:string,val:decimal(38,9),fy:string,fp:string,filed:string,segment:string>"
COMPANY_FACTS = f"cik string, entityName string, facts map<string,map<string,struct<units:map<string,array<{FACT_ENTRY}>>>>>"
SUBMISSIONS = (
    "cik string, name string, filings struct<recent:struct<form:array<string>,accessionNumber:array<string>,"
    "filingDate:array<string>,reportDate:array<string>,primaryDocument:array<string>>>"
)
FILING_INDEX = "cik string, accession string, directory struct<item:array<struct<name:string,size:string>>>"

#: Concept names read by the views.
REVENUE, NET_INCOME, ASSETS, EQUITY, OPERATING_INCOME = "Revenues", "NetIncomeLoss", "Assets", "StockholdersEquity", "OperatingIncomeLoss"
EPS = "EarningsPerShareBasic"

#: Concept categories.
CATEGORIES = {
    "Revenues": "Revenue",
    "CostOfRevenue": "Expenses",
    "OperatingIncomeLoss": "Profitability",
    "NetIncomeLoss": "Profitability",
    "Assets": "Assets",
    "Liabilities": "Liabilities",
    "StockholdersEquity": "Equity",
}

#: Concept patterns that hint at a kind of segment, matched from the start, any case.
SEGMENT_PATTERNS = [
    ("product_segments", ".*(revenue|sales|product)"),
    ("geographic_segments", ".*(geograph|country|region|domestic|foreign)"),
    ("customer_segments", ".*(customer|client)"),
    ("profit_segments", ".*(operating|netincome)"),
]
