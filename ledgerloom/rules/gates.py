"""Gate requirements, bounds and expected types."""

from ledgerloom.rules.concepts import BS_FIELDS, CF_FIELDS, PL_FIELDS

# Keys each statement must know, and how many of them.
KEY_REQUIREMENTS = {
    "bs": (("total_assets", "total_liabilities", "total_equity"), 2),
    "pl": (("revenue", "operating_income", "net_income"), 2),
    "cf": (("operating_cf", "investing_cf", "financing_cf"), 2),
}
NULL_RATE_THRESHOLD = 0.5
VALUE_RULES = {"total_assets": (0.0, None), "revenue": (0.0, None)}

# Bounds of the multiples per profile.
VALUATION_PROFILES = {
    "default": {"per": (0.0, 50.0), "pbr": (0.0, 5.0), "ev_ebitda": (0.0, 40.0)},
    "growth": {"per": (0.0, 100.0), "pbr": (0.0, 10.0), "ev_ebitda": (0.0, 80.0)},
    "value": {"per": (0.0, 30.0), "pbr": (0.0, 3.0), "ev_ebitda": (0.0, 25.0)},
    "financial": {"per": (0.0, 50.0), "pbr": (0.0, 10.0), "ev_ebitda": (0.0, 40.0)},
}

# Expected kind of each field handed from one step to the next.
TYPE_MAPS = {
    "parsed_to_calculator": {
        "revenue": "number", "operating_income": "number", "net_income": "number", "total_assets": "number", "equity": "number",
        "total_equity": "number", "operating_cf": "number", "investing_cf": "number",
    },
    "calculator_to_valuate": {
        "roe_percent": "number", "roa_percent": "number", "operating_margin_percent": "number",
        "revenue_growth_yoy_percent": "number", "profit_growth_yoy_percent": "number", "equity_ratio_percent": "number",
        "revenue": "number", "operating_income": "number", "net_income": "number", "operating_cf": "number",
        "free_cash_flow": "number",
    },
    "raw_to_risk": {
        "content": "text", "text": "text", "xbrl_content": "text",
    },
    "calculator_to_valuate_relative": {
        "roe_percent": "number", "roa_percent": "number", "operating_margin_percent": "number",
        "revenue_growth_yoy_percent": "number", "profit_growth_yoy_percent": "number", "equity_ratio_percent": "number",
        "revenue": "number", "operating_income": "number", "net_income": "number", "operating_cf": "number",
        "free_cash_flow": "number",
    },
    "calculate_to_report": {
        "revenue": "number", "operating_income": "number", "net_income": "number", "roe_percent": "number",
        "roa_percent": "number", "operating_margin_percent": "number", "equity_ratio_percent": "number", "operating_cf": "number",
        "free_cash_flow": "number",
    },
    "valuate_to_report": {
        "enterprise_value": "number", "equity_value": "number", "per_share_value": "number",
    },
    "valuate_relative_to_report": {
        "per": "number", "pbr": "number", "ev_ebitda": "number",
    },
    "web_research_to_harmonize": {
        "ticker": "text", "collected_at": "text", "sources": "object", "metadata": "object",
    },
    "harmonize_to_integrate": {
        "revenue": "number", "operating_income": "number", "net_income": "number", "ordinary_income": "number",
        "gross_profit": "number", "total_assets": "number", "total_equity": "number", "net_assets": "number",
        "operating_cf": "number", "investing_cf": "number", "financing_cf": "number",
    },
    "risk_analyzer_output": {
        "ticker": "text", "analyzed_at": "text", "source_documents": "array", "risk_categories": "object",
    },
    "integrator_output": {
        "revenue": "number", "operating_income": "number", "net_income": "number", "total_assets": "number", "equity": "number",
        "total_equity": "number", "net_assets": "number", "operating_cf": "number", "investing_cf": "number",
        "financing_cf": "number",
    },
}

# Provenance contract of stored data.
PROVENANCE_COLUMNS = ("source", "endpoint_or_doc_id", "fetched_at", "period_end")
PROVENANCE_SOURCES = ("edinet", "jquants", "jpx", "pdf", "manual")

NULL_RATE_FIELDS = BS_FIELDS + PL_FIELDS + CF_FIELDS
