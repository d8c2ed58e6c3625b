"""Statement fields, concept aliases and concept-to-statement tables."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ledgerloom.functions.numbers import strip

# Fields of the three statements, in output order.
BS_FIELDS = (
    "total_assets", "current_assets", "noncurrent_assets", "total_liabilities",
    "current_liabilities", "noncurrent_liabilities", "total_equity", "net_assets",
)
PL_FIELDS = ("revenue", "gross_profit", "operating_income", "ordinary_income", "net_income")
CF_FIELDS = ("operating_cf", "investing_cf", "financing_cf", "free_cash_flow")
STATEMENT_FIELDS = {"bs": BS_FIELDS, "pl": PL_FIELDS, "cf": CF_FIELDS}
FACT_FIELDS = BS_FIELDS + PL_FIELDS + CF_FIELDS[:3]
ALL_FIELDS = BS_FIELDS + PL_FIELDS + CF_FIELDS
COMPARE_FIELDS = ("revenue", "operating_income", "net_income", "total_assets", "equity")
RECORD_FIELDS = (
    "revenue", "operating_income", "net_income", "total_assets", "equity", "operating_cf", "investing_cf",
)

# Normalised XBRL names of each concept.
XBRL_ALIASES = {
    "total_assets": ("totalassets", "assetstotal"),
    "current_assets": ("currentassets",),
    "noncurrent_assets": ("noncurrentassets", "fixedassets"),
    "total_liabilities": ("totalliabilities", "liabilitiestotal", "liabilities"),
    "current_liabilities": ("currentliabilities",),
    "noncurrent_liabilities": ("noncurrentliabilities", "fixedliabilities"),
    "total_equity": ("totalequity", "shareholdersequity", "equityattributabletoownersofparent"),
    "net_assets": ("netassets",),
    "revenue": ("netsales", "sales", "revenue", "operatingrevenue"),
    "gross_profit": ("grossprofit",),
    "operating_income": ("operatingincome", "operatingincomeloss"),
    "ordinary_income": ("ordinaryincome", "ordinaryincomeloss"),
    "net_income": ("profitloss", "netincome", "incomeloss", "profitattributabletoownersofparent"),
    "operating_cf": ("netcashprovidedbyusedinoperatingactivities", "operatingcf"),
    "investing_cf": (
        "netcashprovidedbyusedininvestingactivities",
        "netcashprovidedbyusedininvestmentactivities",
        "investingcf",
    ),
    "financing_cf": ("netcashprovidedbyusedinfinancingactivities", "financingcf"),
}

# Concepts that name the filer.
COMPANY_NAME_CONCEPTS = (
    "filernameinjapanesedei", "companynamecoverpage", "entitycurrentlegalorregisteredname", "filernameinenglishdei",
)

# Japanese item names of each concept; an item listed twice belongs to the first concept.
ITEM_ALIASES = {
    "total_assets": ("資産合計", "総資産", "総資産額"),
    "current_assets": ("流動資産合計",),
    "noncurrent_assets": ("固定資産合計",),
    "total_liabilities": ("負債合計", "負債の部合計"),
    "current_liabilities": ("流動負債合計",),
    "total_equity": ("純資産合計", "純資産の部合計"),
    "net_assets": ("純資産合計", "純資産の部合計"),
    "revenue": ("売上高", "営業収益"),
    "gross_profit": ("売上総利益",),
    "operating_income": ("営業利益",),
    "ordinary_income": ("経常利益",),
    "net_income": (
        "親会社株主に帰属する当期純利益", "親会社株主に帰属する当期純損失",
        "親会社株主に帰属する四半期純利益", "親会社株主に帰属する四半期純損失",
        "親会社株主に帰属する中間純利益", "親会社株主に帰属する中間純損失",
        "当期純利益", "当期純損失", "四半期純利益", "四半期純損失", "中間純利益", "中間純損失",
    ),
    "operating_cf": ("営業活動によるキャッシュ・フロー",),
    "investing_cf": ("投資活動によるキャッシュ・フロー",),
    "financing_cf": ("財務活動によるキャッシュ・フロー",),
}

# Item patterns of the structured statement tables (field, section, items, way of matching).
STRUCTURED_ITEMS = (
    ("revenue", "income_statement", ("売上高", "営業収益"), "exact"),
    ("operating_income", "income_statement", ("営業利益又は営業損失（△）", "営業利益"), "exact"),
    ("net_income", "income_statement", ("親会社株主に帰属する",), "contains"),
    ("total_assets", "balance_sheet", ("資産合計",), "exact"),
    ("equity", "balance_sheet", ("純資産合計",), "exact"),
)


def statement_of(concept: str) -> str:
    return next(s for s, fields in STATEMENT_FIELDS.items() if concept in fields)


def concept_key(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^0-9a-z]+", "")


def alias_key(c: Column) -> Column:
    """Lower case, letters and digits of any script only."""
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", "")


def canonical_concept(name: Column) -> Column:
    """Canonical field of an XBRL element name, by a constant lookup map."""
    pairs = [F.lit(x) for concept, names in XBRL_ALIASES.items() for alias in names for x in (alias, concept)]
    # A hash test sorts out the many names that no one asks for; the map is searched for the wanted ones only.
    return F.when(concept_key(name).isin(*[n for names in XBRL_ALIASES.values() for n in names]), F.try_element_at(F.create_map(*pairs), concept_key(name)))


def item_concept(name: Column) -> Column:
    """Canonical field of a Japanese item name: exact, else the first listed alias it starts with.

    Balance-sheet aliases match exactly only, so that a total of a part never counts as the whole.
    """
    item = strip(name)
    first_owner: dict[str, str] = {}
    for concept, names in ITEM_ALIASES.items():
        for alias in names:
            first_owner.setdefault(alias, concept)
    exact = F.try_element_at(
        F.create_map(*[F.lit(x) for pair in first_owner.items() for x in pair]), item
    )
    bs_names = {a for c, names in ITEM_ALIASES.items() if c in BS_FIELDS for a in names}
    prefix = F.lit(None).cast("string")
    for alias, concept in reversed([kv for kv in first_owner.items() if kv[0] not in bs_names]):
        prefix = F.when(item.startswith(alias), concept).otherwise(prefix)
    return F.coalesce(exact, prefix)


def context_priority(context_id: Column) -> Column:
    """Score of a fact's context: current and consolidated figures first."""
    name = F.lower(context_id)
    has = lambda word: F.contains(name, F.lit(word))
    points = lambda cond, n: F.when(cond, n).otherwise(0)
    return (
        points(has("currentyear"), 100)
        + F.when(has("currentquarter"), 50).when(has("current"), 60).otherwise(0)
        + F.when(has("nonconsolidated"), -25).when(has("consolidated"), 40).otherwise(0)
        + points(has("prior") | has("previous"), -80)
    )
