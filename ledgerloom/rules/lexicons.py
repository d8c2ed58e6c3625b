"""Risk keyword lists, severity words and label tables, passed as parameters."""

# Risk categories in order; on equal scores the first wins.
RISK_CATEGORIES = ("market_risk", "credit_risk", "operational_risk", "regulatory_risk", "other_risk")

# Keywords of each category.
RISK_KEYWORDS = {
    "market_risk": [
        "為替", "金利", "株価", "市場変動", "価格変動", "商品価格", "原材料価格", "有価証券",
        "デリバティブ", "通貨", "景気", "経済環境", "需要変動", "市況",
    ],
    "credit_risk": [
        "信用", "債務不履行", "取引先", "貸倒", "与信", "回収", "売掛金", "不良債権",
        "デフォルト", "破綻", "倒産",
    ],
    "operational_risk": [
        "内部統制", "人材", "IT", "情報システム", "セキュリティ", "サイバー", "災害", "自然災害",
        "感染症", "パンデミック", "品質", "製品安全", "リコール", "サプライチェーン", "供給",
        "事故", "不正", "人件費", "労務", "技術革新", "知的財産",
    ],
    "regulatory_risk": [
        "法令", "規制", "コンプライアンス", "行政処分", "訴訟", "法的", "税制", "税務",
        "会計基準", "開示", "許認可", "独占禁止", "個人情報", "環境規制", "排出", "カーボン",
    ],
}

# Severity words.
SEVERITY_HIGH = ["重大", "著しい", "大幅", "深刻", "甚大", "多大", "大きな影響", "経営に重要", "事業継続"]
SEVERITY_LOW = ["軽微", "限定的", "僅か", "わずか", "小さい"]

# Report labels of the categories always shown, and of the one shown when present.
REQUIRED_RISK_LABELS = {
    "market_risk": "市場リスク", "credit_risk": "信用リスク", "liquidity_risk": "流動性リスク",
    "operational_risk": "オペレーショナルリスク", "regulatory_risk": "規制リスク",
}
EXTRA_RISK_LABELS = {"other_risk": "その他リスク"}
SEVERITY_LABELS = {"high": "高", "medium": "中", "low": "低"}

# Narrative elements of a filing.
NARRATIVE_ELEMENTS = (
    "BusinessRisksTextBlock", "RiskManagementTextBlock",
    "ManagementAnalysisOfFinancialPositionOperatingResultsAndCashFlowsTextBlock",
)

# Fixed value: paths of investor pages.
IR_PATH = r"(?i)/(ir|investor|kabunushi|shareholders?|finance|ir_info)(/|$)"
