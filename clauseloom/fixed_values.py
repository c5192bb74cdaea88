"""Fixed values.

Everything in this module is a value that results depend on: names, word lists, search
patterns, query strings, separators, sizes and prices.  They are stated as plain text.
"""

# --- field names, in column order -------------------------------------------------

PERFORMANCE_FIELDS = (
    "uptime_guarantee",
    "response_time_sla",
    "sla_breach_threshold",
    "sla_measurement_period",
)
PENALTY_FIELDS = (
    "penalty_uptime_breach",
    "penalty_late_delivery",
    "penalty_termination_fee",
    "penalty_late_payment",
    "penalty_data_breach",
)
MONETARY_FIELDS = (
    "penalty_has_monetary",
    "penalty_max_amount",
    "penalty_currency",
    "service_credit_cap",
)
MECHANICS_FIELDS = (
    "renewal_terms",
    "termination_clause",
    "liability_cap",
    "governing_law",
    "dispute_resolution",
)

# --- keywords: a document holding one of them is expected to have the field ---------

KEYWORDS = {
    "uptime_guarantee": ("uptime sla", "availability sla", "99.9", "99.5", "service level agreement"),
    "response_time_sla": ("response time sla", "respond within", "priority 1", "p1 issue", "critical incident response"),
    "sla_breach_threshold": ("falls below", "breach threshold", "sla is breached", "availability drops"),
    "sla_measurement_period": ("measured monthly", "calculated quarterly", "rolling 12", "measurement period"),
    "penalty_uptime_breach": ("service credit", "uptime credit", "availability credit", "sla credit"),
    "penalty_late_delivery": ("liquidated damage", "late delivery penalty", "delay penalty", "per day penalty"),
    "penalty_termination_fee": ("early termination fee", "termination penalty", "cancellation fee"),
    "penalty_late_payment": ("late payment interest", "overdue interest", "past due interest", "1.5% per month"),
    "penalty_data_breach": ("data breach penalty", "security breach fine", "breach notification fine"),
    "service_credit_cap": ("credit cap", "maximum credit", "credits shall not exceed", "credit limit"),
    "renewal_terms": ("auto-renew", "automatically renew", "renewal notice", "notice of non-renewal"),
    "termination_clause": ("terminat", "right to terminate", "notice of termination"),
    "liability_cap": ("aggregate liability", "limitation of liability", "in no event", "shall not exceed"),
    "governing_law": ("govern", "applicable law", "jurisdiction", "laws of"),
    "dispute_resolution": ("arbitrat", "mediat", "dispute resolution", "legal action", "proceedings"),
}

# --- search patterns: how a well-formed value of the field looks --------------------

NUMBER_WORD = r"(?:\d+|one|two|three|four|five|six|seven|eight|nine|ten|eleven|twelve|thirty|sixty|ninety)"
CURRENCY_MARK = r"(?:\$|£|€|USD|GBP|EUR|CAD|AUD)"

PATTERNS = {
    "uptime_guarantee": r"\d{2,3}(?:\.\d+)?\s*%",
    "response_time_sla": NUMBER_WORD + r"\s*(?:hour|business day|day|minute|working day)",
    "sla_breach_threshold": r"(?:below|less than|under|drops?\s+below)\s*\d|breach|falls?\s+below",
    "sla_measurement_period": r"(?:month|quarter|annual|year|rolling|calendar)",
    "penalty_uptime_breach": r"(?:\d+(?:\.\d+)?\s*%|credit|" + CURRENCY_MARK + r"|\bfee\b)",
    "penalty_late_delivery": r"(?:" + CURRENCY_MARK + r"|\d+\s*(?:per day|per week|%)|liquidated|damage)",
    "penalty_termination_fee": r"(?:" + CURRENCY_MARK + r"|" + NUMBER_WORD + r"\s*month|fee|equal to|remaining)",
    "penalty_late_payment": r"(?:\d+(?:\.\d+)?\s*%|interest|per month|per annum|overdue|30\s*days)",
    "penalty_data_breach": r"(?:" + CURRENCY_MARK + r"|\d+|fine|indemnif|reimburse|notify)",
    "penalty_max_amount": r"(?:" + CURRENCY_MARK + r"|\d[\d,]*(?:\.\d+)?(?:\s*(?:million|thousand|M|K))?|" + NUMBER_WORD + r"\s*month)",
    "penalty_currency": r"(?:USD|GBP|EUR|CAD|AUD|\$|£|€)",
    "service_credit_cap": r"(?:\d+(?:\.\d+)?\s*%|not\s+to\s+exceed|maximum|cap)",
    "renewal_terms": r"(?:" + NUMBER_WORD + r"\s*(?:day|month|year)|auto.?renew|notice|perpetuity|term)",
    "termination_clause": r"(?:terminat|cancel|notice|days?\s+(?:prior|written|advance))",
    "liability_cap": r"(?:aggregate|in no event|shall not exceed|" + CURRENCY_MARK + r"|\d[\d,]*|\d+\s*month|limitation|no liability)",
    "governing_law": r"(?:laws?\s+of|govern|jurisdiction|applicable law|courts?\s+of)",
    "dispute_resolution": r"(?:arbitrat|mediat|dispute|adr|conciliat|legal action|courts?\s+of|venue|proceedings)",
}

# --- retrieval queries, by group ----------------------------------------------------

QUERIES = {
    "performance": (
        "uptime guarantee availability SLA percentage service level",
        "response time incident support SLA hours priority",
        "SLA breach threshold availability falls below measurement period",
    ),
    "penalty": (
        "penalty monetary damages liquidated cash fine",
        "service credit uptime breach penalty formula",
        "late delivery penalty liquidated damages milestones",
        "early termination fee cancellation penalty",
        "late payment interest overdue invoice fee",
        "data breach fine liability security incident penalty",
    ),
    "mechanics": (
        "renewal auto-renewal notice period term extension",
        "termination notice period cancellation conditions",
        "limitation of liability cap maximum damages aggregate",
        "governing law jurisdiction applicable law",
        "dispute resolution arbitration mediation",
    ),
    "anchor": (
        "this agreement shall be governed by the laws",
        "in the event of any dispute between the parties",
        "neither party shall be liable for indirect consequential",
        "this agreement shall automatically renew",
        "any dispute arising out of or in connection with",
    ),
}

# --- documents that are not contracts -------------------------------------------------

NON_CONTRACT_MARKERS = (
    "datasheet for contract understanding",
    "arxiv:",
    "abstract\nwe present",
    "i.motivation\na. who created",
)
ADMISSION_MARKERS = ("datasheet for", "arxiv:", "abstract\n")
FIRST_DOCUMENT_MARKER = "atticus dataset"

# --- names given to stored documents ---------------------------------------------------

DATASET_SOURCE = "cuad"
DATASET_ID_PREFIX = "cuad_"
DATASET_PATH = ("cuad_dataset[", "]")
FILE_SOURCE = "file"

# --- sizes, thresholds, separators -----------------------------------------------------

CHUNK_SIZE = 512
CHUNK_OVERLAP = 64
TOP_K = 5
CONTEXT_SEPARATOR = "\n\n---\n\n"
MAX_OUTPUT_TOKENS = 1500
MIN_ADMITTED_CHARS = 200
ADMISSION_WINDOW = 500
MIN_CLEAN_CHARS = 100
MARKER_WINDOW = 1000
SNIPPET_CHARS = 120
SUCCESS_FIELDS = 2
CORPUS_SIZE = 510
RECENT_ROWS = 20

# --- prices, in US dollars per million tokens --------------------------------------------

COST_BANDS = {"min": "0.27", "blended": "0.40", "max": "1.10"}
BATCH_RATE = "0.14"

# --- how amounts are written: currency marks and codes, unit words -------------------------------

CURRENCY_MARKS = {"$": "USD", "£": "GBP", "€": "EUR", "USD": "USD", "GBP": "GBP", "EUR": "EUR", "CAD": "CAD", "AUD": "AUD"}
AMOUNT_UNITS = {"billion": 1_000_000_000, "million": 1_000_000, "thousand": 1_000, "m": 1_000_000, "k": 1_000}

# --- words a boolean value may be written with in a response --------------------------------

TRUE_WORDS = ("true", "t", "yes", "y", "on", "1")
FALSE_WORDS = ("false", "f", "no", "n", "off", "0")
