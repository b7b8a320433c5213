"""Rule sets and limits as plain data.

Fixed values: the keyword lists, labels, scores and limits below must equal
those of the platform whose results we match, so they are written out as text.
A ladder is a list of ``(label, keywords)`` tried in order; a keyword matches
when it occurs anywhere in the lower-cased text.
"""

# --- pull-request titles -----------------------------------------------------

PR_TITLE_RULES = [
    ("bug fix", ["fix", "bug"]),
    ("feature", ["feat", "add", "implement"]),
    ("refactor", ["refactor", "clean"]),
    ("test", ["test"]),
    ("documentation", ["doc"]),
]
PR_TITLE_DEFAULT = "not clear"
PR_TITLE_LABELS = ["bug fix", "feature", "refactor", "test", "documentation", "not clear"]

PR_TITLE_SHORT_RULES = [
    ("bug_fix", ["fix", "bug"]),
    ("feature", ["feat", "add"]),
    ("refactor", ["refactor"]),
    ("test", ["test"]),
    ("documentation", ["doc"]),
]
PR_TITLE_SHORT_DEFAULT = "other"

PR_TITLE_TEST_FIRST_RULES = [
    ("bug fix", ["fix", "bug"]),
    ("test", ["test"]),
    ("documentation", ["doc"]),
    ("feature", ["feat", "add", "implement"]),
    ("refactor", ["refactor", "clean"]),
]

# --- proposals ---------------------------------------------------------------

FUNDED = "funded"
FUNDING_STATUS_RULES = [
    ("approved", ["completed", "approved"]),
    ("in_progress", ["in_progress", "pending"]),
]
FUNDING_STATUS_DEFAULT = "not_funded"

WALLET_TERMS = [
    "wallet", "lace", "yoroi", "daedalus", "eternl", "nami", "flint",
    "browser extension", "mobile wallet", "desktop wallet", "hardware wallet",
    "cardano wallet", "ada wallet",
]
COMPETITOR_TERMS = [
    "browser wallet", "web wallet", "browser extension wallet",
    "lace competitor", "lace alternative", "wallet competition",
    "yoroi", "eternl", "nami", "flint",
]

WALLET_TYPE_RULES = [
    ("lace", ["lace"]),
    ("yoroi", ["yoroi"]),
    ("daedalus", ["daedalus"]),
    ("eternl", ["eternl"]),
    ("nami", ["nami"]),
    ("flint", ["flint"]),
    ("browser_wallet_generic", ["browser wallet", "web wallet", "browser extension"]),
    ("mobile_wallet_generic", ["mobile wallet", "mobile app", "ios", "android"]),
    ("desktop_wallet_generic", ["desktop wallet", "desktop app"]),
    ("hardware_wallet_integration", ["hardware wallet", "cold storage", "ledger", "trezor"]),
]
WALLET_TYPE_DEFAULT = "wallet_infrastructure"

COMPETITION_RULES = [
    ("direct_competitor", ["browser wallet", "web wallet", "browser extension wallet"]),
    ("existing_competitor", ["yoroi", "eternl", "nami", "flint"]),
    ("indirect_competitor", ["mobile wallet", "desktop wallet"]),
    ("ecosystem_enabler", ["wallet integration", "wallet api", "wallet sdk", "wallet infrastructure"]),
]
COMPETITION_DEFAULT = "other"
COMPETITION_SCORES = {
    "direct_competitor": 100,
    "existing_competitor": 75,
    "indirect_competitor": 50,
    "ecosystem_enabler": 25,
}
COMPETITION_SCORE_DEFAULT = 10
# (column, threshold, points): points are added when column > threshold.
SCORE_BONUSES = [
    ("funding_success_rate", 50, 20),
    ("total_funding_received", 100000, 15),
]

# Output column -> category token counted in the funding summary.
CATEGORY_COUNTS = {
    "defi_projects": "DeFi",
    "infrastructure_projects": "Infrastructure",
    "devtools_projects": "Developer Tools",
}

# --- repositories and limits -------------------------------------------------

CODE_HOST = "github.com"
REPO_KEY_PATTERN = r"github\.com/([^/]+/[^/]+)"
PINNED_REPOSITORY = "input-output-hk/lace"
PINNED_LABEL = "lace"
TOP_LABEL = "top_10"
TOP_N = 10
DEFAULT_REPOSITORIES = [
    "cardano-foundation/cardano-wallet",
    "input-output-hk/cardano-node",
    "input-output-hk/plutus",
    "Emurgo/cardano-serialization-lib",
]
SAMPLE_REPOSITORIES = DEFAULT_REPOSITORIES[:2]

FRESHNESS_DAYS = 7
PROPOSALS_PER_PAGE = 50
LIMITS = {
    "sample": {"max_prs": 50, "max_releases": 10, "max_pages": 2},
    "dev": {"max_prs": 50, "max_releases": 10, "max_pages": 5},
    "prod": {"max_prs": None, "max_releases": None, "max_pages": None},
}
