"""Vocabularies and limits.

Every operator takes its vocabulary as a parameter; these are the
defaults.  The lists below are fixed values that must equal the
behaviour being reproduced, so they are kept verbatim, in their natural
order, in one place.
"""

from __future__ import annotations

# --- fixed values (must match the reproduced behaviour) -------------------

# Link pre-filter used while crawling: a link is followed when one of these
# occurs in its lower-cased text or URL.
CRAWL_LINK_KEYWORDS = [
    "admission", "apply", "application", "deadline",
    "requirement", "prerequisite", "checklist",
    "mcat", "gpa", "grade", "academic", "course",
    "prerequisite", "preparation", "standard",
    "curriculum", "program", "rotation", "clinical",
    "research", "volunteer", "experience",
    "recommendation", "letter", "interview", "statement",
    "student", "diversity", "inclusion", "class",
    "profile", "statistic", "demographic",
    "technical", "physical", "cognitive", "standard",
]

# Link ranking: keep-list (also the score vocabulary) and skip-list.
RANK_KEEP_KEYWORDS = [
    "admission", "apply", "application", "deadline",
    "requirement", "prerequisite", "mcat", "gpa",
    "curriculum", "program", "course", "rotation",
    "statistics", "class", "profile", "demographics",
    "technical", "standards", "interview", "candidate",
    "residency", "state", "in-state",
]
RANK_SKIP_KEYWORDS = [
    "login", "search", "contact", "news", "events",
    "faculty", "staff", "directory", "privacy",
    "accessibility", "sitemap", "social",
]

# Rule classifier: section -> keywords, in taxonomy order.
SECTION_KEYWORDS = {
    "application_requirements": ["requirement", "prerequisite", "mcat", "gpa"],
    "application_deadlines": ["deadline", "date", "timeline"],
    "program_curriculum": ["curriculum", "course", "rotation"],
    "interview_process": ["interview", "mmi", "visit"],
    "technical_standards": ["technical", "standard", "physical", "cognitive"],
    "program_statistics": ["statistic", "class", "profile", "demographic"],
    "ideal_candidate_profile": ["candidate", "quality", "trait", "seek"],
    "program_type": ["md program", "medical doctor", "degree"],
    "program_name": ["school of medicine", "medical school"],
    "program_website": ["http", "www", ".edu"],
    "residency_preferences": ["resident", "match", "placement"],
}

# Main-content selectors of the crawler profile, tried in order.
CRAWL_CONTENT_SELECTORS = [
    'main#content', 'article', 'div.content', 'div.main-content',
    'div[id*="admission"]', 'div[id*="requirements"]',
    'div[class*="admission"]', 'div[class*="requirements"]',
    'div[id*="apply"]', 'div[class*="apply"]',
    'div[id*="curriculum"]', 'div[id*="program"]',
    'div[class*="curriculum"]', 'div[class*="program"]',
    'div[id*="prerequisite"]', 'div[id*="technical"]',
    'div[class*="prerequisite"]', 'div[class*="technical"]',
    'div[id*="student"]', 'div[id*="diversity"]',
    'div[class*="student"]', 'div[class*="diversity"]',
]
CRAWL_CONTENT_TAGS = ["p", "h1", "h2", "h3", "h4", "li", "td"]
CRAWL_SKIP_CLASSES = ["nav", "menu", "footer", "copyright"]
CRAWL_FALLBACK_TAGS = ["p", "h1", "h2", "h3", "li"]

# Main-content selectors and removed elements of the DOM profile.
DOM_MAIN_SELECTORS = ["main", "article", '[role="main"]', "#content", ".content", ".main-content"]
DOM_REMOVE_SELECTORS = ["nav", "header", "footer", ".nav", ".menu", ".sidebar", ".widget",
                        "script", "style", "noscript"]

# Non-web documents: the crawler tests three, the extractor seven.
CRAWL_DOC_EXTENSIONS = [".pdf", ".doc", ".docx"]
EXTRACT_DOC_EXTENSIONS = [".pdf", ".doc", ".docx", ".ppt", ".pptx", ".xls", ".xlsx"]

TOKENS_PER_MINUTE = 30000
REQUESTS_PER_MINUTE = 500
TOKENS_PER_DAY = 90000
RATE_WINDOW_SECONDS = 60
PROMPT_COST_PER_1K = 0.03
COMPLETION_COST_PER_1K = 0.06
CHARS_PER_TOKEN = 4
TOP_LINKS = 25
CONTENT_PREFIX = 500
REPORT_PREFIX = 100
CONFIDENCE_STEP = 0.3
CONFIDENCE_CAP = 0.9
LINK_RELEVANCE = 0.8
FUZZY_SHARE = 0.75
NOT_PUBLISHED = "Not published"
EXTRACT_BATCH = 3
URL_ATTEMPTS = 3

# --- end of fixed values ---------------------------------------------------

# Test vocabulary.  No default term occurs in the synthetic anchors, so the
# query registry runs with frequent tokens of the corpus instead.
TEST_KEEP_KEYWORDS = ["the", "de", "en", "la", "er"]
TEST_SKIP_KEYWORDS = ["un", "is"]
TEST_SECTION_KEYWORDS = {
    "english": ["the", "and", "of"],
    "french": ["les", "des", "une"],
    "german": ["der", "und", "sch"],
    "spanish": ["para", "los", "ción"],
}

