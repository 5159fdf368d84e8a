"""Fixed values that must equal the reference's for right results.

They are stated here as plain text, in natural order, in one place.
"""

# --- fixed values -----------------------------------------------------------

# Site suffix removed from page titles (" - <site>" at the end).
SITE_SUFFIX = "myanimelist.net"

# Strict link filter: an href containing any of these is dropped.
STRICT_LINK_PATTERNS = ("/wiki/Special:Random", "#", "Category:", ":Citation")

# One white space character as Python's str.split() sees it.
WS_RE = (r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}"
         r"\x{205f}\x{3000}]")

# Python's string.punctuation (deleted before tokenising word-vector text).
ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Stop words of the content analyzer (the index library's default list),
# and its minimum token length.
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "can", "for", "from",
    "have", "if", "in", "is", "it", "may", "not", "of", "on", "or", "tbd",
    "that", "the", "this", "to", "us", "we", "when", "will", "with", "yet",
    "you", "your",
)
STOP_MIN_LEN = 2

# BM25F defaults of the index library.
BM25_B = 0.75
BM25_K1 = 1.2

# Score weights per scoring mode: score = a * pagerank + b * bm25, per term.
SCORE_WEIGHTS = {
    "both": (100000.0, 1.5),
    "pagerank": (100000.0, 0.0),
    "bm25": (0.0, 1.5),
}

# PageRank settings.
DAMPING = 0.85
EPSILON = 1e-4

# Popularity fallback when a page has no popularity number.
POPULARITY_FALLBACK = 99999

# Results per page.
PAGE_LEN = 10

# Suggestion settings: edit cost cap and number of suggestions.
SUGGEST_MAX_COST = 5
SUGGEST_SIZE = 3

# Related results: seeds taken from the top hits and queries per seed.
RELATED_K = 2

# Word-vector training: epochs and parallel workers.
W2V_EPOCHS = 3
W2V_WORKERS = 8

# Crawl delay default (seconds) when robots give none.
DEFAULT_CRAWL_DELAY = 3.0

# Redirect link prefix of the result view.
REDIRECT_PREFIX = "check_url?u="

# Status counted for a failed link request.
FAILED_STATUS = 400
