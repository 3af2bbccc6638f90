"""Sizes, limits and names that results depend on."""

# Composite text and embedding input.
TOP_KEYWORDS = 15
TOP_CAST = 15
TOP_REVIEWS = 5
REVIEW_CHARS = 600
EMBED_CHARS = 5000
TEXT_SEPARATOR = " | "

# Embedding calls.
EMBED_BATCH = 16
EMBED_TRIES = 4
EMBED_DIM = 1024

# Landing.
FRESH_HOURS = 24
MAX_PAGES = 25
ENRICH_LIMIT = 200
LANDED_REVIEWS = 5

# Tables that are merged into by key: buckets of a new one, and the age at which what no version names may go.
TABLE_BUCKETS = 16
VACUUM_HOURS = 24

# Search and look-ups.
SEARCH_LIMIT = 5
OVERFETCH = 4
FILTERED_CANDIDATES = 100
TRENDING_LIMIT = 10
BROWSE_LIMIT = 200
BROWSE_SEMANTIC_LIMIT = 20
DETAILS_LIMIT = 5
SNIPPET_CHARS = 300

# Write-back.
SCORE_MIN = 1
SCORE_MAX = 10
WATCH_STATUSES = ("queued", "watched")
WATCH_ADDED_BY = 1
REASON_CHARS = 500
RECOMMENDED_BY = "agent"

# Chat logs.
CONTEXT_TURNS = 6
CONTEXT_ROLES = ("user", "assistant")
OBSERVATION_CHARS = 2000
TOOL_NAMES = (
    "search_movies_semantic",
    "fetch_trending_movies",
    "get_movie_details",
    "compare_movies",
    "add_to_watchlist",
    "log_group_rating",
    "log_recommendation",
    "get_group_history",
)
