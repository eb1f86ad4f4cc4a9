"""Configured defaults."""

# ---- fixed values: sizes, limits and delays -------------------------------------------------
CHUNK_BYTES = 51_200
PULL_PAGE_DOCS = 500
SYNC_BATCH_FILES = 50
MIN_BATCH_DELAY_MS = 1_000
DEBOUNCE_MS = 500
STABILITY_MS = 200
KEPT_VERSIONS = 10
KEPT_AUDIT_ROWS = 1_000
SEARCH_MAX_FILES = 20
SEARCH_MAX_LINES = 5
PREVIEW_IDS = 10
MAX_RETRIES = 3
RETRY_INITIAL_MS = 100
RETRY_MAX_MS = 10_000
RETRY_MULTIPLIER = 2.0
RETRY_JITTER = 0.1

# ---- fixed values: names and formats --------------------------------------------------------
MAX_INDEX_KEY = 2**32 - 2  # the largest whole number that an object's key order puts first
CHUNK_TYPE = "leaf"
FILE_TYPES = ("plain", "newnote", "notes")
BINARY_TYPE = "newnote"
BINARY_EXTENSIONS = ("png", "jpg", "jpeg", "pdf", "zip", "7z", "rar", "mp4", "mov", "avi")
SEARCH_EXTENSIONS = ("md", "txt", "json")
SEARCH_SKIPPED_DIRS = (".obsidian", "node_modules", ".git")
IGNORED_NAMES = ("node_modules", ".git", ".obsidian", "dist", "build", ".env")
IGNORED_SUFFIXES = (".tmp",)
WATCHED_FOLDERS = ("100", "101", "102", "103", "104")
STATIC_SALT_PREFIX = "%="
EPHEMERAL_SALT_PREFIX = "%$"
CHUNK_ID_PREFIX = "h:+"
STORE_CODEC = "zstd"  # of tables that hold bytes of files
CONFLICT_OPEN = "<<<<<<< LOCAL"
CONFLICT_MIDDLE = "======="
CONFLICT_CLOSE = ">>>>>>> REMOTE"
AUDIT_ACTIONS = ("sync_file", "pull_vault", "error", "init", "config")
STRATEGIES = ("last-write-wins", "remote-wins", "local-wins", "keep-both")
NO_CONFLICT = "no conflict"
LOCAL_NEWER = "local is newer"
REMOTE_NEWER = "remote is newer"
SAME_TIME = "same mtime, local wins (tiebreaker)"
REMOTE_RULE = "remote-wins strategy"
LOCAL_RULE = "local-wins strategy"
BOTH_RULE = "keeping both versions"
UNKNOWN_RULE = "unknown strategy, defaulting to local"

# Folder prefixes per agent. Agent names are labels: pass your own rules to the scope operators.
DEFAULT_SCOPES = {
    "owner": ("000", "001", "002", "003", "004", "005"),
    "assistant": ("100", "101", "102", "103", "104"),
    "shared": ("200", "201"),
}
DEFAULT_AGENT = "assistant"
ROOT_SCOPE = "root"
