"""Fixed values of the report data model.

Everything here has to keep its exact value for results to agree with tables that were loaded by other tools.
"""

from __future__ import annotations

from datetime import date

# Account listing defaults and the test account that is never loaded.
UNNAMED_ACCOUNT = "Unnamed Account"
DEFAULT_CURRENCY = "USD"
EXCLUDED_ACCOUNTS = ("8024672713",)
META_ACCOUNT_PREFIX = "act_"

# Default for a breakdown the platform leaves out.
UNKNOWN_BREAKDOWN = "Unknown"

# Incremental window.
LOOKBACK_DAYS = 14
FIRST_RUN_FLOOR = date(2022, 1, 1)
CHUNK_DAYS = 30

# Enum names used in row filters.
KEYWORD_CRITERION = "KEYWORD"
ASSET_CHANNEL_TYPES = ("PERFORMANCE_MAX", "SMART", "LOCAL")
AUDIENCE_TYPES = ("AFFINITY", "IN_MARKET", "USER_LIST", "CUSTOM_AUDIENCE", "CUSTOM_INTENT")

# Ad types that carry text assets.
RESPONSIVE_SEARCH_AD = "RESPONSIVE_SEARCH_AD"
RESPONSIVE_DISPLAY_AD = "RESPONSIVE_DISPLAY_AD"
EXPANDED_TEXT_AD = "EXPANDED_TEXT_AD"

# Money is stored in millionths of the account currency.
MICROS_PER_UNIT = 1_000_000
