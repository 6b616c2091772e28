"""Typed scans over landed platform responses."""

from spendmill.sources.accounts import (
    GOOGLE_ACCOUNT_DDL,
    META_ACCOUNT_DDL,
    attach_accounts,
    exclude_accounts,
    google_accounts,
    meta_accounts,
    request_key,
    unique_accounts,
)
from spendmill.sources.landing import explode_batches, read_batches, read_landed, read_listing, read_requests
from spendmill.sources.wire import read_wire

__all__ = [
    "GOOGLE_ACCOUNT_DDL",
    "META_ACCOUNT_DDL",
    "attach_accounts",
    "exclude_accounts",
    "explode_batches",
    "google_accounts",
    "meta_accounts",
    "read_batches",
    "read_landed",
    "read_listing",
    "read_requests",
    "read_wire",
    "request_key",
    "unique_accounts",
]
