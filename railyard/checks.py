"""The column tests of every published table."""

from __future__ import annotations

from railyard.operators.quality import accepted_range, accepted_values, not_null, unique
from railyard.rails import SCHEMES

# Which column must satisfy what.
CHECKS = {
    # bronze
    "ach_transactions": (*not_null("txn_id", "amount_egp"),),
    "meeza_authorisations": (*not_null("auth_id"),),
    "ipn_transactions": (*not_null("txn_id"),),
    "meeza_digital_wallet_events": (*not_null("_id"),),
    "atm_sessions": (*not_null("atm_id", "session_id"),),
    # silver
    "stg_ach_transactions": (
        unique("txn_id"),
        *not_null("txn_id", "amount_egp", "settlement_date", "originating_bank_id", "source_created_at"),
        accepted_range("amount_egp", 0, inclusive=False),
        accepted_values("txn_type", "CREDIT", "DEBIT", "RETURN"),
        accepted_values("txn_status", "PENDING", "SETTLED", "RETURNED", "FAILED"),
    ),
    "stg_meeza_authorisations": (
        unique("auth_id"),
        *not_null("auth_id", "is_approved", "amount_egp", "auth_timestamp"),
        accepted_values("auth_status", "APPROVED", "DECLINED", "REVERSED"),
        accepted_values("channel", "POS", "ECOMMERCE", "ATM", "CONTACTLESS"),
        accepted_range("amount_egp", 0, inclusive=False),
    ),
    "stg_ipn_transactions": (
        unique("txn_id"),
        *not_null("txn_id", "payment_ref", "met_sla", "initiated_at"),
        accepted_values("txn_status", "COMPLETED", "FAILED", "REVERSED", "PROCESSING"),
        accepted_range("processing_time_ms", 0),
    ),
    "stg_meeza_digital_wallet": (
        unique("document_id"),
        *not_null("document_id", "amount_egp", "event_timestamp"),
        accepted_range("amount_egp", 0),
    ),
    "stg_atm_sessions": (
        *not_null("session_id", "atm_id", "amount_egp", "updated_ts"),
        accepted_range("amount_egp", 0),
    ),
    # gold
    "mart_daily_txn_volume": (
        *not_null("report_date", "scheme", "txn_count", "total_amount_egp", "approved_count", "failed_count"),
        accepted_values("scheme", *SCHEMES),
        *(
            accepted_range(c, 0)
            for c in ("txn_count", "total_amount_egp", "approved_count", "failed_count", "avg_txn_amount_egp")
        ),
    ),
    "mart_scheme_performance": (
        *not_null("report_date", "scheme", "channel"),
        accepted_values("scheme", *SCHEMES),
        accepted_range("txn_volume", 0),
        accepted_range("approval_rate_pct", 0, 100),
        accepted_range("avg_processing_ms", 0),
    ),
    "mart_settlement_summary": (
        *not_null("settlement_date", "originating_bank_id", "receiving_bank_id"),
        accepted_range("settlement_rate_pct", 0, 100),
    ),
    # serving
    "daily_txn_volume": (
        *not_null("report_date", "scheme", "txn_count", "refreshed_at"),
        accepted_values("scheme", *SCHEMES),
    ),
    "scheme_performance": (*not_null("report_date", "scheme", "channel", "approval_rate_pct", "refreshed_at"),),
    "settlement_summary": (
        *not_null("settlement_date", "originating_bank_id", "receiving_bank_id", "refreshed_at"),
    ),
}
