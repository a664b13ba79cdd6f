"""Fixed contract values and tunable rule parameters."""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values that must equal the source contract -----------------------
# Header of the transaction export (two columns are both named "Account").
HEADERS = (
    "Timestamp", "From Bank", "Account", "To Bank", "Account",
    "Amount Received", "Receiving Currency", "Amount Paid", "Payment Currency",
    "Payment Format", "Is Laundering",
)
# Payload keys, by position.
KEYS = (
    "timestamp", "from_bank", "from_account", "to_bank", "to_account",
    "amount_received", "receiving_currency", "amount_paid", "payment_currency",
    "payment_format", "is_laundering",
)
CORRECTION_TARGET_HEADER = "Target Raw Record ID"
# Currency written with six decimals; every other currency has two.
HIGH_SCALE_CURRENCY = "Bitcoin"
HIGH_SCALE, DEFAULT_SCALE = 6, 2
# Amounts must stay below this bound so that decimal(24,6) always fits.
AMOUNT_LIMIT = "1e18"
# Row statuses and reason codes.
ACCEPTED, REJECTED, DUPLICATE = "accepted", "rejected", "duplicate_candidate"
DUPLICATE_REASON = "exact_payload_match"
MALFORMED_REASON = "malformed_csv"
WIDTH_REASON = "wrong_column_count"
# Model feature names, in design-matrix order.
NUMERIC_FEATURES = (
    "log_amount_paid", "log_prior_transaction_count", "log_prior_average_amount",
    "log_amount_to_prior_average", "same_bank", "self_transfer",
    "has_prior_history", "hour_sin", "hour_cos", "weekday_sin", "weekday_cos",
)
CATEGORICAL_FEATURES = ("payment_currency", "receiving_currency", "payment_format")
UNKNOWN_CATEGORY = "UNKNOWN"
MODEL_VERSION = "chunked_adagrad_v1"
WEEKDAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
RANKING_KS = (100, 500, 1000, 5000)
SPIKE_REASON = "Amount at least 10x earlier average after 5+ earlier payments"
# --------------------------------------------------------------------------------


@dataclass(frozen=True)
class RiskConfig:
    """Transparent risk rules (points 2 + 2 + 1; alert at score >= 2)."""
    high_amount_min_rows: int = 100
    high_amount_percent_rank: float = 0.99
    velocity_min: int = 5
    counterparty_min: int = 3
    high_amount_points: int = 2
    velocity_points: int = 2
    counterparty_points: int = 1
    alert_score: int = 2


@dataclass(frozen=True)
class QualityPolicy:
    """Publication gate: largest rejected/total fraction per affected file."""
    max_rejected_fraction: float = 0.05


@dataclass(frozen=True)
class TrainConfig:
    """Weighted logistic regression: AdaGrad over ordered chunks of rows."""
    epochs: int = 3
    learning_rate: float = 0.15
    l2: float = 1e-5
    accumulator_init: float = 1e-8
    chunk_rows: int = 200_000
