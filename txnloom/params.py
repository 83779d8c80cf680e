"""Thresholds and weights, passed explicitly to every operator that uses them.

Each class can be filled from environment variables named ``<PREFIX>_<FIELD>``
(for example ``CHURN_WINDOW_STEPS``) with :meth:`from_env`.
"""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields
from typing import ClassVar

SIM_EPOCH = "2023-01-01T00:00:00Z"

# The transaction types, in display order.
TXN_TYPES = ("PAYMENT", "TRANSFER", "CASH_IN", "CASH_OUT", "DEBIT")

# The customer segments.
SEGMENTS = ("Premium", "Standard", "Basic", "Private Banking", "Student")


class _EnvParams:
    PREFIX: ClassVar[str] = ""

    @classmethod
    def from_env(cls, environ: Mapping[str, str] | None = None):
        env = os.environ if environ is None else environ
        found = {}
        for f in fields(cls):
            raw = env.get(f"{cls.PREFIX}_{f.name.upper()}")
            if raw is None or raw == "":
                continue
            kind = type(f.default)
            if kind is tuple:
                found[f.name] = tuple(v.strip() for v in raw.split(",") if v.strip())
            else:
                found[f.name] = kind(raw)
        return cls(**found)


@dataclass(frozen=True)
class FraudParams(_EnvParams):
    PREFIX: ClassVar[str] = "FRAUD"
    types: tuple[str, ...] = ("TRANSFER", "CASH_OUT")
    amount_threshold: float = 200000.0
    dest_balance: float = 0.0
    # Fixed value: the id written to alerts and metrics.
    rule_id: str = "SPEC-7.1: type in (TRANSFER,CASH_OUT) & amount>200000 & newbalanceDest==0"


@dataclass(frozen=True)
class ChurnParams(_EnvParams):
    PREFIX: ClassVar[str] = "CHURN"
    epoch: str = SIM_EPOCH
    window_steps: int = 24
    slide_steps: int = 12
    min_signals: int = 2
    freq_low_per_12: float = 1.0
    freq_hist_per_12: float = 3.0
    amount_drop_fraction: float = 0.20
    balance_low_threshold: float = 500.0
    balance_low_consecutive: int = 2
    watermark_hours: int = 48
    # Rows of one customer and step are put in order in runs of at most this
    # many order keys, so that no task ever collects an unbounded group.
    order_chunk: int = 65536


@dataclass(frozen=True)
class RiskParams(_EnvParams):
    PREFIX: ClassVar[str] = "RISK"
    w_frequency: float = 0.25
    w_avg_transfer: float = 0.25
    w_cashout_prop: float = 0.25
    w_unique_dest: float = 0.25
    tier_low_max: float = 0.25
    tier_medium_max: float = 0.60


@dataclass(frozen=True)
class ClvParams(_EnvParams):
    PREFIX: ClassVar[str] = "CLV"
    w_volume: float = 0.30
    w_frequency: float = 0.25
    w_diversity: float = 0.25
    w_recency: float = 0.20
    recency_zero_after_steps: int = 48
    n_txn_types: int = 5
    tier_high_min: float = 0.70
    tier_growth_min: float = 0.40


@dataclass(frozen=True)
class ComplianceParams(_EnvParams):
    PREFIX: ClassVar[str] = "COMPLIANCE"
    window_steps: int = 168
    risk_high_pct: float = 5.0
    risk_medium_pct: float = 1.0


@dataclass(frozen=True)
class DormancyParams(_EnvParams):
    PREFIX: ClassVar[str] = "DORMANCY"
    inactive_steps: int = 72
    severe_steps: int = 120
    min_history: int = 5


@dataclass(frozen=True)
class BlendParams(_EnvParams):
    PREFIX: ClassVar[str] = "BLEND"
    fraud_weight: float = 0.6
    churn_weight: float = 0.4


@dataclass(frozen=True)
class StreamParams(_EnvParams):
    """Where a transaction stream comes from and how fast it is read."""

    PREFIX: ClassVar[str] = "STREAM"
    kind: str = "kafka"  # kafka, json or parquet
    location: str = ""  # topic, or directory for the file kinds
    bootstrap_servers: str = ""
    starting_offsets: str = "latest"
    max_per_trigger: int = 100000  # offsets (kafka) or files (json, parquet)
    trigger: str = "10 seconds"
    once: bool = False
