"""Every tunable of the marts and streams, with the production defaults."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# Segment labels, thresholds in VND, order status, list lengths.
HIGH_LABEL = "High Value"
MEDIUM_LABEL = "Medium Value"
LOW_LABEL = "Low Value"
COMPLETED = "completed"


@dataclass(frozen=True)
class Params:
    """``as_of`` stands for today in every relative date, so that runs can be repeated."""

    as_of: dt.date
    completed: tuple[str, ...] = (COMPLETED,)

    # customer segments
    high_value: int = 100_000_000
    medium_value: int = 10_000_000
    report_high_value: int = 10_000
    report_medium_value: int = 5_000

    # revenue and product reports
    months_back: int = 12
    days_back: int = 90
    top_k: int = 10

    # streams
    watermark: str = "5 seconds"
    revenue_window: str = "10 seconds"
    product_window: str = "1 minute"
    stream_top_k: int = 5
    alert_amount: int = 10_000_000
    alert_window: str = "1 minute"
    alert_orders: int = 5
    similar_orders: int = 3

    # recommendations
    recommendations: int = 5
    als_blocks: int = 10
    als_block_scores: int = 4_000_000
    als_iterations: int = 10
    als_regularisation: float = 0.01
    seed: int = 42
