from riskflow.functions.scalars import (
    as_timestamp,
    avg_amount,
    epoch_seconds,
    fraud_rate,
    safe_divide,
    exact_amount,
    inexact_amount,
    trunc_second,
)

__all__ = ["as_timestamp", "avg_amount", "epoch_seconds", "fraud_rate", "safe_divide", "exact_amount", "inexact_amount", "trunc_second"]
