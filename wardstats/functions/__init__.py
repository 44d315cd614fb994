from .dates import DAY_MS, epoch_millis, in_days, los_millis
from .money import MONEY, clean_currency, currency_rest, is_bad_currency
from .ratios import ABOVE, BELOW, NEAR, classify, percent, ratio

__all__ = [
    "ABOVE", "BELOW", "DAY_MS", "MONEY", "NEAR", "classify", "clean_currency",
    "currency_rest", "epoch_millis", "in_days", "is_bad_currency", "los_millis", "percent", "ratio",
]
