"""Risk classification expressions. Order of the CASE arms is part of the contract."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from stockrisk import constants as K


def days_until_stockout(qty: Column, usage: Column) -> Column:
    """Stock divided by average usage; NULL without a usage signal."""
    return F.when(usage > 0, qty / usage)


def reorder_flag(usage: Column, days: Column) -> Column:
    return F.when((usage > 0) & (days <= K.REORDER_MAX_DAYS), F.lit(True)).otherwise(F.lit(False))


def stock_status(usage: Column, days: Column) -> Column:
    """No usage (NULL or zero) is HEALTHY before any threshold is looked at."""
    return (
        F.when(usage.isNull() | (usage == 0), F.lit(K.STATUS_HEALTHY))
        .when(days <= K.CRITICAL_MAX_DAYS, F.lit(K.STATUS_CRITICAL))
        .when(days <= K.LOW_MAX_DAYS, F.lit(K.STATUS_LOW))
        .when(days <= K.MEDIUM_MAX_DAYS, F.lit(K.STATUS_MEDIUM))
        .otherwise(F.lit(K.STATUS_HEALTHY))
    )


def status_sort_order(status: Column) -> Column:
    expr = None
    for label, order in K.STATUS_SORT_ORDER.items():
        expr = (F.when if expr is None else expr.when)(status == label, F.lit(order))
    return expr.otherwise(F.lit(K.STATUS_SORT_ORDER_OTHER))


def horizon_bucket(days: Column) -> Column:
    expr = F.when(days.isNull(), F.lit(K.NO_USAGE_BUCKET))
    for upper, label in K.HORIZON_BUCKETS:
        expr = expr.when(days <= upper, F.lit(label))
    return expr.otherwise(F.lit(K.HORIZON_BUCKET_OTHER))


def priority_score(qty: Column, days: Column) -> Column:
    """Zero stock outranks everything, even without a usage signal."""
    expr = F.when(qty == 0, F.lit(K.SCORE_ZERO_STOCK)).when(days.isNull(), F.lit(K.SCORE_NO_USAGE))
    for upper, score in K.SCORE_BY_DAYS:
        expr = expr.when(days <= upper, F.lit(score))
    return expr.otherwise(F.lit(K.SCORE_OTHER))


def priority_band(score: Column) -> Column:
    expr = None
    for lower, label in K.PRIORITY_BANDS:
        expr = (F.when if expr is None else expr.when)(score >= lower, F.lit(label))
    return expr.otherwise(F.lit(K.PRIORITY_BAND_OTHER))
