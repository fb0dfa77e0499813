"""Builders for hand-made raw event frames."""

import datetime as dt


from shipgauge.schemas import DELIVERY_EVENTS, ML_EVENTS

D0 = dt.datetime(2024, 3, 1)


def at(day=0, hour=0, minute=0, second=0):
    return D0 + dt.timedelta(days=day, hours=hour, minutes=minute, seconds=second)


def delivery(spark, rows):
    """rows: (event_id, team, event_type, event_date, lead_time_days, ci_passed)"""
    return spark.createDataFrame(rows, DELIVERY_EVENTS)


def ml(spark, rows):
    """rows: (event_id, team, model_name, event_type, event_date, psi, precision, drift_triggered)"""
    return spark.createDataFrame(rows, ML_EVENTS)


def empty_ml(spark):
    return spark.createDataFrame([], ML_EVENTS)


def as_dicts(df, order=None):
    rows = [r.asDict() for r in df.collect()]
    if order:
        rows.sort(key=lambda r: tuple(r[c] for c in order))
    return rows
