"""Small builders for hand-made event tables."""

import datetime as dt

from clickpath.schema import EVENT_SCHEMA

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def at(seconds: float) -> dt.datetime:
    return T0 + dt.timedelta(seconds=seconds)


def ev(t, etype="view", product=1, category=10, brand="b1", price=1.0, user=1, session="s1", code=None):
    return (at(t) if isinstance(t, (int, float)) else t, etype, product, category, code, brand, price, user, session)


def events_df(spark, rows):
    return spark.createDataFrame(rows, EVENT_SCHEMA)
