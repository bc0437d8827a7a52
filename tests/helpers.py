"""Small typed tables for edge-case tests."""

from datetime import datetime, timedelta

from forumlens.sources.tables import POSTS_COLUMNS, USERS_COLUMNS, VOTES_COLUMNS

T0 = datetime(2020, 1, 1, 0, 0, 0)


def schema(cols):
    return ", ".join(f"{n} {t}" for n, t in cols)


def posts_df(spark, rows):
    """rows: dicts with any subset of the posts columns."""
    names = [n for n, _ in POSTS_COLUMNS]
    data = [tuple(r.get(n) for n in names) for r in rows]
    return spark.createDataFrame(data, schema(POSTS_COLUMNS))


def users_df(spark, rows):
    names = [n for n, _ in USERS_COLUMNS]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows],
                                 schema(USERS_COLUMNS))


def votes_df(spark, rows):
    return spark.createDataFrame(rows, schema(VOTES_COLUMNS))


def at(**kw):
    return T0 + timedelta(**kw)
