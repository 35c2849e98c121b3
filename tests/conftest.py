import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from daypanel.core import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session("tests", "local[4]")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.sparkContext.setLogLevel("ERROR")
    return session


def series(spark, columns: dict, entity: str = "a", start: str = "2024-01-01"):
    """One entity's daily rows from parallel lists."""
    import datetime as dt

    first = dt.date.fromisoformat(start)
    n = len(next(iter(columns.values())))
    types = {float: "double", int: "double", bool: "boolean", str: "string"}
    kind = {}
    for c, values in columns.items():
        known = next((v for v in values if v is not None), 0.0)
        kind[c] = types[type(known)]
    cast = lambda c, v: float(v) if v is not None and kind[c] == "double" else v
    rows = [
        (entity, first + dt.timedelta(days=i), *(cast(c, columns[c][i]) for c in columns)) for i in range(n)
    ]
    schema = "entity string, day date, " + ", ".join(f"{c} {t}" for c, t in kind.items())
    return spark.createDataFrame(rows, schema)


def ordered(df, *columns):
    rows = df.orderBy("entity", "day").collect()
    return [tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in rows]
