import json

from pubspark.operators.parse import bronze_from_raw


def raw_df(spark, items, run=None):
    rows = [(i if isinstance(i, str) else json.dumps(i, ensure_ascii=False),) for i in items]
    return spark.createDataFrame(rows, "raw_item string")


def bronze_of(spark, items):
    return bronze_from_raw(raw_df(spark, items))


def rows(df, *cols):
    return sorted([tuple(r[c] for c in cols) for r in df.select(*cols).collect()],
                  key=lambda t: tuple("" if v is None else str(v) for v in t))


def srt(expected):
    return sorted(expected, key=lambda t: tuple("" if v is None else str(v) for v in t))
