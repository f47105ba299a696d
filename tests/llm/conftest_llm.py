import json


def rows_of(df):
    return sorted(json.dumps(r.asDict(recursive=True), sort_keys=True, default=str) for r in df.collect())
