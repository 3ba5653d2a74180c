"""Comparison of a query's rows with its SQL's, as sets of rows with columns in order of their names."""

from pathlib import Path

import duckdb
import pandas as pd

DATA = Path("/root/testdata/sf0.001")


def connection(data: Path = DATA):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for path in data.iterdir():
        if path.suffix == ".parquet":
            con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path if path.is_file() else f'{path}/*.parquet'}')")
    return con


def rows(frame: pd.DataFrame) -> list[str]:
    def plain(v):
        if hasattr(v, "tolist"):
            v = v.tolist()
        if isinstance(v, list):
            return [plain(x) for x in v]
        if v is None or v is pd.NA or v != v:
            return None
        if isinstance(v, bool):
            return v
        if isinstance(v, (int, float)):
            return round(float(v), 6)
        return str(v)

    ordered = frame[sorted(frame.columns)]
    return sorted(str([plain(v) for v in row]) for row in ordered.itertuples(index=False, name=None))
