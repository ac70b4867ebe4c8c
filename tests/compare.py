"""Run registered queries in Spark and in DuckDB and compare them exactly.

    python -m tests.compare [--sf DIR] [names …]
"""

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
DEFAULT = "/root/testdata/sf0.01"


def duck(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS FROM '{folder}/{t}.parquet'")
    return con


def kind(arrow_type):
    text = str(arrow_type)
    return {"large_string": "string", "date32[day]": "date"}.get(text, text)


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def rows_of(table):
    names = sorted(table.column_names)
    columns = [[plain(v) for v in table.column(n).to_pylist()] for n in names]
    return names, sorted(zip(*columns), key=repr)


def compare(df, con, sql):
    """A list of differences, empty when schema and rows agree exactly."""
    ours = df.toArrow()
    theirs = con.sql(sql).to_arrow_table()
    problems = []
    types = [{f.name: kind(f.type) for f in t.schema} for t in (ours, theirs)]
    if types[0] != types[1]:
        problems.append(f"schema {types[0]} / {types[1]}")
    if sorted(types[0]) == sorted(types[1]):
        names, left = rows_of(ours)
        _, right = rows_of(theirs)
        if left != right:
            only_left, only_right = set(left) - set(right), set(right) - set(left)
            few = [sorted(s, key=repr)[:3] for s in (only_left, only_right)]
            problems.append(
                f"{names}: {len(left)} / {len(right)} rows, "
                f"{len(only_left)} / {len(only_right)} differ: {few[0]} / {few[1]}"
            )
    return problems


def main(args):
    from almanack.registry import ORACLES, QUERIES
    from almanack.session import local_session

    folder = DEFAULT
    if args[:1] == ["--sf"]:
        folder, args = args[1], args[2:]
    spark, con = local_session(), duck(folder)
    bad = 0
    for name in args or QUERIES:
        began = time.time()
        try:
            if name in ORACLES:
                problems = compare(QUERIES[name](spark, folder), con, ORACLES[name])
            else:
                problems = [] if QUERIES[name](spark, folder).toArrow().num_rows else ["no rows"]
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:900]}"]
        bad += bool(problems)
        state = "ok  " if not problems else "FAIL"
        print(f"{state} {name} {time.time() - began:.1f}s {'' if name in ORACLES else '(rows only)'}", *problems, sep="\n     " if problems else " ", flush=True)
    print(f"{bad} of {len(args or QUERIES)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
