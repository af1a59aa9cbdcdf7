"""DuckDB SQL text helpers mirroring the reference's typed JSON accessors."""

INT_RE = "[+-]?[0-9]+"
FLOAT_RE = "[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?"


def PR(path: str, payload: str = "properties") -> str:
    """Missing JSON path reads as ''."""
    return f"coalesce(json_extract_string({payload}, '$.{path}'), '')"


def P(path: str, payload: str = "properties") -> str:
    return f"nullif({PR(path, payload)}, '')"


def INT(x: str, t: str = "INTEGER") -> str:
    return f"(CASE WHEN regexp_full_match(trim({x}), '{INT_RE}') THEN TRY_CAST(trim({x}) AS {t}) END)"


def FLT(x: str) -> str:
    return f"(CASE WHEN regexp_full_match({x}, '{FLOAT_RE}') THEN TRY_CAST({x} AS DOUBLE) END)"


def FLTC(x: str) -> str:
    return FLT(f"replace({x}, ',', '.')")


def TS(x: str) -> str:
    return ("try_strptime(" + x + ", ['%Y-%m-%dT%H:%M:%SZ', '%Y-%m-%dT%H:%M:%S.%gZ', "
            "'%Y-%m-%dT%H:%M:%S', '%Y-%m-%d %H:%M:%S', '%Y-%m-%d'])")


def VGTE(x: str, ver: str) -> str:
    a, b, c = ver.split(".")
    xs = "coalesce(" + x + ", '')"
    parts = ", ".join("coalesce(" + INT("split_part(" + xs + ", '.', " + str(i) + ")") + ", 0)"
                      for i in (1, 2, 3))
    return f"(({parts}) >= ({a}, {b}, {c}))"


def LIFETIME_BUCKET(d: str) -> str:
    return (f"(CASE WHEN {d} IS NULL THEN '(unknown)' WHEN {d} = 0 THEN 'D00' WHEN {d} <= 3 THEN 'D01-03' "
            f"WHEN {d} <= 7 THEN 'D04-07' WHEN {d} <= 14 THEN 'D08-14' WHEN {d} <= 30 THEN 'D15-30' "
            f"ELSE 'D31+' END)")


def LIFETIME_ORDER(d: str) -> str:
    return (f"(CASE WHEN {d} IS NULL THEN 99 WHEN {d} = 0 THEN 0 WHEN {d} <= 3 THEN 1 WHEN {d} <= 7 THEN 2 "
            f"WHEN {d} <= 14 THEN 3 WHEN {d} <= 30 THEN 4 ELSE 5 END)")


def RND(x: str, n: int) -> str:
    """Half-up rounding of the shortest decimal form of a double (Spark ``round``)."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 18)), {n}) AS DOUBLE)"


def STABLE(sql: str, cols: list[str], n: int = 9) -> str:
    """Round the listed double columns of a result to n digits (float-noise guard)."""
    if not cols:
        return sql
    rep = ", ".join(f"{RND(c, n)} AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) _s"
