"""SQL text helpers for the oracle queries (rule tables become CASE expressions)."""

from __future__ import annotations

from tallyloom.fixed_values import NULL_KEY_PART, Bands, Rules


def lit(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).upper()
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else repr(value)


def case(branches, other) -> str:
    body = " ".join(f"WHEN {cond} THEN {lit(value)}" for cond, value in branches)
    return f"(CASE {body} ELSE {lit(other)} END)"


def bands(expr: str, b: Bands) -> str:
    return case(((f"{expr} {b.op} {bound}", label) for bound, label in b.cuts), b.other)


def rules(r: Rules) -> str:
    return case(((f"({pred})", label) for label, pred in r.rows), r.other)


def mapped(expr: str, mapping: dict, other=None) -> str:
    return case(((f"{expr} = {lit(k)}", v) for k, v in mapping.items()), other)


def member(expr: str, sets: dict, other=None) -> str:
    return case(((f"{expr} IN ({', '.join(lit(v) for v in vs)})", k) for k, vs in sets.items()), other)


def like(expr: str, patterns: dict, other=None) -> str:
    return case(((f"{expr} LIKE {lit(p)}", k) for k, p in patterns.items()), other)


def suffix(expr: str, suffixes: dict, other=None) -> str:
    return case(((f"suffix({expr}, {lit(s)})", k) for k, s in suffixes.items()), other)


def argmax(pairs, other=None) -> str:
    best = f"GREATEST({', '.join(c for c, _ in pairs)})"
    return case(((f"{c} = {best}", label) for c, label in pairs), other)


def div(n: str, d: str) -> str:
    return f"(CAST({n} AS DOUBLE) / NULLIF(CAST({d} AS DOUBLE), 0))"


def avg(x: str) -> str:
    return f"(CAST(SUM({x}) AS DOUBLE) / NULLIF(COUNT({x}), 0))"


def avg_over(x: str, w: str) -> str:
    return f"(CAST(SUM({x}) OVER ({w}) AS DOUBLE) / NULLIF(COUNT({x}) OVER ({w}), 0))"


def clamp(x: str) -> str:
    return f"LEAST(100, GREATEST(0, {x}))"


def key(*cols: str) -> str:
    parts = " || '-' || ".join(f"COALESCE(CAST({c} AS VARCHAR), '{NULL_KEY_PART}')" for c in cols)
    return f"md5({parts})"


def month_diff(a: str, b: str) -> str:
    return f"date_diff('month', {a}, {b})"
