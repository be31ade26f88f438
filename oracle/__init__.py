"""Reference answers in DuckDB SQL: named relations plus one SELECT per registered query."""

from __future__ import annotations

import re

AS_OF = "date '2024-01-16'"
CALENDAR = ("1992-01-01", "2030-12-31")


def rnd(x: str, n: int = 2) -> str:
    """Half-up rounding in decimal arithmetic, after dropping binary noise."""
    return f"cast(round(round(cast({x} as decimal(38, 12)), {max(9, n + 6)}), {n}) as double)"


def pct(a: str, b: str) -> str:
    return rnd(f"100e0 * ({a}) / nullif({b}, 0)")


def ratio(a: str, b: str, n: int = 2) -> str:
    return rnd(f"cast({a} as double) / nullif(cast({b} as double), 0)", n)


def total(x: str) -> str:
    return f"cast(sum({x}) as bigint)"


def flag(cond: str) -> str:
    return f"cast(coalesce({cond}, false) as smallint)"


def compose(final: str, relations: dict[str, str]) -> str:
    """Prefix a SELECT with the relations it needs, in dependency order."""
    order: list[str] = []

    def visit(sql: str) -> None:
        for name in re.findall(r"\b[a-z][a-z0-9]*_[a-z0-9_]+\b", sql):
            if name in relations and name not in order:
                visit(relations[name])
                if name not in order:
                    order.append(name)

    visit(final)
    if not order:
        return final
    ctes = ",\n".join(f"{n} as materialized ({relations[n]})" for n in order)
    if final.lstrip().startswith("with "):
        return f"with {ctes},\n{final.lstrip()[5:]}"
    return f"with {ctes}\n{final}"
