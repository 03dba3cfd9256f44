"""Named common table expressions and their composition into one statement."""

from __future__ import annotations

CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, needs: str, body: str) -> None:
    """Register a table expression with the ones it reads from."""
    CTES[name] = (needs.split(), body)


def compose(needs: str, select: str) -> str:
    """WITH clause of everything needed, in dependency order, then the select."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for other in CTES[name][0]:
            visit(other)
        ordered.append(name)

    for name in needs.split():
        visit(name)
    clauses = ",\n".join(f"{n} AS MATERIALIZED ({CTES[n][1]})" for n in ordered)
    return f"WITH {clauses}\n{select}" if ordered else select


def week_of(day: str) -> str:
    return f"(year({day}) * 100 + (dayofyear({day}) - 1) // 7 + 1)::INTEGER"


def day_of(week: str) -> str:
    return f"(make_date(({week}) // 100, 1, 1) + (7 * (({week}) % 100 - 1))::INTEGER)"


def minus_weeks(week: str, n: int) -> str:
    return week_of(f"({day_of(week)} - {7 * n})")


def minus_months(month: str, n: int) -> str:
    total = f"(({month}) // 100 * 12 + ({month}) % 100 - 1 - {n})"
    return f"({total} // 12 * 100 + {total} % 12 + 1)"
