"""Oracle SQL assembly: a query names its final SELECT; the CTEs it reads
(and theirs, transitively) are prepended in dependency order."""

from __future__ import annotations

import re

from ledgerloom.plans import oracle_binding, oracle_models

CTES: dict[str, str] = {**oracle_binding.CTES, **oracle_models.CTES}
_FORMAT = {"as_of_month": "2001-12-01"}
_WORD = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def _deps(text: str) -> list[str]:
    return [w for w in dict.fromkeys(_WORD.findall(text)) if w in CTES]


def with_ctes(final_sql: str) -> str:
    order: list[str] = []
    seen: set[str] = set()

    def visit(name: str, stack: tuple = ()) -> None:
        if name in seen:
            return
        if name in stack:
            raise ValueError(f"cycle at {name}")
        for d in _deps(CTES[name]):
            if d != name:
                visit(d, stack + (name,))
        seen.add(name)
        order.append(name)

    for d in _deps(final_sql):
        visit(d)
    if not order:
        return final_sql
    body = ",\n".join(f"{n} AS ({CTES[n].format(**_FORMAT) if '{as_of' in CTES[n] else CTES[n]}\n)"
                      for n in order)
    return f"WITH {body}\n{final_sql}"


def select_all(cte: str) -> str:
    return with_ctes(f"SELECT * FROM {cte}")
