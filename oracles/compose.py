"""Puts check queries together from named parts.

A part refers to another part as `{name}`; the parts a query needs become its
WITH list. `RND(x, n)` rounds the printed decimal value half away from zero,
`DIV(a, b)` is a double division that gives null for zero.
"""

from __future__ import annotations

import re

PARTS: dict[str, str] = {}

_NAME = re.compile(r"\{(\w+)\}")


def part(name: str, sql: str) -> None:
    PARTS[name] = sql


def _macro(sql: str, name: str, build) -> str:
    """Replace `name(a, b)` calls, inner ones first."""
    while (hit := [m.start() for m in re.finditer(rf"\b{name}\(", sql)]):
        start = hit[-1]
        depth, pos, cuts = 0, start + len(name), []
        for pos in range(start + len(name), len(sql)):
            ch = sql[pos]
            depth += (ch == "(") - (ch == ")")
            if ch == "," and depth == 1:
                cuts.append(pos)
            if depth == 0:
                break
        edges = [start + len(name), *cuts, pos]
        args = [sql[a + 1 : b].strip() for a, b in zip(edges, edges[1:])]
        sql = sql[:start] + build(*args) + sql[pos + 1 :]
    return sql


def query(sql: str, swap: dict[str, str] | None = None, keep: frozenset[str] = frozenset()) -> str:
    """`swap` lets all parts but `keep` read another part instead of one, which itself may read the original."""
    swap = swap or {}

    def text_of(name: str) -> str:
        return PARTS[name] if name in swap.values() or name in keep else swapped(PARTS[name])

    def swapped(text: str) -> str:
        return _NAME.sub(lambda m: f"{{{swap.get(m[1], m[1])}}}", text)

    sql = swapped(sql)
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in _NAME.findall(text):
            if name in PARTS and name not in ordered:
                visit(text_of(name))
                ordered.append(name)

    visit(sql)
    ctes = ",\n".join(f"p_{n} as ({text_of(n)})" for n in ordered)
    own = re.match(r"\s*with\s+", sql)
    if own and ctes:
        sql = sql[own.end() :]
        ctes += ","
    text = (f"with {ctes}\n" if ctes else "") + sql
    text = _NAME.sub(lambda m: f"p_{m[1]}" if m[1] in PARTS else m[1], text)
    text = _macro(text, "DIV", lambda a, b: f"(cast({a} as double) / nullif(cast({b} as double), 0))")
    return _macro(
        text, "RND", lambda x, n: f"cast(cast(cast(cast({x} as double) as varchar) as decimal(38,{n})) as double)"
    )
