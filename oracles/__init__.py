"""The same results in plain SQL, for the check against another engine."""

from __future__ import annotations


def all_oracles() -> dict[str, str]:
    from oracles import evaluation, features, gold, nested, quality, silver, star

    merged: dict[str, str] = {}
    for module in (silver, gold, star, quality, features, evaluation, nested):
        merged.update(module.ORACLES)
    return merged
