"""Rows and values for tests."""

from __future__ import annotations

from datetime import date, datetime


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def day(text: str) -> date:
    return date.fromisoformat(text)


def rows(df) -> list[dict]:
    return [r.asDict() for r in df.collect()]


def by(df, *keys) -> dict:
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in rows(df)}
