"""DuckDB SQL that answers each registered query independently of the Spark code."""

from __future__ import annotations

import re

from revpulse.oracle import audits, checks, entities, models

CTES: dict[str, str] = {**entities.CTES, **models.CTES, **audits.CTES, **checks.CTES}
_NAMES = re.compile(r"\b(" + "|".join(sorted(CTES, key=len, reverse=True)) + r")\b")


def _needed(text: str, seen: dict[str, None]) -> dict[str, None]:
    for name in dict.fromkeys(_NAMES.findall(text)):
        if name not in seen:
            _needed(CTES[name], seen)
            seen[name] = None
    return seen


def statement(select: str) -> str:
    """A select with the common table expressions it mentions in front."""
    needed = _needed(select, {})
    if not needed:
        return select
    ctes = ",\n".join(f"{n} AS (\n{CTES[n].strip()}\n)" for n in needed)
    return f"WITH {ctes}\n{select.strip()}"


def statements() -> dict[str, str]:
    answers = {**entities.ANSWERS, **models.ANSWERS, **audits.ANSWERS, **checks.ANSWERS}
    return {name: statement(sql) for name, sql in answers.items()}
