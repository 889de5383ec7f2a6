"""Named subqueries written into one SQL text.

Operators are chained by handing frames on, and a WITH clause inside a chained frame is
not always planned correctly, so named parts are inlined as plain subqueries instead.
"""

from __future__ import annotations

import re


def nested(text: str, **parts: str) -> str:
    """``text`` with each ``@name`` replaced by the subquery of that name.

    A part may use the parts listed before it.
    """
    done: dict[str, str] = {}
    for name, body in parts.items():
        done[name] = f"({_fill(body, done)})"
    return _fill(text, done)


def _fill(text: str, parts: dict[str, str]) -> str:
    return re.sub(r"@(\w+)", lambda m: parts[m.group(1)], text)
