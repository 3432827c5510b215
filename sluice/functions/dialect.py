"""Source-dialect SQL text in config values, as Spark reads it.

Config rows hold SQL written for the source database: double quotes name
columns there (and keep their case), while Spark would take them for string
constants.  ``spark_sql`` rewrites such names to back-ticks, outside string
literals and comments; text it cannot read is rejected before any data is read.
"""

from __future__ import annotations

from sluice.plans.strategy import ConfigError


def _quoted(text: str, start: int, quote: str) -> tuple[str, int]:
    """The content of the quoted run that opens at ``start`` (a doubled quote
    stands for one) and the place after it."""
    out, i = [], start + 1
    while i < len(text):
        if text[i] == quote:
            if text[i + 1 : i + 2] != quote:
                return "".join(out), i + 1
            i += 1
        out.append(text[i])
        i += 1
    raise ConfigError(f"unterminated {quote} in config SQL: {text!r}")


def back_ticked(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def spark_sql(text: str) -> str:
    """``text`` with double-quoted names in back-ticks and literals escaped for Spark."""
    out, i = [], 0
    while i < len(text):
        ch = text[i]
        if ch == "'":
            content, i = _quoted(text, i, "'")
            # a backslash is an ordinary character in the source dialect
            out.append("'" + content.replace("\\", "\\\\").replace("'", "\\'") + "'")
        elif ch == '"':
            name, i = _quoted(text, i, '"')
            if not name:
                raise ConfigError(f"empty quoted name in config SQL: {text!r}")
            out.append(back_ticked(name))
        elif ch == "`":
            name, i = _quoted(text, i, "`")
            out.append(back_ticked(name))
        elif text.startswith("--", i):
            end = text.find("\n", i)
            i = len(text) if end < 0 else end
        elif text.startswith("/*", i):
            end = text.find("*/", i + 2)
            if end < 0:
                raise ConfigError(f"unterminated comment in config SQL: {text!r}")
            out.append(" ")
            i = end + 2
        else:
            out.append(ch)
            i += 1
    return "".join(out)


def plain_name(name: str) -> str:
    """A configured column name without the double quotes or back-ticks around it."""
    name = name.strip()
    if name[:1] in ('"', "`"):
        content, end = _quoted(name, 0, name[0])
        if end == len(name) and content:
            return content
        raise ConfigError(f"not a column name: {name!r}")
    return name
