"""Text helpers for configuration values."""

from __future__ import annotations

import re
from collections.abc import Collection

from pyspark.sql import Column
from pyspark.sql import functions as F

# The command words an import may carry.
COMMANDS = (
    "PRINT", "NOGROUPBY", "SUMFIELDS", "NODELTA", "FORCEDELTA", "INTRADAY", "NOINTRADAY",
    "NODAY", "NOSCHEDULE", "SOURCE_UPDATE_NULL", "SOURCE_FILTER_IMPORT", "DELETE_TAIL",
    "DELETE_HEAD", "LOG_ROWCOUNT", "LOG_QUERY", "LOG_WARNING", "LOG_IMPORTS", "DATADAY",
)

# Flags whose singular and plural forms count alike.
EITHER_NUMBER = ("LOG_IMPORTS", "LOG_QUERY")


def string_spaces(s: Column) -> Column:
    """Tabs and line ends become spaces and runs of them one space; the ends are not trimmed."""
    return F.regexp_replace(s, r"[ \t\r\n]+", " ")


def blank_as_null(s: Column) -> Column:
    return F.nullif(F.trim(s), F.lit(""))


def error_json(error: BaseException, where: str = "-") -> dict[str, str]:
    """What went wrong, for the run log: the error's class and condition, and its message."""
    condition = getattr(error, "getCondition", lambda: None)() or type(error).__name__
    state = getattr(error, "getSqlState", lambda: None)() or ""
    return {
        "Severity": "16",
        "State": state,
        "Procedure": where,
        "Line": condition,
        "Message": str(error),
    }


def command_words(commands: Column) -> Column:
    """The upper-cased words of a command text; flags are compared as whole words."""
    return F.split(F.trim(string_spaces(F.upper(F.coalesce(commands, F.lit(""))))), " ")


def command_flags(commands: Column) -> dict[str, Column]:
    """Flag name -> whether the command text holds it."""
    words = command_words(commands)

    def held(flag: str) -> Column:
        form = flag[:-1] if flag in EITHER_NUMBER else flag + "$"
        return F.exists(words, lambda w: w.rlike(f"^-+{form}"))

    return {c: held(c) for c in COMMANDS}


def flag_set(commands: str) -> frozenset[str]:
    words = {w.lstrip("-") for w in commands.upper().split() if w.startswith("-")}
    for flag in EITHER_NUMBER:
        if any(w.startswith(flag[:-1]) for w in words):
            words.add(flag)
    return frozenset(words)


_QUOTED_OR_NAME = re.compile(
    r"'(?:[^']|'')*'|\"(?:[^\"]|\"\")*\"|`[^`]*`"          # quoted text stays as it is
    r"|(?<![\w)\]'\"`])\[(?P<name>[A-Za-z_][^\]'\"`]*)\]"  # [name] -> `name`, no element of an array or map
    r"|(?<![\w.])(?P<table>S|F|D|T|A|DATA)\.",              # table letters of the documented filters
    re.IGNORECASE,
)


def sql_text(text: str, columns: Collection[str] = ()) -> str:
    """Configured SQL text as a Spark expression: [name] quoting and the table letters that
    documented filters use. A letter that is one of `columns` is a struct's name and stays."""
    own = {c.upper() for c in columns}

    def one(m: re.Match) -> str:
        if m.group("name"):
            return f"`{m.group('name')}`"
        letter = m.group("table")
        return "" if letter and letter.upper() not in own else m.group(0)

    return _QUOTED_OR_NAME.sub(one, text or "").strip()


_QUOTED = r"'(?:\\.|''|[^'\\])*'|\"(?:\\.|\"\"|[^\"\\])*\"|`[^`]*`"


def split_outside(text: str, separator: str) -> list[str]:
    """The parts of a text between separators (a pattern) that stand outside quotes and brackets."""
    out, depth, start = [], 0, 0
    for m in re.finditer(rf"(?P<quoted>{_QUOTED})|(?P<cut>{separator})|[(\[{{]|[)\]}}]", text, re.IGNORECASE):
        if m["cut"] is not None and depth == 0:
            out.append(text[start : m.start()])
            start = m.end()
        elif m["quoted"] is None and m[0] in "([{":
            depth += 1
        elif m["quoted"] is None and m[0] in ")]}":
            depth -= 1
    return [*out, text[start:]]


def field_list(text: str, columns: Collection[str] = ()) -> list[str]:
    """The expressions of a comma-separated list; commas inside brackets or quotes do not split."""
    return [p.strip() for p in split_outside(sql_text(text, columns), ",") if p.strip()]


def to_int(text: str) -> int:
    try:
        return int((text or "").strip())
    except ValueError:
        return 0


def to_scale(text: str) -> float:
    """A scaling coefficient: comma or dot decimals; blank or 0 means 1."""
    try:
        return float((text or "").strip().replace(",", ".")) or 1.0
    except ValueError:
        return 1.0
