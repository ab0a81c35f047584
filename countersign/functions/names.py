"""Quoting of identifiers and literals for generated SQL."""

from collections.abc import Iterable


def quoted(name: str) -> str:
    """Back-quoted identifier, so that dots and spaces in a name stay part of it."""
    return "`" + name.replace("`", "``") + "`"


def quoted_table(name: str) -> str:
    """A dotted table name with each part quoted. Parts that are quoted already are left alone."""
    return name if "`" in name else ".".join(quoted(part) for part in name.split("."))


def literal(value: str) -> str:
    """String literal of Spark SQL."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def free_name(taken: Iterable[str], wanted: str) -> str:
    """``wanted``, with underscores behind it until no taken name equals it in any case."""
    names = {name.lower() for name in taken}
    while wanted.lower() in names:
        wanted += "_"
    return wanted
