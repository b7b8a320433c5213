"""Keyword rules and string extraction. Every function returns a Column."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lowered_text(first: Column | str, *rest: Column | str) -> Column:
    """Lower-cased ``first`` joined with the others by blanks.

    A null in ``rest`` counts as empty; a null ``first`` makes the text null.
    """
    parts = [_col(first)]
    for c in rest:
        parts += [F.lit(" "), F.coalesce(_col(c), F.lit(""))]
    return F.lower(F.concat(*parts) if len(parts) > 1 else parts[0])


def matches_any(text: Column | str, terms: Iterable[str], word_boundary: bool = False) -> Column:
    """True when any term occurs in ``text``; null text gives null.

    By default a term matches inside words too ("add" in "address").
    """
    text = _col(text)
    terms = list(terms)
    if not terms:
        return F.when(text.isNotNull(), F.lit(False))
    if word_boundary:
        return text.rlike(r"\b(?:" + "|".join(re.escape(t) for t in terms) + r")\b")
    return reduce(Column.__or__, [text.contains(t) for t in terms])


def flag(condition: Column) -> Column:
    """Three-valued condition as a plain boolean: null counts as false."""
    return F.coalesce(condition, F.lit(False))


def label_ladder(
    text: Column | str,
    rules: Sequence[tuple[str, Sequence[str]]],
    default: str,
    word_boundary: bool = False,
) -> Column:
    """Label of the first rule with a matching term, else ``default``.

    Pass a column that is lowered already, so the text is prepared once.
    """
    text = _col(text)
    ladder = reduce(
        lambda w, rule: w.when(matches_any(text, rule[1], word_boundary), rule[0]),
        rules,
        F.when(F.lit(False), F.lit(default)),
    )
    return ladder.otherwise(default)


def any_contains(columns: Iterable[Column | str], needle: str) -> Column:
    """True when any column holds ``needle``; nulls are no match."""
    return reduce(Column.__or__, [flag(_col(c).contains(needle)) for c in columns])


def link_key(columns: Sequence[Column | str], host: str, pattern: str) -> Column:
    """Lower-cased first group of ``pattern`` in the first column holding ``host``.

    There is no fall-through: a column that holds the host but fails the pattern
    gives ''. Without the host in any column the key is null.
    """
    columns = [_col(c) for c in columns]
    pick = reduce(
        lambda w, c: w.when(c.contains(host), F.regexp_extract(c, pattern, 1)),
        columns,
        F.when(F.lit(False), F.lit("")),
    )
    return F.lower(pick)


def has_token(column: Column | str, token: str, is_array: bool = False, trim: bool = False) -> Column:
    """Membership of ``token`` in an array, or in a list kept as "[A,B]" text.

    Text tokens keep their blanks unless ``trim`` is set: "[A, B]" has " B", not "B".
    """
    column = _col(column)
    if is_array:
        return F.array_contains(column, token)
    tokens = F.split(F.translate(column, "[]", ""), ",", -1)
    if trim:
        tokens = F.transform(tokens, lambda t: F.trim(t))
    return F.array_contains(tokens, token)


def nested_contains(column: Column | str, needle: str) -> Column:
    """True when any string of an array of arrays holds ``needle``."""
    return flag(F.exists(F.flatten(_col(column)), lambda uri: uri.contains(needle)))


def repo_owner(full_name: Column | str) -> Column:
    return F.split_part(_col(full_name), F.lit("/"), F.lit(1))


def repo_name(full_name: Column | str) -> Column:
    return F.split_part(_col(full_name), F.lit("/"), F.lit(2))
