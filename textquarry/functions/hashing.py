"""Deterministic pseudo-randomness and content hashes.

Every random choice in the library is a hash of the row key and a seed, so a
lost executor recomputes the same rows and any engine can repeat the choice.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def uniform(*keys: Column | str, seed: int | str = 42) -> Column:
    """A number in [0, 1) from the first 32 bits of ``md5(key|...|seed)``."""
    parts = [(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]
    digest = F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def pick(options: list, *keys: Column | str, seed: int | str = 42) -> Column:
    """One of ``options``, each equally likely, chosen by the row key."""
    slot = F.floor(uniform(*keys, seed=seed) * len(options)).cast("int") + 1
    return F.element_at(F.array(*[F.lit(o) for o in options]), slot)


def pick_weighted(options: list, weights: list[float], *keys: Column | str, seed: int | str = 42) -> Column:
    """One of ``options`` with probability proportional to its weight."""
    if len(options) != len(weights):
        raise ValueError("options and weights must have the same length")
    total, running = float(sum(weights)), 0.0
    draw, choice = uniform(*keys, seed=seed), None
    for option, weight in zip(options[:-1], weights[:-1]):
        running += weight / total
        below = draw < F.lit(running)
        choice = F.when(below, F.lit(option)) if choice is None else choice.when(below, F.lit(option))
    return F.lit(options[-1]) if choice is None else choice.otherwise(F.lit(options[-1]))


def let(value: Column, body) -> Column:
    """``body`` applied to a value that is computed once.

    Inside a lambda, an outer expression is evaluated again for every element; a
    bound lambda variable is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def squeeze(text: Column) -> Column:
    """Runs of white space become one space; ends are trimmed."""
    return F.trim(F.regexp_replace(text, r"[ \t\n\r\f\x0B]+", " "))


def content_hash(text: Column) -> Column:
    """The identity of a text up to white space."""
    return F.md5(squeeze(text))
