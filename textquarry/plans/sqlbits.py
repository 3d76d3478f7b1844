"""Fragments shared by the SQL twins."""

from __future__ import annotations

SPACE = r"[ \t\n\r\f\x0B]+"
NONSPACE = r"[^ \t\n\r\f\x0B]+"


def uniform(*keys: str, seed: int | str = 42) -> str:
    parts = " || '|' || ".join(f"({k})::VARCHAR" for k in keys)
    return f"(('0x' || substr(md5({parts} || '|{seed}'), 1, 8))::BIGINT / 4294967296.0)"


def pick(options: list, *keys: str, seed: int | str = 42) -> str:
    listed = ", ".join("'" + str(o).replace("'", "''") + "'" for o in options)
    return f"([{listed}])[floor({uniform(*keys, seed=seed)} * {len(options)})::INT + 1]"


def words(col: str) -> str:
    return f"regexp_extract_all({col}, '{NONSPACE}')"


def n_words(col: str) -> str:
    return f"len({words(col)})::BIGINT"


def squeeze(col: str) -> str:
    return f"trim(regexp_replace({col}, '{SPACE}', ' ', 'g'))"
