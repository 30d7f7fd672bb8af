"""Words of the language rules in DuckDB SQL."""

from __future__ import annotations

_W = r"[\p{L}\p{M}\p{N}_]+"
CHUNK = rf"{_W}(?:[''’]{_W})*"


def uncontracted(x: str) -> str:
    return rf"regexp_replace({x}, '(?i)(n[''’]t|[''’](s|re|ll|ve|d|m))$', '')"


def tokens_of(table: str) -> str:
    """Alphabetic tokens of a table (record_id, text) without offsets."""
    return f"""select record_id, i, token from (
      select record_id, unnest(range(1, len(l) + 1)) as i, unnest(list_transform(l, lambda c: {uncontracted('c')})) as token
      from (select record_id, regexp_extract_all(text, '{CHUNK}') as l from {table}))
      where regexp_full_match(token, '\\p{{L}}+')"""
