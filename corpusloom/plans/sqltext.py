"""SQL text shared by the equivalents (DuckDB dialect)."""

from __future__ import annotations

_BLANKS = [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]
BLANKS = " || ".join(f"chr({c})" for c in _BLANKS)
WS_CLASS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WORDS = rf"[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_{WS_CLASS}]"


def strip(x: str) -> str:
    return f"trim({x}, {BLANKS})"


def words(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '{WORDS}')"


def draw_int(seed: int, stream: str, key: str) -> str:
    return f"CAST('0x' || substr(md5('{seed}:{stream}:' || {key}), 1, 8) AS BIGINT)"


def draw(seed: int, stream: str, key: str) -> str:
    return f"({draw_int(seed, stream, key)} / 4294967296.0::DOUBLE)"


def grams(w: str, n: int = 3) -> str:
    run = " || ' ' || ".join([f"{w}[i]"] + [f"{w}[i + {k}]" for k in range(1, n)])
    return f"list_transform(range(1, len({w}) - {n - 2}), lambda i: {run})"


def repeat_fraction(g: str, cap: float = 0.5) -> str:
    c = f"{cap}::DOUBLE"
    return (
        f"CASE WHEN len({g}) = 0 THEN 0.0::DOUBLE ELSE least({c}, "
        f"(len({g}) - len(list_distinct({g}))) * {c} * 2 / len({g})) END"
    )


def count_of(x: str, piece: str) -> str:
    return f"CAST((length({x}) - length(replace({x}, '{piece}', ''))) / {len(piece)} AS BIGINT)"


def after_first(x: str, marker: str) -> str:
    """Null when the marker is absent."""
    return f"CASE WHEN instr({x}, '{marker}') > 0 THEN substr({x}, instr({x}, '{marker}') + {len(marker)}) END"


def before_first(x: str, marker: str) -> str:
    return f"CASE WHEN instr({x}, '{marker}') > 0 THEN left({x}, instr({x}, '{marker}') - 1) ELSE {x} END"
