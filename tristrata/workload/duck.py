"""DuckDB spellings of the expressions used in the SQL counterparts."""

from __future__ import annotations

# The primes of the published 64-bit xxHash and its seed.
P1 = 11400714785074694791
P2 = 14029467366897019727
P3 = 1609587929392839161
P4 = 9650029242287828579
P5 = 2870177450012600261
SEED = 42

_MOD = "18446744073709551616::UHUGEINT"


def _u(n: int) -> str:
    return f"{n}::UHUGEINT"


def _let(name: str, value: str, body: str) -> str:
    return f"list_transform([{value}], lambda {name}: {body})[1]"


def _mul(x: str, n: int) -> str:
    return f"(({x}) * {_u(n)} % {_MOD})"


def _add(x: str, n: int) -> str:
    return f"((({x}) + {_u(n)}) % {_MOD})"


def _rotl(x: str, bits: int) -> str:
    return f"(({x}) * {_u(2**bits)} % {_MOD} + ({x}) // {_u(2 ** (64 - bits))})"


def _little_endian(text: str, offset: str, n: int) -> str:
    return " + ".join(
        f"ascii(substr({text}, ({offset}) + {j + 1}, 1))::UHUGEINT * {_u(256**j)}" for j in range(n)
    )


def xxhash64(text: str) -> str:
    """Unsigned xxHash64 of an ASCII text of at most 31 characters."""
    lane = _little_endian("s", "8 * i", 8)
    mixed = f"list_transform(range(0, length(s) // 8), lambda i: {_mul(lane, P2)})"
    mixed = f"list_transform({mixed}, lambda k: {_mul(_rotl('k', 31), P1)})"
    start = _add("length(s)::UHUGEINT", SEED + P5)
    step8 = _add(_mul(_rotl("xor(h, k)", 27), P1), P4)
    lanes = f"list_reduce(list_prepend({start}, {mixed}), lambda h, k: {step8})"

    word = _mul(_little_endian("s", "8 * (length(s) // 8)", 4), P1)
    step4 = _add(_mul(_rotl(f"xor(a, {word})", 23), P2), P3)
    half = f"CASE WHEN length(s) % 8 >= 4 THEN {step4} ELSE a END"

    tail = _mul("ascii(substr(s, i + 1, 1))::UHUGEINT", P5)
    rest = f"list_transform(range(4 * (length(s) // 4), length(s)), lambda i: {tail})"
    step1 = _mul(_rotl("xor(h, k)", 11), P1)
    bytes_done = f"list_reduce(list_prepend(b, {rest}), lambda h, k: {step1})"

    out = "xor(z, z // 4294967296::UHUGEINT)"
    out = _let("z", _mul(f"xor(y, y // {_u(2**29)})", P3), out)
    out = _let("y", _mul(f"xor(x, x // {_u(2**33)})", P2), out)
    out = _let("x", bytes_done, out)
    out = _let("b", half, out)
    out = _let("a", lanes, out)
    return _let("s", text, out)


def sk_text(text: str) -> str:
    """Surrogate key of a text expression, which may be NULL."""
    h = _let(
        "u",
        xxhash64(text),
        f"least(CASE WHEN u >= {_u(2**63)} THEN {_MOD} - u ELSE u END, {_u(2**63 - 1)})::BIGINT",
    )
    return f"(CASE WHEN {text} IS NULL THEN CAST({SEED} AS BIGINT) ELSE {h} END)"


def sk(column: str) -> str:
    return sk_text(f"CAST({column} AS VARCHAR)")


def nk(*parts: str) -> str:
    return " || '|' || ".join(f"coalesce({p}, '')" for p in parts)


def sk_concat(*parts: str) -> str:
    return sk_text("(" + nk(*parts) + ")")


def norm(column: str) -> str:
    return f"trim(lower({column}), ' ')"


def tidy(column: str) -> str:
    return f"nullif({norm(column)}, '')"


def to_int(column: str) -> str:
    return f"try_cast(trunc(try_cast(trim({column}) AS DOUBLE)) AS INT)"


def to_date(column: str) -> str:
    return f"try_cast(substr({column}, 1, 10) AS DATE)"


def minutes(day: str, clock: str) -> str:
    return f"epoch(try_strptime({day} || ' ' || {clock}, '%Y-%m-%d %H:%M'))"


def duration(day: str, start: str, end: str) -> str:
    return f"CAST(trunc(({minutes(day, end)} - {minutes(day, start)}) / 60) AS INT)"


def number(column: str) -> str:
    return f"try_cast(regexp_replace({column}, '[^0-9.\\-]', '', 'g') AS DOUBLE)"


def latest(view: str, key: str, tie_break: list[str]) -> str:
    """Newest row per key; ties go to the greatest values of the given columns."""
    order = ", ".join(f"{c} DESC NULLS LAST" for c in ["ingested_at", *tie_break])
    rank = f"row_number() OVER (PARTITION BY {key} ORDER BY {order})"
    return f"(SELECT * FROM (SELECT *, {rank} AS rn FROM {view}) WHERE rn = 1)"
