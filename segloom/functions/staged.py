"""Fast forms of the partition functions for a named column of a DataFrame.

``hashing`` folds over the characters of a text, which Spark interprets. The forms here stay
in generated code:

* the string hash of a whole-number column is arithmetic on the number;
* Murmur2 takes a short text four characters at a time, as slices of its hexadecimal form.
  Only longer texts take the fold.

Values used more than once are columns of their own, so that each is computed once. The
expressions are long but regular, hence written as SQL text. They are kept small on purpose:
the JVM does not compile a generated method beyond 8,000 bytes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segloom.functions.hashing import (
    MASK32,
    MURMUR2_MULTIPLIER,
    MURMUR2_SEED,
    hashcode_id,
    murmur2,
    murmur_id,
)
from segloom.functions.keys import is_integral, partition_key

# Character codes of '0' and '-', longest text of a bigint.
CODE_ZERO = 48
CODE_MINUS = 45
MAX_LONG_TEXT = 20
# Digits that are handled at a time; a bigint has two such chunks and one digit more.
CHUNK_DIGITS = 9

# ASCII texts up to this many bytes avoid the fold.
SHORT_TEXT = 32


def _quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


# How the names of helper columns begin.
TEMP = "__h_"


def _temp(name: str) -> str:
    return TEMP + name


def _signed32(value: int) -> int:
    """Member of [-2**31, 2**31) with the same low 32 bits, so that products fit a bigint."""
    return (value + (1 << 31)) % (1 << 32) - (1 << 31)


def _digit_polynomial(shifted: str) -> str:
    """Sum of digit * 31**place of a number below 10**9, given as a double that is 0.5 larger.

    With q(j) = floor(n / 10**j) the digit at place j is q(j) - 10 q(j+1), so the sum equals n
    plus the sum of q(j) * 21 * 31**(j-1) over j >= 1, and no digit has to be taken out. The
    half keeps every quotient away from whole numbers, so rounding in the product cannot move
    it across one. Doubles hold all values exactly and need no overflow checks.
    """
    terms = [f"rint({shifted} * 1E-{j}D - 0.5D) * {21 * 31 ** (j - 1)}D" for j in range(1, CHUNK_DIGITS)]
    return f"cast({shifted} - 0.5D + {' + '.join(terms)} as bigint)"


def with_hashcode_integral(df: DataFrame, column: str, partitions: int, name: str) -> DataFrame:
    """Partition id by the string hash of a whole-number column; null counts as empty text."""
    number, size, low, middle = _temp("number"), _temp("size"), _temp("low"), _temp("middle")
    chunk = 10**CHUNK_DIGITS
    # What the characters add whatever the digits: a '0' at each place, and the sign.
    plain = [CODE_ZERO * sum(31**j for j in range(digits)) for digits in range(MAX_LONG_TEXT + 1)]
    signed = [0] + [plain[n - 1] + CODE_MINUS * 31 ** (n - 1) for n in range(1, MAX_LONG_TEXT + 1)]
    constants = ", ".join(f"{_signed32(value)}L" for value in plain + signed)
    position = f"octet_length(cast({number} as string)) + if({number} < 0, {len(plain)}, 0)"
    raw = F.expr(
        f"coalesce(get(array({constants}), {position}), 0L) + {_digit_polynomial(low)}"
        f" + (({_digit_polynomial(middle)} & {MASK32}L) * {_signed32(31**CHUNK_DIGITS)}L & {MASK32}L)"
        f" - {size} div {chunk * chunk}L * {_signed32(31 ** (2 * CHUNK_DIGITS))}L"
    )
    # Null is replaced first and put back last: code for values that cannot be null is shorter.
    # Negated magnitudes have no special case for the smallest bigint.
    return (
        df.withColumn(number, F.expr(f"coalesce(cast({_quoted(column)} as bigint), 0L)"))
        .withColumn(size, F.expr(f"if({number} > 0, -{number}, {number})"))
        .withColumns(
            {
                low: F.expr(f"0.5D - {size} % {chunk}L"),
                middle: F.expr(f"0.5D - {size} div {chunk}L % {chunk}L"),
            }
        )
        .withColumn(name, F.when(F.col(_quoted(column)).isNull(), 0).otherwise(hashcode_id(raw, partitions)))
        .drop(number, size, low, middle)
    )


def with_modulo_integral(df: DataFrame, column: str, partitions: int, name: str) -> DataFrame:
    """Partition id by remainder of a whole-number column; a null key fails the query."""
    failure = F.raise_error(F.lit(f"modulo partitioning needs a whole number, {column} is null"))
    number = F.coalesce(F.col(_quoted(column)).cast("long"), failure.cast("long"))
    return df.withColumn(name, F.pmod(number, F.lit(partitions)).cast("int"))


def _times(value: str, factor: str = f"{MURMUR2_MULTIPLIER}L") -> str:
    return f"(({value}) * {factor} & {MASK32}L)"


def _with_murmur2(df: DataFrame, text: str, longest: int, out: str) -> DataFrame:
    """Add Murmur2 of an ASCII column of at most ``longest`` bytes."""
    length, digits = _temp("length"), _temp("digits")

    def number(start: int, size: str) -> str:
        return f"coalesce(cast(conv(substring({digits}, {start}, {size}), 16, 10) as bigint), 0L)"

    # Reversing the text first makes a slice of its hexadecimal form little-endian.
    words = {_temp(f"w{i}"): F.expr(_times(number(-8 * (i + 1), "8"))) for i in range(longest // 4)}
    state = f"{MURMUR2_SEED}L ^ {length}"
    for i, word in enumerate(words):
        whole = f"{length} >= {4 * i + 4}"
        mixed = _times(f"{word} ^ shiftright({word}, 24)")
        # One mention of the running state per round keeps the expression linear in size.
        factor = f"case when {whole} then {MURMUR2_MULTIPLIER}L else 1L end"
        state = f"({_times(state, factor)} ^ case when {whole} then {mixed} else 0L end)"
    factor = f"case when {length} % 4 > 0 then {MURMUR2_MULTIPLIER}L else 1L end"
    tail = number(1, f"cast({length} % 4 * 2 as int)")
    a, b = _temp("a"), _temp("b")
    return (
        df.withColumns({length: F.char_length(text).cast("long"), digits: F.hex(F.reverse(text))})
        .withColumns(words)
        .withColumn(a, F.expr(_times(f"{state} ^ {tail}", factor)))
        .withColumn(b, F.expr(_times(f"{a} ^ shiftright({a}, 13)")))
        .withColumn(out, F.expr(f"{b} ^ shiftright({b}, 15)"))
        .drop(length, digits, *words, a, b)
    )


def with_murmur_integral(df: DataFrame, column: str, partitions: int, name: str) -> DataFrame:
    """Partition id by Murmur2 of a whole-number column's text; null counts as empty text."""
    text, out = _temp("text"), _temp("out")
    hashed = _with_murmur2(df.withColumn(text, partition_key(F.col(_quoted(column)))), text, MAX_LONG_TEXT, out)
    return hashed.withColumn(name, murmur_id(F.col(out), partitions)).drop(text, out)


def with_murmur_text(df: DataFrame, column: str, partitions: int, name: str) -> DataFrame:
    """Partition id by Murmur2 of a column's text; null counts as empty text."""
    key, brief, long, out = _temp("key"), _temp("brief"), _temp("long"), _temp("out")
    is_short = f"octet_length({key}) <= {SHORT_TEXT} and octet_length({key}) = char_length({key})"
    prepared = df.withColumn(key, partition_key(F.col(_quoted(column)))).withColumns(
        {brief: F.expr(f"if({is_short}, {key}, '')"), long: F.expr(f"if({is_short}, null, {key})")}
    )
    raw = F.coalesce(murmur2(F.col(long)), F.col(out))
    hashed = _with_murmur2(prepared, brief, SHORT_TEXT, out)
    return hashed.withColumn(name, murmur_id(raw, partitions)).drop(key, brief, long, out)


StagedFunction = Callable[[DataFrame, str, int, str], DataFrame]

INTEGRAL_FORMS: dict[str, StagedFunction] = {
    "hashcode": with_hashcode_integral,
    "murmur": with_murmur_integral,
    "modulo": with_modulo_integral,
}
TEXT_FORMS: dict[str, StagedFunction] = {"murmur": with_murmur_text}

# Columns up to which a form fits into a compiled method together with reading and writing
# them. Uncompiled, it would be slower than the fold, which is not part of that method.
WIDEST_TABLE = {"hashcode": 45, "murmur": 65, "modulo": 10_000}


def staged_form(df: DataFrame, column: str, function: str) -> StagedFunction | None:
    """The fast form for ``column``, if there is one that suits its type and the table."""
    if len(df.columns) > WIDEST_TABLE[function]:
        return None
    return (INTEGRAL_FORMS if is_integral(df, column) else TEXT_FORMS).get(function)
