"""Column-level helpers that stay inside whole-stage codegen.

Each is a composition of built-in expressions; none is a Python UDF.
"""

from __future__ import annotations


from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_cast(c: str | Column, type_name: str) -> Column:
    """Cast that gives null for bad input under ANSI rules."""
    return col_of(c).try_cast(type_name)


def nan_div(num: Column, den: Column) -> Column:
    """JVM floating division: x/0 gives NaN when x is 0, not an error (rule 7)."""
    return F.when(den == 0, F.lit(float("nan"))).otherwise(num.cast("double") / den.cast("double"))


def map_field_or_default(m: Column, key: str, default: str = "0") -> Column:
    """Value of ``key`` in a parsed JSON map, ``default`` only when the key is absent.

    A present JSON null stays null: ``map_contains_key`` tells the cases apart.
    """
    return F.when(F.map_contains_key(m, F.lit(key)), m[key]).otherwise(F.lit(default))


def padded(c: str | Column, width: int, fill: str = "0") -> Column:
    """Text filled up on the left to ``width``; longer text stays whole (``lpad`` alone would cut it)."""
    x = col_of(c).cast("string")
    return F.when(F.length(x) < width, F.lpad(x, width, fill)).otherwise(x)


def octet(addr: str | Column, i: int) -> Column:
    """Octet ``i`` (0-based) of a dotted address as int; null when missing or bad."""
    v = F.get(F.split(col_of(addr), "[.]"), i).try_cast("int")
    return F.when((v >= 0) & (v <= 255), v)


def address_number(addr: str | Column) -> Column:
    """32-bit value of a dotted address as bigint; null unless there are four
    octets in 0..255. One ``split`` folded by ``aggregate``, so the parse is
    not repeated when Catalyst copies the expression into inferred filters."""
    parts = F.split(col_of(addr), "[.]")
    value = F.aggregate(parts, F.lit(0).cast("bigint"),
                        lambda acc, x: acc * 256 + x.try_cast("int").cast("bigint"))
    ok = (F.size(parts) == 4) & F.forall(parts, lambda x: x.try_cast("int").between(0, 255))
    return F.when(ok, value)


def dot(a: str | Column, b: str | Column) -> Column:
    """Dot product of two numeric arrays with SQL higher-order functions."""
    prod = F.zip_with(col_of(a), col_of(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prod, F.lit(0.0), lambda acc, x: acc + F.coalesce(x, F.lit(0.0)))


def norm2(a: str | Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: str | Column, b: str | Column) -> Column:
    """Vector cosine ``a.b / (|a| |b|)``; a zero vector gives NaN, as on the JVM."""
    return nan_div(dot(a, b), norm2(a) * norm2(b))


def split_words(line: str | Column, sep: str = " ") -> Column:
    """JVM ``String.split(sep)`` on a line (O75, SURVEY §1 rule 5).

    Trailing empty strings are dropped; an empty line gives one empty token;
    a line of separators only gives none.
    """
    c = col_of(line)
    stripped = F.regexp_replace(c, f"(?:{sep})+$", "")
    return (F.when(c == "", F.array(F.lit("")))
            .when(stripped == "", F.array().cast("array<string>"))
            .otherwise(F.split(stripped, sep)))
