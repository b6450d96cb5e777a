"""A content fingerprint of a table as a multiset: independent of order, files and partitions, and
sensitive to how often a row occurs.

Each row becomes an unambiguous text (for every column in the order of names: name, type, null or
length and value); two digests of it, told apart by what stands before it, are each summed modulo
2^256. A digest is taken as eight numbers of 32 bits, which are summed by the engine; the sixteen sums
are put together where the query starts.

Defined cases: times are counted in microseconds, binary values written in hex, all others as their
text; an empty table has the sums 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LIMBS, _BITS = 8, 32


def row_text(rows: DataFrame) -> Column:
    parts = []
    for field in sorted(rows.schema.fields, key=lambda f: f.name):
        kind, column = field.dataType.simpleString(), F.col(f"`{field.name}`")
        value = F.unix_micros(column).cast("string") if kind == "timestamp" else F.hex(column) if kind == "binary" else column.cast("string")
        shown = F.concat(F.lit("="), F.octet_length(value).cast("string"), F.lit(":"), value)
        parts += [F.lit(f"{len(field.name)}:{field.name} {kind} "), F.coalesce(shown, F.lit("-"))]
    return F.concat(*parts)


def limb_sums(rows: DataFrame) -> DataFrame:
    """One row: the number of rows and the sums of the numbers of both digests."""
    texts = rows.select(row_text(rows).alias("text"))
    digests = texts.select(*[F.sha2(F.concat(F.lit(mark), F.col("text")), 256).alias(mark) for mark in ("a", "b")])
    limb = lambda mark, k: F.conv(F.substring(mark, 8 * k + 1, 8), 16, 10).cast("decimal(10,0)")
    return digests.agg(
        F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(limb(m, k)), F.lit(0)).cast("decimal(38,0)").alias(f"{m}{k}") for m in ("a", "b") for k in range(_LIMBS)]
    )


def multiset_fingerprint(rows: DataFrame) -> tuple[int, str, str]:
    """(rows, first sum, second sum), the sums in hex."""
    sums = limb_sums(rows).first()
    whole = lambda m: sum(int(sums[f"{m}{k}"]) << (_BITS * (_LIMBS - 1 - k)) for k in range(_LIMBS)) % (1 << 256)
    return sums["n"], f"{whole('a'):064x}", f"{whole('b'):064x}"


def xor_fingerprint(rows: DataFrame) -> DataFrame:
    """The order-free exclusive or of row hashes, all inside the engine; pairs of equal rows cancel."""
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.bit_xor(F.xxhash64(*sorted(rows.columns))).alias("fingerprint"))
