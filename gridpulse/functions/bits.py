from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def interleave(codes: list[Column], bits: int) -> Column:
    """Z-order value: the lowest ``bits`` bits of every code, taken in turn. At most 63 bits in all."""
    width = len(codes)
    if width * bits > 63:
        raise ValueError("codes do not fit in 63 bits")
    picked = [
        F.shiftleft(F.shiftright(code.cast("bigint"), bit).bitwiseAND(F.lit(1).cast("bigint")), bit * width + width - 1 - place)
        for bit in range(bits)
        for place, code in enumerate(codes)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), picked)


def spread_bits(codes: list[Column], bits: int) -> Column:
    """``interleave`` for codes below 2^bits, each looked up once in the table of all codes' spread bits."""
    width = len(codes)
    if width * bits > 63:
        raise ValueError("codes do not fit in 63 bits")
    table = F.array(*[F.lit(sum((code >> b & 1) << (b * width) for b in range(bits))).cast("bigint") for code in range(1 << bits)])
    spread = [F.shiftleft(F.get(table, code.cast("int")), width - 1 - place) for place, code in enumerate(codes)]
    return reduce(lambda a, b: a.bitwiseOR(b), spread)
