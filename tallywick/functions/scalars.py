"""Scalar helpers that are columns: time shifts, distances, rounding, and the letter-square codec."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Fixed value: the divisor of the codec's keys.
DIVISOR = 8271997208960872478735181815578166723519929177896558845922250595511921395049126920528021164569045773


def shifted(time: Column, hours: int) -> Column:
    """A fixed shift, without daylight saving."""
    return time + F.make_dt_interval(hours=F.lit(hours))


def distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.sqrt(F.pow(x1 - x2, F.lit(2)) + F.pow(y1 - y2, F.lit(2)))


def half_up(value: Column, places: int = 2) -> Column:
    return F.floor(value * 10 ** places + 0.5) / 10 ** places


def doubled_backslashes(text: Column) -> Column:
    return F.replace(text, F.lit("\\"), F.lit("\\\\"))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rot13(text: Column) -> Column:
    turned = UPPER[13:] + UPPER[:13] + LOWER[13:] + LOWER[:13]
    return F.translate(text, UPPER + LOWER, turned)


LIMB = 17  # digits of a limb: ten times a limb and a carry fit into a long


def _limbs(n: int, n_limbs: int) -> list[int]:
    return [n // 10 ** (LIMB * k) % 10 ** LIMB for k in range(n_limbs - 1, -1, -1)]


def quotient_mod(digits: Column, divisor: int, modulus: int) -> Column:
    """(digits / divisor) mod `modulus` for a text of decimal digits of any length, by long division.

    The remainder is a struct of 17-digit limbs, the greatest first, so structs compare as numbers.
    As many leading digits as are surely less than the divisor are taken at once; each further
    digit is brought down, and the greatest multiple of the divisor that fits is taken off.
    """
    head = len(str(divisor)) - 1
    n_limbs = (head + 2 + LIMB - 1) // LIMB
    names = [f"l{k}" for k in range(n_limbs)]
    packed = lambda values: F.struct(*[v.cast("long").alias(n) for v, n in zip(values, names)])
    multiples = F.array(*[packed(map(F.lit, _limbs(k * divisor, n_limbs))) for k in range(10)])
    top = 10 ** (LIMB - 1)

    def brought(state: Column, digit: Column) -> Column:
        """Ten times the remainder plus the digit: each limb gets the leading digit of the next."""
        rest = [state["rest"][n] for n in names]
        low = [F.call_function("div", x, F.lit(top)) for x in rest[1:]] + [digit.cast("long")]
        grown = packed([x % top * 10 + y for x, y in zip(rest, low)])
        return F.struct(grown.alias("rest"), state["q"].alias("q"))

    def fitted(state: Column) -> Column:
        times = F.size(F.filter(multiples, lambda m: m <= state["rest"])) - 1
        return F.struct(state["rest"].alias("rest"), state["q"].alias("q"), times.alias("times"), F.get(multiples, times).alias("off"))

    def reduced(state: Column) -> Column:
        out = []
        for k, n in enumerate(names):
            lower = names[k + 1:]
            part = lambda x: F.struct(*[x[m] for m in lower])  # noqa: B023, E731
            borrow = F.when(part(state["rest"]) < part(state["off"]), 1).otherwise(0) if lower else F.lit(0)
            out.append(state["rest"][n] - state["off"][n] - borrow)
        rest = packed([F.when(x < 0, x + 10 ** LIMB).otherwise(x) for x in out])
        return F.struct(rest.alias("rest"), ((state["q"] * 10 + state["times"]) % modulus).cast("long").alias("q"))

    # Through arrays of one, so that each stage is worked out once.
    step = lambda state, digit: F.transform(F.transform(F.array(brought(state, digit)), fitted), reduced)[0]
    width = n_limbs * LIMB
    start = F.lpad(F.left(digits, F.lit(head)), width, "0")
    first = packed([F.substring(start, k * LIMB + 1, LIMB) for k in range(n_limbs)])
    further = F.filter(F.split(F.substring(digits, head + 1, (1 << 31) - 1), ""), lambda x: x != "")
    return F.aggregate(further, F.struct(first.alias("rest"), F.lit(0).cast("long").alias("q")), step, lambda state: state["q"])


def letter_shift(key: Column, divisor: int = DIVISOR) -> Column:
    """(key / divisor) mod 25 + 1 for keys of any number of digits; null for what is no number."""
    number = F.when(key.rlike("^[0-9]+$"), key)
    return (quotient_mod(number, divisor, 25) + 1).cast("int")


def decode_messages(df: DataFrame) -> DataFrame:
    """(msg_id, message): the square of letters is read by its anti-diagonals, from the top right, and shifted back.

    The square's side is the whole root of the length; letters past the square are not part of
    it. A null message or key gives null, a message under one letter an empty text. The shift is one
    translation of the text; a diagonal's letters stand one less than the side apart.
    """
    z, n = F.col("z"), F.col("n")
    square = df.select("msg_id", letter_shift(F.col("key")).alias("z"), F.col("message").alias("text"), F.floor(F.sqrt(F.length("message"))).cast("int").alias("n"))
    # A letter less than z above A wraps round.
    shifted = square.select("msg_id", "n", F.call_function("translate", F.col("text"), F.lit(UPPER), F.substring(F.lit(UPPER * 2), F.lit(27) - z, F.lit(26))).alias("text"))
    chars = shifted.select("msg_id", "n", F.split("text", "").alias("chars"))
    column = lambda i: F.sequence(F.least(i, n - 1), F.greatest(i - n + 1, F.lit(0)), F.lit(-1))
    line = lambda i: F.array_join(F.transform(column(i), lambda j: F.get("chars", (i - j) * n + j)), "")
    lines = F.transform(F.sequence(F.lit(0), 2 * (n - 1)), line)
    return chars.select("msg_id", F.when(F.col("chars").isNotNull(), F.when(n > 0, F.array_join(lines, "")).otherwise("")).alias("message"))
