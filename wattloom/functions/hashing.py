"""Hash positions for the sketches, as JVM-side column expressions."""

import math

from pyspark.sql import Column, functions as F

from wattloom.schemas import CMS_SEED_STEP


def hex_modulo(digest: str, digits: int, modulus: int) -> str:
    """SQL expression: value of a hex string of ``digits`` characters, modulo ``modulus``.

    Folded from the left in chunks small enough that every intermediate fits a bigint.
    """
    if modulus < 2 ** 31:
        width = 8
    elif modulus < 2 ** 47:
        width = 4
    else:
        raise ValueError("modulus must be below 2**47")
    total = "0L"
    for start in range(1, digits + 1, width):
        chunk = f"cast(conv(substring({digest}, {start}, {width}), 16, 10) as bigint)"
        total = f"(({total} * {16 ** width}L + {chunk}) % {modulus}L)"
    return total


def bloom_shape(capacity: int, fpp: float) -> tuple[int, int]:
    """(bits, hashes) of a Bloom filter sized for ``capacity`` keys."""
    bits = math.ceil(-capacity * math.log(fpp) / math.log(2) ** 2)
    return bits, max(1, round(bits / capacity * math.log(2)))


def bloom_digests(key: str, bits: int) -> tuple[Column, Column]:
    """First position and step of a key: its SHA-256 and MD5 digests modulo ``bits``."""
    text = f"encode(cast(`{key}` as string), 'utf-8')"
    return (F.expr(hex_modulo(f"sha2({text}, 256)", 64, bits)),
            F.expr(hex_modulo(f"md5({text})", 32, bits)))


def bloom_positions(first: str, step: str, bits: int, hashes: int) -> Column:
    """Array of the bit positions of a key (double hashing)."""
    return F.expr("array(" + ", ".join(
        f"({first} + {i}L * {step}) % {bits}L" for i in range(hashes)) + ")")


def cms_seeds(depth: int) -> list[int]:
    return [row * CMS_SEED_STEP % 2 ** 32 for row in range(1, depth + 1)]


def cms_cells(item: str, width: int, depth: int) -> Column:
    """Array of (row, col): the counter of an item in every row of the sketch."""
    def cell(row, seed):
        head = f"substring(sha2(concat(unhex('{seed:08x}'), encode(`{item}`, 'utf-8')), 256), 1, 8)"
        return (f"named_struct('row', {row}, 'col', "
                f"cast(conv({head}, 16, 10) as bigint) % {width}L)")
    return F.expr("array(" + ", ".join(
        cell(i, s) for i, s in enumerate(cms_seeds(depth))) + ")")
