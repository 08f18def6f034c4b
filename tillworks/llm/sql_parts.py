"""Pieces of SQL that several of the SQL counterparts share."""

#: CTE `crc_steps(steps)`: the crc32 of every byte as a list of 256 numbers.
CRC_STEPS = """crc_steps AS (
        SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, k:
            CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS steps
        FROM range(256) t(b)
    )"""


def crc32(text: str) -> str:
    """The unsigned crc32 of an ASCII text, in a query that has crc_steps in its FROM."""
    codes = f"list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))"
    folded = f"list_reduce(list_prepend(4294967295, {codes}), lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]))"
    return f"xor({folded}, 4294967295)"
