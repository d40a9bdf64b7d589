"""Conversations for the tests: a given table plus nulls, empty and long texts, repeated rows
and turns, copies of one conversation, and extra columns whose names the operators use."""

import zlib

from .cases import rows

SCHEMA = "conv_id long, turn long, role string, text string, id string, harm int, audit string, path int, of long, copy int, block long"
LONG = "A very long turn without an end, " * 20_000

ODD = [
    (None, 0, "user", "No conversation."),
    (None, None, "assistant", "None either."),
    (3_000, None, "user", "A null turn comes first."),
    (3_000, 2**62, "assistant", "A late turn."),
    (3_000, -(2**63), "user", "The earliest turn."),
    (3_001, 0, None, None),
    (3_002, 0, "user", ""),
    (3_002, 1, "assistant", " \t\n\x0b "),
    (3_003, 0, "user", LONG),
    (3_003, 1, "assistant", LONG + "."),
    (3_004, 0, "tool", "Roles of other kinds."),
    (3_004, 1, "", "Éé 漢字 \U0001f600!"),
    (3_005, 0, "user", "Same row."),
    (3_005, 0, "user", "Same row."),
    (3_005, 5, "user", "Same row."),
    (3_005, 5, "assistant", "Other."),
    (-7, 0, "system", "A negative id"),
    (-7, 1, "user", "is an id."),
    *((4_000 + i, t, ("user", "assistant")[t % 2], f"Copied turn {t}.") for i in range(40) for t in range(10)),
    *((5_000, t, ("user", "assistant", "user")[t % 3], f"Long talk {t % 7}.") for t in range(300)),
]


def talk_rows():
    return [r[:4] for r in rows("conversations")] + ODD


def talks(spark):
    return spark.createDataFrame([(*r, "x", 1, "K", 2, 3, 4, 5) for r in talk_rows()], SCHEMA).repartition(5)


def no_talks(spark):
    return spark.createDataFrame([], SCHEMA)


def crc(text):
    return zlib.crc32(text.encode())
