"""Small inputs with what is awkward in them."""

import zlib

from conftest import FOLDER  # noqa: F401

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, fp long, row string, "
    "`a.b` string, shard int, `word` string, rank int, cut string, spans int"
)


def docs(spark, rows):
    """Documents with more columns, of names that operators use inside, all null."""
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), *[None] * 9) for i, t in rows], SCHEMA)


def sentence(i, n=12):
    return " ".join(f"w{(i * 37 + j * j) % 1009}" for j in range(n))


ODD = [
    (1, None), (2, ""), (3, "  \n "), (4, "one"), (5, sentence(1)), (6, sentence(1)), (6, sentence(1)),
    (7, "Ünïcode ÉCOLE's 12 <|endoftext|> \x00 \x1c 한 中文, don't"), (None, sentence(2)), (None, None),
    (8, "word " * 30_000), (9, "x" * 100_000), (10, sentence(3, 3000)),
]


def crc(text):
    return zlib.crc32(str(text).encode())
