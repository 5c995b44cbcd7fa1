"""A small table with what operators must stand: nulls, empty and long texts, ties, repeated rows, clashing names."""

from __future__ import annotations

from pyspark.sql.types import LongType, StringType, StructField, StructType

NAMES = "row n node root base spans text_hash slot shard length start ids word count own_id high low terms clean".split()
SCHEMA = StructType(
    [StructField("doc_id", LongType()), StructField("text", StringType())]
    + [StructField(x, StringType()) for x in NAMES]
)

PROSE = (
    "The river runs past the old mill and the children watch it from the bridge. In spring the water is high and "
    "brown. It was not always so, for the dam above the town is new. Nobody in the town was asked about it. "
)
OTHER = (
    "A good bread needs time and little else. The dough is to rest in a cool place over night. It is baked on a "
    "hot stone with steam. Then it has to cool down, which is the hardest part for most. "
)


def near(text: str, k: int) -> str:
    """The text with one word changed, which one depends on ``k``."""
    own = text.split(" ")
    own[k % len(own)] = f"changed{k}"
    return " ".join(own)


def texts() -> list[tuple[int | None, str | None]]:
    long = " ".join(f"word{k % 977} the {k}" for k in range(12_000)) + "."
    found = [
        (1, PROSE * 3),
        (2, PROSE.upper() * 3),
        (3, PROSE * 3),
        (3, PROSE * 3),
        (4, near(PROSE * 3, 40)),
        (5, near(PROSE * 3, 80)),
        (6, OTHER + PROSE),
        (7, OTHER),
        (8, None),
        (9, ""),
        (10, " \n\t "),
        (11, "two words"),
        (12, "Two words"),
        (13, "one"),
        (None, PROSE * 3),
        (None, "no identifier here"),
        (14, long),
        (15, near(long, 5_000)),
        (16, "mail a.b@c.example.org, +1 (306) 555-4891, 42.144.35.254, 4111 1111 1111 1111. Müller 😀 " + OTHER),
        (17, "300.1.1.1 1.2.3.4.5.6.7.8 4111111111111112 +123 x@y a@b.c_d@e.f" + " 12" * 40),
        (18, "spam " * 300),
        (19, "%%% $$$ " * 100),
    ]
    return found + [(100 + k, near(PROSE * 4, 7 * k)) for k in range(12)]


def frame(spark, rows=None):
    rows = texts() if rows is None else rows
    return spark.createDataFrame([(*r, *["clash"] * len(NAMES)) for r in rows], SCHEMA)


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(rows) -> dict[int, str | None]:
    """Texts of the rows that have an identifier."""
    return {d: t for d, t in rows if d is not None}
