"""Word lexicons: the tab-separated file reader and the test lexicon."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pulse.functions.sizing import broadcast_if_small
from pulse.schema import LEXICON

# A lexicon above this size is joined by the planner, not broadcast.
LEXICON_BROADCAST_MAX_BYTES = 32 << 20

# --- fixed values: the test lexicon of FIXTURES.md §4 (ord, word, score) -----
# "that" appears twice on purpose: the first entry (+2) must win.
FIXTURE_LEXICON = [
    (1, "that", 2),
    (2, "with", 1),
    (3, "this", 3),
    (4, "from", -2),
    (5, "than", -3),
    (6, "thre", -1),
    (7, "and", 1),
    (8, "of", -1),
    (9, "eriner", 4),
    (10, "rely", -4),
    (11, "that", -5),
]
# ---------------------------------------------------------------------------


def read_lexicon(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """SRC2: ``word<TAB>score`` lines, with the place of each line as ``ord``.

    The typed schema replaces the reference's ``split("\\t")`` + ``toInt``, and
    a bad line fails the read as there (``mode="DROPMALFORMED"`` drops bad
    lines).  Lines are ordered by file, by block inside the file, and by line
    inside the block, however the files are dealt to tasks.
    """
    return (
        spark.read.schema(LEXICON)
        .option("sep", "\t")
        .option("mode", mode)
        .option("quote", "")
        .csv(path)
        .select(
            "word",
            "score",
            F.struct(
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("line"),
            ).alias("ord"),
        )
    )


def fixture_lexicon(spark: SparkSession) -> DataFrame:
    """The small test lexicon as (ord, word, score)."""
    return spark.createDataFrame(FIXTURE_LEXICON, "ord long, word string, score int")


def first_wins(lexicon: DataFrame) -> DataFrame:
    """One score per word: the earliest entry wins (the reference's ``lookup(w)(0)``)."""
    return lexicon.groupBy("word").agg(F.min_by("score", "ord").alias("score"))


def lexicon_dimension(lexicon: DataFrame) -> DataFrame:
    """Deduplicated lexicon, broadcast when its size is proven small."""
    return broadcast_if_small(first_wins(lexicon), LEXICON_BROADCAST_MAX_BYTES)
