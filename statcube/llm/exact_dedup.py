"""Exact duplicates by a tree merge of digest runs; DataFrame operations only.

Every row is a digest of 32 bytes, dealt to one of many runs by a hash of its id, so that a group
that holds a third of all rows is spread over all runs. A run is reduced to one row per digest
with the number of its rows and the identifier to keep. Runs are then merged in rounds, ``fan_in``
runs at a time (run number divided by the fan-in), and every round keeps the winner and the count
of each digest. A round is spread over tasks by (merged run, digest): no task holds a whole run, and
a digest arrives at most ``fan_in`` times per merged run. The winners then go the way back down:
first to the runs in which a digest occurs, then to the rows of each run, so the join back never
meets all rows of a hot digest under one key.

The winner is verified at every level: rows only merge if SHA-256, length in characters and a second
hash (xxHash64) of the text agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statcube.llm.shared import Query, table
from statcube.operators.joins import lookup_join
from statcube.sources.scratch import materialize

FAN_IN = 8
LEAST_RUNS = 64

_KEY = ["__digest", "__length", "__second"]
#: Number of a row in a written table; tells rows apart that share an id or have none.
ROW = "__row"


def number_written(docs: DataFrame) -> DataFrame:
    """The rows as a written table with ``__row``, so that the numbers don't change between two uses."""
    return materialize(docs.withColumn(ROW, F.monotonically_increasing_id()), "documents")


def digest_rows(docs: DataFrame, identifier: str, text: Column, carried: list[Column] | None = None) -> DataFrame:
    """``__id``, the verified key of the text (a missing text as empty) and carried columns."""
    whole = F.coalesce(text, F.lit(""))
    return docs.select(
        F.col(identifier).alias("__id"),
        F.unhex(F.sha2(whole, 256)).alias("__digest"),
        F.char_length(whole).cast("long").alias("__length"),
        F.xxhash64(whole).alias("__second"),
        *(carried or []),
    )


def merge_runs(rows: DataFrame, keys: list[str], keep: str = "largest", runs: int | None = None, fan_in: int = FAN_IN) -> DataFrame:
    """Rows (``__id``, keys, others) plus ``keep_id`` and ``group_size`` of their keys.

    ``rows`` is read twice, so it should be a written table or cheap to compute. Keys must not be
    NULL. ``keep`` is ``smallest`` or ``largest``; rows without an id are counted, but kept only
    if no row of the group has an id.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is smallest or largest")
    best = F.max if keep == "largest" else F.min
    if runs is None:
        runs = max(LEAST_RUNS, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.withColumn("__run", F.pmod(F.xxhash64("__id"), F.lit(runs)).cast("int"))
    leaves = rows.groupBy("__run", *keys).agg(best("__id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    merged, width = leaves, runs
    while width > 1:
        width = -(-width // fan_in)
        merged = (
            merged.withColumn("__run", F.floor(F.col("__run") / fan_in).cast("int"))
            .groupBy("__run", *keys)
            .agg(best("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
        )
    winners = merged.drop("__run")
    per_run = leaves.select("__run", *keys).join(winners, keys)
    return rows.join(per_run, ["__run", *keys]).drop("__run")


def exact_dedup(docs: DataFrame, identifier: str = "doc_id", text: str = "text", keep: str = "largest", runs: int | None = None, fan_in: int = FAN_IN) -> DataFrame:
    """One row per row of ``docs``: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when they are identical; a missing text counts as empty. Of equal texts the
    row with the largest (or smallest) id is kept; rows that repeat that id and text are all marked. A missing id is only kept if
    its whole group has none. Other columns are ignored. An empty table gives an empty result.
    """
    rows = materialize(digest_rows(docs, identifier, F.col(text)), "digests")
    return merge_runs(rows, _KEY, keep, runs, fan_in).select(
        F.col("__id").alias(identifier),
        "keep_id",
        F.col("group_size").cast("long").alias("group_size"),
        F.col("__id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("__digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, identifier: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` per text, with all its columns: the largest id, rows without an id last, then the first row.

    Rows are numbered once and the verdict is on the row number, so rows that share an id or have none are judged by their
    texts. As long as the rows that go are measured to be few, no text is shuffled to remove them.
    """
    docs = number_written(docs)
    place = F.struct(F.col(identifier).alias("id"), (-F.col(ROW)).alias("row"))
    found = exact_dedup(docs.select(place.alias("__place"), text), "__place", text)
    gone = found.filter("NOT kept").select((-F.col("__place.row")).alias(ROW))
    return lookup_join(docs, gone, [ROW], "left_anti").drop(ROW)


def op6(spark, folder):
    return exact_dedup(table(spark, folder, "documents"))


OP6_SQL = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

QUERIES: dict[str, tuple[Query, str | None]] = {"op6_exact_dedup": (op6, OP6_SQL)}
