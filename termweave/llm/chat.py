"""Chat formatting by perspective rotation (operator 6).

For every participant of a dialogue the dialogue is rendered with that speaker
as the assistant and all others as named users; the mask holds where the
assistant's own words stand, in code points of the rendered text. A dialogue is
one row a speaker. Only one of more than PART_MESSAGES messages takes several, as
no row can hold a dialogue of any size: parts are cut by the place of a message,
whatever its turn, so that no row or group grows without bound, and the parts in
order are the whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import written

#: Messages of one part.
PART_MESSAGES = 1024
#: What stands around a message.
ASSISTANT_OPEN, USER_OPEN, USER_NAMED, CLOSE = "<|assistant|>\n", "<|user|>\n", ": ", "<|end|>\n"


def _placed(said: DataFrame) -> DataFrame:
    """said with the place of each message in its dialogue, from 0, by turn, name and text.

    Messages are dealt by ranges of that order, counted in each range, and a
    dialogue's ranges are added up, so a dialogue of any size is numbered by many
    tasks. The last key parts equal messages, whose order does not matter.
    """
    order = [F.col("turn").asc_nulls_first(), "name", "text"]
    ranged = said.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange("conv_id", *order, "tie")
    ranged = written(ranged.select(*said.columns, F.spark_partition_id().alias("range")))
    counts = ranged.groupBy("conv_id", "range").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select(F.col("conv_id").alias("c"), F.col("range").alias("r"), before.alias("before"))
    inside = ranged.withColumn("at", F.row_number().over(Window.partitionBy("conv_id", "range").orderBy(*order)) - 1)
    return inside.join(offsets, inside.conv_id.eqNullSafe(F.col("c")) & (inside.range == F.col("r"))).select(*said.columns, (F.col("before") + F.col("at")).alias("place"))


def rotate(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, speaker, part, n_turns, n_own, rendered, mask of every dialogue, participant and part.

    mask: "start:end" of the speaker's own messages in this part, end exclusive,
    comma-joined. A null role is the participant "unknown", a null text is empty, a
    null turn comes first, rows of one turn are ordered by role and text, and rows
    without a conversation form one dialogue of their own. Other columns are not
    read; an empty table gives an empty result.
    """
    said = turns.select(turns[conversation].alias("conv_id"), turns[turn].cast("long").alias("turn"), F.coalesce(turns[role], F.lit("unknown")).alias("name"), F.coalesce(turns[text], F.lit("")).alias("text"))
    said = _placed(said).withColumn("part", F.floor(F.col("place") / PART_MESSAGES).cast("long"))
    speakers = turns.select(turns[conversation].alias("c"), F.coalesce(turns[role], F.lit("unknown")).alias("speaker")).distinct()
    rows = said.join(speakers, said.conv_id.eqNullSafe(speakers.c)).withColumn("own", F.col("name") == F.col("speaker"))
    rows = rows.withColumn("opening", F.when(F.col("own"), F.lit(ASSISTANT_OPEN)).otherwise(F.concat(F.lit(USER_OPEN), "name", F.lit(USER_NAMED))))
    rows = rows.withColumn("message", F.concat("opening", "text", F.lit(CLOSE)))
    of_part = Window.partitionBy("conv_id", "speaker", "part").orderBy("place")
    rows = rows.withColumn("at", F.col("place")).withColumn("end", F.sum(F.length("message")).over(of_part.rowsBetween(Window.unboundedPreceding, 0)))
    start = F.col("end") - F.length("message") + F.length("opening")
    rows = rows.withColumn("span", F.when(F.col("own"), F.concat(start.cast("string"), F.lit(":"), (start + F.length("text")).cast("string"))))
    ordered = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("at", c))), lambda x: x[c])
    return rows.groupBy("conv_id", "speaker", "part").agg(
        F.count("*").alias("n_turns"),
        F.sum(F.col("own").cast("long")).alias("n_own"),
        F.array_join(ordered("message"), "").alias("rendered"),
        F.array_join(ordered("span"), ",").alias("mask"),
    )


def sql(part_messages: int = PART_MESSAGES) -> str:
    """The same on table conversations, in DuckDB SQL."""
    lit = lambda s: " || chr(10) || ".join(f"'{x}'" for x in s.split("\n"))
    return f"""
    WITH plain AS (SELECT conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, 'unknown') AS name, coalesce(text, '') AS text FROM conversations),
    said AS (SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, name, text) - 1) // {part_messages} AS part FROM plain),
    speakers AS (SELECT DISTINCT conv_id AS c, name AS speaker FROM said),
    opened AS (SELECT *, name = speaker AS own, CASE WHEN name = speaker THEN {lit(ASSISTANT_OPEN)} ELSE {lit(USER_OPEN)} || name || '{USER_NAMED}' END AS opening
               FROM said JOIN speakers ON conv_id IS NOT DISTINCT FROM c),
    placed AS (SELECT *, opening || text || {lit(CLOSE)} AS message, row_number() OVER w AS place, sum(length(opening || text || {lit(CLOSE)})) OVER w AS fin
               FROM opened WINDOW w AS (PARTITION BY conv_id, speaker, part ORDER BY turn NULLS FIRST, name, text ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    spans AS (SELECT *, CAST(fin - length(message) + length(opening) AS BIGINT) AS start FROM placed)
    SELECT conv_id, speaker, part, count(*) AS n_turns, CAST(sum(CASE WHEN own THEN 1 ELSE 0 END) AS BIGINT) AS n_own,
           string_agg(message, '' ORDER BY place) AS rendered,
           coalesce(string_agg(CASE WHEN own THEN start || ':' || (start + length(text)) END, ',' ORDER BY place), '') AS mask
    FROM spans GROUP BY conv_id, speaker, part"""
