"""Chat formatting from every participant's side.

For each participant of a conversation the dialogue is rendered once, with that speaker as the assistant and the others as named users; the
roles in CONTEXT (system messages) are rendered as they are and never speak. A row is one turn of one rendering, with its place in
the whole rendering, so a rendering is its rows' segments in order, however long the conversation is. The training mask is the assistant's
text and its closing mark, given as code-point positions in the rendering.

DataFrame functions only. Lengths are summed over turns by blockwise running sums, and turns meet their conversation's participants in
SALTS parts, so a conversation that holds much of the table is spread over tasks.

Defined cases: turns of one number follow each other by role and text; a null text is empty, a null role is UNKNOWN; rows without
conversation or turn number can't be placed and are left out; repeated rows are rendered each; a conversation without participants
has no rendering.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallycast.operators.prefix import prefix_sums

CONTEXT = ("system",)
UNKNOWN = "unknown"
OPEN, CLOSE, END_LINE = "<|im_start|>", "<|im_end|>", "\n"
SALTS = 8


def perspectives(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Columns conv_id, speaker, turn, role, segment, start, and train_from and train_to (null where nothing is trained on)."""
    rows = turns.select(
        F.col(conversation).alias("conv_id"),
        F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(F.col(role), F.lit(UNKNOWN)).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).filter(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
    speakers = (
        rows.filter(~F.col("role").isin(*CONTEXT))
        .select("conv_id", F.col("role").alias("speaker"))
        .distinct()
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    own = F.col("role") == F.col("speaker")
    heading = (
        F.when(own, F.lit("assistant"))
        .when(F.col("role").isin(*CONTEXT), F.col("role"))
        .otherwise(F.concat(F.lit("user name="), F.col("role")))
    )
    sided = (
        rows.withColumn("salt", F.pmod(F.xxhash64("turn", "text"), F.lit(SALTS)).cast("int"))
        .join(speakers, ["conv_id", "salt"])
        .drop("salt")
        .withColumn("head", F.concat(F.lit(OPEN), heading, F.lit(END_LINE)))
        .withColumn("segment", F.concat("head", "text", F.lit(CLOSE + END_LINE)))
        .withColumn("size", F.length("segment").cast("bigint"))
    )
    by_turn = sided.groupBy("conv_id", "speaker", "turn").agg(F.sum("size").alias("turn_size"))
    before = (
        prefix_sums(by_turn, ["conv_id", "speaker"], "turn", F.col("turn_size"), "until")
        .withColumn("turn_start", F.col("until") - F.col("turn_size"))
        .select("conv_id", "speaker", "turn", "turn_start")
    )
    within = W.partitionBy("conv_id", "speaker", "turn").orderBy("role", "text").rowsBetween(W.unboundedPreceding, -1)
    start = F.col("turn_start") + F.coalesce(F.sum("size").over(within), F.lit(0))
    trained = F.col("start") + F.length("head")
    return (
        sided.join(before, ["conv_id", "speaker", "turn"])
        .withColumn("start", start)
        .select(
            "conv_id",
            "speaker",
            "turn",
            "role",
            "segment",
            "start",
            F.when(own, trained).alias("train_from"),
            F.when(own, trained + F.length("text") + len(CLOSE)).alias("train_to"),
        )
    )


SQL = f"""
WITH rows_ AS (
    SELECT conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '{UNKNOWN}') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL
), speakers AS (
    SELECT DISTINCT conv_id, role AS speaker FROM rows_ WHERE role NOT IN ('{"', '".join(CONTEXT)}')
), sided AS (
    SELECT *, '{OPEN}' || CASE WHEN role = speaker THEN 'assistant' WHEN role IN ('{"', '".join(CONTEXT)}') THEN role
        ELSE 'user name=' || role END || chr(10) AS head
    FROM rows_ JOIN speakers USING (conv_id)
), placed AS (
    SELECT *, head || text || '{CLOSE}' || chr(10) AS segment FROM sided
), started AS (
    SELECT *, CAST(coalesce(sum(length(segment)) OVER (
        PARTITION BY conv_id, speaker ORDER BY turn, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
    ), 0) AS BIGINT) AS start FROM placed
)
SELECT conv_id, speaker, turn, role, segment, start,
    CASE WHEN role = speaker THEN start + length(head) END AS train_from,
    CASE WHEN role = speaker THEN start + length(head) + length(text) + {len(CLOSE)} END AS train_to
FROM started
"""
