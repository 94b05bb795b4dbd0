"""Chat formatting in budgeted windows.

Prefix sums of turn tokens cut a conversation into spans of whole turns. Each window is the system
turn, a limited history that repeats the turns before the span, and the span. Only the assistant
texts of the span are under the loss mask, so every one is a target exactly once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import named, staged

#: Tokens of a window, of the history it repeats, and of a turn's marks.
BUDGET, HISTORY, MARKS = 2048, 256, 6
#: Template: <|role|> newline text <|end|> newline.
END = "<|end|>\n"


def escape(text: Column) -> Column:
    """Text in which no control string is left: every < and [ is followed by a backslash and a dash."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in "<[":
        text = F.replace(text, F.lit(mark), F.lit(mark + "\\-"))
    return text


def unescape(text: Column) -> Column:
    """The text that ``escape`` was given."""
    for mark in "[<":
        text = F.replace(text, F.lit(mark + "\\-"), F.lit(mark))
    return F.replace(text, F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    """As ``escape``, and no | is left bare, so the first |> ends the role."""
    return F.replace(escape(role), F.lit("|"), F.lit("|\\-"))


def estimated_tokens(text: Column) -> Column:
    """A turn's tokens where no tokenizer is given: a quarter of its bytes, and its marks."""
    return F.ceil(F.octet_length(text) / 4) + F.lit(MARKS)


def format_windows(
    turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, tokens: str | None = None,
) -> DataFrame:
    """Windows of the conversations in ``turns`` (conv_id, turn, role, text; others are ignored).

    Returns (conv_id, window_no, n_repeated, text, loss, n_tokens, over_budget): the formatted
    text, how many of its turns repeat earlier ones, and the spans (start, stop) in code points
    that the loss covers. ``tokens`` names a column with the tokens of each turn, marks included;
    they are estimated without it and at least 1.

    Turns go by turn, then role, then text; nulls first, null roles and texts count as empty, and
    repeated rows are turns of their own. Rows of a null conv_id are one conversation. The first
    turn is retained in every window if its role is system; other system turns are ordinary.
    A window holds at most ``budget`` tokens unless the system turn, history and its one new turn
    exceed them, which over_budget tells: turns are never cut. An empty table gives no window.
    """
    rows = turns.select(
        named("conv_id").alias("conv_id"), named("turn").alias("turn"),
        F.coalesce(named("role"), F.lit("")).alias("role"),
        F.coalesce(named("text"), F.lit("")).alias("text"),
        *([F.greatest(F.lit(1), named(tokens)).cast("long").alias("tokens")] if tokens else []),
    )
    if not tokens:
        rows = rows.withColumn("tokens", estimated_tokens(F.col("text")).cast("long"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = (
        rows.withColumn("pos", F.row_number().over(order))
        .withColumn("is_system", F.expr("pos = 1 AND role = 'system'"))
        .withColumn("own", F.expr("IF(is_system, 0L, tokens)"))
        .withColumn("stop", F.sum("own").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("start", F.expr("stop - own"))
        .withColumn("system", F.first(F.expr("IF(is_system, text, NULL)")).over(
            order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("system_tokens", F.first(F.expr("IF(is_system, tokens, 0L)")).over(
            order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("only", F.expr("is_system") & F.lead("pos").over(order).isNull())
        .where("only OR NOT is_system")
        .withColumn("room", F.expr(f"greatest(1L, {int(budget)} - {int(history)} - system_tokens)"))
        .withColumn("bucket", F.expr("start DIV room"))
    )
    # Turns that start in one stretch of `room` tokens share a window; the last of them gets one of
    # its own where it runs over. So no span depends on the one before and none needs recursion.
    stretch = Window.partitionBy("conv_id", "bucket").orderBy("start")
    rows = (
        rows.withColumn("base", F.first("start").over(stretch.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("alone", F.expr("stop - base > room AND start > base"))
        .withColumn("window_no", F.expr("2L * bucket + CAST(alone AS BIGINT)"))
        .withColumn("at", F.expr("IF(alone, start, base)"))
    )
    # A turn is history of those windows that begin within `history` tokens after its start.
    ahead = Window.partitionBy("conv_id").orderBy("start").rangeBetween(1, int(history))
    rows = rows.withColumn("later", F.collect_set(
        F.expr("IF(start = at, named_struct('window_no', window_no, 'at', at), NULL)"),
    ).over(ahead) if history > 0 else F.expr("CAST(array() AS ARRAY<STRUCT<window_no: BIGINT, at: BIGINT>>)"))
    placed = rows.select(
        "conv_id", "pos", "start", "tokens", "only", "role", "text", "system", "system_tokens", "window_no", "at",
        F.explode(F.expr("""concat(
            array(named_struct('to', window_no, 'kind', IF(only, 2, 3))),
            IF(start = at AND system IS NOT NULL AND NOT only,
               array(named_struct('to', window_no, 'kind', IF(at = 0, 2, 0))), array()),
            transform(filter(later, w -> w.at > start AND w.window_no <> window_no),
                      w -> named_struct('to', w.window_no, 'kind', 1)))""")).alias("place"),
    )
    # Kinds: 0 repeated system turn, 1 history, 2 system turn met first, 3 new turn.
    piece = placed.select(
        "conv_id", F.col("place.to").alias("window_no"), F.col("place.kind").alias("kind"),
        F.expr("IF(place.kind IN (0, 2), 0, pos)").alias("pos"),
        F.expr("IF(place.kind IN (0, 2), IF(only, tokens, system_tokens), tokens)").alias("tokens"),
        F.expr("IF(place.kind IN (0, 2), 'system', role)").alias("role"),
        F.expr("IF(place.kind IN (0, 2), IF(only, text, system), text)").alias("text"),
    ).select(
        "conv_id", "window_no", "kind", "pos", "tokens",
        F.concat(F.lit("<|"), escape_role(F.col("role")), F.lit("|>\n")).alias("head"),
        escape(F.col("text")).alias("body"),
        F.expr("kind = 3 AND role = 'assistant'").alias("target"),
    )
    inside = Window.partitionBy("conv_id", "window_no").orderBy("pos")
    length = F.expr(f"length(head) + length(body) + {len(END)}")
    piece = piece.withColumn("begin", F.sum(length).over(inside) - length + F.length("head"))
    return piece.groupBy("conv_id", "window_no").agg(
        F.sort_array(F.collect_list(F.struct("pos", "head", "body"))).alias("pieces"),
        F.sort_array(F.collect_list(F.expr(
            "IF(target, named_struct('start', begin, 'stop', begin + length(body)), NULL)"))).alias("loss"),
        F.count_if(F.col("kind") < 2).alias("n_repeated"), F.sum("tokens").alias("n_tokens"),
    ).select(
        "conv_id", "window_no", "n_repeated",
        F.concat_ws("", F.transform("pieces", lambda p: F.concat(p.head, p.body, F.lit(END)))).alias("text"),
        "loss", "n_tokens", (F.col("n_tokens") > budget).alias("over_budget"),
    )


def read_turns(windows: DataFrame) -> DataFrame:
    """The turns that ``format_windows`` was given, read from its texts: (conv_id, place, role, text)."""
    part = windows.select(
        "conv_id", "window_no", "n_repeated", F.posexplode(F.split("text", r"<\|end\|>\n", -1)))
    return (
        part.where("pos >= n_repeated AND col <> ''")
        .select(
            "conv_id", F.struct("window_no", "pos").alias("place"),
            unescape(F.replace(F.expr(r"substr(col, 3, locate('|>\n', col) - 3)"), F.lit("|\\-"), F.lit("|"))).alias("role"),
            unescape(F.expr(r"substr(col, locate('|>\n', col) + 3)")).alias("text"),
        )
    )


def loss_texts(windows: DataFrame) -> DataFrame:
    """The texts under the loss mask, cut out by the spans: (conv_id, place, text)."""
    return windows.select("conv_id", "window_no", "text", F.posexplode("loss").alias("n", "span")).select(
        "conv_id", F.struct("window_no", "n").alias("place"),
        unescape(F.expr("substr(text, CAST(span.start + 1 AS INT), CAST(span.stop - span.start AS INT))")).alias("text"),
    )


def conversation_digests(windows: DataFrame) -> DataFrame:
    """One row per conversation, read back from the windows.

    A digest over a whole conversation needs its text in one place, so one group holds one
    conversation; the windows themselves never need that.
    """
    turns = read_turns(windows).groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("place", "role", "text"))).alias("t"))
    turns = turns.select("conv_id", F.size("t").cast("long").alias("n_turns"), F.sha2(F.concat_ws(
        "", F.transform("t", lambda x: F.concat(x.role, F.lit("\n"), x.text, F.lit("\n")))), 256).alias("turns_sha256"))
    loss = loss_texts(windows).groupBy("conv_id").agg(
        F.concat_ws("", F.sort_array(F.collect_list(F.struct("place", "text"))).getField("text")).alias("t"))
    size = windows.groupBy("conv_id").agg(F.sum(F.length("text")).alias("formatted_chars"))
    joined = turns.alias("a").join(size.alias("s"), F.expr("a.conv_id <=> s.conv_id")).join(
        loss.alias("l"), F.expr("a.conv_id <=> l.conv_id"), "left")
    return joined.select(
        "a.conv_id", "n_turns", "turns_sha256", F.expr("CAST(coalesce(length(l.t), 0) AS BIGINT)").alias("loss_chars"),
        F.sha2(F.coalesce("l.t", F.lit("")), 256).alias("loss_sha256"), "formatted_chars",
    )


ORACLE = f"""
WITH given AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), r0 AS (
    SELECT *, CAST(ceil(strlen(text) / 4.0) AS BIGINT) + {MARKS} AS tokens,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS pos FROM given
), r1 AS (
    SELECT *, pos = 1 AND role = 'system' AS is_system, CASE WHEN pos = 1 AND role = 'system' THEN 0 ELSE tokens END AS own
    FROM r0
), r2 AS (
    SELECT *, sum(own) OVER w - own AS start, sum(own) OVER w AS stop,
           coalesce(max(CASE WHEN is_system THEN tokens END) OVER c, 0) AS sys_tokens,
           coalesce(max(CASE WHEN is_system THEN {{size}} END) OVER c, 0) AS sys_chars,
           max(pos) OVER c AS n, {{size}} AS chars
    FROM r1 WINDOW w AS (PARTITION BY conv_id ORDER BY pos), c AS (PARTITION BY conv_id)
), r3 AS (
    SELECT *, start // greatest(1, {BUDGET - HISTORY} - sys_tokens) AS bucket FROM r2 WHERE NOT is_system
), r4 AS (
    SELECT *, min(start) OVER (PARTITION BY conv_id, bucket) AS base FROM r3
), r5 AS (
    SELECT *, CASE WHEN stop - base > greatest(1, {BUDGET - HISTORY} - sys_tokens) AND start > base
                   THEN start ELSE base END AS begins FROM r4
), windows AS (
    SELECT conv_id, begins, min(sys_chars) AS sys_chars, sum(chars) AS chars FROM r5 GROUP BY 1, 2
), repeated AS (
    SELECT w.conv_id, w.begins, sum(t.chars) AS chars FROM windows w JOIN r5 t
    ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.start < w.begins AND t.start >= w.begins - {HISTORY} GROUP BY 1, 2
), sizes AS (
    SELECT w.conv_id, sum(w.sys_chars + w.chars + coalesce(r.chars, 0)) AS chars FROM windows w LEFT JOIN repeated r
    ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.begins = w.begins GROUP BY 1
    UNION ALL SELECT conv_id, chars FROM r2 WHERE is_system AND n = 1
)
SELECT r.conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
       coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY pos), '')) AS loss_sha256,
       max(s.chars)::BIGINT AS formatted_chars
FROM r2 r JOIN sizes s ON s.conv_id IS NOT DISTINCT FROM r.conv_id GROUP BY 1
""".replace("{size}", "(length(role) + length(text) + 2 * (length(text) - length(replace(replace(text, '<', ''), '[', '')))"
            " + length(text) - length(replace(text, chr(92), '')) + 2 * (length(role) - length(replace(replace(replace(role, '<', ''), '[', ''), '|', '')))"
            " + length(role) - length(replace(role, chr(92), '')) + 13)")


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    marked = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], turns.schema)
    return conversation_digests(staged(format_windows(turns.unionByName(marked)), "windows"))
