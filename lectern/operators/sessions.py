"""Session counters, conversations, usage and latency reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern import constants as C
from lectern.operators.ordered import exact_percentiles, next_in_group


def utc_now() -> Column:
    """The time of the query as a UTC timestamp without a zone."""
    return F.expr("convert_timezone(current_timezone(), 'UTC', localtimestamp())")


def create_sessions(ids: DataFrame, session: str = "session_id", now: Column | None = None) -> DataFrame:
    """One fresh session per id: (session, created_at); `now` replaces the current time."""
    return ids.select(session).where(F.col(session).isNotNull()).distinct().withColumn("created_at", utc_now() if now is None else now)


def known_events(events: DataFrame, sessions: DataFrame, session: str = "session_id") -> DataFrame:
    """Events of created sessions only; a hot session is split by adaptive skew handling."""
    return events.join(sessions.select(session).distinct(), session, "left_semi")


def unknown_events(events: DataFrame, sessions: DataFrame, session: str = "session_id") -> DataFrame:
    """Events to warn about: their session was never created."""
    return events.join(sessions.select(session).distinct(), session, "left_anti")


def rollup_aggregates(ts: str = "ts", subject: str = "subject") -> list[Column]:
    """Counters of one session; also used by the streaming version."""
    return [
        F.count("*").alias("question_count"),
        F.max(ts).alias("last_activity"),
        F.array_sort(F.collect_set(subject)).alias("subjects"),
    ]


def session_rollup(events: DataFrame, sessions: DataFrame | None = None, session: str = "session_id") -> DataFrame:
    """Question count, last activity and sorted subject set per session.

    With a `sessions` table (session, created_at) every created session has a row, a
    fresh one with count 0 and its creation time as last activity.
    """
    if sessions is None:
        return events.groupBy(session).agg(*rollup_aggregates())
    counted = known_events(events, sessions, session).groupBy(session).agg(*rollup_aggregates())
    return sessions.join(counted, session, "left").select(
        session, "created_at",
        F.coalesce("question_count", F.lit(0)).cast("bigint").alias("question_count"),
        F.coalesce("last_activity", "created_at").alias("last_activity"),
        F.coalesce("subjects", F.array().cast("array<string>")).alias("subjects"),
    )


def conversation_pairs(turns: DataFrame, conversation: str = "conv_id", order: str = "turn") -> DataFrame:
    """User turns with the assistant turn right after them."""
    following = next_in_group(turns, [conversation], order, ["role", "text"], "__next")
    return following.where((F.col("role") == "user") & (F.col("__next.role") == "assistant")).select(
        conversation, order, F.col("text").alias("question"), F.col("__next.text").alias("answer")
    )


def conversation_history(turns: DataFrame, conversation: str = "conv_id", order: str = "turn", width: int | None = None) -> DataFrame:
    """One row per conversation with its messages in order: (conversation, messages).

    With `width`, rows hold the turns of one stretch of that many order numbers:
    (conversation, part, messages), for conversations that one row cannot hold.
    """
    keys = [F.col(conversation)] + ([F.floor(F.col(order) / width).cast("bigint").alias("part")] if width else [])
    message = F.struct(order, "role", "text")
    return turns.groupBy(*keys).agg(F.array_sort(F.collect_list(message)).alias("messages"))


def last_messages(turns: DataFrame, k: int = C.LAST_MESSAGES, conversation: str = "conv_id", order: str = "turn") -> DataFrame:
    """The k newest messages of each conversation (cut map-side by WindowGroupLimit)."""
    newest = F.row_number().over(Window.partitionBy(conversation).orderBy(F.col(order).desc()))
    return turns.withColumn("recency", newest).where(F.col("recency") <= k)


def fold_steps(steps: DataFrame, run: str = "run_id", step: str = "step", field: str = "field", value: str = "value") -> DataFrame:
    """Last value of every field of a run."""
    return steps.groupBy(run, field).agg(F.max_by(value, step).alias(value))


def usage_cost(usage: DataFrame, prices: DataFrame, max_questions: int = C.DAILY_QUESTIONS, max_dollars: float = C.DAILY_DOLLARS) -> DataFrame:
    """Questions and dollars per user and day with a limit flag.

    Usage has user_id, ts, model_name, input_tokens, output_tokens; prices are dollars
    per million tokens. Tokens are summed per model before the price join. Usage of a
    model without a price counts as questions; its dollars are unknown, which
    `unpriced` shows, and `dollars` holds the priced part (null if there is none).
    """
    daily = usage.groupBy("user_id", F.to_date("ts").alias("day"), "model_name").agg(
        F.count("*").alias("questions"), F.sum("input_tokens").alias("i"), F.sum("output_tokens").alias("o")
    )
    cost = (F.col("i") * F.col("input_price") + F.col("o") * F.col("output_price")) / 1e6
    per_day = daily.join(prices, "model_name", "left").groupBy("user_id", "day").agg(
        F.sum("questions").cast("bigint").alias("questions"), F.sum(cost).alias("dollars"),
        F.sum(F.when(cost.isNull(), F.col("questions")).otherwise(0)).cast("bigint").alias("unpriced"),
    )
    over = (F.col("questions") > max_questions) | F.coalesce(F.round("dollars", 9) > max_dollars, F.lit(False))
    return per_day.withColumn("over_limit", over)


def latency_percentiles(df: DataFrame, latency: str, shares: Sequence[float] = (0.5, 0.95, 0.99)) -> DataFrame:
    return exact_percentiles(df, latency, shares)


def error_rate(df: DataFrame, failed: Column) -> DataFrame:
    return df.agg(F.count("*").alias("n"), F.avg(F.when(failed, 1.0).otherwise(0.0)).alias("error_rate"))


def last_hours(df: DataFrame, ts: str, until: Column, hours: int = 24) -> DataFrame:
    """Rows of the last hours before `until` (a literal, or a scalar subquery)."""
    start = until - F.expr(f"INTERVAL {hours} HOURS")
    return df.where((F.col(ts) > start) & (F.col(ts) <= until))
