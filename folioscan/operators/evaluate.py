"""Token ledgers, accuracy and scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscan.functions import answers as A

TOKEN_BUDGET = 5_000_000


def distinct_traces(traces: DataFrame) -> DataFrame:
    """Traces with one row per trace_id (rows of one id are taken to be equal)."""
    return traces.dropDuplicates(["trace_id"])


def parsed_answers(traces: DataFrame, questions: DataFrame) -> DataFrame:
    """trace_id, qid, logged_at, domain, split, answer, and prompt, completion and total tokens; unknown questions are dropped."""
    asked = questions.where(F.col("qid").isNotNull()).dropDuplicates(["qid"]).select("qid", F.col("domain").alias("question_domain"), "split", "answer_format")
    rows = distinct_traces(traces).join(asked, "qid")
    usage = F.col("usage")
    return rows.select(
        "trace_id", "qid", "logged_at", F.col("question_domain").alias("domain"), "split", A.parse_answer(F.col("answer"), F.col("answer_format")).alias("answer"),
        A.prompt_tokens(usage).alias("prompt_tokens"), A.completion_tokens(usage).alias("completion_tokens"), A.total_tokens(usage).alias("total_tokens"),
    )


def token_ledger(parsed: DataFrame) -> DataFrame:
    """One row per question (its last answer, the tokens of all its traces) and a first row 'summary'; place orders them."""
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("prompt_tokens", "completion_tokens", "total_tokens")]
    rows = parsed.groupBy("qid").agg(F.max_by("answer", F.struct("logged_at", "trace_id")).alias("answer"), *sums)
    summary = parsed.agg(*sums).select(F.lit("summary").alias("qid"), F.lit("").alias("answer"), "prompt_tokens", "completion_tokens", "total_tokens", F.lit(0).alias("place"))
    return summary.unionByName(rows.withColumn("place", F.lit(1)))


def token_score(total: Column, budget: int = TOKEN_BUDGET) -> Column:
    """The unused part of the budget, from 0 to 1; 0 without a positive total."""
    return F.when(total > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), (budget - total) / budget))).otherwise(0.0)


def final_score(accuracy: Column, total: Column, budget: int = TOKEN_BUDGET) -> Column:
    """100 x accuracy x (0.7 + 0.3 x token score), at least 0."""
    return F.greatest(F.lit(0.0), 100 * accuracy * (0.7 + 0.3 * token_score(total, budget)))


def judged(gold: DataFrame, answers: DataFrame) -> DataFrame:
    """Gold (qid, gold, ...) with answers (qid, answer, tokens): correct is 1 for an equal answer; missing and empty ones are wrong."""
    right = (F.col("gold") != "") & (F.coalesce("answer", F.lit("")) == F.col("gold"))
    return gold.join(answers, "qid", "left").withColumn("correct", F.coalesce(right, F.lit(False)).cast("int"))


def score_breakdown(rows: DataFrame) -> DataFrame:
    """By domain and split, with subtotals; a summed-over dimension is 'all'."""
    label = lambda c: F.when(F.grouping(c) == 1, "all").otherwise(F.coalesce(c, F.lit("")))
    return rows.rollup("domain", "split").agg(
        label("domain").alias("domain_label"), label("split").alias("split_label"), F.count("*").alias("n"),
        F.round(F.avg("correct"), 6).alias("accuracy"), F.coalesce(F.sum("total_tokens"), F.lit(0)).alias("total_tokens"),
    ).select(F.col("domain_label").alias("domain"), F.col("split_label").alias("split"), "n", "accuracy", "total_tokens")


def leaderboard(runs: DataFrame) -> DataFrame:
    """Runs (run, accuracy, total_tokens, submitted_at) by score, then accuracy, fewer tokens and earlier time, with their place."""
    from pyspark.sql import Window

    scored = runs.withColumn("score", F.round(final_score(F.col("accuracy"), F.col("total_tokens")), 6))
    order = Window.orderBy(F.desc("score"), F.desc("accuracy"), "total_tokens", "submitted_at", "run")  # a row per run
    return scored.withColumn("place", F.row_number().over(order))
