"""Questions and answers of a product (JN16, JN17, AGG22).

Questions: product_id, question_id, page, pos. Answers: question_id, answer_id, nickname.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.functions.text import strip
from shelfspark.operators.ranking import ranked_hits


def unanswered(questions: DataFrame, answers: DataFrame) -> DataFrame:
    return questions.join(answers.select("question_id"), "question_id", "left_anti")


def unanswered_counts(questions: DataFrame, answers: DataFrame) -> DataFrame:
    """Open questions per product, 0 when all are answered."""
    open_ = unanswered(questions, answers).groupBy("product_id").agg(F.count("*").alias("_n"))
    totals = questions.groupBy("product_id").agg(F.count("*").alias("questions_total"))
    return totals.join(open_, "product_id", "left").select(
        "product_id", "questions_total", F.coalesce("_n", F.lit(0)).alias("questions_unanswered"))


def answered_by(questions: DataFrame, answers: DataFrame, username: str) -> DataFrame:
    """Questions with an answer by the user; names compare trimmed and without case."""
    mine = answers.where(F.lower(strip(F.coalesce("nickname", F.lit("")))) == username.strip().lower())
    return questions.join(mine.select("question_id"), "question_id", "left_semi")


def with_answered_flag(questions: DataFrame, answers: DataFrame, username: str) -> DataFrame:
    mine = answered_by(questions, answers, username).select("question_id").distinct().withColumn("_hit", F.lit(True))
    return questions.join(mine, "question_id", "left").withColumn("answered_by_username", F.coalesce("_hit", F.lit(False))).drop("_hit")


def accumulated(questions: DataFrame) -> DataFrame:
    """Place of each question in the list read page by page."""
    hits = questions.withColumnRenamed("product_id", "term")
    return ranked_hits(hits).withColumnRenamed("term", "product_id").withColumnRenamed("ranking", "place")
