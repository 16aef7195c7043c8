"""Simple chunks, task cards and chat samples made of these."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SUMMARY_CHARS = 180


def simple_chunks(sections: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """A chunk for each section, numbered through its document."""
    number = F.row_number().over(Window.partitionBy(doc_id).orderBy("section_id")) - 1
    numbered = sections.withColumn("chunk_id", F.concat(F.col(doc_id).cast("string"), F.lit("::"), F.format_string("chunk_%04d", number)))
    return numbered.withColumn("summary", F.replace(F.substring("content", 1, SUMMARY_CHARS), F.lit("\n"), F.lit(" ")))


def task_cards(chunks: DataFrame) -> DataFrame:
    """A draft card for each chunk, to be filled in by a person."""
    return chunks.select(
        F.concat(F.lit("card_"), "chunk_id").alias("task_card_id"), F.lit("faq").alias("task_type"), F.concat(F.lit("Explain: "), "title").alias("user_goal"),
        F.array("chunk_id").alias("source_chunk_ids"), F.lit("draft").alias("review_status"),
    )


def _message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def samples(cards: DataFrame, system: str) -> DataFrame:
    """(``id``, ``messages``, ``source_chunk_ids``): a system text, the card's goal, and a place for the answer; a card without chunks stands for itself."""
    chunks = F.when(F.coalesce(F.size("source_chunk_ids"), F.lit(0)) > 0, F.col("source_chunk_ids")).otherwise(F.array("task_card_id"))
    answer = F.concat(F.lit("Draft answer for "), "task_card_id")
    return cards.select(F.concat(F.lit("sft_"), "task_card_id").alias("id"), F.array(_message("system", F.lit(system)), _message("user", F.col("user_goal")), _message("assistant", answer)).alias("messages"), chunks.alias("source_chunk_ids"))


def recipe_matches(recipes: DataFrame, chunks: DataFrame, order: str) -> DataFrame:
    """For each recipe (``recipe_id``, ``doc``, ``section_title`` and, if it matters, ``index``) the first chunk that fits, in order; a recipe without one is an error.

    Recipes are few and chosen by hand; the chunks are read once.
    """
    c = chunks.select("doc", "section_title", "chunk_id", F.col("chunk_index_in_section").alias("_index"), F.col(order).alias("_order"))
    fits = (F.col("r.doc") == F.col("c.doc")) & (F.col("r.section_title") == F.col("c.section_title")) & (F.col("r.index").isNull() | (F.col("r.index") == F.col("c._index")))
    found = recipes.alias("r").join(c.alias("c"), fits, "left").groupBy("r.recipe_id").agg(F.min_by("c.chunk_id", "c._order").alias("chunk_id"))
    return found.select("recipe_id", F.coalesce("chunk_id", F.raise_error(F.concat(F.lit("no chunk for "), "recipe_id")).cast("string")).alias("chunk_id"))
