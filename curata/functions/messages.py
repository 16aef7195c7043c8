"""Expressions over arrays of chat messages (structs of role and content) and truthiness."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def of_role(messages: Column, role: str) -> Column:
    return F.filter(messages, lambda m: m["role"] == role)


def last_of(messages: Column, role: str) -> Column:
    """Content of the last message of a role, or null."""
    return F.try_element_at(of_role(messages, role), F.lit(-1))["content"]


def first_filled(messages: Column, role: str) -> Column:
    """Content of the first message of a role that isn't blank, or null."""
    return F.get(F.filter(of_role(messages, role), lambda m: F.trim(m["content"]) != ""), F.lit(0))["content"]


def joined(messages: Column, role: str) -> Column:
    return F.array_join(F.transform(of_role(messages, role), lambda m: m["content"]), "\n")


def filled(col: Column) -> Column:
    """A string with more than white space, else null."""
    return F.when(F.trim(F.regexp_replace(col, r"\s+", " ")) != "", col)


def answer_text(reference: Column, messages: Column) -> Column:
    """The reference answer, else the last answer that isn't blank, else ''."""
    answers = F.filter(of_role(messages, "assistant"), lambda m: F.trim(m["content"]) != "")
    return F.coalesce(filled(reference), F.try_element_at(answers, F.lit(-1))["content"], F.lit(""))


def first_true(*cols: Column, default: str = "<unknown>") -> Column:
    """The first string that is neither null nor empty."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in cols), F.lit(default))


def numbered(steps: Column) -> Column:
    return F.array_join(F.transform(steps, lambda s, i: F.concat((i + 1).cast("string"), F.lit(". "), s)), "\n")


def visible_answer(task: Column, answer: Column, steps: Column) -> Column:
    """A step task's answer with its numbered steps behind a blank line, unless it starts with them or there are none."""
    base = F.trim(F.coalesce(answer, F.lit("")))
    real = F.filter(F.transform(F.coalesce(steps, F.array().cast("array<string>")), lambda s: F.btrim(s, F.lit(" \t\n\r\x0b\f"))), lambda s: s != "")
    plain = ~F.coalesce(task == "step_by_step", F.lit(False)) | (F.size(real) == 0) | base.startswith("1.")
    return F.when(plain, base).when(base == "", numbered(real)).otherwise(F.concat(base, F.lit("\n\n"), numbered(real)))
