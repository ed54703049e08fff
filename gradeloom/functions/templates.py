"""Prompt and training-text templates as column expressions, kept by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.functions.text import has_text, text_or_empty, trim_py

# Role markers, end marker and system line of the chat format.
SYSTEM_LINE = "You are a helpful, respectful and honest assistant. Always answer as helpfully as possible."
SYSTEM_MARK, USER_MARK, ASSISTANT_MARK = "<|system|>\n", "<|user|>\n", "<|assistant|>\n"
END_MARK = "</s>"
ROLES = ("system", "user", "assistant")


def user_message() -> Column:
    """Instruction, followed by the context unless that is blank."""
    instruction, context = text_or_empty("instruction"), text_or_empty("context")
    with_context = F.concat(instruction, F.lit("\n\nContext: "), context)
    return F.when(trim_py(context) != "", with_context).otherwise(instruction)


def _chat(after_system: str, *tail: Column) -> Column:
    opening = SYSTEM_MARK + SYSTEM_LINE + END_MARK + after_system + USER_MARK
    return F.concat(F.lit(opening), user_message(), F.lit(END_MARK + "\n" + ASSISTANT_MARK), *tail)


def chat_text() -> Column:
    """Training text: system line, user message and response."""
    return _chat("\n", text_or_empty("response"), F.lit(END_MARK))


def chat_prompt(after_system: str = " \n") -> Column:
    """Evaluation prompt; by default a space follows the system line's end marker."""
    return _chat(after_system)


def headings_prompt(closing: str = "\n") -> Column:
    """Instruction / Context / Response headings; any non-empty context counts, even a blank one."""
    context = F.when(
        has_text("context"), F.concat(F.lit("### Context:\n"), F.col("context"), F.lit("\n\n"))
    ).otherwise("")
    return F.concat(
        F.lit("### Instruction:\n"), text_or_empty("instruction"), F.lit("\n\n"), context,
        F.lit("### Response:" + closing),
    )


def question_prompt() -> Column:
    """Headings around a bare prompt, no context and no newline at the end."""
    return F.concat(F.lit("### Instruction:\n"), text_or_empty("instruction"), F.lit("\n\n### Response:"))


def serving_text(system: Column, prompt: Column, response: Column) -> Column:
    """Serving format: the system and user blocks appear only when they have text."""

    def block(mark: str, c: Column) -> Column:
        return F.when(F.length(c) > 0, F.concat(F.lit(mark), c, F.lit(END_MARK + "\n"))).otherwise("")

    return F.concat(
        block(SYSTEM_MARK, system), block(USER_MARK, prompt),
        F.lit(ASSISTANT_MARK), F.coalesce(response, F.lit("")), F.lit(END_MARK),
    )


TEMPLATES: dict[str, Callable[[], Column]] = {
    "chat": chat_text,
    "chat_prompt": chat_prompt,
    "headings": headings_prompt,
    "question": question_prompt,
}


def register_template(name: str, build: Callable[[], Column]) -> None:
    TEMPLATES[name] = build


def apply_template(df: DataFrame, name: str, into: str = "text") -> DataFrame:
    if name not in TEMPLATES:
        raise ValueError(f"unknown template {name!r}; known: {sorted(TEMPLATES)}")
    return df.withColumn(into, TEMPLATES[name]())


def evaluation_rows(df: DataFrame, template: str = "chat_prompt") -> DataFrame:
    """Prompt and reference beside the columns they came from."""
    return apply_template(df, template, "prompt").select(
        "id", "prompt", F.col("response").alias("reference"), "instruction", "context", "category"
    )


def render_conversations(messages: DataFrame, add_generation_prompt: bool = False) -> DataFrame:
    """One text per conversation, turns in order; messages of other roles are left out.

    The pieces of one conversation meet in one row, because that row is the result.
    """
    piece = F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), F.col("content"), F.lit(END_MARK + "\n"))
    rendered = F.when(F.col("role").isin(*ROLES), piece).otherwise("")
    turns = F.array_sort(F.collect_list(F.struct("turn", rendered.alias("piece"))))
    text = F.array_join(F.col("_turns.piece"), "")
    if add_generation_prompt:
        text = F.concat(text, F.lit("<|assistant|>\n"))
    return messages.groupBy("conv_id").agg(turns.alias("_turns")).select("conv_id", text.alias("text"))
