"""Prompt and chat templates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# System lines and template markup.
DOCUMENT_SYSTEM = "You are a helpful document assistant."
START, END = "<|im_start|>", "<|im_end|>"
RAG_TEMPLATE = (
    "\nYou are an assistant for question-and-answer sessions about the book \"{title}\" by {author}.\n"
    "Use the following pieces of retrieved context to answer the questions.\n"
    "If you don't know the answer, you can say \"I don't know\".\n"
    "QUESTION: {question}\nCONTEXT: {context}\nANSWER:\n")


def render_chatml(question: Column, context: Column, answer: Column | None = None,
                  system: str = DOCUMENT_SYSTEM) -> Column:
    """System, user (context and question) and assistant turn; open-ended without an answer."""
    head = F.concat(F.lit(f"{START}system\n{system}{END}\n{START}user\nContext: "), context,
                    F.lit("\nQuestion: "), question, F.lit(f"{END}\n{START}assistant\n"))
    return head if answer is None else F.concat(head, answer, F.lit(END))


def to_messages(instruction: Column, input_: Column, output: Column) -> Column:
    """Instruction row as a user and an assistant message."""
    user = F.concat(instruction, F.lit("\n Input: "), input_)
    return F.array(F.struct(user.alias("content"), F.lit("user").alias("role")),
                   F.struct(output.alias("content"), F.lit("assistant").alias("role")))


def render_message(role: Column, content: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), content, F.lit(f"{END}\n"))


def apply_template(messages: Column, gen_prompt: bool = False) -> Column:
    """Message array as one chat text, with an open assistant turn on request."""
    body = F.array_join(F.transform(messages, lambda m: render_message(m["role"], m["content"])), "")
    return F.concat(body, F.lit(f"{START}assistant\n")) if gen_prompt else body


def render_threads(df: DataFrame, key: str = "conv_id", turn: str = "turn",
                   role: str = "role", text: str = "text", turns_per_part: int = 1024) -> DataFrame:
    """Chat text per thread, in parts of ``turns_per_part`` consecutive turn numbers.

    The parts of a thread, joined in order, are its whole text, so a thread of any
    length is rendered without ever being gathered into one group.
    """
    line = F.struct(F.col(turn).alias("t"), render_message(F.col(role), F.col(text)).alias("x"))
    part = F.expr(f"{turn} div {turns_per_part}").cast("bigint")
    return (df.groupBy(key, part.alias("part"))
            .agg(F.count("*").alias("n_messages"),
                 F.array_join(F.transform(F.array_sort(F.collect_list(line)), lambda m: m["x"]), "").alias("chat")))


def render_qa(question: Column, context: Column) -> Column:
    """Question prompt; the context line is left out when it is empty or null."""
    tail = F.concat(F.lit("Question: "), question, F.lit("\nAnswer:"))
    return F.when(F.coalesce(context, F.lit("")) != "",
                  F.concat(F.lit("Context: "), context, F.lit("\n"), tail)).otherwise(tail)


def render_rag(question: Column, context: Column, title: str, author: str) -> Column:
    """Fill the retrieval prompt; the two columns are inserted literally."""
    head, rest = RAG_TEMPLATE.replace("{title}", title).replace("{author}", author).split("{question}")
    middle, tail = rest.split("{context}")
    return F.concat(F.lit(head), question, F.lit(middle), context, F.lit(tail))
