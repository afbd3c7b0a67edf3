"""Prompt templates as native string columns, and the registry users extend."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomset.functions.text import has_text, text_or_empty

# (instruction, input, output) -> text; output is None for an inference prompt.
Template = Callable[[Column, Column, "Column | None"], Column]

# The exact wording and markers of the four formats.
ALPACA_WITH_INPUT = (
    "Below is an instruction that describes a task, paired with further input that "
    "provides further context. Write a response that appropriately completes the request."
)
ALPACA_NO_INPUT = (
    "Below is an instruction that describes a task. "
    "Write a response that appropriately completes the request."
)
CHATML_USER = "<|im_start|>user\n"
CHATML_ASSISTANT = "<|im_start|>assistant\n"
CHATML_END = "<|im_end|>"
LLAMA3_BEGIN = "<|begin_of_text|>"
LLAMA3_USER = "<|start_header_id|>user<|end_header_id|>\n\n"
LLAMA3_ASSISTANT = "<|start_header_id|>assistant<|end_header_id|>\n\n"
LLAMA3_END = "<|eot_id|>"


def _text(*parts: Column | str | None) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts if p is not None])


def _user_turn(instruction: Column, inp: Column) -> Column:
    """The instruction, followed by the input on its own line when there is one."""
    return F.when(has_text(inp), _text(instruction, "\n", inp)).otherwise(instruction)


def _closed(output: Column | None, end: str) -> tuple[Column | str | None, ...]:
    return (None,) if output is None else (output, end)


def alpaca(instruction: Column, inp: Column, output: Column | None) -> Column:
    task, answer = "\n\n### Instruction:\n", "\n\n### Response:\n"
    return F.when(
        has_text(inp),
        _text(ALPACA_WITH_INPUT, task, instruction, "\n\n### Input:\n", inp, answer, output),
    ).otherwise(_text(ALPACA_NO_INPUT, task, instruction, answer, output))


def chatml(instruction: Column, inp: Column, output: Column | None) -> Column:
    return _text(
        CHATML_USER, _user_turn(instruction, inp), CHATML_END + "\n" + CHATML_ASSISTANT, *_closed(output, CHATML_END)
    )


def llama3(instruction: Column, inp: Column, output: Column | None) -> Column:
    return _text(
        LLAMA3_BEGIN + LLAMA3_USER,
        _user_turn(instruction, inp),
        LLAMA3_END + LLAMA3_ASSISTANT,
        *_closed(output, LLAMA3_END),
    )


def mistral(instruction: Column, inp: Column, output: Column | None) -> Column:
    return _text("[INST] ", _user_turn(instruction, inp), " [/INST] ", output)


_REGISTRY: dict[str, Template] = {
    "alpaca": alpaca,
    "chatml": chatml,
    "llama3": llama3,
    "mistral": mistral,
}


def template_names() -> list[str]:
    return sorted(_REGISTRY)


def get_template(name: str) -> Template:
    try:
        return _REGISTRY[name.lower()]
    except KeyError:
        raise ValueError(f"no template named {name!r}; known are {template_names()}") from None


def register_template(name: str, template: Template) -> None:
    """Add or replace a template. It may build native columns or call a ``pandas_udf``."""
    _REGISTRY[name.lower()] = template


def render(df: DataFrame, template: str, mode: str = "train", keep: tuple[str, ...] = ("row_id",)) -> DataFrame:
    """Project unified rows to ``(*keep, text)``; columns the table lacks count as ''."""
    if mode not in ("train", "inference"):
        raise ValueError(f"no mode named {mode!r}; known are train and inference")
    build = get_template(template)
    columns = df.columns
    output = text_or_empty("output", columns) if mode == "train" else None
    text = build(text_or_empty("instruction", columns), text_or_empty("input", columns), output)
    return df.select(*keep, text.alias("text"))
