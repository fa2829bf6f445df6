"""Prompt templates and chat templates.

A chat template is data (``TemplateSpec``). The presets follow public
descriptions of the formats; no byte equality with any tokenizer is claimed, and
date preambles and thinking blocks are left out.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatloom.functions.text import as_column, let, strip, text_or_empty


def fill_template(template: str, **values: Column | str) -> Column:
    """Fill ``{name}`` placeholders with columns.

    The template is cut into literal and column pieces once, on the driver.
    Values are never scanned for placeholders, so a note holding ``{count}``
    stays verbatim. A missing value counts as ``""``. Format specs and conversions
    are an error.
    """
    pieces: list[Column] = []
    for literal, name, spec, conversion in Formatter().parse(template):
        if spec or conversion:
            raise ValueError(f"placeholder {name!r} has a format spec or a conversion")
        if literal:
            pieces.append(F.lit(literal))
        if name is not None:
            pieces.append(text_or_empty(values[name]))
    return F.concat(*pieces) if pieces else F.lit("")


@dataclass(frozen=True)
class TemplateSpec:
    """How one chat format writes a conversation.

    ``system_policy``: ``keep`` writes a system turn like any other, ``drop``
    leaves it out, ``fold_into_first_user`` puts its text and a blank line in
    front of the first user turn.
    """

    name: str
    turn_prefix: str
    turn_suffix: str
    end_of_turn: str
    bos: str = ""
    role_map: dict[str, str] = field(default_factory=dict)
    system_policy: str = "keep"
    trim_content: bool = False

    def header(self, role: str) -> str:
        return self.turn_prefix + self.role_map.get(role, role) + self.turn_suffix

    @property
    def instruction_part(self) -> str:
        return self.header("user")

    @property
    def response_part(self) -> str:
        return self.header("assistant")


# Markers of the supported chat formats.
LLAMA = TemplateSpec(
    name="llama-3.1",
    bos="<|begin_of_text|>",
    turn_prefix="<|start_header_id|>",
    turn_suffix="<|end_header_id|>\n\n",
    end_of_turn="<|eot_id|>",
    trim_content=True,
)
GEMMA = TemplateSpec(
    name="gemma3",
    bos="<bos>",
    turn_prefix="<start_of_turn>",
    turn_suffix="\n",
    end_of_turn="<end_of_turn>\n",
    role_map={"assistant": "model"},
    system_policy="fold_into_first_user",
    trim_content=True,
)
CHATML = TemplateSpec(
    name="chatml",
    turn_prefix="<|im_start|>",
    turn_suffix="\n",
    end_of_turn="<|im_end|>\n",
)
TEMPLATES = {spec.name: spec for spec in (LLAMA, GEMMA, CHATML)}


def message(role: Column | str, content: Column) -> Column:
    """One ``{role, content}`` struct; a plain string is a literal role."""
    role = F.lit(role) if isinstance(role, str) else role
    return F.struct(role.alias("role"), content.alias("content"))


def _is_system(m: Column) -> Column:
    return m["role"] == "system"


def system_text(messages: Column) -> Column:
    """The system turns of a conversation as one text."""
    system = F.filter(messages, _is_system)
    return F.array_join(F.transform(system, lambda m: m["content"]), "\n\n")


def without_system(messages: Column) -> Column:
    return F.filter(messages, lambda m: ~F.coalesce(_is_system(m), F.lit(False)))


def fold_system(messages: Column, system: Column) -> Column:
    """Other than system turns, the text ``system`` in front of the first user turn.

    Where there is no user turn, it becomes one at the start.
    """

    def fold(parts: Column) -> Column:
        first_user = F.array_position(F.transform(parts["rest"], lambda m: m["role"]), "user")
        folded = F.transform(
            parts["rest"],
            lambda m, i: message(
                m["role"],
                F.when(
                    i + 1 == first_user, F.concat(parts["system"], F.lit("\n\n"), m["content"])
                ).otherwise(m["content"]),
            ),
        )
        alone = F.array(message("user", parts["system"]))
        return (
            F.when(parts["system"] == "", parts["rest"])
            .when(first_user == 0, F.concat(alone, parts["rest"]))
            .otherwise(folded)
        )

    return let(F.struct(without_system(messages).alias("rest"), system.alias("system")), fold)


def render_turns(messages: Column, spec: TemplateSpec) -> Column:
    """The turns one after the other, as they are, without marks around them."""

    def role(m: Column) -> Column:
        out = F.coalesce(m["role"], F.lit(""))
        for known, shown in spec.role_map.items():
            out = F.when(m["role"] == known, F.lit(shown)).otherwise(out)
        return out

    def turn(m: Column) -> Column:
        content = F.coalesce(m["content"], F.lit(""))
        return F.concat(
            F.lit(spec.turn_prefix),
            role(m),
            F.lit(spec.turn_suffix),
            strip(content) if spec.trim_content else content,
            F.lit(spec.end_of_turn),
        )

    return F.array_join(F.transform(messages, turn), "")


def render_chat(
    messages: Column | str, spec: TemplateSpec, add_generation_prompt: bool = False
) -> Column:
    """Write a conversation (array of ``{role, content}``) as one training text."""
    messages = as_column(messages)
    if spec.system_policy == "fold_into_first_user":
        messages = fold_system(messages, system_text(messages))
    elif spec.system_policy == "drop":
        messages = without_system(messages)
    elif spec.system_policy != "keep":
        raise ValueError(f"unknown system policy {spec.system_policy!r}")
    pieces = [render_turns(messages, spec)]
    if spec.bos:
        pieces.insert(0, F.lit(spec.bos))
    if add_generation_prompt:
        pieces.append(F.lit(spec.response_part))
    return F.concat(*pieces)
