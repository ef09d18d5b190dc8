"""Message-array expressions: struct builders, ShareGPT normalisation, system
prompt, chat-template rendering and per-message lengths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trainloom import config as C
from trainloom.functions.text import col_

MESSAGE_TYPE = "array<struct<role:string,content:string>>"


def message(role, content) -> Column:
    r = F.lit(role) if isinstance(role, str) else role
    return F.struct(r.alias("role"), F.coalesce(content if isinstance(content, Column) else F.lit(content),
                                                F.lit("")).alias("content"))


def messages(*pairs) -> Column:
    """Array of {role, content} from (role, content) pairs."""
    return F.array(*[message(r, c) for r, c in pairs])


def empty_messages() -> Column:
    return F.array().cast(MESSAGE_TYPE)


def map_role(speaker) -> Column:
    """M1 role mapping; unknown or missing speakers become 'user'."""
    s = col_(speaker)
    expr = None
    for name, role in C.ROLE_MAP.items():
        expr = (F.when(s == name, F.lit(role)) if expr is None else expr.when(s == name, F.lit(role)))
    return expr.otherwise(F.lit("user"))


def sharegpt_to_messages(conv) -> Column:
    """M1: [{from|role, value|content}] -> [{role, content}]; ``from`` wins over
    ``role``, ``value`` over ``content``, empty counts as missing."""
    def turn(t):
        speaker = F.coalesce(F.nullif(t.getField("from"), F.lit("")), t.getField("role"))
        content = F.coalesce(F.nullif(t.getField("value"), F.lit("")), t.getField("content"), F.lit(""))
        return F.struct(map_role(speaker).alias("role"), content.alias("content"))
    return F.transform(F.coalesce(col_(conv), F.array()), turn)


def ensure_system(msgs, system_prompt: str = C.CODE_SYSTEM_PROMPT) -> Column:
    """M4: prepend the default system message unless the first role is system."""
    m = F.coalesce(col_(msgs), empty_messages())
    first_is_system = F.coalesce(F.try_element_at(m, F.lit(1)).getField("role") == F.lit("system"), F.lit(False))
    return F.when(first_is_system, m).otherwise(F.concat(F.array(message("system", system_prompt)), m))


def header(role) -> Column:
    return F.concat(F.lit(C.TEMPLATE_HEADER_OPEN), F.coalesce(col_(role), F.lit("user")), F.lit(C.TEMPLATE_HEADER_CLOSE))


def rendered_piece(role, content) -> Column:
    """One message in the chat template."""
    return F.concat(header(role), F.coalesce(col_(content), F.lit("")), F.lit(C.TEMPLATE_EOT))


def rendered_piece_length(role, content) -> Column:
    return (F.lit(len(C.TEMPLATE_HEADER_OPEN) + len(C.TEMPLATE_HEADER_CLOSE) + len(C.TEMPLATE_EOT))
            + F.length(F.coalesce(col_(role), F.lit("user"))) + F.coalesce(F.length(col_(content)), F.lit(0)))


def render_chat(msgs) -> Column:
    """M9: messages -> one training string (no generation prompt)."""
    pieces = F.transform(col_(msgs), lambda m: rendered_piece(m.getField("role"), m.getField("content")))
    return F.concat(F.lit(C.TEMPLATE_BOS), F.array_join(pieces, ""))


def eval_prompt(prompt, system_prompt: str = C.CODE_SYSTEM_PROMPT) -> Column:
    """System + "Complete this function:" + prompt, single turn."""
    return messages(("system", system_prompt),
                    ("user", F.concat(F.lit(C.COMPLETE_FUNCTION_PREFIX), F.coalesce(col_(prompt), F.lit("")))))
