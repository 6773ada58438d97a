"""Chat formatting by incremental rendering of a black-box template.

A template is any function from turns to one text; nothing is asked of it but
its output. A conversation's successive prefixes (its first turn, its first
two, ...) are rendered and each output is compared with the one before: where
the earlier output is a prefix of the later one, the rest is the new turn's
span. Where it is not, the template has rewritten history (it moved a system
text, dropped an old answer, closed the text with a mark that the next turn
takes away): the conversation is flagged with the first such turn and the
number of characters that were left as they were, and has no spans.

Inside a span, the characters that count for the loss are found in the same
way: the prefix is rendered once more with a private character as the new
turn's text, which shows what the template writes before and after it.

Long conversations are cut into pieces of ``piece_turns`` turns, so no task
holds a conversation and rendering stays linear in its length. A piece is
rendered behind the last ``context_turns`` turns before it. That is right for a
template whose turns depend on no more than these. It is checked, not trusted:
the last turn of every piece is rendered again as the context of the next one,
and ``join_pieces`` raises if the two differ. ``piece_turns=None`` renders whole
conversations, for templates that look further back.

Corner cases: rows are ordered by turn (null first), then role, text and hash;
a null text or role is empty; repeated rows are turns of their own; a null
conversation id is a conversation of its own; a table without rows gives none;
other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvan.llm.common import frames
from sylvan.operators.ordering import with_run_position

Turn = tuple[str, str]

PIECE_TURNS = 64
CONTEXT_TURNS = 2
LOSS_ROLES = ("assistant",)
#: Stands for a turn's text when its place is looked for (the first that the
#: conversation doesn't hold).
PROBES = ("\ue000", "\ue001", "\uf8fe", "\uf8ff")

SPAN = "struct<role:string,start:long,end:long,loss_start:long,loss_end:long>"
PIECE = f"piece long, formatted string, spans array<{SPAN}>, rewritten_turn long, kept_chars long, context_mark long, last_mark long"


class InstTemplate:
    """Turns between instruction marks::

        <<SYS>> system text <</SYS>><s>[INST] user text [/INST] assistant text </s>

    Any other role: ``<s>[ROLE] role [/ROLE] text </s>``. A mark inside a text
    gets a backslash; backslashes before a mark are doubled, so ``unescape``
    gives every text back. Marks are always set off from the text by a space.
    """

    MARKS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]")
    _any = "|".join(re.escape(m) for m in MARKS)
    _plain = re.compile(rf"(\\*)({_any})")
    _escaped = re.compile(rf"(\\+)({_any})")
    _turn = re.compile(
        r"(?P<user><s>\[INST\] )|(?P<other><s>\[ROLE\] )|(?P<system><<SYS>> )|(?P<assistant> )"
    )

    def escape(self, text: str) -> str:
        return self._plain.sub(lambda m: m[1] + m[1] + "\\" + m[2], text) if "<" in text or "[" in text else text

    def unescape(self, text: str) -> str:
        return self._escaped.sub(lambda m: m[1][: len(m[1]) // 2] + m[2], text) if "\\" in text else text

    def render(self, turns: list[Turn]) -> str:
        """The black box: escaped roles and texts to one text."""
        out = []
        for role, text in turns:
            if role == "user":
                out.append(f"<s>[INST] {text} [/INST]")
            elif role == "assistant":
                out.append(f" {text} </s>")
            elif role == "system":
                out.append(f"<<SYS>> {text} <</SYS>>")
            else:
                out.append(f"<s>[ROLE] {role} [/ROLE] {text} </s>")
        return "".join(out)

    def _until(self, text: str, at: int, mark: str) -> tuple[str, int]:
        """The text up to the next ``mark`` that isn't escaped, and the place after it."""
        stop = text.index(" " + mark, at)
        return text[at:stop], stop + 1 + len(mark)

    def parse(self, formatted: str) -> list[Turn]:
        """The turns that a formatted text holds, unescaped."""
        at, turns = 0, []
        while at < len(formatted):
            opened = self._turn.match(formatted, at)
            if opened is None:
                raise ValueError(f"no turn starts at character {at}")
            role, at = opened.lastgroup, opened.end()
            if role == "other":
                role, at = self._until(formatted, at, "[/ROLE]")
                role, at = self.unescape(role), at + 1
                text, at = self._until(formatted, at, "</s>")
            else:
                text, at = self._until(formatted, at, {"user": "[/INST]", "system": "<</SYS>>", "assistant": "</s>"}[role])
            turns.append((role, self.unescape(text)))
        return turns


def _common(a: str, b: str) -> int:
    """Length of the common beginning."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid)
    return low


def text_place(render: Callable[[list[Turn]], str], earlier: list[Turn], turn: Turn, before: str, span: str) -> tuple[int, int] | None:
    """Where the turn's text stands inside its span; None if the template
    doesn't show it as a single stretch."""
    probe = next((p for p in PROBES if p not in before and p not in span), None)
    if probe is None:
        return None
    probed = render([*earlier, (turn[0], probe)])
    if not probed.startswith(before) or probed.count(probe) != 1:
        return None
    head, tail = probed[len(before) :].split(probe)
    stop = len(span) - len(tail)
    if not (span.startswith(head) and span.endswith(tail) and len(head) <= stop):
        return None
    return len(head), stop


def render_turns(
    render: Callable[[list[Turn]], str], turns: list[Turn], context: int = 0, loss_roles: tuple[str, ...] = LOSS_ROLES
) -> dict:
    """Spans of ``turns`` (behind the first ``context`` of them) by rendering
    successive prefixes: ``formatted`` without the context, ``spans`` (role,
    start, end and the loss stretch or None), and, if the template rewrites
    history, the first turn that did (``rewritten``, from 0, the context not
    counted) and the characters ``kept`` before the change."""
    before, base, parts, spans, at, marks = "", 0, [], [], 0, []
    for k, turn in enumerate(turns):
        output = render(turns[: k + 1])
        if not output.startswith(before):
            return {"formatted": render(turns), "spans": None, "rewritten": max(0, k - context), "kept": max(0, _common(before, output) - base), "marks": marks}
        span = output[len(before) :]
        marks.append(zlib.crc32(span.encode("utf-8", "surrogatepass")))
        if k < context:
            base = len(output)
        else:
            place = text_place(render, turns[:k], turn, before, span) if turn[0] in loss_roles else None
            if turn[0] in loss_roles and place is None:
                raise ValueError(f"the template doesn't show the text of a turn of {turn[0]!r} as a single stretch")
            spans.append((turn[0], at, at + len(span), at + place[0] if place else None, at + place[1] if place else None))
            parts.append(span)
            at += len(span)
        before = output
    return {"formatted": "".join(parts), "spans": spans, "rewritten": None, "kept": None, "marks": marks}


def format_conversations(
    rows: DataFrame,
    template,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    loss_roles: tuple[str, ...] = LOSS_ROLES,
    piece_turns: int | None = PIECE_TURNS,
    context_turns: int = CONTEXT_TURNS,
) -> DataFrame:
    """One row per piece of a conversation (its number ``piece`` from 0):
    ``formatted``, ``spans`` (role, start and end of each turn in it, and of
    its text if it counts for the loss; code points, ends exclusive), and for a
    template that rewrites history ``rewritten_turn`` and ``kept_chars``.
    ``context_mark`` and ``last_mark`` serve the check of ``join_pieces``."""
    key_type = rows.select(id_col).schema[0].dataType.simpleString()
    turns = rows.select(
        F.col(id_col).alias("key"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"),
    )
    placed = with_run_position(turns, ["key"], ["turn", "role"], position="at").drop("turn")
    if piece_turns is None:
        dealt = placed.withColumn("piece", F.lit(0).cast("long")).withColumn("context", F.lit(False))
    else:
        own = F.floor(F.col("at") / piece_turns)
        # the last turns of a piece are the context of the next
        last = F.col("at") % piece_turns >= piece_turns - context_turns
        here = F.struct(own.alias("piece"), F.lit(False).alias("context"))
        there = F.struct((own + 1).alias("piece"), F.lit(True).alias("context"))
        dealt = placed.withColumn("_to", F.explode(F.when(last, F.array(here, there)).otherwise(F.array(here))))
        dealt = dealt.select("key", "role", "text", "at", "_to.piece", "_to.context")
    dealt = dealt.repartition("key", "piece").sortWithinPartitions("key", "piece", "at")

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def pieces() -> Iterator[tuple]:
            flat = (row for b in batches for row in zip(b["key"].tolist(), b["key"].isna().tolist(), b["piece"], b["context"], b["role"], b["text"]))
            for (key, null, piece), group in groupby(flat, lambda r: (None if r[1] else r[0], r[1], r[2])):
                group = list(group)
                context = sum(r[3] for r in group)
                if context == len(group):  # nothing follows the last piece
                    continue
                made = render_turns(template.render, [(template.escape(r[4]), template.escape(r[5])) for r in group], context, loss_roles)
                marks = made["marks"]
                spans = None if made["spans"] is None else [
                    {"role": template.unescape(s[0]), "start": s[1], "end": s[2], "loss_start": s[3], "loss_end": s[4]} for s in made["spans"]
                ]
                rewritten = None if made["rewritten"] is None else int(piece) * (piece_turns or 0) + made["rewritten"]
                # a context of one turn shows no more than that turn alone
                mark = marks[context - 1] if context > 1 and len(marks) >= context else None
                yield None if null else key, int(piece), made["formatted"], spans, rewritten, made["kept"], mark, marks[-1] if marks else None

        for frame in frames(pieces(), ["key", "piece", "formatted", "spans", "rewritten_turn", "kept_chars", "context_mark", "last_mark"], 256):
            yield frame.astype({c: "Int64" for c in ("rewritten_turn", "kept_chars", "context_mark", "last_mark")})

    return dealt.mapInPandas(work, f"key {key_type}, {PIECE}").withColumnRenamed("key", id_col)


def join_pieces(pieces: DataFrame, template, id_col: str = "conv_id") -> DataFrame:
    """Read the formatted conversations back, one row each: ``n_turns``,
    ``turns_sha256`` (role, line feed, text, line feed of every turn),
    ``loss_chars`` and ``loss_sha256`` (the unescaped text under the loss mask)
    and ``formatted_chars``; all null but the last for a conversation whose
    history was rewritten, with ``rewritten_turn`` (else null).

    A conversation's pieces pass through one task in order, as a SHA-256 runs
    over its bytes in order; no more than a piece is held. Raises if a turn was
    rendered otherwise at the end of one piece than as context of the next."""
    key_type = pieces.select(id_col).schema[0].dataType.simpleString()
    dealt = pieces.withColumnRenamed(id_col, "key").repartition("key").sortWithinPartitions("key", "piece")

    def digest(rows: Iterator[tuple]) -> tuple:
        turns, loss = hashlib.sha256(), hashlib.sha256()
        n = loss_chars = chars = 0
        last, rewritten = None, None
        for _, _, formatted, spans, changed, context_mark, last_mark in rows:
            chars += len(formatted)
            if rewritten is not None or changed is not None:
                rewritten = changed if rewritten is None else rewritten
                continue
            if last is not None and context_mark is not None and last != context_mark:
                raise ValueError("the template looks further back than the context of a piece: raise context_turns or use piece_turns=None")
            last = last_mark
            for role, text in template.parse(formatted):
                turns.update(f"{role}\n{text}\n".encode())
                n += 1
            for span in spans:
                if not pd.isna(span["loss_start"]):
                    text = template.unescape(formatted[int(span["loss_start"]) : int(span["loss_end"])])
                    loss_chars += len(text)
                    loss.update(text.encode())
        if rewritten is not None:
            return None, None, None, None, chars, rewritten
        return n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, None

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole = lambda column: [None if gone else int(x) for x, gone in zip(column, column.isna())]

        def rows() -> Iterator[tuple]:
            flat = (
                row for b in batches
                for row in zip(b["key"].tolist(), b["key"].isna().tolist(), b["formatted"], b["spans"], whole(b["rewritten_turn"]), whole(b["context_mark"]), whole(b["last_mark"]))
            )
            for (key, null), group in groupby(flat, lambda r: (None if r[1] else r[0], r[1])):
                yield None if null else key, *digest(group)

        for frame in frames(rows(), ["key", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewritten_turn"], 1000):
            yield frame.astype({c: "Int64" for c in ("n_turns", "loss_chars", "formatted_chars", "rewritten_turn")})

    read = dealt.select("key", "piece", "formatted", "spans", "rewritten_turn", "context_mark", "last_mark").mapInPandas(
        work, f"key {key_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, rewritten_turn long"
    )
    return read.withColumnRenamed("key", id_col)
