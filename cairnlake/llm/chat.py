"""Chat formatting with a black-box template: spans and loss masks from renderings alone.

A template is a function from turns to text. Successive prefixes of a conversation are rendered, and each
output is compared with the one before: what was added is the turn's span, and an output that does not
keep the one before (but for a closing suffix) shows a template that rewrites history. Inside its span
a turn's text is located by rendering the same prefix with a stand-in character for the text.

format_conversations renders every prefix, of any template. format_turns alone may, of a template that says it goes by
turns, continue the rendering of the one before with that of the new turn; the whole rendering must confirm it."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnlake.llm.common import small_batches

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

OPEN, CLOSE = "### ", "</turn>\n"


#: What stands for a backslash and for each character that could begin a control string; none of them stays.
_ESCAPES = {"\\": "\\\\", "#": "\\h", "<": "\\l", ":": "\\c"}
_PLAIN = {code[1]: c for c, code in _ESCAPES.items()}
_TEXT_TABLE = str.maketrans({c: code for c, code in _ESCAPES.items() if c != ":"})
_ROLE_TABLE = str.maketrans(_ESCAPES)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _PLAIN[m[1]], text, flags=re.DOTALL) if "\\" in text else text


class _Marked(dict):
    """Turns as marked_turns writes them. Each prefix of a conversation asks again for the turns of the one before, so they are
    kept, up to MOST_KEPT characters."""

    kept = 0

    def __missing__(self, turn: Turn) -> str:
        role, text = turn
        made = f"{OPEN}{role.translate(_ROLE_TABLE)}: {text.translate(_TEXT_TABLE)}{CLOSE}"
        if self.kept + len(text) + len(made) > MOST_KEPT:
            self.clear()
            self.kept = 0
        if len(text) + len(made) <= MOST_KEPT:
            self[turn] = made
            self.kept += len(text) + len(made)
        return made


MOST_KEPT = 8 << 20
_marked = _Marked()


def marked_turns(turns: list[Turn]) -> str:
    """The standard template: `### role: text</turn>` and a line feed for each turn."""
    return "".join(map(_marked.__getitem__, turns))


#: What a template says of itself: it renders turns one after the other, whatever stands around them.
marked_turns.by_turn = True


def parse_marked(output: str) -> list[Turn]:
    """The turns of a text that marked_turns wrote."""
    turns = []
    pieces = output.split(CLOSE)
    if pieces.pop():
        raise ValueError("text after the last turn mark")
    for piece in pieces:
        head = re.match(r"### ([^:]*): ", piece)
        if head is None:
            raise ValueError("turn without its opening mark")
        turns.append((unescape(head[1]), unescape(piece[head.end() :])))
    return turns


@dataclass
class Formatted:
    text: str
    spans: list[tuple[int, int]]  # of each turn
    contents: list[tuple[int, int]]  # of each turn's text as rendered
    rewrites: bool  # an earlier part changed as turns were added


def _shared(a: str, b: str, back: bool = False) -> int:
    """Length of the longest common prefix, or suffix, by binary search over slices."""
    if not back and b.startswith(a):
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        same = a[len(a) - middle : len(a) - low] == b[len(b) - middle : len(b) - low] if back else a[low:middle] == b[low:middle]
        low, high = (middle, high) if same else (low, middle - 1)
    return low


def _content(template: Template, earlier: list[Turn], role: str, text: str, output: str) -> tuple[int, int]:
    """Where the text of the last turn stands in the output. A stand-in character takes its place; if the text
    holds the whole private-use area, two renderings with different stand-ins tell where they differ."""
    mark = next((c for c in map(chr, range(0xE000, 0xF8FF)) if c not in text), None)
    probe = template([*earlier, (role, mark or "\ue000")])
    other = output if mark else template([*earlier, (role, "\ue001")])
    start = _shared(other, probe)
    return start, max(start, len(output) - _shared(other, probe, back=True))


def _continued(template: Template, turns: list[Turn]) -> Formatted:
    """The rendering of each prefix as that of the one before and what the new turn adds."""
    pieces, spans, contents, end = [], [], [], 0
    for role, text in turns:
        piece = template([(role, text)])
        start, stop = _content(template, [], role, text, piece)
        spans.append((end, end + len(piece)))
        contents.append((end + start, end + stop))
        pieces.append(piece)
        end += len(piece)
    return Formatted("".join(pieces), spans, contents, False)


def format_turns(template: Template, turns: list[Turn], every: bool = False) -> Formatted:
    """Renders every prefix of the conversation, whatever its length, and compares it with the one before: what a
    template looks back at cannot be seen from parts. The text is that of the last rendering, so it is the
    template's own. The work grows with the square of the number of turns, but for a template that goes by turns
    and whose rendering of the whole conversation bears that out: there it grows with the text. With `every`, what a template
    says of itself is not asked."""
    if not every and getattr(template, "by_turn", False):
        made = _continued(template, turns)
        if made.text == template(turns):
            return made
    before, spans, contents, rewrites = template([]), [], [], False
    for i, (role, text) in enumerate(turns):
        output = template(turns[: i + 1])
        keep = _shared(before, output)
        closing = before[keep:]
        if not output.endswith(closing):
            rewrites, closing = True, ""
        spans.append((keep, len(output) - len(closing)))
        contents.append(_content(template, turns[:i], role, text, output))
        before = output
    return Formatted(before, spans, contents, rewrites)


def format_conversations(df: DataFrame, template: Template = marked_turns) -> DataFrame:
    """(conv_id, text, spans, contents, roles, rewrites) of each conversation, rows taken by turn.

    Null texts and roles count as empty, null turns come first, and rows of equal turn follow by role and
    text; repeated rows are turns of their own. A null conv_id is a conversation like any other. Every prefix is rendered."""
    small_batches(df.sparkSession)
    turns = F.array_sort(F.collect_list(F.struct(F.coalesce("turn", F.lit(-(2**63))).alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                made, roles = [], []
                for rows in part.column(1).to_pylist():
                    own = [(r["role"], r["text"]) for r in rows]
                    made.append(format_turns(template, own, every=True))
                    roles.append([role for role, _ in own])
                pairs = pa.list_(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([m.text for m in made], pa.string()), pa.array([m.spans for m in made], pairs), pa.array([m.contents for m in made], pairs), pa.array(roles, pa.list_(pa.string())), pa.array([m.rewrites for m in made])],
                    ["conv_id", "text", "spans", "contents", "roles", "rewrites"],
                )

    grouped = df.select("conv_id", "turn", "role", "text").groupBy("conv_id").agg(turns.alias("turns"))
    kind = df.schema["conv_id"].dataType.simpleString()
    return grouped.mapInArrow(run, f"conv_id {kind}, text string, spans array<array<bigint>>, contents array<array<bigint>>, roles array<string>, rewrites boolean")


def read_back(formatted: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """Digests of what the formatted texts and their loss masks hold, parsed from the output."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_turns, turns_sha, loss_chars, loss_sha, chars = [], [], [], [], []
            for text, contents, roles in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                turns = parse_marked(text)
                n_turns.append(len(turns))
                turns_sha.append(hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest())
                loss = "".join(unescape(text[a:b]) for (a, b), role in zip(contents, roles) if role == loss_role)
                loss_chars.append(len(loss))
                loss_sha.append(hashlib.sha256(loss.encode()).hexdigest())
                chars.append(len(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_turns, pa.int64()), pa.array(turns_sha, pa.string()), pa.array(loss_chars, pa.int64()), pa.array(loss_sha, pa.string()), pa.array(chars, pa.int64()), batch.column(4)],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewrites"],
            )

    kind = formatted.schema["conv_id"].dataType.simpleString()
    return formatted.select("conv_id", "text", "contents", "roles", "rewrites").mapInArrow(run, f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, rewrites boolean")
