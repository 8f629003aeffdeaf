"""Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) turns to a string; nothing
is known of how it works. Rendering one more turn at a time and comparing with the
output before shows where that turn's text lies. A template that changes what it
wrote before rewrites history: the turn from which on outputs differ is reported,
and spans are then measured in the last output.

Every prefix of a conversation is rendered from its first turn on, so a template
may depend on anything before; a task then holds one conversation, and its time
grows with the square of the turns. A caller who knows that a template writes
every turn by itself, as `marked` does, may say turn_local=True: turns then stream
through in parts of PART, and memory does not grow with a conversation. Each part
starts with the turn before it, which must come out as it did in the part before;
a template seen to break the promise is an error, never another result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]
PART = 64

_MARK = re.compile(r"<(\\*)\|")
_MARKED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    """`<|` cannot appear in the result; every `<\\...|` has one backslash more."""
    return _MARK.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _MARKED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """A role stands on one line."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role),
                  flags=re.DOTALL)


def marked(turns: list[Turn]) -> str:
    """The template of this module: marked turns, control strings inside texts escaped."""
    return "".join(f"<|im_start|>{escape_role(role)}\n{escape(text)}<|im_end|>\n"
                   for role, text in turns)


# What `shortened` leaves of an answer that has been followed up.
KEPT = 80


def shortened(turns: list[Turn]) -> str:
    """A template that rewrites history, as those do which drop earlier reasoning: once a
    user writes again, longer answers before are cut to KEPT characters."""
    last = max((i for i, (role, _) in enumerate(turns) if role == "user"), default=-1)
    return "".join(
        marked([turn]) if turn[0] != "assistant" or i > last or len(turn[1]) <= KEPT else
        f"<|im_start|>assistant\n{escape(turn[1][:KEPT])}<|cut|><|im_end|>\n"
        for i, turn in enumerate(turns))


def first_rewrite(template: Template, turns: list[Turn]) -> int:
    """The first turn with which a template changes what it wrote before (-1: none)."""
    out = template([])
    for i in range(len(turns)):
        more = template(turns[:i + 1])
        if not more.startswith(out):
            return i
        out = more
    return -1


def turn_spans(template: Template, turns: list[Turn]) -> tuple[str, list[tuple[int, int]], int]:
    """Output, the span each turn added, and the first turn that rewrote history (-1: none)."""
    out, spans, rewrote = template([]), [], -1
    for i in range(len(turns)):
        more = template(turns[:i + 1])
        if more.startswith(out):
            spans.append((len(out), len(more)))
        else:
            if rewrote < 0:
                rewrote = i
            same = next((k for k, (x, y) in enumerate(zip(out, more)) if x != y),
                        min(len(out), len(more)))
            spans = [(a, min(b, len(more))) for a, b in spans]
            spans.append((same, len(more)))
        out = more
    return out, spans, rewrote


_PROBE = "\ue000"


def content_span(template: Template, before: list[Turn], turn: Turn,
                 span: tuple[int, int], out: str, escaped: str) -> tuple[int, int]:
    """Where the turn's own text lies in its span, found by rendering a probe in its place.

    What stands before and after the probe belongs to the template.
    """
    probed = template([*before, (turn[0], _PROBE)])[span[0]:]
    head, _, tail = probed.rpartition(_PROBE)
    if out[span[0]:span[1]] != head + escaped + tail:
        raise ValueError("the template changes the text in a way that escaping does not explain")
    return span[0] + len(head), span[1] - len(tail)


class _Conversation:
    """What is known of one conversation while its turns stream by."""

    def __init__(self, name, template: Template, keep: bool, turn_local: bool,
                 watched: Template | None):
        self.name, self.template, self.keep = name, template, keep
        self.turn_local, self.watched = turn_local, watched
        self.watched_rewrote: int | None = None
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = 0
        self.rewrote = -1
        self.text: list[str] = []
        self.spans: list[tuple[int, int, bool]] = []
        self.part: list[Turn] = []
        self.before: Turn | None = None
        self.seam = ""

    def add(self, turn: Turn) -> None:
        self.part.append(turn)
        if self.turn_local and len(self.part) == PART:
            self.close()

    def close(self) -> None:
        if not self.part:
            return
        lead = [self.before] if self.before else []
        turns = [*lead, *self.part]
        out, spans, rewrote = turn_spans(self.template, turns)
        if self.turn_local and (rewrote >= 0 or spans[0][0] or (
                lead and out[spans[0][0]:spans[0][1]] != self.seam)):
            raise ValueError("the template does not write every turn by itself: turn_local is wrong")
        self.rewrote = rewrote
        if self.watched:
            self.watched_rewrote = first_rewrite(self.watched, self.part)
        # A part without a lead is the beginning, with whatever stands before its first turn.
        first = spans[1][0] if lead else 0
        shift = self.chars - first
        for i in range(len(lead), len(turns)):
            role, text = turns[i]
            begin, end = spans[i]
            inner = (begin, end)
            if rewrote < 0:
                inner = content_span(self.template, turns[:i], turns[i], spans[i], out,
                                     escape(text))
                # The turn is read back from the output, not taken from the input.
                head = out[begin:inner[0]]
                role = unescape_role(head[len("<|im_start|>"):-1]) \
                    if self.template is marked else role
                text = unescape(out[inner[0]:inner[1]])
            trained = role == "assistant"
            self.turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            if trained:
                self.loss.update(text.encode("utf-8", "surrogatepass"))
                self.loss_chars += len(text)
            if self.keep:
                self.spans.append((inner[0] + shift, inner[1] + shift, trained))
        added = out[first:]
        if self.keep:
            self.text.append(added)
        self.n += len(self.part)
        self.chars += len(added)
        self.before, self.seam = self.part[-1], out[spans[-1][0]:spans[-1][1]]
        self.part = []

    def row(self) -> tuple:
        self.close()
        return (self.name, self.n, self.turns.hexdigest(), self.loss_chars,
                self.loss.hexdigest(), self.chars, self.rewrote, self.watched_rewrote,
                "".join(self.text) if self.keep else None,
                [{"start": a, "end": b, "trained": t} for a, b, t in self.spans]
                if self.keep else None)


_COLUMNS = ("n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
            "formatted_chars long, rewrote long, watched_rewrote long, formatted string, "
            "spans array<struct<start: long, end: long, trained: boolean>>")
_KINDS = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(),
          pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()),
                              ("trained", pa.bool_())]))]


def _format(template: Template, keep: bool, turn_local: bool, watched: Template | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(rows, kind):
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], k) for i, k in enumerate([kind, *_KINDS])],
                names=["conv_id", *(c.split()[0] for c in (
                    "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars",
                    "rewrote", "watched_rewrote", "formatted", "spans"))])

        now, rows, held, kind = None, [], 0, pa.int64()
        for batch in batches:
            kind = batch.schema.field("conv_id").type
            names = batch.column("conv_id").to_pylist()
            for name, role, text in zip(names, batch.column("role").to_pylist(),
                                        batch.column("text").to_pylist()):
                if now is None or now.name != name:
                    if now is not None:
                        rows.append(now.row())
                        held += rows[-1][5] if keep else 0
                        if len(rows) >= 1000 or held > 1 << 24:
                            yield emit(rows, kind)
                            rows, held = [], 0
                    now = _Conversation(name, template, keep, turn_local, watched)
                now.add((role or "", text or ""))
        if now is not None:
            rows.append(now.row())
        if rows:
            yield emit(rows, kind)

    return run


def format_conversations(turns: DataFrame, template: Template = marked, *,
                         keep: bool = True, turn_local: bool = False,
                         watched: Template | None = None) -> DataFrame:
    """One row for each conv_id, with the formatted text and its spans if `keep`.

    turn_local promises that the template writes every turn by itself, see above.
    `watched` is a second template, of which only the first turn that rewrites history is
    reported, as watched_rewrote; it is rendered up to there, over true prefixes.
    An empty table gives no rows. Defined results: null roles and texts are empty; rows of one turn number go by
    role and text, and a row given twice is two turns; null turns come first; rows
    without a conv_id are one conversation; other columns are ignored.
    """
    if watched and turn_local:
        raise ValueError("a watched template needs true prefixes")
    kind = turns.schema["conv_id"].dataType.simpleString()
    rows = (turns.select("conv_id", "turn", "role", "text").repartition("conv_id")
            .sortWithinPartitions("conv_id", "turn", "role", "text"))
    return rows.select("conv_id", "role", "text").mapInArrow(
        _format(template, keep, turn_local, watched), f"conv_id {kind}, {_COLUMNS}")
