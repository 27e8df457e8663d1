"""Event-stream framing, deltas and tagged text: in batch by ordered aggregation, in streams by keyed state."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

DONE = "[DONE]"


def events(lines: Iterable[str], held: list[str] | None = None, last: bool = True) -> Iterator[str]:
    """Data of server-sent events: `data:` lines joined until a blank line; comments and other fields are left out. held carries an open event over calls."""
    held = [] if held is None else held
    for line in lines:
        line = line.rstrip("\r")
        if not line:
            if held:
                yield "\n".join(held)
                held.clear()
        elif line.startswith("data:"):
            held.append(line[5:].removeprefix(" "))
    if last and held:
        yield "\n".join(held)
        held.clear()


@dataclass
class Reply:
    text: str = ""
    finish: str | None = None
    bad: int = 0
    done: bool = False


def accumulate(data: Iterable[str], reply: Reply | None = None) -> Reply:
    """Deltas into a text; malformed data counts, nothing counts after the end mark; the last finish reason stays."""
    reply = reply or Reply()
    for x in data:
        if reply.done or x.strip() == DONE:
            reply.done = True
            break
        try:
            choice = json.loads(x)["choices"][0]
        except (ValueError, KeyError, IndexError, TypeError):
            reply.bad += 1
            continue
        reply.text += (choice.get("delta") or {}).get("content") or ""
        reply.finish = choice.get("finish_reason") or reply.finish
    return reply


def replies(lines: DataFrame, key: str, order: str, line: str = "value") -> DataFrame:
    """(key, text, finish, bad) of whole streams of lines; a group is one stream."""

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        r = accumulate(events(pdf.sort_values(order)[line]))
        return pd.DataFrame([(pdf[key].iloc[0], r.text, r.finish, r.bad)], columns=[key, "text", "finish", "bad"])

    return lines.groupBy(key).applyInPandas(fold, f"{key} {dict(lines.dtypes)[key]}, text string, finish string, bad long")


def stream_replies(lines: DataFrame, key: str = "stream", order: str = "n", line: str = "value") -> DataFrame:
    """A stream of lines -> (key, event): each event when its blank line has come; the open one stays in state."""

    def step(k: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = list(state.get[0]) if state.exists else []
        rows = pd.concat(list(pdfs)).sort_values(order)
        found = list(events(rows[line], held, last=False))
        state.update((held,))
        yield pd.DataFrame({key: [k[0]] * len(found), "event": found})

    return lines.groupBy(key).applyInPandasWithState(step, f"{key} string, event string", "held array<string>", "append", GroupStateTimeout.NoTimeout)


def guard_lines(lines: Iterable[str], most: int) -> Iterator[str]:
    """A line over `most` becomes an empty data line, and lines that follow are left out until one of normal length begins a field."""
    skipping = False
    for line in lines:
        if len(line) > most:
            if not skipping:
                yield "data: {}"
            skipping = True
        elif skipping and line and not line.startswith(("data:", "event:", "id:", ":")):
            continue
        else:
            skipping = False
            yield line


def coalesce_deltas(deltas: Iterable[str], every: int) -> Iterator[str]:
    """Deltas joined `every` at a time; the rest at the end."""
    held: list[str] = []
    for d in deltas:
        held.append(d)
        if len(held) == every:
            yield "".join(held)
            held = []
    if held:
        yield "".join(held)


#: Tags that part a reply's reasoning, solution and code from its text.
REASONING = ("think", "thinking", "reason", "reasoning", "thought", "Thought")
PARTS = {**{f"<{t}>": ("reasoning", f"</{t}>") for t in REASONING}, "<|begin_of_thought|>": ("reasoning", "<|end_of_thought|>"), "◁think▷": ("reasoning", "◁/think▷"), "<|begin_of_solution|>": ("solution", "<|end_of_solution|>"), "<code_interpreter>": ("code", "</code_interpreter>")}


@dataclass
class Splitter:
    """Feeds of text -> (kind, text) items. A tag may come in pieces: what could begin one waits."""

    kind: str = "message"
    until: str = ""
    waiting: str = ""
    items: list[tuple[str, str]] = field(default_factory=list)

    def _add(self, text: str) -> None:
        if text:
            if self.items and self.items[-1][0] == self.kind:
                self.items[-1] = (self.kind, self.items[-1][1] + text)
            else:
                self.items.append((self.kind, text))

    def feed(self, text: str, last: bool = False) -> None:
        self.waiting += text
        while True:
            marks = [self.until] if self.until else list(PARTS)
            at, mark = min(((i, m) for m in marks if (i := self.waiting.find(m)) >= 0), default=(-1, ""))
            if at < 0:
                break
            self._add(self.waiting[:at])
            self.waiting = self.waiting[at + len(mark) :]
            self.kind, self.until = ("message", "") if self.until else PARTS[mark]
        keep = 0 if last else max((n for m in marks for n in range(1, len(m)) if self.waiting.endswith(m[:n])), default=0)
        self._add(self.waiting[: len(self.waiting) - keep])
        self.waiting = self.waiting[len(self.waiting) - keep :]


def split_parts(text: str) -> list[tuple[str, str]]:
    s = Splitter()
    s.feed(text, last=True)
    return s.items


def fold_output(data: Iterable[dict]) -> list[dict]:
    """Typed response events -> items: added items and parts, deltas appended, what is done replaces."""
    items: list[dict] = []
    for e in data:
        kind, at = e.get("type", ""), e.get("output_index", 0)
        if kind.endswith("output_item.added"):
            items.append(dict(e["item"]))
        elif kind.endswith("output_item.done") and at < len(items):
            items[at] = dict(e["item"])
        elif kind.endswith("content_part.added") and at < len(items):
            items[at].setdefault("content", []).append(dict(e["part"]))
        elif kind.endswith("output_text.delta") and at < len(items):
            part = items[at].setdefault("content", [{}])[e.get("content_index", 0)]
            part["text"] = part.get("text", "") + e["delta"]
        elif kind.endswith("arguments.delta") and at < len(items):
            items[at]["arguments"] = items[at].get("arguments", "") + e["delta"]
    return items


#: Segments end here.
def segment_loop(segments: list[str], end: str, most: int = 20) -> tuple[list[str], list[str]]:
    """(bodies, recaps) of recorded segments, until the end mark, a segment without recap, or `most`."""
    bodies, recaps = [], []
    for s in segments[:most]:
        recap = re.search(r"(?m)^>\s*\*\*前文提要\*\*\s*\n((?:>.*\n?)*)", s)
        bodies.append((s[: recap.start()] if recap else s).replace(end, "").strip())
        if recap:
            recaps.append(re.sub(r"(?m)^>\s?", "", recap[1]).strip())
        if end in s or not recap:
            break
    return bodies, recaps


def parts_udf():
    return F.pandas_udf(lambda c: c.map(lambda x: [{"kind": k, "text": t} for k, t in split_parts(x)] if x is not None else None), "array<struct<kind:string,text:string>>")
