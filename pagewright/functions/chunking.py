"""Texts split into chunks of a token budget: the places of cuts are searched for in running sums of the lines' lengths."""

from __future__ import annotations

import math
import re

import numpy as np

#: Characters that one token stands for.
CHARS_PER_TOKEN = 3.2


def tokens(text: str) -> int:
    return max(1, int(len(text) / CHARS_PER_TOKEN)) if text else 0


def content_budget(most: int, offset: int, ratio: float) -> int:
    """Tokens of a chunk's content; the rest of ``most`` is for its header."""
    budget = int((most - offset) * ratio)
    return budget if budget > 0 else 100


def _widest(budget: int) -> int:
    """Most characters whose tokens are within the budget."""
    return math.ceil(CHARS_PER_TOKEN * (budget + 1)) - 1


def split_line(line: str, budget: int) -> list[str]:
    """A line cut at blanks into the longest pieces within the budget; a single word above it is a piece."""
    ends = np.append(np.array([m.start() for m in re.finditer(" ", line)], np.int64), len(line))
    pieces, at, end, most = [], 0, 0, _widest(budget)
    while at < len(line):
        if line[at] == " ":
            at += 1
            continue
        # the last word's end within reach, else that of the word itself
        i = np.searchsorted(ends, at + most, "right") - 1
        end = int(ends[i]) if i >= 0 and ends[i] > at else int(ends[np.searchsorted(ends, at, "right")])
        pieces.append(line[at:end])
        at = end + 1
    # blanks that no longer fit begin the next chunk
    return pieces + [""] if end < len(line) else pieces


class _Lines:
    """Lines that follow each other, with running sums of their characters and of those that aren't blank."""

    def __init__(self, lines: list[str], budget: int):
        self.lines, self.budget = lines, budget
        self.own = np.array([tokens(x) for x in lines], np.int64)
        self.chars = np.concatenate([[0], np.cumsum([len(x) + 1 for x in lines], dtype=np.int64)])
        self.full = np.concatenate([[0], np.cumsum([bool(x.strip()) for x in lines], dtype=np.int64)])

    def count(self, start: int, ends: np.ndarray, after_cut: bool) -> np.ndarray:
        """Tokens of the lines from ``start`` to each end; the first after a cut counts without its line end."""
        n = np.maximum(1, ((self.chars[ends] - self.chars[start]) / CHARS_PER_TOKEN).astype(np.int64))
        return np.where(ends == start + 1, self.own[start], n) if after_cut else n

    def cut(self, start: int, after_cut: bool) -> int:
        """Where the chunk from ``start`` ends: before the first line that doesn't fit, once it has any text."""
        stop = int(np.searchsorted(self.chars, self.chars[start] + _widest(self.budget), "right")) + 1
        while True:
            ends = np.arange(start + 1, min(stop, len(self.lines)))
            over = (self.count(start, ends, after_cut) + self.own[ends] > self.budget) & (self.full[ends] > self.full[start])
            if over.any():
                return int(ends[np.argmax(over)])
            if stop >= len(self.lines):
                return len(self.lines)
            # nothing but blank lines so far
            stop *= 2

    def chunks(self) -> list[tuple[str, int]]:
        out, start, after_cut = [], 0, False
        while start < len(self.lines):
            end = self.cut(start, after_cut)
            content = "\n".join(self.lines[start:end]).strip()
            if content:
                out.append((content, int(self.count(start, np.array([end]), after_cut)[0])))
            start, after_cut = end, True
        return out


def by_budget(text: str, budget: int) -> list[tuple[str, int]]:
    """``(content, tokens)`` of chunks of whole lines; a line above the budget is split at blanks.

    The last piece of a split line begins the next chunk, the others are chunks. A single word above the budget
    is a chunk by itself. A line joins a chunk while its own tokens and those of the chunk are within the budget.
    """
    if tokens(text + "\n") < budget:
        return [(text.strip(), tokens(text + "\n"))] if text.strip() else []
    lines = text.split("\n")
    wide = [i for i, x in enumerate(lines) if len(x) > _widest(budget)]
    out: list[tuple[str, int]] = []
    before: list[str] = []
    for i, j in zip([-1, *wide], [*wide, len(lines)]):
        # the lines between two that are too wide, led by the rest of the first of them
        out += _Lines(before + lines[i + 1 : j], budget).chunks()
        if j < len(lines):
            *whole, rest = split_line(lines[j], budget)
            out += [(piece.strip(), tokens(piece)) for piece in whole if piece.strip()]
            before = [rest.strip()]
    return out


def by_headings(text: str, most_chars: int = 6000) -> list[str]:
    """Sections between headings of one level; longer ones are split at paragraphs, their heading repeated.

    The level is the highest that occurs at least twice, else the highest there is.
    """
    levels = [len(m[1]) for m in re.finditer(r"(?m)^(#{1,6})[ \t]+\S", text)]
    if not levels:
        return _paragraphs(text, "", most_chars)
    level = min((x for x in set(levels) if levels.count(x) > 1), default=min(levels))
    parts = re.split(rf"(?m)^(?=#{{{level}}}[ \t]+\S)", text)
    out: list[str] = []
    for part in parts:
        if part.strip():
            head = part.split("\n", 1)[0] if re.match(r"#{1,6}[ \t]", part) else ""
            out += _paragraphs(part, head, most_chars)
    return out


def _paragraphs(text: str, head: str, most_chars: int) -> list[str]:
    if len(text) <= most_chars:
        return [text.strip()] if text.strip() else []
    out, piece = [], ""
    for part in re.split(r"\n{2,}", text):
        if piece and len(piece) + len(part) + 2 > most_chars:
            out.append(piece.strip())
            piece = f"{head}\n\n{part}" if head else part
        else:
            piece = f"{piece}\n\n{part}" if piece else part
    return out + ([piece.strip()] if piece.strip() else [])
