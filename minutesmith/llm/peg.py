"""A small parsing-expression grammar: ordered choice, greedy repetition, predicates, memoised rules, trees.

A grammar maps rule names to expressions; an expression is a regular expression (a terminal, compiled), a rule name in
angle brackets, or a tuple whose head says how its parts combine:
("seq", a, b, ...), ("or", a, b, ...), ("many", a), ("some", a), ("maybe", a), ("not", a), ("and", a), ("test", name).
A test is a function (text, position) -> end position or -1, given to the parser by name: a semantic predicate.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cache


@dataclass
class Tree:
    rule: str
    start: int
    end: int
    children: list[Tree] = field(default_factory=list)

    def find(self, rule: str) -> Tree | None:
        return next((c for c in self.children if c.rule == rule), None)


@cache
def _terminal(pattern: str) -> re.Pattern[str]:
    return re.compile(pattern)


class Parser:
    """One text under one grammar. Every rule is tried at most once at each position."""

    def __init__(self, grammar: dict[str, object], text: str, tests: dict[str, Callable[[str, int], int]] | None = None) -> None:
        self.grammar, self.text, self.tests = grammar, text, tests or {}
        self.memo: dict[tuple[str, int], Tree | None] = {}

    def rule(self, name: str, at: int) -> Tree | None:
        key = (name, at)
        if key not in self.memo:
            self.memo[key] = None  # left recursion fails
            out: list[Tree] = []
            end = self._match(self.grammar[name], at, out)
            self.memo[key] = Tree(name, at, end, out) if end >= 0 else None
        return self.memo[key]

    def _match(self, e: object, at: int, out: list[Tree]) -> int:
        if isinstance(e, str):
            if e.startswith("<") and e.endswith(">"):
                tree = self.rule(e[1:-1], at)
                if tree is None:
                    return -1
                out.append(tree)
                return tree.end
            m = _terminal(e).match(self.text, at)
            return m.end() if m else -1
        head, *parts = e  # type: ignore[misc]
        if head == "seq":
            for p in parts:
                at = self._match(p, at, out)
                if at < 0:
                    return -1
            return at
        if head == "or":
            for p in parts:
                own: list[Tree] = []
                end = self._match(p, at, own)
                if end >= 0:
                    out += own
                    return end
            return -1
        if head in ("many", "some", "maybe"):
            n = 0
            while True:
                own = []
                end = self._match(parts[0], at, own)
                if end < 0 or (end == at and n):
                    break
                out += own
                n += 1
                stop = end == at or head == "maybe"
                at = end
                if stop:
                    break
            return -1 if head == "some" and not n else at
        if head == "not":
            return at if self._match(parts[0], at, []) < 0 else -1
        if head == "and":
            return at if self._match(parts[0], at, []) >= 0 else -1
        if head == "test":
            return self.tests[parts[0]](self.text, at)
        raise ValueError(f"unknown expression {head!r}")

    def parse(self, start: str) -> Tree:
        """The tree of the whole text; raises ValueError where the grammar ends before it."""
        tree = self.rule(start, 0)
        if tree is None or tree.end != len(self.text):
            raise ValueError(f"text does not match {start} after character {tree.end if tree else 0}")
        return tree
