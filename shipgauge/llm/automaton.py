"""Byte automata built from rule expressions.

An expression is a nested tuple: ("set", bytes), ("seq", a, b, ...),
("alt", a, b, ...), ("star", a), ("plus", a), ("opt", a). ``compile_rules``
turns several into one automaton by subset construction and minimisation.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def chars(text: str) -> tuple:
    return ("set", bytes(sorted(set(text.encode()))))


def literal(text: str, any_case: bool = False) -> tuple:
    return ("seq", *(("set", bytes({b, ord(chr(b).swapcase())} if any_case and chr(b).isalpha() else {b}))
                     for b in text.encode()))


def seq(*parts) -> tuple:
    return ("seq", *parts)


def alt(*parts) -> tuple:
    return ("alt", *parts)


def star(part) -> tuple:
    return ("star", part)


def plus(part) -> tuple:
    return ("seq", part, ("star", part))


def opt(part) -> tuple:
    return ("alt", part, ("seq",))


def at_least(n: int, part) -> tuple:
    return ("seq", *[part] * n, ("star", part))


def mirrored(rule: tuple) -> tuple:
    """The expression of all words of ``rule`` read backwards."""
    if rule[0] == "set":
        return rule
    parts = [mirrored(p) for p in rule[1:]]
    return (rule[0], *(reversed(parts) if rule[0] == "seq" else parts))


@dataclass(frozen=True)
class Automaton:
    """Deterministic automaton over byte classes.

    ``next`` is flat: state numbers are multiples of ``width``, so a step is
    ``next[state + byte_class]``. Accepting states are numbered last, from
    ``accept_from``; ``rules[state]`` lists the rules that end in one of them.
    State ``dead`` (-1 if none) can never accept again.
    """

    classes: bytes
    width: int
    next: tuple
    start: int
    accept_from: int
    rules: dict
    dead: int


class _Fragments:
    """Non-deterministic automaton under construction."""

    def __init__(self):
        self.empty: list[list[int]] = []
        self.move: list[tuple[bytes, int] | None] = []

    def state(self) -> int:
        self.empty.append([])
        self.move.append(None)
        return len(self.empty) - 1

    def add(self, rule: tuple) -> tuple[int, int]:
        first, last = self.state(), self.state()
        if rule[0] == "set":
            self.move[first] = (rule[1], last)
        elif rule[0] == "seq":
            at = first
            for part in rule[1:]:
                a, b = self.add(part)
                self.empty[at].append(a)
                at = b
            self.empty[at].append(last)
        elif rule[0] == "alt":
            for part in rule[1:]:
                a, b = self.add(part)
                self.empty[first].append(a)
                self.empty[b].append(last)
        else:  # star
            a, b = self.add(rule[1])
            self.empty[first] += [a, last]
            self.empty[b] += [a, last]
        return first, last

    def closure(self, states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for x in self.empty[todo.pop()]:
                if x not in seen:
                    seen.add(x)
                    todo.append(x)
        return frozenset(seen)


def compile_rules(rules: dict[str, tuple], anywhere: bool) -> Automaton:
    """One minimal automaton for all ``rules``; ``anywhere``: a match may begin at any byte."""
    nfa = _Fragments()
    begin = nfa.state()
    ends = {}
    for name, rule in rules.items():
        first, last = nfa.add(rule)
        nfa.empty[begin].append(first)
        ends[last] = name
    sets = sorted({move[0] for move in nfa.move if move})
    kinds: dict[tuple, int] = {}
    classes = bytes(kinds.setdefault(tuple(b in s for s in sets), len(kinds)) for b in range(256))
    width = len(kinds)
    sample = [classes.index(c) for c in range(width)]
    closures = {m[1]: nfa.closure([m[1]]) for m in nfa.move if m}
    always = nfa.closure([begin]) if anywhere else frozenset()

    # subset construction, on the states that read a byte or end a rule
    useful = {i for i, m in enumerate(nfa.move) if m} | set(ends)
    start = nfa.closure([begin]) & useful
    numbers, todo, table = {start: 0}, [start], []
    while todo:
        row, now = [], todo.pop(0)
        for b in sample:
            to = set(always)
            for i in now:
                m = nfa.move[i]
                if m and b in m[0]:
                    to |= closures[m[1]]
            key = frozenset(to & useful)
            if key not in numbers:
                numbers[key] = len(numbers)
                todo.append(key)
            row.append(numbers[key])
        table.append(row)
    moves = np.array(table, np.int64).reshape(-1, width)
    found = [tuple(sorted(ends[i] for i in key if i in ends)) for key in numbers]

    # minimisation: refine the partition by what each state accepts until stable
    labels = {x: i for i, x in enumerate(sorted(set(found)))}
    part = np.array([labels[x] for x in found])
    while True:
        _, finer = np.unique(np.column_stack([part, part[moves]]), axis=0, return_inverse=True)
        if finer.max() == part.max():
            break
        part = finer.reshape(-1)
    part = part.reshape(-1)
    of = {int(p): i for i, p in reversed(list(enumerate(part)))}  # a member of each class
    order = sorted(of, key=lambda p: bool(found[of[p]]))
    rank = {p: i for i, p in enumerate(order)}
    flat = [rank[int(part[moves[of[p], c]])] * width for p in order for c in range(width)]
    dead = next((rank[p] * width for p in order if not found[of[p]] and all(part[moves[of[p]]] == p)), -1)
    return Automaton(classes, width, tuple(flat), rank[int(part[0])] * width,
                     sum(not found[of[p]] for p in order) * width,
                     {rank[p] * width: found[of[p]] for p in order if found[of[p]]}, dead)


def ends_of(machine: Automaton, data: bytes) -> list[tuple[int, int]]:
    """One pass over ``data``: (index of the last byte, state) of every accepting step."""
    table, accept, state = machine.next, machine.accept_from, machine.start
    hits = []
    for i, c in enumerate(data.translate(machine.classes)):
        state = table[state + c]
        if state >= accept:
            hits.append((i, state))
    return hits


def longest(machine: Automaton, data: bytes, at: int, end: int, step: int) -> int | None:
    """Where the longest word read from ``at`` towards ``end`` stops (exclusive; None if there is none)."""
    table, classes, state, best = machine.next, machine.classes, machine.start, None
    while at != end:
        state = table[state + classes[data[at]]]
        at += step
        if state >= machine.accept_from:
            best = at
        elif state == machine.dead:
            break
    return best
