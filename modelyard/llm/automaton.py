"""Rule expressions compiled into one minimal byte automaton.

Expressions are the regular ones (literals, classes, groups, alternatives,
repetition), over ASCII; no anchors, look-arounds or back references.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as op
from re import _parser

import numpy as np

BYTES = range(256)


def _members(items, fold: bool) -> frozenset[int]:
    found: set[int] = set()
    negated = False
    for kind, value in items:
        if kind is op.NEGATE:
            negated = True
        elif kind is op.LITERAL:
            found.add(value)
        elif kind is op.RANGE:
            found.update(range(value[0], value[1] + 1))
        else:
            raise ValueError(f"{kind} is not supported in a rule")
    if fold:
        found |= {ord(x) for c in found if c < 128 for x in (chr(c).lower(), chr(c).upper())}
    return frozenset(set(BYTES) - found if negated else found)


class Nfa:
    """States with byte-set edges and empty edges, built from a parsed expression."""

    def __init__(self) -> None:
        self.edges: list[tuple[int, frozenset[int], int]] = []
        self.empty: list[tuple[int, int]] = []
        self.size = 0

    def state(self) -> int:
        self.size += 1
        return self.size - 1

    def add(self, tree, start: int, fold: bool) -> int:
        """Append ``tree`` behind ``start``; returns the state behind it."""
        for kind, value in tree:
            if kind is op.LITERAL:
                start = self._step(start, _members([(kind, value)], fold))
            elif kind is op.NOT_LITERAL:
                start = self._step(start, _members([(op.NEGATE, None), (op.LITERAL, value)], fold))
            elif kind is op.IN:
                start = self._step(start, _members(value, fold))
            elif kind is op.SUBPATTERN:
                _, more, less, inner = value
                start = self.add(inner, start, bool((fold or more & re.I) and not less & re.I))
            elif kind is op.BRANCH:
                end = self.state()
                for choice in value[1]:
                    self.empty.append((self.add(choice, start, fold), end))
                start = end
            elif kind is op.MAX_REPEAT:
                least, most, inner = value
                for _ in range(least):
                    start = self.add(inner, start, fold)
                if most is op.MAXREPEAT:
                    loop = self.state()
                    self.empty += [(start, loop), (self.add(inner, loop, fold), loop)]
                    start = loop
                else:
                    end = self.state()
                    for _ in range(most - least):
                        self.empty.append((start, end))
                        start = self.add(inner, start, fold)
                    self.empty.append((start, end))
                    start = end
            else:
                raise ValueError(f"{kind} is not supported in a rule")
        return start

    def _step(self, start: int, members: frozenset[int]) -> int:
        end = self.state()
        self.edges.append((start, members, end))
        return end


@dataclass(frozen=True)
class Dfa:
    """``moves[state * classes + byte class]`` is the next state times ``classes``; state 0 is the
    start. From ``accepting`` on, states accept; ``marks`` has the bit set of rules of each state.
    ``dead`` is the state (times ``classes``) that nothing leaves, or -1."""

    kinds: bytes
    classes: int
    moves: list[int]
    accepting: int
    marks: list[int]
    dead: int


def _determinise(nfa: Nfa, starts: list[int], ends: dict[int, int]) -> Dfa:
    """Subset construction, then minimisation by refining the split into accept sets."""
    follow: list[list[int]] = [[] for _ in range(nfa.size)]
    for a, b in nfa.empty:
        follow[a].append(b)

    def closed(states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for nxt in follow[todo.pop()]:
                if nxt not in seen:
                    seen.add(nxt)
                    todo.append(nxt)
        return frozenset(seen)

    sets = sorted({members for _, members, _ in nfa.edges}, key=sorted)
    signature = [tuple(b in s for s in sets) for b in BYTES]
    numbers = {x: i for i, x in enumerate(dict.fromkeys(signature))}
    kinds = bytes(numbers[x] for x in signature)
    example = [kinds.index(i) for i in range(len(numbers))]
    leaving: list[list[tuple[frozenset[int], int]]] = [[] for _ in range(nfa.size)]
    for a, members, b in nfa.edges:
        leaving[a].append((members, b))

    first = closed(starts)
    index, queue, moves = {first: 0}, [first], []
    for states in queue:
        out = [(members, b) for a in states for members, b in leaving[a]]
        row = []
        for byte in example:
            target = closed([b for members, b in out if byte in members])
            if target not in index:
                index[target] = len(queue)
                queue.append(target)
            row.append(index[target])
        moves.append(row)
    grid = np.array(moves, dtype=np.int64)
    marks = np.array([sum({1 << ends[s] for s in states if s in ends}) for states in queue], dtype=np.int64)

    block = np.unique(marks, return_inverse=True)[1].reshape(-1)
    while True:
        wide = np.column_stack([block, block[grid]])
        finer = np.unique(wide, axis=0, return_inverse=True)[1].reshape(-1)
        if finer.max() == block.max():
            break
        block = finer
    count = block.max() + 1
    example_state = np.full(count, -1)
    example_state[block[::-1]] = np.arange(len(block))[::-1]
    # The start comes first, accepting states last.
    place = sorted(range(count), key=lambda b: (marks[example_state[b]] > 0, b != block[0]))
    if marks[0]:
        raise ValueError("a rule matches the empty text")
    new = np.empty(count, dtype=np.int64)
    new[place] = np.arange(count)
    states = example_state[place]
    small = new[block[grid[states]]]
    out_marks = marks[states]
    dead = [s for s in range(count) if not out_marks[s] and (small[s] == s).all()]
    classes = len(numbers)
    return Dfa(
        kinds,
        classes,
        (small * classes).reshape(-1).tolist(),
        int((out_marks == 0).sum()) * classes,
        out_marks.tolist(),
        dead[0] * classes if dead else -1,
    )


def compile_search(rules: list[str]) -> Dfa:
    """One automaton that, read from the start of a text, accepts where a match of any rule ends."""
    nfa, ends = Nfa(), {}
    start = nfa.state()
    nfa.edges.append((start, frozenset(BYTES), start))
    for i, rule in enumerate(rules):
        begin = nfa.state()
        nfa.empty.append((start, begin))
        ends[nfa.add(_parser.parse(rule), begin, False)] = i
    return _determinise(nfa, [start], ends)


def compile_anchored(rule: str, backwards: bool = False) -> Dfa:
    """Automaton of one rule from its first byte, or from its last byte backwards."""
    nfa = Nfa()
    begin = nfa.state()
    end = nfa.add(_parser.parse(rule), begin, False)
    if backwards:
        nfa.edges = [(b, members, a) for a, members, b in nfa.edges]
        nfa.empty = [(b, a) for a, b in nfa.empty]
        begin, end = end, begin
    return _determinise(nfa, [begin], {end: 0})


def furthest(dfa: Dfa, data: bytes, at: int, stop: int) -> int:
    """Position of the longest match from ``at`` towards ``stop``, or -1; backwards if stop < at."""
    state, best, step = 0, -1, 1 if stop >= at else -1
    kinds, moves = dfa.kinds, dfa.moves
    while at != stop:
        state = moves[state + kinds[data[at if step > 0 else at - 1]]]
        if state == dfa.dead:
            break
        at += step
        if state >= dfa.accepting:
            best = at
    return best


def scanner(rules: list[str]):
    """Function from bytes to (rule, start, end), leftmost and longest, not overlapping within a rule.

    One pass of the combined automaton finds where matches begin to end. Each
    such place is carried back to its leftmost start and on to its furthest end
    by the rule's own automata; the text behind a match is searched afresh.
    """
    search = compile_search(rules)
    ahead = [compile_anchored(rule) for rule in rules]
    back = [compile_anchored(rule, backwards=True) for rule in rules]
    kinds, moves, accepting, marks, classes = search.kinds, search.moves, search.accepting, search.marks, search.classes
    each = range(len(rules))

    def scan(data: bytes) -> list[tuple[int, int, int]]:
        found: list[tuple[int, int, int]] = []
        done = [0] * len(rules)
        state = 0
        for at, kind in enumerate(data.translate(kinds), 1):
            state = moves[state + kind]
            if state >= accepting:
                mark = marks[state // classes]
                for rule in each:
                    if mark >> rule & 1 and at > done[rule]:
                        start = furthest(back[rule], data, at, done[rule])
                        if start >= 0:
                            done[rule] = furthest(ahead[rule], data, start, len(data))
                            found.append((rule, start, done[rule]))
        return found

    scan.states = len(marks)
    return scan
