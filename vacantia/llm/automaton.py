"""One deterministic automaton for many regular expressions, as a transition array.

The expressions are byte patterns of a small language: literals, classes, groups,
alternatives and the repeats ``? * + {n} {n,}``. They become one nondeterministic
automaton that may start anywhere; subset construction over classes of bytes makes it
deterministic, partition refinement makes it minimal. Once any expression has matched the
automaton stays in its accepting state until a *dead* byte.

A dead byte leads every state back to the start: no match contains one, so the texts
fall into independent pieces between dead bytes, and many pieces are scanned side by side,
one byte of each a step.
"""

import re
import re._constants as C
import re._parser as parser

import numpy as np

_START = 0


class _Nfa:
    def __init__(self):
        self.step: list[list[tuple[np.ndarray, int]]] = [[]]
        self.empty: list[list[int]] = [[]]

    def state(self) -> int:
        self.step.append([])
        self.empty.append([])
        return len(self.step) - 1

    def add(self, tree, at: int, fold: bool) -> int:
        """Adds a parsed pattern from state ``at``; returns the state behind it."""
        for op, arg in tree:
            at = self._add(op, arg, at, fold)
        return at

    def _add(self, op, arg, at: int, fold: bool) -> int:
        if op in (C.LITERAL, C.IN):
            end = self.state()
            self.step[at].append((_bytes(op, arg, fold), end))
            return end
        if op is C.SUBPATTERN:
            _, on, _, inner = arg
            return self.add(inner, at, fold or bool(on & re.IGNORECASE))
        if op is C.BRANCH:
            end = self.state()
            for way in arg[1]:
                self.empty[self.add(way, at, fold)].append(end)
            return end
        if op is C.MAX_REPEAT:
            low, high, inner = arg
            for _ in range(low):
                at = self.add(inner, at, fold)
            if high is C.MAXREPEAT:
                loop, end = self.state(), self.state()
                self.empty[at].append(loop)
                self.empty[loop].append(end)
                self.empty[self.add(inner, loop, fold)].append(loop)
                return end
            for _ in range(high - low):
                end = self.state()
                self.empty[at].append(end)
                self.empty[self.add(inner, at, fold)].append(end)
                at = end
            return at
        raise ValueError(f"not in the language of the rules: {op}")

    def closure(self, states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for s in self.empty[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)


def _bytes(op, arg, fold: bool) -> np.ndarray:
    out = np.zeros(256, bool)
    negate = False
    for kind, value in [(op, arg)] if op is C.LITERAL else arg:
        if kind is C.LITERAL:
            out[value] = True
        elif kind is C.RANGE:
            out[value[0] : value[1] + 1] = True
        elif kind is C.NEGATE:
            negate = True
        else:
            raise ValueError(f"not in the language of the rules: {kind}")
    if fold:
        upper, lower = out[0x41:0x5B].copy(), out[0x61:0x7B].copy()
        out[0x41:0x5B] |= lower
        out[0x61:0x7B] |= upper
    return ~out if negate else out


class Automaton:
    """``next[state * 256 + byte]``; state 0 is the start, ``accept`` the accepting one."""

    def __init__(self, patterns: list[bytes]):
        nfa = _Nfa()
        final = nfa.state()
        for p in patterns:
            nfa.empty[nfa.add(parser.parse(p), _START, False)].append(final)
        table, accept = _subsets(nfa, final)
        self.built = len(table)
        self.table, self.accept = _minimise(table, accept)
        self.states = len(self.table)
        rows = np.delete(self.table, self.accept, axis=0)
        self.dead = (rows == _START).all(axis=0)
        self.next = self.table.astype(np.uint16 if self.states < 1 << 16 else np.uint32).ravel()

    def pieces_with_match(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of every piece of the texts that holds a match of any rule."""
        edge = np.empty(len(buf) + 1, bool)
        alive = ~self.dead[buf]
        edge[0] = edge[-1] = True
        edge[1:-1] = alive[1:] != alive[:-1]
        edge[offsets] = True
        cut = np.flatnonzero(edge)
        use = alive[cut[:-1]] if len(buf) else np.zeros(0, bool)
        start, end = cut[:-1][use], cut[1:][use]
        if not len(start):
            return start, end
        # Longest first, so the pieces still running are always the first ones.
        order = np.argsort(start - end, kind="stable")
        at, size = start[order], (end - start)[order]
        state = np.zeros(len(order), self.next.dtype)
        running = np.searchsorted(-size, -np.arange(size[0]), "left")
        wide = np.zeros(len(order), np.int64)
        for i, n in enumerate(running.tolist()):
            where = wide[:n]
            np.multiply(state[:n], 256, out=where, dtype=np.int64)
            where += buf[at[:n] + i]
            self.next.take(where, out=state[:n])
        hit = np.sort(order[state == self.accept])
        return start[hit], end[hit]


def _subsets(nfa: _Nfa, final: int) -> tuple[np.ndarray, int]:
    """Subset construction. All subsets with the final state are one state."""
    sets = [m for steps in nfa.step for m, _ in steps]
    # Bytes that no rule tells apart form one class.
    _, first, byte_class = np.unique(np.stack(sets), axis=1, return_index=True, return_inverse=True)
    moves = [
        [[t for m, t in steps if m[b]] for b in first.tolist()] for steps in nfa.step
    ]
    begin = nfa.closure([_START])
    number, todo, rows = {begin: _START}, [begin], {}
    accept = 1
    known: dict[frozenset, frozenset] = {}
    count = 2
    while todo:
        subset = todo.pop()
        row = []
        for c in range(len(first)):
            to = frozenset(t for s in subset for t in moves[s][c])
            if to not in known:
                known[to] = nfa.closure(to) | begin
            to = known[to]
            if final in to:
                row.append(accept)
                continue
            if to not in number:
                number[to] = count
                count += 1
                todo.append(to)
            row.append(number[to])
        rows[number[subset]] = row
    rows[accept] = [accept] * len(first)
    table = np.array([rows[i] for i in range(count)])
    return table[:, byte_class.ravel()], accept


def _minimise(table: np.ndarray, accept: int) -> tuple[np.ndarray, int]:
    """Merges states that no input tells apart, by refining the partition until it stands."""
    group = np.zeros(len(table), np.int64)
    group[accept] = 1
    n = 2
    distinct = np.unique(table, axis=1)
    while True:
        _, rep, new = np.unique(
            np.column_stack([group, group[distinct]]), axis=0, return_index=True, return_inverse=True
        )
        new = new.ravel()
        if len(rep) == n:
            break
        group, n = new, len(rep)
    # Number the states so that the start stays 0.
    order = np.argsort(np.where(rep == rep[new[_START]], -1, rep))
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    state = rank[new]
    out = np.empty((n, 256), np.int64)
    out[state[rep]] = state[table[rep]]
    return out, int(state[accept])
