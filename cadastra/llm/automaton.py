"""Regular expressions compiled to minimal deterministic automata over bytes.

Supported syntax: literals, ``\\n \\t \\xHH`` and escaped punctuation, ``[...]`` classes with
ranges and negation, ``.`` (any byte but newline), groups ``(...)``, ``(?:...)`` and
``(?i:...)``, ``|`` and the quantifiers ``? * + {m} {m,} {m,n}``.
"""

from __future__ import annotations

from dataclasses import dataclass

ALL = frozenset(range(256))
_SHORT = {"n": 10, "t": 9, "r": 13, "f": 12, "v": 11}


class _Parser:
    def __init__(self, pattern: str):
        self.p, self.i, self.fold = pattern, 0, False

    def peek(self) -> str:
        return self.p[self.i] if self.i < len(self.p) else ""

    def take(self) -> str:
        self.i += 1
        return self.p[self.i - 1]

    def parse(self):
        node = self.alternatives()
        if self.i != len(self.p):
            raise ValueError(f"unexpected {self.peek()!r} at {self.i} in {self.p!r}")
        return node

    def alternatives(self):
        options = [self.sequence()]
        while self.peek() == "|":
            self.take()
            options.append(self.sequence())
        return options[0] if len(options) == 1 else ("alt", options)

    def sequence(self):
        parts = []
        while self.peek() not in ("", "|", ")"):
            parts.append(self.quantified(self.atom()))
        return ("cat", parts)

    def quantified(self, node):
        while (q := self.peek()) and q in "?*+{":
            self.take()
            if q == "{":
                end = self.p.index("}", self.i)
                low, comma, high = self.p[self.i : end].partition(",")
                self.i = end + 1
                node = ("rep", node, int(low), int(high) if high else None if comma else int(low))
            else:
                node = ("rep", node, int(q == "+"), 1 if q == "?" else None)
        return node

    def atom(self):
        c = self.take()
        if c == "(":
            before = self.fold
            if self.p.startswith("?i:", self.i):
                self.i, self.fold = self.i + 3, True
            elif self.p.startswith("?:", self.i):
                self.i += 2
            node = self.alternatives()
            if self.take() != ")":
                raise ValueError(f"unbalanced group in {self.p!r}")
            self.fold = before
            return node
        if c == "[":
            return ("set", self.bracket())
        if c == ".":
            return ("set", ALL - {10})
        return ("set", self.folded({self.escape() if c == "\\" else ord(c)}))

    def escape(self) -> int:
        c = self.take()
        if c == "x":
            self.i += 2
            return int(self.p[self.i - 2 : self.i], 16)
        return _SHORT.get(c, ord(c))

    def bracket(self) -> frozenset[int]:
        negated = self.peek() == "^"
        self.i += negated
        members: set[int] = set()
        first = True
        while first or self.peek() != "]":
            first = False
            c = self.take()
            low = self.escape() if c == "\\" else ord(c)
            if self.peek() == "-" and self.p[self.i + 1] != "]":
                self.take()
                c = self.take()
                members.update(range(low, (self.escape() if c == "\\" else ord(c)) + 1))
            else:
                members.add(low)
        self.take()
        found = self.folded(members)
        return ALL - found if negated else found

    def folded(self, members: set[int]) -> frozenset[int]:
        if self.fold:
            members = members | {b ^ 32 for b in members if chr(b).isascii() and chr(b).isalpha()}
        return frozenset(members)


def parse(pattern: str):
    return _Parser(pattern).parse()


def mirrored(node):
    """The expression that matches the reversed strings."""
    if node[0] == "cat":
        return ("cat", [mirrored(x) for x in reversed(node[1])])
    if node[0] == "alt":
        return ("alt", [mirrored(x) for x in node[1]])
    return ("rep", mirrored(node[1]), *node[2:]) if node[0] == "rep" else node


class _Nfa:
    def __init__(self):
        self.eps: list[list[int]] = []
        self.arc: list[tuple[frozenset[int], int] | None] = []

    def state(self) -> int:
        self.eps.append([])
        self.arc.append(None)
        return len(self.eps) - 1

    def add(self, node, start: int) -> int:
        """Append ``node`` after ``start`` and return the state behind it."""
        kind = node[0]
        if kind == "set":
            end = self.state()
            self.arc[(mid := self.state())] = (node[1], end)
            self.eps[start].append(mid)
            return end
        if kind == "cat":
            for part in node[1]:
                start = self.add(part, start)
            return start
        if kind == "alt":
            end = self.state()
            for option in node[1]:
                self.eps[start].append(s := self.state())
                self.eps[self.add(option, s)].append(end)
            return end
        _, inner, low, high = node
        for _ in range(low):
            start = self.add(inner, start)
        if high is None:
            loop, end = self.state(), self.state()
            self.eps[start].append(loop)
            self.eps[self.add(inner, loop)].append(loop)
            self.eps[loop].append(end)
            return end
        end = self.state()
        self.eps[start].append(end)
        for _ in range(high - low):
            start = self.add(inner, start)
            self.eps[start].append(end)
        return end

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for t in self.eps[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)


@dataclass
class Dfa:
    """A minimal automaton as transition arrays.

    ``classes`` maps each byte to its class; ``table[s + c]`` is the next state, where a state
    is its row's offset.  States from ``accepting`` on accept, ``rules[s // width]`` names which
    rules; ``dead`` is the state that nothing leaves, or -1.
    """

    classes: bytes
    width: int
    table: list[int]
    start: int
    accepting: int
    rules: list[tuple[int, ...]]
    dead: int


def compile_rules(nodes: list, *, search: bool, classes: bytes | None = None) -> Dfa:
    """Union of ``nodes`` by subset construction and partition refinement.

    With ``search`` a match may begin at any byte.  ``classes`` shares another automaton's byte
    classes, which must be at least as fine.
    """
    nfa, starts, ends = _Nfa(), [], {}
    for rule, node in enumerate(nodes):
        starts.append(s := nfa.state())
        ends[nfa.add(node, s)] = rule
    if classes is None:
        sets = list({a[0] for a in nfa.arc if a})
        seen: dict[tuple, int] = {}
        classes = bytes(seen.setdefault(tuple(b in x for x in sets), len(seen)) for b in range(256))
    width = max(classes) + 1
    sample = [classes.index(c) for c in range(width)]
    first = nfa.closure(starts)
    number, rows, todo = {first: 0}, [], [first]
    while todo:
        row = []
        here = todo.pop(0)
        for b in sample:
            after = {a[1] for s in here if (a := nfa.arc[s]) and b in a[0]}
            then = nfa.closure(after) | (first if search else frozenset())
            if then not in number:
                number[then] = len(number)
                todo.append(then)
            row.append(number[then])
        rows.append(row)
    says = [tuple(sorted(ends[s] for s in here if s in ends)) for here in number]
    labels: dict = {}
    block = [labels.setdefault(x, len(labels)) for x in says]
    while True:
        labels = {}
        finer = [labels.setdefault((block[s], *(block[t] for t in rows[s])), len(labels)) for s in range(len(rows))]
        if len(labels) == len(set(block)):
            break
        block = finer
    one = {b: s for s, b in reversed(list(enumerate(block)))}
    order = sorted(one, key=lambda b: (bool(says[one[b]]), b))
    at = {b: k for k, b in enumerate(order)}
    table = [at[block[t]] * width for b in order for t in rows[one[b]]]
    quiet = sum(not says[one[b]] for b in order)
    dead = next((at[b] * width for b in order[:quiet] if all(block[t] == b for t in rows[one[b]])), -1)
    return Dfa(classes, width, table, at[block[0]] * width, quiet * width, [says[one[b]] for b in order], dead)
