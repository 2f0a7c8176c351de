"""Secret scans by one combined deterministic automaton.

All rules are compiled together: each rule's expression, read backwards, becomes a nondeterministic automaton over bytes;
subset construction and minimisation turn their union into one table of transitions. One pass over a text, from its last
byte to its first, then gives for every rule all places at which a match starts. From those, matches are taken leftmost
first and without overlap: the rule's own forward automaton gives the end. Both are linear in the text.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A match is ``head`` then ``body``, both as long as they can be; it counts if the body has ``least`` bytes or more.

    A match that does not count still uses up its text. Expressions know characters, escapes, classes, groups,
    alternatives, ``? * +`` and ``{n}``, over ASCII. ``fold`` makes letters of the head match in either case.
    """

    kind: str
    head: str
    body: str
    least: int
    fold: bool = False


#: The base rules, then rules for further kinds of credentials.
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", "[A-Za-z0-9+/_.=-]+", 12, True),
    Rule("access", "", "AKIA[A-Z0-9]+", 18),
    # A match is a whole run of the class, so asking for 16 in the expression finds what counting afterwards would.
    Rule("hex", "", "[0-9a-f]{16}[0-9a-f]*", 16),
)
MORE_RULES = (
    Rule("pem", "", "-----BEGIN ([A-Z]+ )*PRIVATE KEY-----", 1),
    Rule("hub", "gh[pousr]_", "[A-Za-z0-9]+", 36),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.", "[A-Za-z0-9_-]+", 16),
)
RULES = BASE_RULES + MORE_RULES


class Nfa:
    """States with byte-set arcs and empty arcs, grown from expressions."""

    def __init__(self) -> None:
        self.arcs: list[list[tuple[frozenset[int], int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.arcs.append([])
        self.free.append([])
        return len(self.arcs) - 1

    def add(self, tree: tuple, begin: int) -> int:
        """Attach ``tree`` behind ``begin``; the state in which it ends."""
        kind = tree[0]
        if kind == "set":
            end = self.state()
            self.arcs[begin].append((tree[1], end))
            return end
        if kind == "seq":
            for part in tree[1]:
                begin = self.add(part, begin)
            return begin
        end = self.state()
        if kind == "any":
            for part in tree[1]:
                self.free[self.add(part, begin)].append(end)
        else:  # ("repeat", part, may be absent, may go on)
            enter = self.state()
            self.free[begin].append(enter)
            leave = self.add(tree[1], enter)
            self.free[leave].append(end)
            if tree[2]:
                self.free[begin].append(end)
            if tree[3]:
                self.free[leave].append(enter)
        return end


def syntax(expression: str, fold: bool) -> tuple:
    """Syntax tree of an expression."""
    at = 0

    def byte_set(chars: set[int]) -> tuple:
        if fold:
            chars = chars | {ord(chr(c).swapcase()) for c in chars if chr(c).isalpha()}
        return "set", frozenset(chars)

    def char() -> int:
        nonlocal at
        c = expression[at]
        at += 1
        if c != "\\":
            return ord(c)
        c = expression[at]
        at += 1
        if c == "x":
            at += 2
            return int(expression[at - 2 : at], 16)
        return ord(c)

    def atom() -> tuple:
        nonlocal at
        if expression[at] == "(":
            at += 1
            inner = alternatives()
            at += 1
            return inner
        if expression[at] == "[":
            at += 1
            chars: set[int] = set()
            while expression[at] != "]":
                low = char()
                if expression[at] == "-" and expression[at + 1] != "]":
                    at += 1
                    chars |= set(range(low, char() + 1))
                else:
                    chars.add(low)
            at += 1
            return byte_set(chars)
        return byte_set({char()})

    def sequence() -> tuple:
        nonlocal at
        parts = []
        while at < len(expression) and expression[at] not in "|)":
            part = atom()
            follows = expression[at : at + 1]
            if follows in ("?", "*", "+") and follows:
                at += 1
                part = "repeat", part, follows != "+", follows != "?"
            elif follows == "{":
                close = expression.index("}", at)
                part = "seq", [part] * int(expression[at + 1 : close])
                at = close + 1
            parts.append(part)
        return "seq", parts

    def alternatives() -> tuple:
        nonlocal at
        parts = [sequence()]
        while at < len(expression) and expression[at] == "|":
            at += 1
            parts.append(sequence())
        return ("any", parts) if len(parts) > 1 else parts[0]

    return alternatives()


def backwards(tree: tuple) -> tuple:
    if tree[0] == "set":
        return tree
    if tree[0] == "repeat":
        return "repeat", backwards(tree[1]), tree[2], tree[3]
    parts = [backwards(t) for t in tree[1]]
    return (tree[0], parts[::-1]) if tree[0] == "seq" else (tree[0], parts)


@dataclass(frozen=True)
class Dfa:
    """``step[state * width + classes[byte]]`` is the next state; ``marks[state]`` has a bit for each accepting rule.

    States are ordered so that those without a mark come first; ``plain`` is their number. ``dead`` is the state that
    never accepts again, or -1.
    """

    classes: bytes
    width: int
    step: list[int]
    marks: list[int]
    plain: int
    start: int
    dead: int


def compile_rules(trees: list[tuple], search: bool) -> Dfa:
    """Subset construction over the union of ``trees``, then minimisation. ``search``: a match may begin at any byte."""
    nfa = Nfa()
    root = nfa.state()
    accepts: dict[int, int] = {}
    for i, tree in enumerate(trees):
        begin = nfa.state()
        nfa.free[root].append(begin)
        end = nfa.add(tree, begin)
        accepts[end] = accepts.get(end, 0) | 1 << i

    # Bytes that no arc tells apart form one class.
    sets = sorted({s for arcs in nfa.arcs for s, _ in arcs}, key=sorted)
    looks: dict[tuple[bool, ...], int] = {}
    classes = bytes(looks.setdefault(tuple(b in s for s in sets), len(looks)) for b in range(256))
    width = len(looks)
    sample = [classes.index(c) for c in range(width)]

    def closure(states: set[int]) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for s in nfa.free[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)

    first = closure({root})
    number, order, table = {first: 0}, [first], []
    for states in order:  # grows while it is read
        row = []
        arcs = [a for s in states for a in nfa.arcs[s]]
        for byte in sample:
            reached = {end for chars, end in arcs if byte in chars}
            following = closure(reached | {root} if search else reached)
            if following not in number:
                number[following] = len(order)
                order.append(following)
            row.append(number[following])
        table.append(row)
    marks = [functools.reduce(lambda m, s: m | accepts.get(s, 0), states, 0) for states in order]

    # Partition refinement: states stay together while their marks and their successors' parts agree.
    part = marks
    count = len(set(part))
    while True:
        signatures: dict[tuple, int] = {}
        refined = [signatures.setdefault((part[s], *(part[t] for t in table[s])), len(signatures)) for s in range(len(table))]
        part = refined
        if len(signatures) == count:
            break
        count = len(signatures)
    chosen = {part[s]: s for s in reversed(range(len(table)))}
    ranked = sorted(chosen, key=lambda p: (marks[chosen[p]] != 0, p))
    new = {p: i for i, p in enumerate(ranked)}
    step = [new[part[t]] for p in ranked for t in table[chosen[p]]]
    final = [marks[chosen[p]] for p in ranked]
    loops = [i for i in range(len(ranked)) if not final[i] and set(step[i * width : (i + 1) * width]) == {i}]
    return Dfa(classes, width, step, final, final.count(0), new[part[0]], loops[0] if loops else -1)


class Scanner:
    """All rules in one table for the backward pass, and a forward table per rule and rule head."""

    def __init__(self, rules: tuple[Rule, ...] = RULES) -> None:
        self.rules = rules
        trees = [("seq", [syntax(r.head, r.fold), syntax(r.body, False)]) for r in rules]
        self.starts = compile_rules([backwards(t) for t in trees], search=True)
        self.ends = [compile_rules([t], search=False) for t in trees]
        self.heads = [compile_rules([syntax(r.head, r.fold)], search=False) if r.head else None for r in rules]
        d = self.starts
        # States as row offsets: one addition and one lookup per byte.
        self._step = [s * d.width for s in d.step]
        self._accepting = d.plain * d.width

    def start_places(self, data: bytes) -> list[tuple[int, int]]:
        """(place, rules as bits) of every match start, last first."""
        step, accepting, state = self._step, self._accepting, self.starts.start * self.starts.width
        hits, at = [], len(data)
        for c in reversed(data.translate(self.starts.classes)):
            state = step[state + c]
            at -= 1
            if state >= accepting:
                hits.append((at, state))
        return [(p, self.starts.marks[s // self.starts.width]) for p, s in hits]

    @staticmethod
    def longest(dfa: Dfa, data: bytes, begin: int, stop: int | None = None) -> int:
        """End of the longest match that begins at ``begin``, or -1."""
        state, best = dfa.start, begin if dfa.marks[dfa.start] else -1
        for at in range(begin, len(data) if stop is None else stop):
            state = dfa.step[state * dfa.width + dfa.classes[data[at]]]
            if state == dfa.dead:
                break
            if dfa.marks[state]:
                best = at + 1
        return best

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, rule number, end) of all matches that count, in bytes, by start and then rule."""
        hits = self.start_places(data)
        if not hits:
            return []
        out, free = [], [0] * len(self.rules)
        for begin, bits in reversed(hits):
            for r, rule in enumerate(self.rules):
                if bits >> r & 1 and begin >= free[r]:
                    end = self.longest(self.ends[r], data, begin)
                    body = self.longest(self.heads[r], data, begin, end) if rule.head else begin
                    free[r] = end
                    if end - body >= rule.least:
                        out.append((begin, r, end))
        return out

    def text_spans(self, text: str) -> list[tuple[str, int, int]]:
        """(kind, start, end) in code points, by start and then in the order of the rules."""
        data = text.encode()
        found = self.spans(data)
        if len(data) != len(text) and found:
            places = sorted({p for s, _, e in found for p in (s, e)})
            points, before, n = {}, 0, 0
            for p in places:
                n += len(data[before:p].decode())
                points[p], before = n, p
            found = [(points[s], r, points[e]) for s, r, e in found]
        return [(self.rules[r].kind, s, e) for s, r, e in found]


@functools.lru_cache(maxsize=4)
def scanner(rules: tuple[Rule, ...] = RULES) -> Scanner:
    """The compiled rules; each worker compiles them once."""
    return Scanner(rules)


SPANS = "array<struct<kind string, start long, end long>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def scan_secrets(df: DataFrame, id_col: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, spans): all secrets of every whole text, as (kind, start, end) in code points, end exclusive.

    Null and empty texts have an empty list; null ids and repeated rows stay; other columns are left out.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = scanner(rules).text_spans
        for batch in batches:
            found = [[{"kind": k, "start": s, "end": e} for k, s, e in find(t or "")] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, _SPANS)], ["doc_id", "spans"])

    narrow = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return narrow.mapInArrow(run, f"doc_id long, spans {SPANS}")


def redact_secrets(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``df`` with every secret in ``text`` replaced by ``<KIND>``; overlapping spans become one, named by the first.

    All rows and columns stay, texts without a secret unchanged, nulls null.
    """
    @F.arrow_udf("string")
    def clean(texts: pa.Array) -> pa.Array:
        find = scanner(rules).text_spans
        # Stretches of texts without a secret are passed on as they are; one text at a time is a Python string.
        out, done = [pa.array([], texts.type)], 0
        for i in range(len(texts)):
            value = texts[i].as_py()
            found = find(value) if value else []
            if found:
                out += [texts.slice(done, i - done), pa.array([_without(value, found)], texts.type)]
                done = i + 1
        return pa.concat_arrays([*out, texts.slice(done)])

    return df.withColumn(text, clean(F.col(text).cast("string")))


def _without(value: str, found: list[tuple[str, int, int]]) -> str:
    parts, done, shown = [], 0, -1
    for kind, start, end in found:
        if start >= shown:
            parts += [value[done:start], f"<{kind.upper()}>"]
        done = shown = max(shown, end)
    return "".join([*parts, value[done:]])
