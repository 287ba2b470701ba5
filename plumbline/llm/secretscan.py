"""Secret scan with one deterministic automaton for all rules.

Rule regexes (ASCII: literals, classes, groups, alternatives, ? * + {m} {m,}) are parsed into one
nondeterministic automaton, made deterministic by subset construction over byte classes and minimised into
one transition array. Every text is read once, byte by byte, for all rules together; the accepting states
met on the way say which rules may have a match in it (long counted repeats are shortened there, which
only ever adds texts). Only such texts (a few in a hundred) are read again, for
those rules alone: backwards by the reversed rule, which accepts wherever a match starts, and then from
the first start on by the rule itself for the longest end. Leftmost longest matches that do not overlap
follow, in linear time.

Defined cases: a null or empty text has no span; null ids and repeated rows give one row each; an empty table
gives no rows; other columns are ignored. Offsets count code points, ends are exclusive.
"""

from __future__ import annotations

import functools
import hashlib
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from plumbline.llm.common import table, text_bytes


class Rule(NamedTuple):
    kind: str
    regex: str
    head: str = ""  # the match without its value; a match whose value is shorter than ``least`` counts as found
    least: int = 0  # but is dropped
    base: bool = True
    any_case: bool = False
    counted: int = 1  # how far the combined automaton counts repeats; more multiplies its states


# The kinds of the contract, in its order.
_NAMED = "(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
BASE_RULES = [
    Rule("assign", _NAMED + "[A-Za-z0-9+/_.=-]+", head=_NAMED, least=8, any_case=True),
    Rule("access", "AKIA[A-Z0-9]{12,}"),
    Rule("hex", "[0-9a-f]{32,}", counted=12),
]
# Further kinds, by the public formats of their issuers.
MORE_RULES = [
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}", base=False),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}", base=False),
    Rule("google", "AIza[A-Za-z0-9_-]{20,}", base=False),
    Rule("stripe", "[rs]k_live_[A-Za-z0-9]{16,}", base=False),
    Rule("pem", "-----BEGIN ([A-Z0-9]+ )*PRIVATE KEY-----", base=False),
]
RULES = BASE_RULES + MORE_RULES


# ---------------------------------------------------------------- regexes to automata

# A parsed regex: ("set", frozenset of bytes), ("cat", parts), ("alt", parts), ("rep", part, least, most or None).


def parse(regex: str, any_case: bool = False):
    at = 0

    def alternatives():
        nonlocal at
        parts = [sequence()]
        while at < len(regex) and regex[at] == "|":
            at += 1
            parts.append(sequence())
        return parts[0] if len(parts) == 1 else ("alt", parts)

    def sequence():
        parts = []
        while at < len(regex) and regex[at] not in "|)":
            parts.append(repeated(atom()))
        return ("cat", parts)

    def repeated(part):
        nonlocal at
        while at < len(regex) and regex[at] in "?*+{":
            if regex[at] == "{":
                end = regex.index("}", at)
                low, comma, high = regex[at + 1 : end].partition(",")
                part = ("rep", part, int(low), int(high) if high else None if comma else int(low))
                at = end + 1
            else:
                part = ("rep", part, *{"?": (0, 1), "*": (0, None), "+": (1, None)}[regex[at]])
                at += 1
        return part

    def atom():
        nonlocal at
        at += 1
        if regex[at - 1] == "(":
            inner = alternatives()
            at += 1
            return inner
        if regex[at - 1] == "[":
            end = regex.index("]", at + 1)
            found, text = set(), regex[at:end]
            at = end + 1
            while text:
                if len(text) > 2 and text[1] == "-":
                    found.update(range(ord(text[0]), ord(text[2]) + 1))
                    text = text[3:]
                else:
                    found.add(ord(text[0]))
                    text = text[1:]
        else:
            found = {ord(regex[at - 1])}
        if any_case:
            found |= {ord(x) for b in found for x in (chr(b).lower(), chr(b).upper())}
        return ("set", frozenset(found))

    return alternatives()


class _Nfa:
    """States with byte edges and empty edges; ``accepts`` names the rule of a final state."""

    def __init__(self):
        self.edges: list[list[tuple[frozenset, int]]] = []
        self.empty: list[list[int]] = []
        self.accepts: dict[int, int] = {}

    def state(self) -> int:
        self.edges.append([])
        self.empty.append([])
        return len(self.edges) - 1

    def add(self, node, start: int, backwards: bool) -> int:
        """Let the regex lead on from a state; returns the state behind it."""
        kind = node[0]
        if kind == "set":
            end = self.state()
            self.edges[start].append((node[1], end))
            return end
        if kind == "cat":
            for part in reversed(node[1]) if backwards else node[1]:
                start = self.add(part, start, backwards)
            return start
        if kind == "alt":
            end = self.state()
            for part in node[1]:
                self.empty[self.add(part, self._after(start), backwards)].append(end)
            return end
        _, part, least, most = node
        for _ in range(least):
            start = self.add(part, start, backwards)
        if most is None:
            loop = self._after(start)
            self.empty[self.add(part, loop, backwards)].append(loop)
            return self._after(loop)
        ends = [start]
        for _ in range(most - least):
            start = self.add(part, start, backwards)
            ends.append(start)
        end = self.state()
        for e in ends:
            self.empty[e].append(end)
        return end

    def _after(self, start: int) -> int:
        new = self.state()
        self.empty[start].append(new)
        return new

    def closures(self) -> list[int]:
        """For each state the states that empty edges reach from it, itself included, as bits."""
        found = []
        for s in range(len(self.empty)):
            seen, todo = {s}, [s]
            while todo:
                for t in self.empty[todo.pop()]:
                    if t not in seen:
                        seen.add(t)
                        todo.append(t)
            found.append(sum(1 << t for t in seen))
        return found


class Automaton(NamedTuple):
    """``step[state + byte]`` is the next state; states are multiples of 256 and those from ``final`` on accept."""

    step: list[int]
    start: int
    final: int
    rules: dict[int, tuple[int, ...]]  # of accepting states
    dead: int  # no match can follow; -1 if there is no such state


def _bits(mask: int) -> Iterator[int]:
    while mask:
        low = mask & -mask
        yield low.bit_length() - 1
        mask ^= low


def _subsets(nfa: _Nfa, start: int) -> tuple[list[list[int]], list[frozenset]]:
    """Deterministic transitions by class of bytes that no edge tells apart, widened to bytes."""
    sets = {s for edges in nfa.edges for s, _ in edges}
    signature = defaultdict(list)
    for b in range(256):
        signature[tuple(b in s for s in sets)].append(b)
    classes = list(signature.values())
    reach = nfa.closures()
    moves = [[(c, reach[t]) for on, t in edges for c, members in enumerate(classes) if members[0] in on] for edges in nfa.edges]
    number, order, rows = {reach[start]: 0}, [reach[start]], []
    for states in order:
        targets = [0] * len(classes)
        for s in _bits(states):
            for c, mask in moves[s]:
                targets[c] |= mask
        row = [0] * 256
        for members, target in zip(classes, targets):
            if target not in number:
                number[target] = len(order)
                order.append(target)
            for b in members:
                row[b] = number[target]
        rows.append(row)
    return rows, [frozenset(nfa.accepts[s] for s in _bits(states) if s in nfa.accepts) for states in order]


def _minimised(rows: list[list[int]], accepts: list[frozenset]) -> Automaton:
    """Merge states until no byte tells two of a block apart; accepting states get the highest numbers."""
    columns = sorted({tuple(r[b] for r in rows): b for b in range(256)}.values())
    names: dict = {}
    block = [names.setdefault(a, len(names)) for a in accepts]
    while True:
        names = {}
        finer = [names.setdefault((block[i], *[block[r[b]] for b in columns]), len(names)) for i, r in enumerate(rows)]
        if len(names) == len(set(block)):
            break
        block = finer
    members = {}
    for i, b in enumerate(block):
        members.setdefault(b, i)
    order = sorted(members, key=lambda b: (bool(accepts[members[b]]), b))
    place = {b: 256 * k for k, b in enumerate(order)}
    step = [place[block[t]] for b in order for t in rows[members[b]]]
    final = next((place[b] for b in order if accepts[members[b]]), 256 * len(order))
    rules = {place[b]: tuple(sorted(accepts[members[b]])) for b in order if accepts[members[b]]}
    dead = next((s for s in place.values() if s not in rules and set(step[s : s + 256]) == {s}), -1)
    return Automaton(step, place[block[0]], final, rules, dead)


def relaxed(node, counted: int):
    """The same regex with counted repeats shortened: it has a match wherever the regex has one."""
    if node[0] == "set":
        return node
    if node[0] in ("cat", "alt"):
        return (node[0], [relaxed(part, counted) for part in node[1]])
    _, part, least, most = node
    return ("rep", relaxed(part, counted), min(least, counted), most if most is not None and most <= counted else None)


def compile_rules(
    rules: list[Rule], backwards: bool = False, anywhere: bool = True, relax: bool = False
) -> Automaton:
    """One automaton for all rules. ``anywhere``: behind any bytes; ``backwards``: each rule reversed."""
    nfa = _Nfa()
    start = nfa.state()
    if anywhere:
        nfa.edges[start].append((frozenset(range(256)), start))
    for k, rule in enumerate(rules):
        node = parse(rule.regex, rule.any_case)
        nfa.accepts[nfa.add(relaxed(node, rule.counted) if relax else node, nfa._after(start), backwards)] = k
    return _minimised(*_subsets(nfa, start))


class Scanner(NamedTuple):
    combined: Automaton
    starts: list[Automaton]
    ends: list[Automaton]
    heads: list[Automaton | None]


@functools.cache
def scanner(rules: tuple[Rule, ...]) -> Scanner:
    return Scanner(
        compile_rules(list(rules), relax=True), [compile_rules([r], backwards=True) for r in rules],
        [compile_rules([r], anywhere=False) for r in rules],
        [compile_rules([r._replace(regex=r.head)], anywhere=False) if r.head else None for r in rules])


# ---------------------------------------------------------------- scanning


def rules_in(automaton: Automaton, data: bytes) -> set[int]:
    """Numbers of the rules with a match somewhere: the one pass over every text."""
    step, state, final = automaton.step, automaton.start, automaton.final
    met = set()
    for byte in data:
        state = step[state + byte]
        if state >= final:
            met.add(state)
    return {k for s in met for k in automaton.rules[s]}


def starts(automaton: Automaton, data: bytes) -> list[int]:
    """Ascending positions where a match of the reversed rule ends, reading from the end of the text."""
    step, state, final = automaton.step, automaton.start, automaton.final
    found, at = [], len(data)
    for byte in reversed(data):
        at -= 1
        state = step[state + byte]
        if state >= final:
            found.append(at)
    return found[::-1]


def longest(automaton: Automaton, data: bytes, start: int) -> int:
    """End of the longest match that starts here."""
    step, state, final, dead, end = automaton.step, automaton.start, automaton.final, automaton.dead, start
    for at in range(start, len(data)):
        state = step[state + data[at]]
        if state >= final:
            end = at + 1
        elif state == dead:
            break
    return end


def spans(data: bytes, rules: tuple[Rule, ...]) -> list[tuple[int, int, int]]:
    """(start, rule number, end) in code points, by start and then rule, of all rules' matches."""
    own = scanner(rules)
    found = []
    for k in sorted(rules_in(own.combined, data)):
        last, head = 0, own.heads[k]
        for at in starts(own.starts[k], data):
            if at < last:
                continue
            last = longest(own.ends[k], data, at)
            if head is None or last - longest(head, data, at) >= rules[k].least:
                found.append((at, k, last))
    if not data.isascii():
        points = functools.cache(lambda at: len(data[:at].decode("utf-8", "replace")))
        found = [(points(a), k, points(b)) for a, k, b in found]
    return sorted(found)


_SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def scan(documents: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """Spans of each document: counts and a digest of the base kinds, and all spans."""
    rules = tuple(rules)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in text_bytes(batch.column(1)):
                found = spans(bytes(text), rules) if text else []
                base = [x for x in found if rules[x[1]].base]
                told = lambda xs: ",".join(f"{rules[k].kind}:{a}:{b}" for a, k, b in xs)
                kinds = [rules[k].kind for _, k, _ in base]
                digest = hashlib.sha256(told(base).encode()).hexdigest()
                rows.append((*[kinds.count(k) for k in ("assign", "access", "hex")], digest, told(found)))
            columns = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, [pa.int64()] * 3 + [pa.string()] * 2)]],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(find, _SCHEMA)


def redacted(documents: DataFrame, rules: list[Rule] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """The documents with every span replaced by a mark, and ``n_chars`` counted anew where one was; null stays null."""
    rules, columns = tuple(rules), documents.columns

    def hide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, counts = [], batch.column("n_chars").to_pylist()
            for i, text in enumerate(text_bytes(batch.column("text"))):
                if text is None:
                    out.append(None)
                    continue
                found = spans(bytes(text), rules)
                whole = str(text, "utf-8", "replace")
                if found:
                    parts, at = [], 0
                    for a, _, b in found:  # overlapping spans of several kinds share one mark
                        if b > at:
                            if a >= at:
                                parts += [whole[at:a], mark]
                            at = b
                    whole = "".join([*parts, whole[at:]])
                    counts[i] = len(whole)
                out.append(whole)
            arrays = {"text": pa.array(out, pa.string()), "n_chars": pa.array(counts, pa.int64())}
            yield pa.RecordBatch.from_arrays([arrays.get(c, batch.column(c)) for c in columns], columns)

    rows = documents.withColumns({"text": F.col("text").cast("string"), "n_chars": F.col("n_chars").cast("long")})
    return rows.mapInArrow(hide, rows.schema)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
