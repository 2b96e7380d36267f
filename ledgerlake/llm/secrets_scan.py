"""Secret scan by one combined deterministic automaton.

Every rule is a head (regular expression) followed by a run of tail bytes. The
rules' searching forms (head and the first ``watch`` tail bytes, starting
anywhere) are compiled together: expression to nondeterministic automaton,
subset construction over byte classes, minimisation, and one transition array
per state. A text is read once, byte by byte, for all rules. At an accepting
state the span is settled locally: the tail run is followed to its end, and the
reversed head automaton goes back to the leftmost start after the rule's last
span. Runs shorter than ``least`` are dropped but consumed, as a leftmost
non-overlapping search would.

Defined cases: null and empty texts have no spans; spans of different rules may
overlap; offsets are code points, the end exclusive.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as parser
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS = 512


class Rule(NamedTuple):
    kind: str
    head: str            # before the run
    tail: str            # a character class
    least: int           # bytes of the run, at least
    watch: int = 1       # bytes of the run that the automaton waits for
    fold: bool = False   # letters of the head in either case


BASE = (
    Rule("assign", r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", r"[A-Za-z0-9+/_.=-]", 12, fold=True),
    Rule("access", "AKIA", "[A-Z0-9]", 14, watch=14),
    Rule("hex", "", "[0-9a-f]", 16, watch=16),
)
#: Public token formats besides.
MORE = (
    Rule("private_key", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH |PGP )?PRIVATE KEY(?: BLOCK)?-----", r"[A-Za-z0-9+/=\s]", 16),
    Rule("github", "gh[pousr]_", "[A-Za-z0-9]", 36),
    Rule("slack", "xox[abprs]-", "[A-Za-z0-9-]", 10),
    Rule("google", "AIza", "[A-Za-z0-9_-]", 35),
    Rule("jwt", "eyJ[A-Za-z0-9_-]{2}", r"[A-Za-z0-9_.-]", 40),
    Rule("bearer", r"bearer\x20+", r"[A-Za-z0-9+/_.=~-]", 20, fold=True),
)
RULES = BASE + MORE


class _Nfa:
    """States are numbers; ``step[s]`` lists (byte set, next), ``free[s]`` the moves without a byte."""

    def __init__(self):
        self.step: list[list[tuple[frozenset, int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.step.append([])
        self.free.append([])
        return len(self.step) - 1

    def closure(self, states) -> frozenset:
        found, todo = set(states), list(states)
        while todo:
            for t in self.free[todo.pop()]:
                if t not in found:
                    found.add(t)
                    todo.append(t)
        return frozenset(found)

    def add(self, parsed, at: int, fold: bool, backwards: bool) -> int:
        """The end state after a parsed expression that starts in ``at``."""
        for op, arg in (reversed(list(parsed)) if backwards else parsed):
            if op is sre.SUBPATTERN:
                at = self.add(arg[3], at, fold, backwards)
            elif op is sre.BRANCH:
                end = self.state()
                for branch in arg[1]:
                    start = self.state()
                    self.free[at].append(start)
                    self.free[self.add(branch, start, fold, backwards)].append(end)
                at = end
            elif op is sre.MAX_REPEAT:
                low, high, body = arg
                for _ in range(low):
                    at = self.add(body, at, fold, backwards)
                if high is sre.MAXREPEAT:
                    loop, end = self.state(), self.state()
                    self.free[at] += [loop, end]
                    self.free[self.add(body, loop, fold, backwards)] += [loop, end]
                    at = end
                else:
                    end = self.state()
                    for _ in range(high - low):
                        self.free[at].append(end)
                        at = self.add(body, at, fold, backwards)
                    self.free[at].append(end)
                    at = end
            else:
                end = self.state()
                self.step[at].append((_bytes(op, arg, fold), end))
                at = end
        return at


def _bytes(op, arg, fold: bool = False) -> frozenset:
    if op is sre.LITERAL:
        found = {arg}
    elif op is sre.IN:
        found = set()
        for kind, x in arg:
            found |= ({x} if kind is sre.LITERAL else set(range(x[0], x[1] + 1)) if kind is sre.RANGE
                      else set(b" \t\n\r\f\v") if x is sre.CATEGORY_SPACE else _unknown(kind, x))
    else:
        return _unknown(op, arg)
    if fold:
        found |= {ord(chr(b).swapcase()) for b in found if b < 128}
    return frozenset(found)


def _unknown(op, arg):
    raise ValueError(f"not supported in a rule: {op} {arg}")


def _deterministic(nfa: _Nfa, start: frozenset, ends: dict[int, int], search: bool) -> tuple[list[list[int]], list[tuple]]:
    """Subset construction and minimisation: transition arrays of 256 and the rules that each state accepts."""
    sets = {s for moves in nfa.step for s, _ in moves}
    classes: dict[tuple, list[int]] = {}
    for b in range(256):
        classes.setdefault(tuple(b in s for s in sets), []).append(b)
    groups = list(classes.values())
    first = nfa.closure(start)
    number, todo, table, accept = {first: 0}, [first], [], []
    for states in todo:
        accept.append(tuple(sorted({ends[s] for s in states if s in ends})))
        row = []
        for g in groups:
            to = {t for s in states for chars, t in nfa.step[s] if g[0] in chars}
            to = nfa.closure(to | (start if search else set()))
            if to not in number:
                number[to] = len(todo)
                todo.append(to)
            row.append(number[to])
        table.append(row)
    block = {a: i for i, a in enumerate(dict.fromkeys(accept))}
    part = [block[a] for a in accept]
    while True:  # split blocks until their states agree on the block of every next state
        seen: dict[tuple, int] = {}
        finer = [seen.setdefault((part[s], *(part[t] for t in row)), len(seen)) for s, row in enumerate(table)]
        if len(seen) == len(set(part)):
            break
        part = finer
    rows, accepts = [[] for _ in range(max(part) + 1)], [()] * (max(part) + 1)
    for s, row in enumerate(table):
        if not rows[part[s]]:
            full = [0] * 256
            for g, t in zip(groups, row, strict=True):
                for b in g:
                    full[b] = part[t]
            rows[part[s]], accepts[part[s]] = full, accept[s]
    order = [part[0], *(i for i in range(len(rows)) if i != part[0])]  # the start comes first
    place = {old: new for new, old in enumerate(order)}
    return [[place[t] for t in rows[i]] for i in order], [accepts[i] for i in order]


class Scanner:
    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        nfa, start, ends = _Nfa(), set(), {}
        self.heads, self.tails = [], []
        for i, r in enumerate(rules):
            s = nfa.state()
            start.add(s)
            at = nfa.add(parser.parse(r.head), s, r.fold, False)
            ends[nfa.add(parser.parse(r.tail + "{%d}" % r.watch), at, False, False)] = i
            back = _Nfa()
            s = back.state()
            e = back.add(parser.parse(r.head), s, r.fold, True)
            self.heads.append(_deterministic(back, frozenset({s}), {e: 0}, False))
            chars = next(iter(parser.parse(r.tail)))
            self.tails.append(_bytes(*chars))
        self.dead = [next((s for s, row in enumerate(table) if not accepts[s] and set(row) == {s}), -1)
                     for table, accepts in self.heads]
        table, accepts = _deterministic(nfa, frozenset(start), ends, True)
        self.states = len(table)
        self.rows: list[list] = [[] for _ in table]  # linked: a state's array holds the arrays of the next states
        for row, to, a in zip(self.rows, table, accepts, strict=True):
            row += [self.rows[t] for t in to]
            row.append(a)

    def _start(self, i: int, data: bytes, end: int, floor: int) -> int:
        """The leftmost start, not before floor, of a head that ends at ``end``; -1 if there is none."""
        table, accepts = self.heads[i]
        state, found = 0, end if accepts[0] else -1
        for at in range(end - 1, floor - 1, -1):
            state = table[state][data[at]]
            if accepts[state]:
                found = at
            elif state == self.dead[i]:
                break
        return found

    def scan(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, rule number, end) in bytes, by start and rule."""
        row, out = self.rows[0], []
        floors = [0] * len(self.rules)
        for end, b in enumerate(data, 1):
            row = row[b]
            if row[256]:
                for i in row[256]:
                    rule = self.rules[i]
                    tail = end - rule.watch
                    if tail < floors[i] or (start := self._start(i, data, tail, floors[i])) < 0:
                        continue
                    stop, chars = end, self.tails[i]
                    while stop < len(data) and data[stop] in chars:
                        stop += 1
                    floors[i] = stop
                    if stop - tail >= rule.least:
                        out.append((start, i, stop))
        return sorted(out)

    def spans(self, text: str | None) -> list[dict]:
        """Spans of a text in code points."""
        data = (text or "").encode("utf-8", "surrogatepass")
        found = self.scan(data)
        if found and len(data) != len(text):
            at, points, place = 0, 0, {}
            for p in sorted({p for s, _, e in found for p in (s, e)}):
                points += len(data[at:p].decode("utf-8", "surrogatepass"))
                at, place[p] = p, points
            found = [(place[s], i, place[e]) for s, i, e in found]
        return [{"kind": self.rules[i].kind, "start": s, "end": e} for s, i, e in found]


@lru_cache(maxsize=4)
def scanner(rules: tuple[Rule, ...]) -> Scanner:
    """One compiled automaton per worker process."""
    return Scanner(rules)


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                                  T.StructField("end", T.IntegerType())]))
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def find(docs: DataFrame, text: str = "text", keep: list[str] | None = None, rules: tuple[Rule, ...] = RULES,
         spans: str = "spans") -> DataFrame:
    """``keep`` columns (default: all) and the spans, by start and then rule order."""
    keep = [c for c in (docs.columns if keep is None else keep) if c != spans]

    def run(batches):
        s = scanner(rules)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                found = [s.spans(t) for t in part.column(len(keep)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(keep))), pa.array(found, _ARROW)],
                                                 names=[*keep, spans])

    return docs.select(*keep, F.col(text).alias("__text")).mapInArrow(
        run, T.StructType([*[docs.schema[c] for c in keep], T.StructField(spans, SPANS)]))


def listing(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """All columns; every span (overlapping ones together) is replaced by ``mark``, and ``n_chars``, if there, follows."""
    cols = docs.columns
    found = find(docs.select(F.struct(*cols).alias("__doc"), F.col(text).alias("__raw")), "__raw", rules=rules, spans="__spans")
    # Overlapping spans become one: a piece of text is kept from the furthest end so far to the next start.
    step = lambda a, s: F.struct(
        F.when(s["start"] >= a["at"], F.concat(a["out"], F.substring(
            F.col("__raw"), a["at"] + 1, s["start"] - a["at"]), F.lit(mark))).otherwise(a["out"]).alias("out"),
        F.greatest(a["at"], s["end"]).alias("at"))
    done = F.aggregate("__spans", F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), step,
                       lambda a: F.concat(a["out"], F.substring(F.col("__raw"), a["at"] + 1, F.length("__raw"))))
    found = found.select("__doc", F.when(F.size("__spans") == 0, F.col("__raw")).otherwise(done).alias("__new"))
    return found.select(*[
        F.col("__new").alias(c) if c == text else
        F.when(F.col("__new").eqNullSafe(F.col("__doc")[text]), F.col("__doc")[c])
        .otherwise(F.length("__new").cast(docs.schema[c].dataType)).alias(c) if c == "n_chars" else
        F.col("__doc")[c].alias(c) for c in cols])
