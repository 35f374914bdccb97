"""Secret scans: patterns find labelled credentials, grammar inference learns their formats, likelihood finds more.

1. *Base* spans come from three patterns (``assign``, ``access``, ``hex``).
2. *Learning*: at most ``SAMPLE`` distinct credentials per kind (chosen by hash: the documented bound of the sample), as
   sequences of character classes, form a prefix tree; states whose outgoing frequencies agree within a Hoeffding bound,
   and whose successors do, are merged (:func:`infer`).  The result is a probabilistic automaton per kind.
3. *Background*: a class model of order two, counted over the parts of all runs outside base spans (words, numbers and what
   occurs repeatedly) of all documents, says how likely a part is as ordinary text.  Parts are counted where they are and summed
   by value; the model is the sums by three neighbouring classes, so only these reach the driver.
4. *Scoring*: a part of a run of credential characters lies between two of its start, its end and its symbols (``. = / - _ +``).
   Its score is the log likelihood ratio of a kind's automaton, which decides the lengths too, to the background.  One pass
   over a run keeps the best start for every state, so its cost is the run's length times the states reached.  A part is
   reported (kind ``grammar``) when its score reaches the kind's limit and it overlaps no base span; of parts that overlap,
   the best one.  ``KEEP`` of the held-out credentials reach the limit.  If more than a ``FALSE_POSITIVES`` share of the
   held-out words and numbers of all documents (by occurrence) would too, ordinary text has the format as well: the kind's automaton reports nothing.

Offsets are code points, ends exclusive.  Every text is scanned in full.

Defined cases: a null text is empty; without credentials of a kind there is no automaton for it; repeated rows are each
reported; a null doc_id is passed on; further columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

SAMPLE, ALPHA, KEEP = 5000, 0.05, 0.95
FALSE_POSITIVES = 0.001
HELD_OUT = 5  # every fifth value sets the limit
COUNTED = 1 << 18  # different runs a task counts before it passes them on
RARE = 0.1  # share of the background model that takes all symbols as equally likely
KINDS = ("assign", "access", "hex")
# The base patterns.
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the runs of [0-9a-f]+ that have 24 or more
RUN = re.compile(r"[A-Za-z0-9+/_.=-]+")
REMEMBERED = 64  # runs up to this length are scored once for many texts
SYMBOL = re.compile(r"[+/_.=-]")
# words and numbers: what must not be taken for credentials
ORDINARY = re.compile("[A-Z]?[a-z]+|[0-9]{1,10}")
# a cheap superset of texts that can hold a base span
MAYBE = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]|AKIA[A-Z0-9]{16}|[0-9a-f]{24}"""


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind number, end, credential), by start and kind."""
    out = [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(out)


_CLASS = {c: k for k, group in {"9": "0123456789", "f": "abcdef", "z": "ghijklmnopqrstuvwxyz", "Z": "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}.items() for c in group}


def classes(value: str) -> str:
    """Character classes; an access key's fixed prefix stays literal."""
    head = value[:4] if value.startswith("AKIA") else ""
    return head.translate(str.maketrans("AKI", "123")) + "".join(_CLASS.get(c, c) for c in value[len(head):])


@functools.lru_cache(maxsize=16)
def long_runs(least: int) -> re.Pattern:
    return re.compile(RUN.pattern[:-1] + "{%d,}" % min(least, 1000))  # RE2's bound for a count


_TO_CLASS = str.maketrans(_CLASS)


def classes_of_run(value: str) -> str:
    return value.translate(_TO_CLASS)


# -- grammar inference ---------------------------------------------------------------
@dataclass
class Automaton:
    """Merged states: per state, arrivals, ends, and count and successor per symbol."""

    seen: list[int] = field(default_factory=list)
    ends: list[int] = field(default_factory=list)
    go: list[dict[str, list[int]]] = field(default_factory=list)
    limit: float = math.inf
    least: int = 0  # no shorter part can reach the limit (0: none can)

    def likelihood(self, symbols: str) -> float:
        """Log likelihood, the end included."""
        state, total = 0, 0.0
        for s in symbols:
            step = self.go[state].get(s)
            if step is None:
                return -math.inf
            total += math.log(step[0] / self.seen[state])
            state = step[1]
        if not self.ends[state]:
            return -math.inf
        return total + math.log(self.ends[state] / self.seen[state])


def prefix_tree(sequences: list[str]) -> Automaton:
    t = Automaton([0], [0], [{}])
    for seq in sequences:
        state = 0
        t.seen[0] += 1
        for s in seq:
            step = t.go[state].setdefault(s, [0, -1])
            if step[1] < 0:
                step[1] = len(t.seen)
                t.seen.append(0)
                t.ends.append(0)
                t.go.append({})
            step[0] += 1
            state = step[1]
            t.seen[state] += 1
        t.ends[state] += 1
    return t


def _differ(x: int, n: int, y: int, m: int, alpha: float) -> bool:
    bound = math.sqrt(0.5 * math.log(2 / alpha))
    return abs(x / n - y / m) > bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))


def _compatible(t: Automaton, a: int, b: int, alpha: float) -> bool:
    """Do both states, and what follows them, have the same frequencies as far as the counts can tell?"""
    todo = [(a, b)]
    while todo:
        a, b = todo.pop()
        n, m = t.seen[a], t.seen[b]
        if not n or not m:
            continue
        if _differ(t.ends[a], n, t.ends[b], m, alpha):
            return False
        for s in t.go[a].keys() | t.go[b].keys():
            x, y = t.go[a].get(s), t.go[b].get(s)
            if _differ(x[0] if x else 0, n, y[0] if y else 0, m, alpha):
                return False
            if x and y:
                todo.append((x[1], y[1]))
    return True


def _fold(t: Automaton, into: int, tree: int) -> None:
    """Add the counts of a subtree that hangs on ``tree`` to the automaton at ``into``."""
    todo = [(into, tree)]
    while todo:
        a, b = todo.pop()
        t.seen[a] += t.seen[b]
        t.ends[a] += t.ends[b]
        for s, (c, child) in t.go[b].items():
            step = t.go[a].get(s)
            if step is None:
                t.go[a][s] = [c, child]
            else:
                step[0] += c
                todo.append((step[1], child))


def infer(values: list[str], alpha: float = ALPHA) -> Automaton | None:
    """Probabilistic automaton of the credentials' class sequences by state merging."""
    sequences = sorted(classes(v) for v in values if v)
    if not sequences:
        return None
    t = prefix_tree(sequences)
    red = [0]
    blue = [(0, s) for s in sorted(t.go[0])]
    while blue:
        parent, symbol = blue.pop(0)
        state = t.go[parent][symbol][1]
        if state in red:
            continue
        for r in red:
            if _compatible(t, r, state, alpha):
                t.go[parent][symbol][1] = r
                _fold(t, r, state)
                break
        else:
            red.append(state)
        blue = [(r, s) for r in red for s in sorted(t.go[r]) if t.go[r][s][1] not in red]
    return t


# -- background and limits ---------------------------------------------------------------
def class_triples(parts: Iterable[tuple[str, int]]) -> dict[str, int]:
    """Occurrences of every symbol with the two before it, in parts given as classes with their numbers of occurrences."""
    out: dict[str, int] = {}
    for symbols, n in parts:
        padded = "^^" + symbols + "$"
        for i in range(2, len(padded)):
            around = padded[i - 2 : i + 1]
            out[around] = out.get(around, 0) + n
    return out


class Background:
    """Class model of ordinary parts: a symbol after the two before it, smoothed by shorter contexts."""

    def __init__(self, values: Iterable[tuple[str, int]]):
        self._set(class_triples((classes(v), n) for v, n in values))

    @classmethod
    def of(cls, triples: dict[str, int]) -> Background:
        """From the sums of :func:`class_triples`."""
        out = cls.__new__(cls)
        out._set(triples)
        return out

    def _set(self, triples: dict[str, int]) -> None:
        self.counts: dict[str, dict[str, int]] = {}
        for around, n in triples.items():
            for k in range(3):
                c = self.counts.setdefault(around[2 - k : 2], {})
                c[around[2]] = c.get(around[2], 0) + n
        self.total = {c: sum(n.values()) for c, n in self.counts.items()}
        self.known: dict[tuple[str, str], float] = {}

    def step(self, before: str, symbol: str) -> float:
        """Log probability of ``symbol`` after the two symbols ``before``."""
        got = self.known.get((before, symbol))
        if got is None:
            p = 1 / 16  # about as many classes and symbols
            for k in (2, 1, 0):
                context = before[k:]
                n = self.total.get(context, 0)
                p = (self.counts.get(context, {}).get(symbol, 0) + 4 * p) / (n + 4)
            got = self.known[before, symbol] = math.log((1 - RARE) * p + RARE / 16)
        return got

    def likelihood(self, symbols: str) -> float:
        padded = "^^" + symbols + "$"
        return sum(self.step(padded[i - 2 : i], padded[i]) for i in range(2, len(padded)))


def ratio(automaton: Automaton, background: Background, symbols: str) -> float:
    return automaton.likelihood(symbols) - background.likelihood(symbols)


def held_out(x: list) -> tuple[list, list]:
    """What is learned from, and what sets the limit (small samples do both)."""
    return (x, x) if len(x) < 10 * HELD_OUT else ([v for i, v in enumerate(x) if i % HELD_OUT], x[::HELD_OUT])


def fit(values: list[str], background: Background, alpha: float = ALPHA, keep: float = KEEP) -> Automaton | None:
    """A kind's automaton; ``keep`` of the held-out credentials reach its limit."""
    used, held = held_out(values)
    automaton = infer(used, alpha)
    if automaton:
        scores = sorted(ratio(automaton, background, classes(v)) for v in held)
        automaton.limit = max(0.0, scores[min(len(scores) - 1, int((1 - keep) * len(scores)))] - 1e-6)  # sums may round otherwise
    return automaton


def settle(automaton: Automaton, background: Background, alarms: int, words: int, false_positives: float = FALSE_POSITIVES) -> None:
    """``alarms`` of the held-out ``words`` (by occurrence) reach the limit: if too many, the format is one of ordinary words as well."""
    if alarms > false_positives * words:
        automaton.limit = math.inf
    automaton.least = least_length(automaton, background) if automaton.limit < math.inf else 0


def learn(values: list[str], ordinary: list[tuple[str, int]], alpha: float = ALPHA, keep: float = KEEP,
          false_positives: float = FALSE_POSITIVES) -> tuple[Automaton | None, Background]:
    """A kind's automaton with its limit, and the background model of ``ordinary`` parts with their numbers of occurrences, from lists."""
    # a part that occurs once and is no word may be an unlabelled secret
    plain, plain_held = held_out([(v, n) for v, n in ordinary if n > 1 or ORDINARY.fullmatch(v)])
    background = Background(plain)
    automaton = fit(values, background, alpha, keep)
    if automaton:
        words = [(v, n) for v, n in plain_held if ORDINARY.fullmatch(v)]
        alarms = sum(n for v, n in words if ratio(automaton, background, classes(v)) >= automaton.limit)
        settle(automaton, background, alarms, sum(n for _, n in words), false_positives)
    return automaton, background


def least_length(automaton: Automaton, background: Background) -> int:
    """A part gains at most so much by a symbol and by its end: the length below which none reaches the limit."""
    letters = sorted({c for steps in automaton.go for c in steps} | {"^"})  # no others stand before a symbol of an accepted part
    before = ["^^", *(a + b for a in letters for b in letters)]
    chance: dict[str, float] = {}  # the greatest probability of every symbol
    last = 0.0
    for state, steps in enumerate(automaton.go):
        for c, (n, _) in steps.items():
            chance[c] = max(chance.get(c, 0.0), n / automaton.seen[state])
        last = max(last, automaton.ends[state] / automaton.seen[state] if automaton.seen[state] else 0.0)
    gain = max((math.log(p) - min(background.step(x, c) for x in before) for c, p in chance.items()), default=0.0)
    final = math.log(last) - min(background.step(x, "$") for x in before) if last else 0.0
    return max(1, math.ceil((automaton.limit - final) / gain)) if gain > 0 else 1


def found_parts(text: str, start: int, end: int, automaton: Automaton, background: Background) -> list[tuple[float, int, int]]:
    """(score, start, end) of the parts of a run that reach the limit; of those that end alike in one state, the best."""
    edges = {start, end}
    for m in SYMBOL.finditer(text, start, end):
        edges |= {m.start(), m.end()}
    plain = classes_of_run(text[start:end])
    active: dict[tuple[int, str], tuple[float, int]] = {}  # (state, two symbols before) -> best score and its start
    late: dict[int, list[tuple[int, str, float, int]]] = {}  # an access key's prefix is read at once
    out = []
    for at in range(start, end):
        if at in edges:
            if text.startswith("AKIA", at) and at + 4 <= end:
                state, total, before = 0, 0.0, "^^"
                for c in "1231":
                    step = automaton.go[state].get(c)
                    if step is None:
                        break
                    total += math.log(step[0] / automaton.seen[state]) - background.step(before, c)
                    state, before = step[1], before[1] + c
                else:
                    late.setdefault(at + 4, []).append((state, before, total, at))
            else:
                active[0, "^^"] = max((0.0, at), active.get((0, "^^"), (-math.inf, at)))
        for state, before, total, first in late.pop(at, ()):
            active[state, before] = max((total, first), active.get((state, before), (-math.inf, first)))
        c, moved = plain[at - start], {}
        for (state, before), (total, first) in active.items():
            step = automaton.go[state].get(c)
            if step is not None:
                key = (step[1], before[1] + c)
                got = (total + math.log(step[0] / automaton.seen[state]) - background.step(before, c), first)
                if key not in moved or got > moved[key]:
                    moved[key] = got
        active = moved
        if at + 1 in edges:
            for state, before, total, first in [(*k, *v) for k, v in active.items()] + [x for x in late.get(at + 1, ())]:
                if automaton.ends[state]:
                    total += math.log(automaton.ends[state] / automaton.seen[state]) - background.step(before, "$")
                    if total >= automaton.limit:
                        out.append((total, first, at + 1))
    return out


def grammar_spans(text: str, base: list[tuple], models: list[tuple[Automaton | None, Background]], known: dict | None = None) -> list[tuple[int, int]]:
    """Parts of the text's runs that a kind's format explains better than ordinary text; ``known`` remembers short runs."""
    taken, out = sorted((s, e) for s, _, e, _ in base), []
    least = min((a.least for a, _ in models if a and a.least), default=None)
    if least is None:
        return out
    for m in long_runs(least).finditer(text):
        run = m[0]
        got = known.get(run) if known is not None else None
        if got is None:
            # runs of the same classes have the same parts, and classes are their own classes
            alike = run if "AKIA" in run else classes_of_run(run)
            got = known.get(alike) if known is not None else None
            if got is None:
                got = [x for a, b in models if a and 0 < a.least <= len(run) for x in found_parts(run, 0, len(run), a, b)]
                got.sort(key=lambda x: (-x[0], x[1], -x[2]))
            if known is not None and len(run) <= REMEMBERED:
                if len(known) >= 1 << 17:
                    known.clear()
                known[run] = known[alike] = got
        if not got:
            continue
        near = [(s, e) for s, e in taken if s < m.end() and m.start() < e]
        for _, s, e in got:
            s, e = s + m.start(), e + m.start()
            if not any(a < e and s < b for a, b in near):
                near.append((s, e))
                out.append((s, e))
    return sorted(out)


# -- Spark side ----------------------------------------------------------------------
def _hits(b: pa.RecordBatch, pattern: str) -> list[bool]:
    return pc.fill_null(pc.match_substring_regex(b.column("text"), pattern), False).to_pylist()


def _least_drawn(found: DataFrame, sample: int) -> DataFrame:
    """At most ``sample`` distinct (kind, value) of every kind by hash."""
    drawn = found.select("kind", "value").distinct().withColumn("draw", F.xxhash64(F.lit(9), "value"))
    # the least draws of each of 64 parts hold the least of all: no kind is sorted in one task
    part = drawn.withColumn("r", F.row_number().over(Window.partitionBy("kind", F.pmod("draw", F.lit(64))).orderBy("draw", "value"))).filter(F.col("r") <= sample)
    return part.withColumn("r", F.row_number().over(Window.partitionBy("kind").orderBy("draw", "value"))).filter(F.col("r") <= sample)


def credentials(documents: DataFrame, sample: int = SAMPLE) -> list[list[str]]:
    """At most ``sample`` distinct credentials of each kind, of all documents."""
    schema = pa.schema([("kind", pa.int32()), ("value", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(k, v) for t in b.column("text").filter(pa.array(_hits(b, MAYBE))).to_pylist() for _, k, _, v in base_spans(t)]
            yield C.batch(schema, [k for k, _ in rows], [v for _, v in rows])

    out: list[list[str]] = [[] for _ in KINDS]
    for r in _least_drawn(documents.select("text").mapInArrow(run, "kind int, value string"), sample).select("kind", "value", "draw").sort("kind", "draw").collect():
        out[r.kind].append(r.value)  # at most three samples
    return out


def ordinary_runs(text: str, maybe: bool = True) -> list[str]:
    """Runs outside base spans; ``maybe``: can the text hold any?"""
    taken = [(s, e) for s, _, e, _ in base_spans(text)] if maybe else []
    if not taken:
        return RUN.findall(text)
    return [m[0] for m in RUN.finditer(text) if not any(s < m.end() and m.start() < e for s, e in taken)]


def ordinary_parts(run: str) -> list[str]:
    """A run, and what lies between its symbols."""
    if run.isalnum():
        return [run]
    inner = [x for x in SYMBOL.split(run) if x]
    return inner if inner == [run] else [run, *inner]


def ordinary(documents: DataFrame) -> DataFrame:
    """``symbols, n, held, word`` of the ordinary parts of all documents: classes, occurrences, whether they are held out, whether words.

    One row per classes, ``held`` and ``word``.  A part that occurs once and is no word may be an unlabelled secret.
    """
    schema = pa.schema([("value", pa.string()), ("n", pa.int64())])

    def passed_on(runs: Counter) -> pa.RecordBatch:
        parts: Counter = Counter()
        for run, n in runs.items():
            for part in ordinary_parts(run):
                parts[part] += n
        return C.batch(schema, list(parts), list(parts.values()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: Counter = Counter()
        for b in batches:
            for text, maybe in zip(b.column("text").to_pylist(), _hits(b, MAYBE)):
                if text is not None:
                    runs.update(ordinary_runs(text, maybe))
                    if len(runs) > COUNTED:
                        yield passed_on(runs)
                        runs = Counter()
        yield passed_on(runs)

    rest = lambda c: F.translate(c, "".join(_CLASS), "".join(_CLASS.values()))
    value = F.col("value")
    symbols = F.when(value.startswith("AKIA"), F.concat(F.lit(classes("AKIA")), rest(F.substring(value, 5, (1 << 31) - 1)))).otherwise(rest(value))
    found = documents.select("text").mapInArrow(run, "value string, n long").groupBy("value").agg(F.sum("n").alias("n"))
    marked = found.withColumn("word", value.rlike(f"^(?:{ORDINARY.pattern})$")).filter("n > 1 OR word")
    held = F.pmod(F.xxhash64(F.lit(11), "value"), F.lit(HELD_OUT)) == 0
    return marked.groupBy(symbols.alias("symbols"), held.alias("held"), "word").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("values"))


def background(parts: DataFrame) -> tuple[Background, DataFrame]:
    """The model of the parts that aren't held out, and the held-out words (few parts are both): ``symbols, n``."""
    schema = pa.schema([("around", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sums = class_triples(zip(b.column("symbols").to_pylist(), b.column("n").to_pylist()))
            yield C.batch(schema, list(sums), list(sums.values()))

    few = (parts.agg(F.sum("values")).first()[0] or 0) < 10 * HELD_OUT
    used, words = (parts, parts.filter("word")) if few else (parts.filter("NOT held"), parts.filter("held AND word"))
    sums = used.select("symbols", "n").mapInArrow(run, "around string, n long").groupBy("around").agg(F.sum("n").alias("n"))
    return Background.of({r.around: r.n for r in sums.collect()}), words.select("symbols", "n")  # triples of a dozen classes


def alarms(words: DataFrame, automata: list[Automaton | None], model: Background) -> tuple[list[int], int]:
    """Occurrences of the words that reach each automaton's limit, and of all words."""
    schema = pa.schema([*((f"a{k}", pa.int64()) for k in range(len(automata))), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            symbols, n = b.column("symbols").to_pylist(), b.column("n").to_pylist()
            over = [[c if a and ratio(a, model, x) >= a.limit else 0 for x, c in zip(symbols, n)] for a in automata]
            yield C.batch(schema, *over, n)

    sums = words.mapInArrow(run, ", ".join(f"{f.name} long" for f in schema)).agg(*[F.coalesce(F.sum(f.name), F.lit(0)) for f in schema]).first()
    return list(sums[:-1]), sums[-1]


def scan_secrets(documents: DataFrame, sample: int = SAMPLE, alpha: float = ALPHA, keep: float = KEEP, false_positives: float = FALSE_POSITIVES) -> DataFrame:
    """``doc_id`` and ``spans``: array of (kind, start, end), by start and kind (``grammar`` last)."""
    found = credentials(documents, sample)
    models: list[tuple[Automaton | None, Background]] = []
    if any(found):
        parts = C.cut(ordinary(documents), "secret-parts")
        model, words = background(parts)
        automata = [fit(v, model, alpha, keep) for v in found]
        over, of = alarms(words, automata, model)
        C.forget(parts)
        for automaton, n in zip(automata, over):
            if automaton:
                settle(automaton, model, n, of, false_positives)
            models.append((automaton, model))
    least = min((a.least for a, _ in models if a and a.least), default=None)
    pattern = None if least is None else long_runs(least).pattern
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    schema = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(span))])
    names = (*KINDS, "grammar")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for b in batches:
            base = _hits(b, MAYBE)
            runs = _hits(b, pattern) if pattern else [False] * b.num_rows
            out = []
            for i in range(b.num_rows):
                spans = []
                if base[i] or runs[i]:
                    text = b.column("text")[i].as_py()
                    own = base_spans(text) if base[i] else []
                    more = grammar_spans(text, own, models, known) if runs[i] else []
                    spans = sorted([(s, k, e) for s, k, e, _ in own] + [(s, len(KINDS), e) for s, e in more])
                out.append([{"kind": names[k], "start": s, "end": e} for s, k, e in spans])
            yield C.batch(schema, b.column("doc_id"), out)

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, spans array<struct<kind:string,start:int,end:int>>")


def op9_secret_scan(spark, sf_dir: str) -> DataFrame:
    found = scan_secrets(C.table(spark, sf_dir, "documents"))
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *[of(k).alias(f"n_{k}") for k in (*KINDS, "grammar")],
                        F.sha2(text(F.filter("spans", lambda s: s["kind"] != "grammar")), 256).alias("base_sha256"), text("spans").alias("spans"))
