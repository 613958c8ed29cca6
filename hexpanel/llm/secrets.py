"""Secret scan by grammar inference.

Labelled credentials of known formats make prefix trees; states whose futures are statistically compatible (Hoeffding's
bound) are merged into one probabilistic automaton a format, and one for ordinary tokens. Merging makes states forget how
long a token is, so each automaton also learns the lengths of its format; a token of another length has no likelihood
under it. Every candidate token is scored by how much likelier its best format makes it than ordinary text does: nats a
symbol, over at most SPAN symbols, so that a score doesn't grow with length alone. Base patterns are found exactly and
stay whatever the score; tokens without one are added where the score is high.
"""

from __future__ import annotations

import math
import random
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The base patterns, in the order in which spans of one start are listed.
BASE = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a run that is long enough begins where the leftmost match of any length does
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
RUN = "[A-Za-z0-9+/_.=-]"
DIGEST = re.compile(r"(?:md5|sha(?:1|224|256|384|512))[-:=_][A-Za-z0-9+/]{16,}={0,2}", re.I)  # says itself that it is public
PART = re.compile(r"[^/.=]+")  # of a candidate, which may hold a credential among other things

#: Parameters of training and scoring.
EXAMPLES, ORDINARY, ALPHA, SEED, FLOOR, LEAST_SCORE, SPAN = 160, 3000, 0.02, 11, 1e-3, 25.0, 60

_UPPER, _LOWER, _DIGIT = string.ascii_uppercase, string.ascii_lowercase, string.digits


def symbol(c: str) -> str:
    """Letters and digits by class, other characters by themselves: within a class every model is uniform."""
    return "D" if c in _DIGIT else "U" if c in _UPPER else "h" if c in "abcdef" else "l" if c in _LOWER else c


def labelled(seed: int = SEED, each: int = EXAMPLES, ordinary: int = ORDINARY) -> dict[str, list[str]]:
    """Credentials made by the rules of their formats, and ordinary long tokens, all from one seed."""
    r = random.Random(seed)
    some = lambda alphabet, n: "".join(r.choices(alphabet, k=n))
    alnum, url = _UPPER + _LOWER + _DIGIT, _UPPER + _LOWER + _DIGIT + "_-"
    syllables = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of", "or", "nt", "ea", "ti", "to", "st", "le", "cion", "keit", "lich", "schaft", "ment", "eau", "que", "ando", "heit"]
    word = lambda n: "".join(r.choices(syllables, k=n))
    plain = [
        lambda: word(r.randint(8, 16)), lambda: word(r.randint(8, 16)).upper(), lambda: word(r.randint(8, 14)).capitalize(),
        lambda: r.choice("-=._").join(word(r.randint(1, 5)) for _ in range(r.randint(3, 8))),
        lambda: "/".join(word(r.randint(1, 4)) for _ in range(r.randint(3, 7))) + r.choice(["", ".html", ".txt", "/"]),
        lambda: "".join(word(r.randint(1, 3)).capitalize() for _ in range(r.randint(4, 8))),
        lambda: r.choice("-=_.") * r.randint(20, 80), lambda: some(_DIGIT, r.randint(20, 40)),
        lambda: r.choice("-./").join(some(_DIGIT, r.randint(1, 4)) for _ in range(r.randint(6, 10))),
        lambda: word(r.randint(5, 10)) + some(_DIGIT, r.randint(1, 6)), lambda: word(r.randint(4, 8)) + "." + word(r.randint(2, 6)) + some(_DIGIT, 2),
        lambda: "_".join(word(r.randint(1, 3)).upper() for _ in range(r.randint(4, 7))), lambda: r.choice(syllables) * r.randint(10, 20),
        # what looks like credentials: alphabets, dotted names with digits, identifiers by number, times
        lambda: "".join(r.sample([_UPPER, _LOWER, _DIGIT], r.randint(2, 3))), lambda: ".".join(word(r.randint(1, 3)).capitalize() + r.choice(["", "", str(r.randint(1, 99))]) for _ in range(r.randint(3, 7))),
        lambda: ".".join([word(1), word(2), *("_".join(word(r.randint(1, 2)).capitalize() + r.choice(["", str(r.randint(1, 9))]) for _ in range(r.randint(1, 3))) for _ in range(r.randint(2, 4)))]),
        lambda: "//" + ".".join([r.choice(["www", word(1)]), word(r.randint(2, 5)), r.choice(["org", "com", "net", "de"])]) + "/" + "/".join(r.choice([str(r.randint(1990, 2030)), some(_DIGIT, 2), word(1)]) for _ in range(r.randint(0, 3))) + "/" + "-".join(word(r.randint(1, 3)) for _ in range(r.randint(2, 6))) + r.choice([".html", "", "/"]),
        lambda: "-".join(some("0123456789abcdef", n) for n in (8, 4, 4, 4, 12)), lambda: f"{r.randint(1990, 2030)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}T{some(_DIGIT, 6)}.{some(_DIGIT, 3)}+{some(_DIGIT, 4)}",
        lambda: "".join(word(r.randint(1, 3)).capitalize() + r.choice(["", "", some(_DIGIT, r.randint(1, 3))]) for _ in range(r.randint(4, 8))),
        lambda: word(r.randint(2, 4)) + "." + some("0123456789abcdef", 8) + ".chunk." + r.choice(["js", "css", "map"]),
    ]
    make = {
        "access": lambda: "AKIA" + some(_UPPER + "234567", 16),
        "github": lambda: "gh" + r.choice("pousr") + "_" + some(alnum, 36),
        "google": lambda: "AIza" + some(url, 35),
        "hex": lambda: some("0123456789abcdef", r.choice([32, 40, 64])),
        "jwt": lambda: "eyJ" + some(url, r.randint(17, 60)) + ".eyJ" + some(url, r.randint(30, 500)) + "." + some(url, r.choice([43, 86, 342])),
        "key": lambda: some(alnum + "+/", n := r.choice([32, 40, 43, 64, 86])) + {43: "=", 86: "=="}.get(n, ""),
        "slack": lambda: "xox" + r.choice("bpars") + "-" + some(_DIGIT, r.randint(10, 12)) + "-" + some(_DIGIT, r.randint(10, 12)) + "-" + some(alnum, 24),
        "stripe": lambda: r.choice(["sk", "rk", "pk"]) + r.choice(["_live_", "_test_"]) + some(alnum, 24),
    }
    return {k: [f() for _ in range(each)] for k, f in make.items()} | {"": [plain[i % len(plain)]() for i in range(ordinary)]}


@dataclass
class _State:
    seen: int = 0
    ended: int = 0
    to: dict[str, _State] = field(default_factory=dict)
    taken: dict[str, int] = field(default_factory=dict)


class Automaton:
    """Probabilistic deterministic automaton, inferred by merging red states with compatible blue ones."""

    def __init__(self, examples: list[str], alpha: float = ALPHA):
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        root = _State()
        for x in examples:
            s = root
            s.seen += 1
            for c in map(symbol, x):
                s.taken[c] = s.taken.get(c, 0) + 1
                s = s.to.setdefault(c, _State())
                s.seen += 1
            s.ended += 1
        red, blue = [root], [(root, c) for c in sorted(root.to)]
        while blue:
            blue.sort(key=lambda x: -x[0].to[x[1]].seen)
            parent, c = blue.pop(0)
            state = parent.to[c]
            for other in red:
                if self._compatible(other, state):
                    parent.to[c] = other
                    self._fold(other, state)
                    break
            else:
                red.append(state)
            known = {id(s) for s in red}
            blue = [(s, k) for s in red for k in sorted(s.to) if id(s.to[k]) not in known]
        at = {id(s): i for i, s in enumerate(red)}
        self.states = len(red)
        short, long = min(map(len, examples), default=0), max(map(len, examples), default=0)
        self.shortest, self.longest = max(1, short - (long - short) // 10), long + (long - short) // 4  # beyond the examples as far as they are spread
        #: A row for each state: symbol -> (log probability, next); the end is the symbol "".
        self.rows = [{k: (math.log(s.taken[k] / s.seen), at[id(n)]) for k, n in s.to.items()} | ({"": (math.log(s.ended / s.seen), -1)} if s.ended else {}) for s in red]

    def _differ(self, f: int, n: int, g: int, m: int) -> bool:
        return abs(f / n - g / m) > self.bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))

    def _compatible(self, a: _State, b: _State) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            if self._differ(a.ended, a.seen, b.ended, b.seen):
                return False
            for c in {*a.taken, *b.taken}:
                if self._differ(a.taken.get(c, 0), a.seen, b.taken.get(c, 0), b.seen):
                    return False
                if c in b.to and c in a.to and b.to[c].seen > 1:
                    todo.append((a.to[c], b.to[c]))
        return True

    def _fold(self, a: _State, b: _State) -> None:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            a.seen += b.seen
            a.ended += b.ended
            for c, n in b.taken.items():
                a.taken[c] = a.taken.get(c, 0) + n
            for c, n in b.to.items():
                if c in a.to:
                    todo.append((a.to[c], n))
                else:
                    a.to[c] = n

    def score(self, symbols: list[str]) -> float:
        """Log-likelihood; what a state has never seen costs log(FLOOR) and leaves the state as it is."""
        total, at, low = 0.0, 0, math.log(FLOOR)
        for c in symbols:
            p, to = self.rows[at].get(c, (low, at))
            total += p
            at = to
        return total + self.rows[at].get("", (low, -1))[0]


@lru_cache(1)
def models() -> dict[str, Automaton]:
    return {k: Automaton(v) for k, v in labelled().items()}


@lru_cache(8)
def _candidate(shortest: int) -> re.Pattern:
    return re.compile(f"{RUN}{{{shortest},}}")


def candidate(trained: dict[str, Automaton]) -> re.Pattern:
    """Runs that are long enough for the format of the shortest credentials: under every format, shorter ones have no
    likelihood."""
    return _candidate(min(a.shortest for k, a in trained.items() if k))


def likeliest(token: str, trained: dict[str, Automaton]) -> tuple[str, float]:
    """The format that makes a token likeliest against ordinary text, and by how many nats over at most SPAN symbols;
    minus infinity where no format has tokens of that length."""
    n = len(token)
    fits = [(k, a) for k, a in trained.items() if k and a.shortest <= n <= a.longest]
    if not fits:
        return "", -math.inf
    symbols = [symbol(c) for c in token]
    plain = trained[""].score(symbols)
    return max(((k, (a.score(symbols) - plain) / n * min(n, SPAN)) for k, a in fits), key=lambda x: (x[1], x[0]))


def encoded(token: str, trained: dict[str, Automaton]) -> bool:
    """Whether a token is made like a credential of some format all along but longer than any of it: encoded data."""
    beyond = [a for k, a in trained.items() if k and a.longest < len(token)]
    symbols, width = [symbol(c) for c in token], SPAN // 2
    windows = [symbols[i : i + width] for i in range(0, len(symbols) - width + 1, width)]
    return bool(beyond) and all(max(a.score(w) for a in beyond) - trained[""].score(w) > 0 for w in windows)


def embedded(text: str, parts: list[tuple[int, int]], trained: dict[str, Automaton], least: float) -> list[tuple[str, int, int, float]]:
    """Spans from the start of a part to the end of the same or a later one, apart from each other, none shorter than
    its format's shortest credential: those of the largest sum of nats - least; of them, what `likeliest` scores at
    `least` or more.

    What began at different parts and has come to the same pair of states goes on with the better sum only, so the time
    is in proportion to the length whatever the number of parts.
    """
    if not parts:
        return []
    lo, hi = parts[0][0], parts[-1][1]
    formats = [(k, a.rows, a.shortest) for k, a in trained.items() if k and a.shortest <= hi - lo]
    if not formats:
        return []
    plain, low = trained[""].rows, math.log(FLOOR)
    symbols = [symbol(c) for c in text[lo:hi]]
    rows = {k: r for k, r, _ in formats}
    starts, ends = {a - lo: i for i, (a, _) in enumerate(parts)}, {b - lo: i for i, (_, b) in enumerate(parts)}
    best, last = [0.0] * (len(parts) + 1), [None] * (len(parts) + 1)  # of the first i parts: the sum, and its last span
    joins: dict[int, list] = {}
    pool: dict[tuple[str, int, int], tuple[float, int]] = {}
    for p in range(hi - lo + 1):
        for state, value in joins.pop(p, ()):
            if state not in pool or pool[state] < value:
                pool[state] = value
        if p in ends:
            i = ends[p]
            best[i + 1] = best[i]
            for (k, f, o), (value, since) in pool.items():
                if p - (parts[since][0] - lo) > trained[k].longest:
                    continue
                value += rows[k][f].get("", (low, -1))[0] - plain[o].get("", (low, -1))[0] - least
                if value > best[i + 1] or value == best[i + 1] and last[i + 1] is None:
                    best[i + 1], last[i + 1] = value, (k, since)
        if p in starts:
            i = starts[p]
            for k, r, n in formats:
                if p + n > hi - lo:
                    continue
                value, f, o = best[i], 0, 0
                for c in symbols[p : p + n]:
                    (x, f), (y, o) = r[f].get(c, (low, f)), plain[o].get(c, (low, o))
                    value += x - y
                joins.setdefault(p + n, []).append(((k, f, o), (value, i)))
        if p < hi - lo and pool:
            c, moved = symbols[p], {}
            for (k, f, o), (value, since) in pool.items():
                (x, f), (y, o) = rows[k][f].get(c, (low, f)), plain[o].get(c, (low, o))
                value = (value + x - y, since)
                if (k, f, o) not in moved or moved[k, f, o] < value:
                    moved[k, f, o] = value
            pool = moved
    found, i = [], len(parts)
    while i:
        if last[i] is None:
            i -= 1
            continue
        _, since = last[i]
        found += _best(text, parts[since:i], trained, least)
        i = since
    return sorted(found, key=lambda x: x[1])


def _best(text: str, parts: list[tuple[int, int]], trained: dict[str, Automaton], least: float) -> list[tuple[str, int, int, float]]:
    """All parts together if they score `least`, else the best stretches of up to three of them that do and are apart."""
    stretches = [(0, len(parts))] + [(i, j) for i in range(len(parts)) for j in range(i + 1, min(i + 4, len(parts) + 1))]
    scored = []
    for i, j in stretches:
        a, b = parts[i][0], parts[j - 1][1]
        kind, score = likeliest(text[a:b], trained)
        if score >= least:
            scored.append((kind, a, b, score))
            if j - i == len(parts):
                break
    out: list[tuple[str, int, int, float]] = []
    for x in sorted(scored, key=lambda x: (-x[3], x[1])):
        if all(x[2] <= a or b <= x[1] for _, a, b, _ in out):
            out.append(x)
    return out


def within(text: str, parts: list[tuple[int, int]], trained: dict[str, Automaton], least: float) -> list[tuple[str, int, int, float]]:
    """The whole stretch of parts where it is a candidate that scores `least` or more, else what is embedded in it."""
    if parts and candidate(trained).fullmatch(text, a := parts[0][0], b := parts[-1][1]):
        kind, score = likeliest(text[a:b], trained)
        if score >= least:
            return [(kind, a, b, score)]
        if encoded(text[a:b], trained):
            return []
    return embedded(text, parts, trained, least)


def scan(text: str, trained: dict[str, Automaton], least: float = LEAST_SCORE) -> list[tuple[str, int, int, float | None]]:
    """Spans (kind, start, end, score): base spans first found exactly, then candidates that overlap none and score
    `least` or more, by start, then kind. Positions are code points, ends exclusive. Encoded data and digests that are named
    as such are not candidates. Where a candidate scores less as a
    whole, or overlaps base spans, what its other parts hold between / . = is scored as well."""
    base = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        base += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        base += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    tokens = [(m.start(), m.end()) for m in candidate(trained).finditer(text)]
    base += [("hex", a + m.start(), a + m.end()) for a, b in tokens if b - a >= 32 for m in HEX.finditer(text[a:b])]
    order = {k: i for i, k in enumerate(BASE)}
    digests = [m.span() for m in DIGEST.finditer(text)] if "sha" in low or "md5" in low else []
    taken = sorted([(a, b) for _, a, b in base] + digests)
    found = []
    for k, a, b in base:
        score = likeliest(text[a:b] if k != "assign" else ASSIGN.match(text, a)[2], trained)[1]
        found.append((k, a, b, score if score > -math.inf else None))
    named = lambda kind: kind if kind not in BASE else f"{kind}_like"
    apart: list[list[int]] = []  # the base spans and digests, joined where they overlap
    for a, b in taken:
        if apart and a < apart[-1][1]:
            apart[-1][1] = max(apart[-1][1], b)
        else:
            apart.append([a, b])
    i = 0
    for a, b in tokens:
        while i < len(apart) and apart[i][1] <= a:
            i += 1
        if i == len(apart) or apart[i][0] >= b:
            kind, score = likeliest(text[a:b], trained)
            if score >= least:
                found.append((named(kind), a, b, score))
                continue
            if encoded(text[a:b], trained):
                continue
        stretches: list[list[tuple[int, int]]] = [[]]
        j = i
        for m in PART.finditer(text, a, b):
            between = False
            while j < len(apart) and apart[j][1] <= m.start():
                j, between = j + 1, True
            clear = j == len(apart) or apart[j][0] >= m.end()
            if between or not clear:
                stretches.append([])
            if clear:
                stretches[-1].append(m.span())
        for parts in stretches:
            found += [(named(k), *x) for k, *x in within(text, parts, trained, least)]
    return sorted(found, key=lambda x: (x[1], order.get(x[0], len(order)), x[0]))


def find(df: DataFrame, text: str = "text", into: str = "secrets", least: float = LEAST_SCORE) -> DataFrame:
    """Adds an array column `into` of struct kind, start, end, score by start, then kind; a column of that name is
    replaced. score is null for base spans of a length that no format has. Null and empty texts have no spans; others are
    read whole whatever their length, in time in proportion to it; repeated rows get the same spans, an empty table gives
    no rows. The automata are trained where the job is planned, from a fixed seed, and sent along (a few dozen states)."""
    trained = models()

    @F.arrow_udf("array<struct<kind:string,start:int,end:int,score:double>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        for batch in batches:
            yield pa.array([[dict(zip(("kind", "start", "end", "score"), x, strict=True)) for x in scan(t, trained, least)] if t else [] for t in batch.to_pylist()], kind)

    return df.withColumn(into, run(df[text].cast("string")))
