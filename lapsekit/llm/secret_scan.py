"""Secrets in texts: base patterns, and a linear-chain conditional random field that adds spans.

Base patterns give the kinds assign, access and hex. The field tags every token of every
line. Its features are the token's shape (character classes, length, share of digits,
changes of class), the words and marks beside it (credential words, assignment signs,
quotes) and whether space parts it from them, and of the file how much of it looks like
code. Tags are begin, inside and outside; training maximises the likelihood by gradient
steps over forward-backward expectations, decoding is by Viterbi, many lines side by side.

The field is fitted on the driver, on a bounded set: ``MADE_ROWS`` made-up lines (with
a fixed seed) and at most ``SAMPLE_STRETCHES`` stretches from about ``SAMPLE_ROWS``
random documents, labelled by the base patterns, in parts of at most ``LONGEST``
tokens (those with a base span or an interesting token, and some of the others). All
documents are scanned whole, whatever the length of a line.

Spans are kind:start:end in code points, end exclusive, by start, then kind. Those of
the field (kind crf) that touch a base span are left out: base spans stay as they are.
Null text counts as empty. Each row is scanned by itself; only the text is read.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapsekit.llm.common import map_slices

KINDS = ("assign", "access", "hex", "crf")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the runs of [0-9a-f]+ that are long enough
Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Matches of the base patterns, leftmost and non-overlapping within a kind."""
    out: list[Span] = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


# ---- stretches of tokens and their features ----------------------------------
TOKEN = re.compile(r"[\w+/-]+|[^\w\s]")
DIGIT, LONG = re.compile(r"[0-9]"), re.compile(r"[\w+/-]{32,}")
CREDENTIAL = frozenset("""password passwd pwd pass secret token key apikey api_key api auth authorization bearer
credential credentials access private client_secret signature sig login""".split())


def _in_token(ch: str) -> bool:
    return ch.isalnum() or ch in "_+/-"


def interesting(text: str) -> list[tuple[int, int]]:
    """Places of the tokens of eight characters or more with a digit, or of 32 or more. The scan does not ask for them."""
    found, end, n = [], 0, len(text)
    for m in DIGIT.finditer(text):
        if m.start() < end:
            continue
        start = m.start()
        while start > end and _in_token(text[start - 1]):
            start -= 1
        end = m.end()
        while end < n and _in_token(text[end]):
            end += 1
        if end - start >= 8:
            found.append((start, end))
    if LONG.search(text):
        have = set(found)
        found = sorted(have | {m.span() for m in LONG.finditer(text)})
    return found


def stretches(text: str) -> Iterator[list[tuple[str, int, int]]]:
    """Every line's (token, start, end)."""
    run: list[tuple[str, int, int]] = []
    for m in TOKEN.finditer(text):
        if run and "\n" in text[run[-1][2]:m.start()]:
            yield run
            run = []
        run.append((m[0], m.start(), m.end()))
    if run:
        yield run


def shape(token: str) -> list[str]:
    n = len(token)
    classes = ["U" if c.isupper() else "l" if c.islower() else "d" if c.isdigit() else "s" for c in token[:256]]
    kinds = "".join(sorted(set(classes)))
    size = next((i for i, top in enumerate((2, 4, 8, 12, 16, 20, 24, 32, 48)) if n < top), 9)
    digits = classes.count("d") / len(classes)
    changes = sum(a != b for a, b in zip(classes, classes[1:], strict=False)) / max(1, len(classes) - 1)
    hexed = n >= 8 and all(c in "0123456789abcdefABCDEF" for c in token[:256])
    return [f"k={kinds}", f"n={size}", f"kn={kinds}{size}", f"d={int(digits * 4)}", f"c={int(changes * 5)}",
            f"kc={kinds}{int(changes * 5)}{size}", f"x={hexed}{size}"]


def file_kind(text: str) -> str:
    """How much of the text looks like code: marks of code by length."""
    marks = sum(map(text.count, "={}();<>"))
    share = marks / max(1, len(text))
    return "f=" + ("prose" if share < 0.005 else "mixed" if share < 0.02 else "code")


KINDS_OF_FILE = ("f=prose", "f=mixed", "f=code")
GAP = "01<"  # before a token: none, space, start of the line; behind it, the last is its end


def own(token: str, kind: str) -> list[str]:
    """Features of a token by itself."""
    w, shapes = token.lower(), shape(token)
    return [*shapes, kind, f"{kind}{shapes[2]}", f"w={w if w in CREDENTIAL or len(w) < 3 else '.'}"]


def behind(token: str) -> str:
    """The feature of the token after this one."""
    w = token.lower()
    return f"-1={w if len(w) < 3 or w in CREDENTIAL else shape(token)[2]}"


def ahead(token: str) -> str:
    """The feature of the token before this one."""
    return f"+1={token.lower() if len(token.lower()) < 3 else '.'}"


def beside(big: str, near: bool, sign: bool, gap: int) -> list[str]:
    """Features of a token's surroundings, with its kind and size."""
    near, sign = ("yes" if near else "no"), ("yes" if sign else "no")
    return [f"near={near}", f"sign={sign}", f"near={near}{sign}{big}", f"g={GAP[gap]}{near}{sign}",
            f"gk={GAP[gap]}{big}"]


def is_credential(token: str) -> bool:
    w = token.lower()
    return w in CREDENTIAL or any(c in w for c in ASSIGN_WORDS)


def features(run: list[tuple[str, int, int]], kind: str) -> list[list[str]]:
    out = []
    last = len(run) - 1
    for i, (token, start, end) in enumerate(run):
        before = 2 if not i else int(run[i - 1][2] < start)
        after = 2 if i == last else int(end < run[i + 1][1])
        near = any(is_credential(t) for t, _, _ in run[max(0, i - 4):i])
        sign = any(t in "=:" for t, _, _ in run[max(0, i - 3):i])
        out.append([*own(token, kind), *beside(shape(token)[2], near, sign, before), f"gg={GAP[before]}{GAP[after]}",
                    behind(run[i - 1][0]) if i else "-1=<", ahead(run[i + 1][0]) if i < last else "+1=>"])
    return out


# ---- the field ---------------------------------------------------------------
OUT, BEGIN, INSIDE = 0, 1, 2
NEVER = -1e4


class Field:
    """Weights of features by tag, and of neighbouring tags."""

    def __init__(self, names: dict[str, int], weights: np.ndarray, steps: np.ndarray):
        self.names, self.weights, self.steps = names, weights, steps
        self._tokens: _Tokens | None = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_tokens": None}

    def weight(self, feats: list[str]) -> np.ndarray:
        return self.weights[[k for x in feats if (k := self.names.get(x)) is not None]].sum(axis=0)

    def emissions(self, feats: list[list[str]]) -> np.ndarray:
        return np.array([self.weight(f) for f in feats])

    def decode(self, feats: list[list[str]]) -> list[int]:
        """The best tags (Viterbi); inside only after begin or inside."""
        e = self.emissions(feats)
        score = e[0].copy()
        score[INSIDE] = NEVER
        back = []
        for row in e[1:]:
            s = score[:, None] + self.steps
            back.append(s.argmax(axis=0))
            score = s.max(axis=0) + row
        tags = [int(score.argmax())]
        for b in reversed(back):
            tags.append(int(b[tags[-1]]))
        return tags[::-1]

    def tag(self, texts: list[str]) -> list[tuple[list[tuple[int, int]], np.ndarray]]:
        """(start, end) and tag of every token of each text."""
        return [(list(zip(start.tolist(), end.tolist(), strict=True)), tags) for start, end, tags in self.tagged(texts)]

    def tagged(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Starts, ends and tags of the tokens of each text: the emissions of ``features`` from tables of the
        distinct tokens, and the best path of every line."""
        if self._tokens is None or len(self._tokens) > MOST_TOKENS or len(self._tokens.known) > MOST_TOKENS // 10:
            self._tokens = _Tokens(self)
        known = self._tokens
        start, end, line = token_places("\n".join(texts))  # no token and no line goes over a line feed
        total = len(start)
        if not total:
            none = np.empty(0, np.int64)
            return [(none, none, np.empty(0, np.int8)) for _ in texts]
        tok = np.fromiter(map(known.__getitem__, chain.from_iterable(map(TOKEN.findall, texts))), np.int64, total)
        at = np.cumsum([0] + [len(t) + 1 for t in texts])  # where each text starts
        first = np.searchsorted(start, at)
        kind = np.repeat([KINDS_OF_FILE.index(file_kind(t)) for t in texts], np.diff(first))
        joined = line[1:] == line[:-1]
        before, after = np.full(total, 2), np.full(total, 2)
        before[1:][joined] = after[:-1][joined] = (end[:-1] < start[1:])[joined]

        def lately(flag: np.ndarray, reach: int) -> np.ndarray:
            got, on = np.zeros(total, bool), np.flatnonzero(flag)
            for k in range(1, reach + 1):
                on = on[on < total - k]
                got[on[line[on] == line[on + k]] + k] = True
            return got

        local, behind_, ahead_, big, credential, marks = (known.column(k) for k in range(6))
        near, sign = lately(credential[tok], 4), lately(marks[tok], 3)
        e = local.reshape(-1, 3).take(tok * len(KINDS_OF_FILE) + kind, axis=0)
        e += np.array(known.beside).reshape(-1, 3).take(((big[tok] * 2 + near) * 2 + sign) * 3 + before, axis=0)
        e += known.gaps.reshape(-1, 3).take(before * 3 + after, axis=0)
        end_row = len(behind_)  # the edges of lines stand behind the tokens' rows
        side = np.full(total, end_row)
        side[1:] = np.where(joined, tok[:-1], end_row)
        e += np.vstack([behind_, known.edges[:1]]).take(side, axis=0)
        side[-1] = end_row
        side[:-1] = np.where(joined, tok[1:], end_row)
        e += np.vstack([ahead_, known.edges[1:]]).take(side, axis=0)
        tags = self._paths(e, np.flatnonzero(np.concatenate([[True], ~joined])))
        return [(start[a:b] - t, end[a:b] - t, tags[a:b])
                for a, b, t in zip(first[:-1].tolist(), first[1:].tolist(), at[:-1].tolist(), strict=True)]

    def _paths(self, e: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The best tags of all lines, which begin at ``starts``."""
        lengths = np.diff(np.append(starts, len(e)))
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        live = np.searchsorted(-lengths, -np.arange(lengths[0]), "left")  # lines longer than k
        back, tags = np.zeros(e.shape, np.int8), np.zeros(len(e), np.int8)
        score = e[starts].copy()
        score[:, INSIDE] = NEVER
        k = 1
        while k < lengths[0] and (n := live[k]) > FEW_LINES:
            at = starts[:n] + k
            s0, s1, s2 = (score[:n, a, None] + self.steps[a] for a in range(3))
            best = np.maximum(s0, s1)
            back[at] = np.where(s2 > best, 2, s1 > s0)
            score[:n] = np.maximum(best, s2) + e[at]
            k += 1
        now = score.argmax(axis=1)
        for i in range(live[k] if k < lengths[0] else 0):  # the longest lines' ends, line by line
            rest = slice(starts[i] + k, starts[i] + lengths[i])
            now[i], tags[rest] = self._rest(score[i].tolist(), e[rest])
        tags[starts + np.minimum(lengths, k) - 1] = now
        for k in range(k - 1, 0, -1):
            n = live[k]
            now[:n] = back[starts[:n] + k, now[:n]]
            tags[starts[:n] + k - 1] = now[:n]
        return tags

    def _rest(self, score: list[float], e: np.ndarray) -> tuple[int, np.ndarray]:
        """How a line goes on from ``score``: the tag before ``e`` and those in it. The same sums as for many lines."""
        (oo, ob, oi), (bo, bb, bi), (io, ib, ii) = self.steps.tolist()
        x, y, z = score
        back = bytearray()
        for at in range(0, len(e), SLICE):
            for o, b, i in e[at:at + SLICE].tolist():
                p, q, r = x + oo, y + bo, z + io
                f = q > p
                best = q if f else p
                if r > best:
                    f, best = 2, r
                p, q, r = x + ob, y + bb, z + ib
                g = q > p
                begin = q if g else p
                if r > begin:
                    g, begin = 2, r
                p, q, r = x + oi, y + bi, z + ii
                h = q > p
                inside = q if h else p
                if r > inside:
                    h, inside = 2, r
                back.append(f + 4 * g + 16 * h)
                x, y, z = best + o, begin + b, inside + i
        now = OUT if x >= y and x >= z else BEGIN if y >= z else INSIDE
        tags = bytearray(len(back))
        for k in range(len(back) - 1, -1, -1):
            tags[k] = now
            now = back[k] >> 2 * now & 3
        return now, np.frombuffer(tags, np.int8)


FEW_LINES = 24  # so many lines and fewer are decoded one by one
SLICE = 4096  # tokens that are Python values at once
MOST_TOKENS = 300_000  # distinct tokens that a worker keeps
HEXED = re.compile(r"[0-9a-fA-F]{8,}")
ANY_WORD = re.compile("|".join(ASSIGN_WORDS))


class _Classes(dict):
    """Class of a character as ``shape`` has it, by code point."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        self[code] = out = "U" if c.isupper() else "l" if c.islower() else "d" if c.isdigit() else "s"
        return out


CLASSES = _Classes()


def signature(token: str) -> tuple:
    """What the features of a token depend on, made without the features."""
    w = token.lower()
    special = w if len(w) < 3 or w in CREDENTIAL else ANY_WORD.search(w) is not None
    head = token[:256]
    return special, head.translate(CLASSES), min(len(token), 257), HEXED.fullmatch(head) is not None


@cache
def code_points() -> np.ndarray:
    """Of every code point: 0 space, 1 part of a long token, 2 a token by itself (as ``TOKEN`` has them)."""
    every = "".join(map(chr, range(0x110000)))
    out = np.full(len(every), 2, np.int8)
    for kind, part in ((0, r"\s+"), (1, r"[\w+/-]+")):
        for m in re.finditer(part, every):
            out[m.start():m.end()] = kind
    return out


def token_places(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and line (a number) of every token."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = code_points()[codes]
    there, inner = kind != 0, (kind[1:] == 1) & (kind[:-1] == 1)  # inner: the token goes on
    starts, ends = there.copy(), there
    starts[1:] &= ~inner
    ends[:-1] &= ~inner
    start = np.flatnonzero(starts)
    return start, np.flatnonzero(ends) + 1, np.searchsorted(np.flatnonzero(codes == 10), start)


class _Tokens(dict):
    """Rows of tokens in tables of weights under a field, one row a signature."""

    def __init__(self, field: Field):
        self.field = field
        self.known: dict[tuple, int] = {}
        self.rows: list[tuple] = []
        self.bigs: dict[str, int] = {}
        self.tables: dict[int, np.ndarray] = {}
        self.gaps = np.array([[field.weight([f"gg={a}{b}"]) for b in GAP] for a in GAP])
        self.edges = (field.weight(["-1=<"]), field.weight(["+1=>"]))
        self.beside: list[np.ndarray] = []

    def __missing__(self, token: str) -> int:
        key = signature(token)
        row = self.known.get(key)
        if row is None:
            row = self.known[key] = len(self.rows)
            self.rows.append(self._row(token))
        self[token] = row
        return row

    def _row(self, token: str) -> tuple:
        big, weight = shape(token)[2], self.field.weight
        if big not in self.bigs:
            self.bigs[big] = len(self.bigs)
            self.beside.append(np.array([[[weight(beside(big, bool(a), bool(b), g)) for g in range(3)]
                                          for b in range(2)] for a in range(2)]))
        return (np.array([weight(own(token, k)) for k in KINDS_OF_FILE]), weight([behind(token)]),
                weight([ahead(token)]), self.bigs[big], is_credential(token), token in "=:")

    def column(self, k: int) -> np.ndarray:
        have = self.tables.get(k)
        if have is None or len(have) < len(self.rows):
            new = np.array([r[k] for r in self.rows[0 if have is None else len(have):]])
            self.tables[k] = new if have is None else np.concatenate([have, new])
        return self.tables[k]


def fit(runs: list[list[list[str]]], tags: list[list[int]], rounds: int = 80, rate: float = 0.15,
        ridge: float = 1e-3) -> Field:
    """Maximum likelihood with an L2 penalty, by Adam steps over all stretches at once."""
    count = Counter(x for r in runs for f in r for x in f)
    names = {x: k for k, x in enumerate(sorted(x for x, n in count.items() if n > 1))}
    order = sorted(range(len(runs)), key=lambda k: len(runs[k]))
    runs, tags = [runs[k] for k in order], [tags[k] for k in order]
    most, width = max(map(len, runs)), max(len(f) for r in runs for f in r)
    n = len(names)
    idx = np.full((len(runs), most, width), n)
    gold = np.zeros((len(runs), most), int)
    on = np.zeros((len(runs), most), bool)
    for s, (r, t) in enumerate(zip(runs, tags, strict=True)):
        on[s, :len(r)], gold[s, :len(r)] = True, t
        for i, f in enumerate(r):
            known = [names[x] for x in f if x in names]
            idx[s, i, :len(known)] = known
    flat, live = idx[on], on.sum()
    w, step = np.zeros((n + 1, 3)), np.zeros((3, 3))
    ban = np.zeros((3, 3))
    ban[OUT, INSIDE] = NEVER
    truth_w = np.stack([np.bincount(flat[gold[on] == c].ravel(), minlength=n + 1) for c in range(3)], 1).astype(float)
    pairs = on[:, 1:] & on[:, :-1]
    truth_s = np.zeros((3, 3))
    np.add.at(truth_s, (gold[:, :-1][pairs], gold[:, 1:][pairs]), 1)
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(step), np.zeros_like(step)]

    def lse(x: np.ndarray, axis: int) -> np.ndarray:
        m = x.max(axis=axis, keepdims=True)
        return (m + np.log(np.exp(x - m).sum(axis=axis, keepdims=True))).squeeze(axis)

    for t in range(1, rounds + 1):
        e = np.zeros((*on.shape, 3))
        e[on] = w[flat].sum(axis=1)
        trans = step + ban
        fwd = np.zeros_like(e)
        fwd[:, 0] = e[:, 0] + [0, 0, NEVER]
        for i in range(1, most):
            new = lse(fwd[:, i - 1, :, None] + trans, 1) + e[:, i]
            fwd[:, i] = np.where(on[:, i, None], new, fwd[:, i - 1])
        bwd = np.zeros_like(e)
        for i in range(most - 2, -1, -1):
            new = lse(trans[None] + (e[:, i + 1] + bwd[:, i + 1])[:, None, :], 2)
            bwd[:, i] = np.where(on[:, i + 1, None], new, 0.0)
        z = lse(fwd[:, -1], 1)
        marginal = np.exp(fwd + bwd - z[:, None, None])
        expect_w = np.stack([np.bincount(flat.ravel(), np.repeat(marginal[..., c][on], width), n + 1) for c in range(3)], 1)
        joint = np.exp(fwd[:, :-1, :, None] + trans + (e[:, 1:] + bwd[:, 1:])[:, :, None, :] - z[:, None, None, None])
        expect_s = joint[pairs].sum(axis=0)
        for k, (x, g) in enumerate(((w, (truth_w - expect_w) / live - ridge * w), (step, (truth_s - expect_s) / live - ridge * step))):
            m, v = moments[2 * k], moments[2 * k + 1]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x += rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
        w[n] = 0
    return Field(names, w[:n], step + ban)


# ---- training rows -----------------------------------------------------------
MADE_ROWS, SAMPLE_ROWS, SAMPLE_STRETCHES, LONGEST = 2000, 2000, 2000, 64  # of the training set; LONGEST in tokens
ALNUM = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


def made_line(rnd: random.Random) -> tuple[str, list[tuple[int, int]]]:
    """A made-up line and the places of its secrets."""
    pick = lambda chars, lo, hi: "".join(rnd.choice(chars) for _ in range(rnd.randint(lo, hi)))
    word = lambda: pick("abcdefghijklmnopqrstuvwxyz", 2, 10)
    prose = lambda: " ".join(word() for _ in range(rnd.randint(1, 6)))
    secret = rnd.choice([
        lambda: pick(ALNUM, 20, 48) + pick("0123456789", 1, 2), lambda: pick("0123456789abcdef", 16, 64),
        lambda: "AKIA" + pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 16, 16),
        lambda: rnd.choice(["ghp_", "sk-", "xoxb-", "glpat-", "pk_live_", "AIza"]) + pick(ALNUM, 20, 40) + "7",
        lambda: pick(ALNUM + "+/", 32, 60) + "9", lambda: pick(ALNUM[:52], 16, 40)])()
    if rnd.random() < 0.5:  # no secret: other things with digits
        other = rnd.choice([
            lambda: f"{word()}.{rnd.randint(1, 99)}@{word()}{rnd.randint(1, 9)}.example.com",
            lambda: ".".join(str(rnd.randint(1, 255)) for _ in range(4)), lambda: pick("0123456789", 8, 16),
            lambda: "-".join(pick("0123456789", 3, 4) for _ in range(rnd.randint(3, 4))),
            lambda: f"+{rnd.randint(1, 99)} {pick('0123456789', 3, 4)} {pick('0123456789', 6, 8)}",
            lambda: f"20{rnd.randint(10, 30)}-{rnd.randint(10, 12)}-{rnd.randint(10, 28)}T10:00:00",
            lambda: f"https://{word()}.example.com/{word()}/{rnd.randint(1000, 99999999)}",
            lambda: f"{word()}{rnd.randint(1, 99999)}{word()}", lambda: pick("abcdefghijklmnopqrstuvwxyz", 32, 45),
            lambda: f"v{rnd.randint(1, 9)}.{rnd.randint(0, 20)}.{rnd.randint(0, 99)}-beta{rnd.randint(1, 9)}",
            lambda: "".join(word().capitalize() for _ in range(rnd.randint(1, 4))),
            lambda: f"{word()}, {word()}! ({word()}) #{rnd.randint(1, 99)} & {word()}",
            lambda: f"{rnd.choice(sorted(CREDENTIAL))}{rnd.choice([': ', ' = ', ' '])}{word()}"])()
        return f"{prose()} {other} {prose()}", []
    lead = rnd.choice([
        lambda: f"{rnd.choice(['password', 'secret', 'token', 'api_key', 'apikey', 'key', 'pwd', 'auth'])}"
                f"{rnd.choice(['=', ': ', ' = ', ':'])}{rnd.choice(['', chr(34), chr(39)])}",
        lambda: "Authorization: Bearer ", lambda: f"{prose()} ", lambda: f"export {word().upper()}_KEY=",
        lambda: f"{word()}: "])()
    if rnd.random() < 0.15:  # punctuated, behind a credential word
        secret = rnd.choice(ALNUM) + pick(ALNUM + "$!#%&*@^~?_", 9, 24) + rnd.choice(ALNUM)
        lead = f"{rnd.choice(['pwd', 'pass', 'key', 'auth', 'login', 'password'])}{rnd.choice(['=', ': ', ' = ', ':'])}"
    text = f"{prose()} {lead}"
    tail = lead[-1] if lead[-1] in "\"'" else ""
    return f"{text}{secret}{tail} {prose()}", [(len(text), len(text) + len(secret))]


def labelled(text: str, spans: list[tuple[int, int]]) -> Iterator[tuple[list[list[str]], list[int]]]:
    """(features, tags) of the text's stretches; tokens within a span are begin, then inside."""
    kind = file_kind(text)
    for run in (whole[k:k + LONGEST] for whole in stretches(text) for k in range(0, len(whole), LONGEST)):
        tags, current = [], None
        for _, s, e in run:
            inside = next((k for k, (a, b) in enumerate(spans) if a <= s and e <= b), None)
            tags.append(OUT if inside is None else INSIDE if inside == current else BEGIN)
            current = inside
        yield features(run, kind), tags


def secret_part(text: str, span: Span) -> tuple[int, int]:
    """The secret itself: of an assignment its value."""
    if span[0] == "assign" and (m := ASSIGN.match(text, span[1])):
        return m.span(2)
    return span[1], span[2]


def sampled(docs: DataFrame, text: str = "text", seed: int = 11) -> list:
    """At most ``SAMPLE_STRETCHES`` stretches (t, spans, kind) of about ``SAMPLE_ROWS`` texts. They are chosen by hashes
    of texts and stretches, so the sample does not depend on the partitioning; copies of a text count once."""
    total = docs.count()
    if not total:
        return []

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for t in b["t"]:
                spans = [secret_part(t, s) for s in base_spans(t)]
                places = spans + interesting(t)
                for i, run in enumerate(x[k:k + LONGEST] for x in stretches(t) for k in range(0, len(x), LONGEST)):
                    lo, hi = run[0][1], run[-1][2]
                    if i % 16 and not any(lo <= a and b <= hi for a, b in places):
                        continue
                    out.append((t[lo:hi], [x - lo for s in spans if lo <= s[0] and s[1] <= hi for x in s], file_kind(t)))
            yield pd.DataFrame(out, columns=["t", "spans", "kind"])

    share = F.pmod(F.xxhash64("t", F.lit(seed)), F.lit(1 << 30)) < F.lit(int(min(1.0, SAMPLE_ROWS / total) * (1 << 30)))
    texts = docs.select(F.col(text).alias("t")).filter("t is not null").filter(share).distinct()
    found = texts.mapInPandas(parts, "t string, spans array<int>, kind string")
    return found.orderBy(F.xxhash64("t", "kind"), "t", "kind", "spans").limit(SAMPLE_STRETCHES).collect()


def train(docs: DataFrame | None = None, text: str = "text", seed: int = 11) -> Field:
    """The field, fitted on made-up lines and a bounded sample of ``docs``."""
    rnd = random.Random(seed)
    pairs = [p for _ in range(MADE_ROWS) for p in labelled(*made_line(rnd))]
    for r in sampled(docs, text, seed) if docs is not None else []:
        spans = list(zip(r["spans"][::2], r["spans"][1::2], strict=True))
        pairs += [([[r["kind"] if x.startswith("f=") else x for x in f] for f in feats], tags)
                  for feats, tags in labelled(r["t"], spans)]
    return fit([p[0] for p in pairs], [p[1] for p in pairs])


GROUP_CHARS = 3_000_000  # of texts tagged at once


def groups(texts: list[str | None]) -> Iterator[list[str]]:
    """The texts in order, in runs of bounded length."""
    group: list[str] = []
    chars = 0
    for t in texts:
        if group and chars + len(t or "") > GROUP_CHARS:
            yield group
            group, chars = [], 0
        group.append(t or "")
        chars += len(t or "")
    if group:
        yield group


def spans_of_all(texts: list[str | None], field: Field) -> Iterator[list[Span]]:
    """The spans that the field finds in each text."""
    for group in groups(texts):
        for start, end, tags in field.tagged(group):
            out: list[Span] = []
            for i in np.flatnonzero(tags == BEGIN).tolist():
                k = i + 1
                while k < len(tags) and tags[k] == INSIDE:
                    k += 1
                out.append(("crf", int(start[i]), int(end[k - 1])))
            yield out


def field_spans(text: str, field: Field) -> list[Span]:
    """The spans that the field finds."""
    return next(spans_of_all([text], field))


def with_base(text: str | None, found: list[Span]) -> list[Span]:
    """The base spans, and what those of the field cover beside them: of a span that reaches beyond base spans, the
    stretches outside that hold a letter or digit."""
    if not text:
        return []
    base = base_spans(text)
    added: list[Span] = []
    for kind, start, end in found:
        at = start
        for _, b, e in sorted((b for b in base if b[1] < end and b[2] > start), key=lambda b: b[1]):
            if b > at:
                added.append((kind, at, b))
            at = max(at, e)
        if at < end:
            added.append((kind, at, end))
    added = [s for s in added if any(c.isalnum() for c in text[s[1]:s[2]])]
    return sorted(base + added, key=lambda s: (s[1], KINDS.index(s[0])))


def all_spans(text: str | None, field: Field) -> list[Span]:
    return with_base(text, field_spans(text or "", field))


def spans_column(text: Column, field: Field) -> Column:
    """All spans of a text as kind:start:end, joined by commas."""
    @F.pandas_udf("string")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series([",".join(f"{k}:{s}:{e}" for k, s, e in with_base(t, found))
                             for t, found in zip(b, spans_of_all(b.tolist(), field), strict=True)], dtype=object)

    return scan(text)


def redact(docs: DataFrame, field: Field, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret (of an assignment its value) in ``text`` replaced by ``mark``."""
    def clean(t: str | None, found: list[Span]) -> str | None:
        spans = with_base(t, found)
        if not spans:
            return t
        out, at = [], 0
        for s, e in sorted(secret_part(t, x) for x in spans):
            if e <= at:
                continue
            if s > at or not out:  # what goes on where the last one ended is part of it
                out += [t[at:s], mark]
            at = e
        return "".join([*out, t[at:]])

    return map_slices(docs, docs.schema, lambda part: {
        **part, text: [clean(t, x) for t, x in zip(part[text], spans_of_all(part[text], field), strict=True)]})


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", field: Field | None = None) -> DataFrame:
    """doc_id and spans of every row."""
    field = field or train(docs, text)
    return docs.select(F.col(doc_id).alias("doc_id"), spans_column(F.col(text), field).alias("spans"))
