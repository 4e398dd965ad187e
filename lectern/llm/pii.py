"""Personal data: patterns, and a linear-chain conditional random field over word shapes.

The patterns find what is exactly formed. The field is trained from LABELLED, a small table of
annotated lines, and labels all words of a text; Viterbi runs in numpy over a batch of texts at
once. Its spans are added where no pattern's span is.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterable, Iterator
from functools import cache, cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "secret")
BASE = KINDS[:4]

# -- patterns ------------------------------------------------------------------

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match never begins within a run of digits, so looking there again would only cost time
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[^0-9]+")
DOUBLED = {str(d): str(sum(divmod(2 * d, 10))) for d in range(10)}


def luhn(digits: str) -> bool:
    return sum(int(DOUBLED[c]) if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each at-sign back over the name and on over the domain: linear for any text."""
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in LOCAL:
            begin -= 1
        match = DOMAIN.match(text, at) if begin < at else None
        if match:
            done = match.end()
            yield begin, done
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(begin, end, kind) in code points, by begin, then kind in the order of KINDS."""
    found = [(a, b, "email") for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(len(x := p.lstrip("0")) <= 3 and int(x or 0) <= 255 for p in m[0].split(".")):
            found.append((*m.span(), "ip"))
    for m in CARD.finditer(text):
        if m.end() - m.start() < 38 and 12 <= len(d := DIGITS.sub("", m[0])) <= 19 and luhn(d):
            found.append((*m.span(), "card"))
    for m in PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(DIGITS.sub("", m[0])) <= 15:
            found.append((*m.span(), "phone"))
    return sorted(found, key=in_order)


def in_order(span: tuple[int, int, str]) -> tuple[int, int, int]:
    return span[0], KINDS.index(span[2]), span[1]


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


# -- labelled lines ------------------------------------------------------------

#: What the field learns from: [kind|text] is a span, all else is none.
LABELLED = """
write to [email|anna.berg@mail.example.org] for the list
Kontakt: [email|k.lang@post.example.de], danke
mail [email|jo22 at example dot com] or come by
reach us: [email|info (at) example.net] any day
[email|sales@localhost] takes orders
voir [email|marie@exemple] pour la suite
escriba a [email|ana_ruiz@correo.example.es] hoy
the old box [email|r2@mail] is closed
server [ip|10.20.30.40] was down
from [ip|192.168.7.15]:8080 to the proxy
host [ip|172.16.254.1], port 22
der Rechner [ip|8.8.4.4] antwortet
la machine [ip|203.0.113.77] ne va pas
connect [ip|fe80::1ff:fe23:4567] now
paid with [card|4111 1111 1111 1111] on Monday
Karte [card|5500-0000-0000-0004] gesperrt
number [card|4012888888881881] was used
la carte [card|3782 822463 10005] est prise
charged [card|6011000990139424] twice
his card 6011 [card|6011000400000000] today
the numbers [card|4917610000000000] of that
then [card|6304000000000000] or another
call [phone|+1 (415) 555-0134] after six
ring [phone|(212) 555-0187] or wait
Tel. [phone|030 5550 1234], bitte
phone [phone|415-555-0199] at noon
appelez le [phone|01 55 50 12 34] demain
llame al [phone|+34 915 550 123] pronto
fax [phone|555-0142-77] only
mobile [phone|+44 7700 900123] works
key = [secret|9f86d081884c7d659a2feaa0c55ad015a3bf4f1b]
token = "[secret|b5bb9d8014a0f9b1d61e21e796d78dccdf1350c9]" of the job
token = "[secret|0a4d55a8d778e5022fab701977c5d840bbc486d0]" and more
password: [secret|hX9k2LmQ7vT4zR8w] then
api_key=[secret|AKq83kd02mfnw91xZpq7] in the file
secret [secret|d41d8cd98f00b204e9800998ecf8427e] leaked
in 1998 there were 25 of them
on 12 May 2004 at 10:30 they met
version 3.0 of the license
Licensed under the Apache License, Version 2.0.
the GNU General Public License, version 3.
under CC BY-NC 4.0.
page 117, line 4, of 350
it cost $1,299.95 or 15% less
Kapitel 3 und Absatz 12
chapitre 7 de la loi 2011-45
room 404 on floor 12
from 1914 to 1918
a 3.5 by 2.25 inch part
the score was 21-17 after 90 minutes
section 4.1.2 and table 17
about 10,000,000 people in 2020
el 25 de marzo de 1987
10 20 30 40 50 60
1. first 2. second 3. third
ISBN 978 in 2 volumes
follow @someone and @other on it
meet @ noon, room 7
x1 = y2 + z3 * 10
the 1990s and the 20th century
100 mg twice a day for 14 days
add 250 g of it and 2 eggs
""".strip().splitlines()

# -- words and features ----------------------------------------------------------

WORD = re.compile(r"\w+|[^\w\s]")
HEX = re.compile(r"(?=[0-9a-fA-F]*[0-9])(?=[0-9a-fA-F]*[a-fA-F])[0-9a-fA-F]{16,}\Z")
TRIGGER = re.compile(r"[0-9@]")
SPACE = re.compile(r"\s")
NOT_OF_WORDS = re.compile(r"\W")
#: What makes an added span one of its kind, by what it holds: numbers are written with digits (an ip also with colons),
#: an address with a digit, an at-sign or the words for it (name, at, host, dot), and a secret may look like anything.
HOLDS = {
    "email": re.compile(r"[0-9@]|[\w.%+-]\W{0,3}\bat\b\W{0,3}[\w-]{1,63}\W{0,3}(?:\.|\bdot\b)\W{0,3}\w", re.IGNORECASE),
    "ip": re.compile(r"[0-9@]|:[a-f]*:", re.IGNORECASE),
    "card": TRIGGER, "phone": TRIGGER, "secret": re.compile(""),
}
#: Characters of context on either side of a digit or at-sign, at least.
AROUND = 48
#: Characters that are cut into words, and words that are scored, at once; spans are the same with any value.
LONGEST = 1 << 16
#: Characters of texts that go through Viterbi together, at least if a task has them: more texts in step, fewer steps.
GATHERED = 8_000_000
#: Words before and behind a word that its features look at.
BEFORE, BEHIND = 3, 2
#: Words stand as "^" in features where a text has none. They are put behind each text, and so before the next.
PAD = " ^" * max(BEFORE, BEHIND) + " "
#: Words whose shape and mark a task keeps, and the longest of them.
KEPT, KEPT_LONG = 1 << 17, 64


def tokens(text: str, begin: int, end: int) -> list[tuple[int, int]]:
    """Words without white space, where letters and digits run together if they do."""
    return [m.span() for m in WORD.finditer(text, begin, end)]


def shape(word: str) -> str:
    if word.isalpha():  # most words; the patterns below say the same
        if word.islower():
            return "x"
        if "A" <= word[0] <= "Z" and word[1:].islower():
            return "Xx"
    if HEX.match(word):
        return "hex"
    kinds = re.sub(r"[A-Z]+", "X", re.sub(r"[^\W\d_A-Z]+", "x", word))
    digits = re.sub(r"[0-9]+", lambda m: f"d{min(len(m[0]), 20) if len(m[0]) < 6 else 6 + (len(m[0]) > 9) + (len(m[0]) > 12) + (len(m[0]) > 19)}", kinds)
    return digits if len(digits) <= 8 else f"mixed{min(3, len(word) // 10)}"


def mark(word: str) -> str:
    return word.lower() if len(word) > 1 and word.isalpha() else word


def features(words: list[str], spaced: list[bool]) -> list[list[str]]:
    """Shapes of a word and of those near it, and whether white space stands before it."""
    shapes = [shape(w) for w in words]
    marks = [mark(w) for w in words]
    at = lambda xs, i: xs[i] if 0 <= i < len(xs) else "^"
    out = []
    for i in range(len(words)):
        near = [f"s{k}={at(shapes, i + k)}" for k in (-2, -1, 0, 1, 2)]
        near += [f"p={at(shapes, i - 1)}|{shapes[i]}", f"n={shapes[i]}|{at(shapes, i + 1)}", f"t={spaced[i]}|{shapes[i]}"]
        near += [f"w{k}={at(marks, i + k)}" for k in (-3, -2, -1, 0, 1)] + ["bias"]
        out.append(near)
    return out


def annotated(line: str) -> tuple[str, list[tuple[int, int, str]]]:
    text, spans, at = "", [], 0
    for m in re.finditer(r"\[(\w+)\|([^\]]*)\]", line):
        text += line[at : m.start()]
        spans.append((len(text), len(text) + len(m[2]), m[1]))
        text, at = text + m[2], m.end()
    return text + line[at:], spans


# -- the field -------------------------------------------------------------------

LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))


def may_follow() -> np.ndarray:
    """0 where a label may follow another, else minus infinity; the last row is the beginning."""
    out = np.zeros((len(LABELS) + 1, len(LABELS)))
    for j, label in enumerate(LABELS):
        if label[0] == "I":
            for i, before in enumerate((*LABELS, "^")):
                if before[1:] != label[1:]:
                    out[i, j] = -1e9
    return out


class Field:
    """weights: a row of label scores for each known feature; steps: scores from label to label."""

    def __init__(self, names: dict[str, int], weights: np.ndarray, steps: np.ndarray):
        self.names, self.weights, self.steps = names, weights, steps

    def emissions(self, rows: list[list[str]]) -> np.ndarray:
        known = [[self.names[f] for f in row if f in self.names] for row in rows]
        return np.array([self.weights[k].sum(axis=0) for k in known]).reshape(-1, len(LABELS))

    def __reduce__(self):
        return Field, (self.names, self.weights, self.steps)  # tables are made where they are read

    @cached_property
    def tables(self) -> Tables:
        return Tables(self.names, self.weights)

    def decode(self, stretches: list[np.ndarray]) -> list[np.ndarray]:
        """Best labels of each stretch, whose scores are given."""
        if not stretches:
            return []
        lengths = np.array([len(s) for s in stretches])
        first, scores = np.cumsum(lengths) - lengths, np.concatenate(stretches)
        return np.split(self.best(lengths, lambda k, t: scores[first[k] + t]), first[1:])

    def best(self, lengths: np.ndarray, scores: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
        """Best labels of sequences, one behind the other: Viterbi over all of them at once, one step a word.

        scores(k, t) gives the scores of words t of sequences k; it is asked for LONGEST words at a time. Only the
        way back is kept, a byte for each word and label.
        """
        n, order = self.steps.shape[1], np.argsort(-lengths, kind="stable")
        start, going = (np.cumsum(lengths) - lengths)[order], -lengths[order]
        # the longest come first, so the sequences that have a word t are the first active[t] of them
        active = np.searchsorted(going, -np.arange(lengths.max(initial=0)), "left")
        upto = np.concatenate([[0], np.cumsum(active)])
        bounds = [0]
        while bounds[-1] < len(active):
            bounds.append(max(bounds[-1] + 1, int(np.searchsorted(upto, upto[bounds[-1]] + LONGEST, "right")) - 1))
        moves, rank = self.steps[:-1, :, None], np.arange(n, 0, -1, dtype=np.uint8)[:, None, None]
        back, last = np.empty(n * upto[-1], np.uint8), np.empty(len(order), np.uint8)
        best = np.zeros((n, 0))
        for a, b in zip(bounds, bounds[1:]):
            times = np.repeat(np.arange(a, b), active[a:b])
            block = scores(order[np.arange(upto[a], upto[b]) - upto[times]], times)
            at, base = 0, int(upto[a])
            sizes = active[a : b + 1].tolist() + [0] * (b == len(active))
            for t, (k, after) in enumerate(zip(sizes, sizes[1:]), a):
                mine = block[at : at + k].T
                if t == 0:
                    best = self.steps[-1][:, None] + mine
                else:
                    paths = best[:, None, :k] + moves
                    most = paths.max(axis=0)
                    # the first label that is as good as any, counted from the end
                    np.max((paths == most) * rank, axis=0, out=back[n * (base + at) : n * (base + at + k)].reshape(n, k))
                    best = most + mine
                if after < k:
                    last[after:k] = best[:, after:k].argmax(axis=0)
                at += k
        out, now, end = np.zeros(upto[-1], np.uint8), last[:0], int(upto[-1])
        for a, b in zip(reversed(bounds[:-1]), reversed(bounds)):
            for t, k in zip(range(b - 1, a - 1, -1), reversed(active[a:b].tolist())):
                if k > len(now):
                    now = np.concatenate([now, last[len(now) : k]])
                out[start[:k] + t] = now
                if t:
                    now = n - back[n * (end - k) : n * end].reshape(n, k)[now, np.arange(k)]
                end -= k
        return out


class Tables:
    """Weights by numbers of shapes and marks: the scores of many words at once, without their features' names."""

    def __init__(self, names: dict[str, int], weights: np.ndarray):
        none = np.zeros(weights.shape[1])
        row = lambda feature: weights[names[feature]] if feature in names else none
        learnt = lambda kind: ["^", *sorted({f.split("=", 1)[1] for f in names if f[0] == kind} - {"^"})]
        shapes, marks = learnt("s"), learnt("w")
        # the last row of each is of all that is not learnt, which weighs nothing
        one = lambda name, known: np.array([*(row(f"{name}={x}") for x in known), none])
        two = lambda name, left: np.array([[*(row(f"{name}={a}|{b}") for b in shapes), none] for a in left] + [[none] * (len(shapes) + 1)])
        flat = lambda table: table.reshape(-1, len(none))
        self.shapes = len(shapes) + 1
        self.before = flat(two("p", shapes) + one("s-1", shapes)[:, None] + one("s0", shapes) + row("bias"))
        self.behind = flat(two("n", shapes) + one("s1", shapes))
        self.spaced = flat(two("t", (False, True)))
        self.far = {k: one(f"s{k}", shapes) for k in (-2, 2)}
        self.near = {k: one(f"w{k}", marks) for k in (-3, -2, -1, 0, 1)}
        self.words = Words({x: i for i, x in enumerate(shapes)}, {x: i for i, x in enumerate(marks)})

    def scores(self, words: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Scores of the words at these places of a row of words: numbers of Words, doubled, and one if white space stands before."""
        seen = {k: words[at + k] for k in range(-BEFORE, BEHIND + 1)}
        spaced, shapes = seen[0] & 1, {k: seen[k] >> (self.words.bits + 1) for k in (-2, -1, 0, 1, 2)}
        out = self.before[shapes[-1] * self.shapes + shapes[0]]
        out += self.behind[shapes[0] * self.shapes + shapes[1]]
        out += self.spaced[spaced * self.shapes + shapes[0]]
        for k, table in self.far.items():
            out += table[shapes[k]]
        for k, table in self.near.items():
            marks = seen[k] >> 1 & (1 << self.words.bits) - 1
            known = np.flatnonzero(marks < len(table) - 1)
            out[known] += table[marks[known]]
        return out


class Words(dict):
    """The number of a word's shape and mark; words that came lately are kept."""

    def __init__(self, shapes: dict[str, int], marks: dict[str, int]):
        super().__init__()
        self.shapes, self.marks, self.bits = shapes, marks, len(marks).bit_length()
        self.small = self.numbered("x", None)

    def numbered(self, form: str, name: str | None) -> int:
        return self.shapes.get(form, len(self.shapes)) << self.bits | self.marks.get(name, len(self.marks))

    def __missing__(self, word: str) -> int:
        # most new words are of small letters and not learnt
        number = self.small if word not in self.marks and word.isalpha() and word.islower() else self.numbered(shape(word), mark(word))
        if len(word) <= KEPT_LONG:
            if len(self) >= KEPT:
                self.clear()
            self[word] = number
        return number


def train(lines: list[str] = LABELLED, rounds: int = 150, penalty: float = 0.05, rate: float = 0.3) -> Field:
    """Gradient ascent on the likelihood of the labelled lines (forward and backward sums), Adagrad steps."""
    data, names = [], {}
    for text, spans in map(annotated, lines):
        places = tokens(text, 0, len(text))
        rows = features([text[a:b] for a, b in places], spacing(text, places))
        labels = []
        for a, b in places:
            inside = next(((s, k) for s, e, k in spans if s <= a and b <= e), None)
            labels.append(0 if inside is None else LABELS.index(("B-" if inside[0] == a else "I-") + inside[1]))
        data.append(([[names.setdefault(f, len(names)) for f in row] for row in rows], np.array(labels)))
    n, hard = len(LABELS), may_follow()
    weights, steps = np.zeros((len(names), n)), np.zeros((n + 1, n))
    seen_w, seen_s = np.full(weights.shape, 1e-2), np.full(steps.shape, 1e-2)
    for _ in range(rounds):
        up_w, up_s = -penalty * weights, -penalty * steps
        for rows, gold in data:
            scores = np.array([weights[r].sum(axis=0) for r in rows])
            move = steps + hard
            forward, backward = np.zeros_like(scores), np.zeros_like(scores)
            forward[0] = move[-1] + scores[0]
            for t in range(1, len(rows)):
                forward[t] = np.logaddexp.reduce(forward[t - 1][:, None] + move[:-1], axis=0) + scores[t]
            for t in range(len(rows) - 2, -1, -1):
                backward[t] = np.logaddexp.reduce(move[:-1] + (scores[t + 1] + backward[t + 1])[None], axis=1)
            total = np.logaddexp.reduce(forward[-1])
            rest = -np.exp(forward + backward - total)
            rest[np.arange(len(gold)), gold] += 1
            for r, g in zip(rows, rest):
                up_w[r] += g
            up_s[-1] += -np.exp(forward[0] + backward[0] - total)
            up_s[-1, gold[0]] += 1
            for t in range(1, len(rows)):
                up_s[:-1] -= np.exp(forward[t - 1][:, None] + move[:-1] + (scores[t] + backward[t])[None] - total)
                up_s[gold[t - 1], gold[t]] += 1
        seen_w += up_w**2
        seen_s += up_s**2
        weights += rate * up_w / np.sqrt(seen_w)
        steps += rate * up_s / np.sqrt(seen_s)
    return Field(names, weights, steps + hard)


def spacing(text: str, places: list[tuple[int, int]]) -> list[bool]:
    return [a == 0 or text[a - 1].isspace() for a, _ in places]


def stretches(text: str) -> list[tuple[int, int]]:
    """Parts of a text within AROUND characters of a digit or at-sign and on to white space; parts that meet are one.

    The field does not go by them: it labels whole texts.
    """
    out: list[list[int]] = []
    for m in TRIGGER.finditer(text):
        if out and m.end() + AROUND <= out[-1][1]:
            continue
        a, b = max(0, m.start() - AROUND), min(len(text), m.end() + AROUND)
        if out and a <= out[-1][1]:
            a = out[-1][0]
        else:
            least = out[-1][1] if out else 0
            while a > least and not text[a - 1].isspace():
                a -= 1
        space = SPACE.search(text, b)
        b = space.start() if space else len(text)
        if out and a <= out[-1][1]:
            out[-1][1] = b
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


@cache
def characters() -> np.ndarray:
    """Of each code point: 1 if it is of words, 2 if it is white space, else 0."""
    every = "".join(map(chr, range(sys.maxunicode + 1)))
    out = np.zeros(len(every), np.uint8)
    for number, pattern in ((1, r"\w+"), (2, r"\s+")):
        for m in re.finditer(pattern, every):
            out[m.start() : m.end()] = number
    return out


def places(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begins and ends of the words of a text that is not empty, as of tokens, and their spacing."""
    kinds = characters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    space, word = kinds == 2, kinds == 1
    within, begins, ends = word[1:] & word[:-1], ~space, ~space
    begins[1:] &= ~within
    ends[:-1] &= ~within
    begins = np.flatnonzero(begins).astype(np.int32)
    return begins, np.flatnonzero(ends).astype(np.int32) + 1, np.concatenate([[True], space])[begins]


def parts(texts: list[str]) -> Iterator[tuple[str, list[tuple[int, int, int, int]]]]:
    """Strings of about LONGEST characters: texts, each with PAD behind it, or parts of longer texts, which cut no word.

    And of each text or part in it: where it lies, from and to, its text's number and where it begins in its text.
    """
    held, lies, size = [], [], 0
    for i, text in enumerate(texts):
        at = 0
        while at < len(text):
            if held and size + len(text) > LONGEST:
                yield "".join(held), lies
                held, lies, size = [], [], 0
            cut = NOT_OF_WORDS.search(text, at + LONGEST) if len(text) - at > LONGEST else None
            end = cut.start() if cut else len(text)
            lies.append((size, size + end - at, i, at))
            held += [text[at:end], PAD if end == len(text) else ""]
            size, at = size + end - at + len(held[-1]), end
    if held:
        yield "".join(held), lies


def labelled(texts: list[str], field: Field) -> Iterator[tuple[int, list[tuple[int, int, str]]]]:
    """The field's spans in the texts, each text read as a whole: number of the text, its spans."""
    tables, first, count = field.tables, np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    total = max(BEFORE, BEHIND)
    none = np.zeros(total, np.int32)
    rows = [(none + 2 * tables.words["^"], none, none)]
    for text, lies in parts(texts):
        begins, ends, spaced = places(text)
        words = np.fromiter(map(tables.words.__getitem__, WORD.findall(text)), np.int32, len(begins))
        a, b, which, at = np.array(lies).T
        if at[0] and len(begins) and begins[0] == 0:
            spaced[0] = texts[which[0]][at[0] - 1].isspace()
        low, high = np.searchsorted(begins, a), np.searchsorted(begins, b)
        first[which] = np.where(at == 0, total + low, first[which])
        count[which] += high - low
        total += len(words)
        moved = (at - a).astype(np.int32)[np.searchsorted(a, begins, "right") - 1]
        rows.append((2 * words + spaced, begins + moved, ends + moved))
    words, begins, ends = map(np.concatenate, zip(*rows))
    del rows
    labels = field.best(count, lambda k, t: tables.scores(words, first[k] + t))
    found, start = np.flatnonzero(labels), np.cumsum(count) - count
    whose = np.searchsorted(start, found, "right") - 1
    at = first[whose] + found - start[whose]
    bounds = [0, *(np.flatnonzero(np.diff(whose)) + 1).tolist(), len(found)] if len(found) else [0]
    for x, y in zip(bounds, bounds[1:]):
        yield int(whose[x]), spans_of(labels[found[x:y]], zip(begins[at[x:y]].tolist(), ends[at[x:y]].tolist()))


def find(texts: list[str], field: Field) -> list[tuple[list, list]]:
    """Of each text: the patterns' spans, and all spans with those that the field adds."""
    based = [base_spans(t) if TRIGGER.search(t) else [] for t in texts]
    added: list[list] = [[] for _ in texts]
    for i, spans in labelled(texts, field):
        added[i] = spans
    out = []
    for text, base, more in zip(texts, based, added):
        # an added span can be of its kind and lies clear of the patterns' spans
        extra, done, at, clear = [], 0, 0, covered(base)
        for a, b, kind in sorted(more, key=in_order):
            while at < len(clear) and clear[at][1] <= a:  # both lists are sorted: one pass over them
                at += 1
            if a >= done and HOLDS[kind].search(text[a:b]) and not (at < len(clear) and clear[at][0] < b):
                extra.append((a, b, kind))
                done = b
        out.append((base, sorted(base + extra, key=in_order)))
    return out


def covered(spans: list[tuple]) -> list[tuple[int, int]]:
    """The places under spans sorted by begin, overlapping ones merged."""
    out: list[tuple[int, int]] = []
    for begin, end, _ in spans:
        if out and begin < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def spans_of(labels: np.ndarray, places: Iterable[tuple[int, int]]) -> list[tuple[int, int, str]]:
    out: list[list] = []
    for label, (a, b) in zip(labels, places):
        name = LABELS[label]
        if name[0] == "B":
            out.append([a, b, name[2:]])
        elif name[0] == "I" and out:
            out[-1][1] = b
    return [tuple(x) for x in out]


def gathered(columns: Iterable[pd.Series]) -> Iterator[list[str]]:
    """The texts of Arrow batches, in lists of GATHERED characters or more but for the last; a null is an empty text."""
    texts: list[str] = []
    for column in columns:
        texts += [t if isinstance(t, str) else "" for t in column]
        if sum(map(len, texts)) >= GATHERED:
            yield texts
            texts = []
    if texts:
        yield texts


def detect(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """doc_id, base (spans of the patterns), spans (all): strings of kind:begin:end, and counts of
    the patterns' spans by kind, for every row.

    A null or empty text has no span. A very long text is read whole; equal rows give equal
    results; other columns are not read. Rows stay in their partitions. The trained field is small
    (the features of LABELLED) and goes to all tasks.
    """
    held = docs.sparkSession.sparkContext.broadcast(field or train())

    @F.pandas_udf(", ".join(f"n_{k} bigint" for k in BASE) + ", base string, spans string")
    def run(columns: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in gathered(columns):
            found = find(texts, held.value)
            counts = {f"n_{k}": [sum(s[2] == k for s in base) for base, _ in found] for k in BASE}
            yield pd.DataFrame({**counts, "base": [joined(b) for b, _ in found], "spans": [joined(s) for _, s in found]})

    # ids stay in the JVM: beside a null, pandas would hold them as doubles
    return docs.select("doc_id", run("text").alias("_f")).select("doc_id", "_f.*").withColumn(
        "base_sha256", F.sha2(F.col("base").cast("binary"), 256))
