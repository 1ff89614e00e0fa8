"""Operator 8: personal data by exact base patterns plus a semi-Markov conditional random field.

The base finds e-mail addresses, IP addresses, card and phone numbers by fixed
patterns. The field then reads what the base left: it cuts a stretch of tokens
into segments, each an entity of one type or a single outside token. Its features
look at a whole segment (its shape, digit count, checksum, separators, the words
before it), and dynamic programming over segments of bounded length chooses all
boundaries and types together. An entity can only stand where one of the loose
``SHAPES`` fits, so all other text is outside by construction and is never cut;
what is cut is exact for the whole text, however long.

The field is trained here, by stochastic gradient ascent on the likelihood of
sentences made from a small table of labelled patterns (``EXAMPLES``).
"""

from __future__ import annotations

import bisect
import hashlib
import math
import random
import re
from collections import defaultdict
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import arrow_map, quoted

Span = tuple[str, int, int]
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")

# --- the base ----------------------------------------------------------------------------

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL_BACK = re.compile(r"[A-Za-z0-9._%+-]*")
# a match cannot start inside a run of digits unless it can start at the run's first one
_IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_DIGIT = re.compile("[0-9]")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_emails(text: str) -> list[Span]:
    """The leftmost address for each ``@``: the local part is the run before it, back to the previous match."""
    out, end, last, at = [], 0, 0, text.find("@")
    while at >= 0:
        m = _DOMAIN.match(text, at)
        if m:
            start = at - _LOCAL_BACK.match(text[max(end, last) : at][::-1]).end()
            if start < at:
                end = m.end()
                out.append(("email", start, end))
        last, at = at + 1, text.find("@", at + 1)
    return out


def base_spans(text: str) -> list[Span]:
    out = base_emails(text)
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]  # of any length, by their value
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        d = digits_of(m.group())
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(digits_of(m.group())) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def joined(spans: list[Span]) -> str:
    """``kind:start:end`` by kind as listed, then start, comma-joined."""
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1:])))


# --- the field ---------------------------------------------------------------------------

#: What a segment of a type may look like at most; the field weighs every fit. Names and labels have any
#: length and domains any number of labels; a name has up to four words joined by "dot".
_NAME = r"(?<![\w.+-])[\w.+-]+(?: dot [\w.+-]+){0,3}?"
_FIRST = r"(?:(?: ?@ ?| ?[(\[] ?at ?[)\]] ?| at )[\w-]+)"
_LABEL = re.compile(r"(?: ?\. ?| ?[(\[] ?dot ?[)\]] ?| dot )([A-Za-z0-9-]+)(?![\w-])", re.I)
_ADDRESS = re.compile(_NAME + _FIRST, re.I)
SHAPES = {
    "ip": re.compile(r"(?<![\w.])[0-9]{1,3}(?:(?:\[\.\]| ?\. ?| dot )[0-9]{1,3}){3}(?![\w])", re.I),
    "card": re.compile(r"(?<!\w)[0-9](?:[ ./-]{0,2}[0-9]){12,18}(?!\w)"),
    "phone": re.compile(r"(?<!\w)(?:\+|00|\()?[0-9][0-9 ().\-/]{5,22}[0-9](?!\w)"),
}
#: A secret is a whole run of these characters, or what stands between the first "=" or the slashes of one.
_RUN = re.compile(r"[A-Za-z0-9_+/=-]{20,}")
_PART = re.compile(r"[^/]{20,}")
#: Groups of digits that a phone or card number has at most: lists of small numbers are none.
GROUPS = {"phone": 6, "card": 6}
#: Ends of a domain that are offered besides the last one.
DOMAIN_ENDS = 6
#: Every shape holds one of these: a digit or ``@``, a word "at" with a domain after it or in brackets, a long word.
_TRIGGER = re.compile(r"[0-9@]")
_AT = re.compile(r"[(\[] ?at ?[)\]]|\bat [\w-]{1,63}(?:\.[A-Za-z0-9]| ?[(\[] ?dot| dot )", re.I)
_WORD = re.compile(r"\w+|[^\w\s]")
_JOINED = re.compile(r"[\w.+/=-]{2}")  # a stretch is not cut within a name or run
_MORE = re.compile(r" ?(?:\.[A-Za-z0-9]|[(\[] ?dot ?[)\]]|dot [A-Za-z0-9])", re.I)  # a further label of the domain
REACH = 500  # characters a shape can span, with room for its context


def disjoint(spans: list[Span]) -> list[tuple[int, int]]:
    """The text that spans cover, as sorted parts that do not overlap."""
    out: list[tuple[int, int]] = []
    for _, a, b in sorted(spans, key=lambda s: s[1:]):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _log2(n: int) -> int:
    return max(n, 1).bit_length()


def features(kind: str, text: str, start: int, end: int, before: list[str]) -> list[str]:
    """Whole-segment features; ``before`` holds the three tokens left of it, nearest first, in lower case."""
    s = text[start:end]
    digits = digits_of(s)
    letters = sum(c.isalpha() for c in s)
    marks = "".join(sorted(set(re.sub(r"[\w]", "", s))))
    out = [
        "bias",
        f"digits={len(digits)}",
        f"marks={marks}",
        f"size={min(_log2(len(s)), 8)}",
        f"letters={_log2(letters) if letters else 0}",
        f"next={re.sub('[0-9]', '0', text[end:end + 1])}",
        f"prev={re.sub('[0-9]', '0', text[max(start - 1, 0):start])}",
    ]
    out += [f"before={w}" for w in before if w.isalpha() or w in "=:#"]
    if kind == "card":
        out.append(f"luhn={luhn(digits)}")
        out.append("groups=" + "-".join(str(len(g)) for g in re.split(r"[^0-9]+", s))[:24])
    if kind == "phone":
        out.append("groups=" + "-".join(str(min(len(g), 7)) for g in re.split(r"[^0-9]+", s) if g)[:24])
        out.append(f"lead={s[0] if s[0] in '+(' else s[:2] == '00'}")
    if kind == "ip":
        parts = [int(p) for p in re.findall("[0-9]+", s)]
        out.append(f"octets={all(p <= 255 for p in parts)}")
        out.append(f"big={sum(p > 31 for p in parts)}")
    if kind == "email":
        out.append(f"more={_MORE.match(text, end) is not None}")
        out.append(f"at={'sign' if '@' in s else 'boxed' if re.search(r'[(\[]', s) else 'word'}")
        out.append(f"dot={'sign' if '.' in s.partition('@')[2] else 'word' if re.search('dot', s, re.I) else 'none'}")
    if kind == "secret":
        out.append(f"mix={bool(digits)}{bool(letters)}{s.lower() != s}")
        out.append(f"hex={re.fullmatch('[0-9a-f]+', s) is not None}")
        out.append(f"share={int(4 * len(digits) / len(s))}")
    return [f"{kind}|{f}" for f in out]


def _addresses(text: str, tokens: list[tuple[int, int]], hi: int) -> list[tuple[int, int]]:
    """Candidate e-mail segments: from each name, to the ends of its domain after two labels or more."""
    out = []
    for a, _ in tokens:
        m = _ADDRESS.match(text, a, hi)
        if not m:
            continue
        ends, at = [], m.end()
        while label := _LABEL.match(text, at, hi):
            at = label.end()
            if len(label.group(1)) > 1:
                ends.append(at)
        out += [(a, b) for b in (*ends[:DOMAIN_ENDS], *ends[max(DOMAIN_ENDS, len(ends) - 1) :])]
    return out


def _numbers(kind: str, text: str, tokens: list[tuple[int, int]], i: int, hi: int) -> list[tuple[int, int]]:
    """Candidate segments of a number kind from token ``i``: the shape's longest fit and its shorter ones that end with a token."""
    a = tokens[i][0]
    m = SHAPES[kind].match(text, a, hi)
    if not m:
        return []
    out, groups, digits = [], 0, 0
    for j in range(i, len(tokens)):
        c, b = tokens[j]
        if b > m.end():
            break
        if text[c].isdigit():
            groups, digits = groups + 1, digits + len(digits_of(text[c:b]))
        if groups > GROUPS.get(kind, 4) or digits > 19:
            break
        if kind == "phone" and not 7 <= digits <= 15 or kind == "card" and digits < 13:
            continue
        if b == m.end() or SHAPES[kind].fullmatch(text, a, b):  # at most 40 characters
            out.append((a, b))
    return out


def _secrets(text: str, lo: int, hi: int) -> list[tuple[int, int]]:
    """Candidate secrets: whole runs, what follows the first "=" of one, and the long parts between its slashes."""
    out = []
    for run in _RUN.finditer(text, lo, hi):
        a, b = run.span()
        if (a and re.match(r"[\w-]", text[a - 1])) or re.match(r"[\w-]", text[b : b + 1]):
            continue
        out.append((a, b))
        at = text.find("=", a, b)
        if 0 <= at < b - 20 and at > a:
            out.append((at + 1, b))
        if "/" in run.group():
            out += [m.span() for m in _PART.finditer(text, a, b)]
    return out


class Stretch:
    """One stretch of text: its token starts and the segments that some shape allows."""

    def __init__(self, text: str, lo: int, hi: int, taken: list[tuple[int, int]]):
        self.tokens = [(m.start(), m.end()) for m in _WORD.finditer(text, lo, hi)]
        lower = [text[a:b].lower() for a, b in self.tokens]
        at_start, at_end = ({t[side]: i for i, t in enumerate(self.tokens)} for side in (0, 1))
        spans = [("email", a, b) for a, b in _addresses(text, self.tokens, hi)] + [("secret", a, b) for a, b in _secrets(text, lo, hi)]
        for i, (a, _) in enumerate(self.tokens):
            if text[a].isdigit() or text[a] in "+(":
                spans += [(kind, *span) for kind in SHAPES for span in _numbers(kind, text, self.tokens, i, hi)]
        # a segment starts and ends with tokens
        found = {(at_start[a], at_end[b] + 1, kind) for kind, a, b in spans if a in at_start and b in at_end}
        self.segments = []  # (first token, token after the last, kind, features)
        for i, j, kind in sorted(found):
            a, b = self.tokens[i][0], self.tokens[j - 1][1]
            k = bisect.bisect_left(taken, (b, -1)) - 1  # the last taken part that starts before b
            if k >= 0 and taken[k][1] > a:
                continue
            self.segments.append((i, j, kind, features(kind, text, a, b, lower[max(i - 3, 0) : i][::-1])))

    def spans(self, chosen: list[int]) -> list[Span]:
        return [(k, self.tokens[i][0], self.tokens[j - 1][1]) for i, j, k, _ in (self.segments[c] for c in chosen)]


def stretches(text: str, taken: list[tuple[int, int]]) -> list[Stretch]:
    """Parts of the text that can hold an entity: triggers with their reach on both sides, merged; cut between tokens."""
    found = [m.span() for m in _TRIGGER.finditer(text)]
    if " at " in (low := text.lower()) or "(at" in low or "[at" in low or "( at" in low or "[ at" in low:
        found += [m.span() for m in _AT.finditer(text)]
    if max(map(len, text.split()), default=0) >= 20:
        found += [m.span() for m in _RUN.finditer(text)]
    out, lo, hi = [], -1, -1
    for a, b in sorted(found):
        if hi < 0 or a - REACH > hi:
            if hi >= 0:
                out.append((lo, hi))
            lo = max(a - REACH, 0)
        hi = max(hi, min(b + REACH, len(text)))
    if hi >= 0:
        out.append((lo, hi))
    cut = []
    for lo, hi in out:
        while 0 < lo < len(text) and _JOINED.match(text, lo - 1):
            lo -= 1
        while 0 < hi < len(text) and _JOINED.match(text, hi - 1):
            hi += 1
        if cut and lo < cut[-1][1]:
            lo, hi = cut[-1][0], max(hi, cut[-1][1])
            cut.pop()
        cut.append((lo, hi))
    return [Stretch(text, lo, hi, taken) for lo, hi in cut]


def best_path(n: int, segments: list, score) -> list[int]:
    """Viterbi over segments of a stretch of ``n`` tokens; outside tokens score 0. Ties prefer outside."""
    into = defaultdict(list)
    for c, seg in enumerate(segments):
        into[seg[1]].append(c)
    best, back = [0.0] * (n + 1), [-1] * (n + 1)
    for t in range(1, n + 1):
        best[t] = best[t - 1]
        for c in into[t]:
            value = best[segments[c][0]] + score(segments[c])
            if value > best[t]:
                best[t], back[t] = value, c
    out, t = [], n
    while t:
        if back[t] >= 0:
            out.append(back[t])
            t = segments[back[t]][0]
        else:
            t -= 1
    return out[::-1]


def marginals(n: int, segments: list, scores: list[float]) -> list[float]:
    """Probability of each segment under the field (forward and backward sums over all segmentations)."""
    into, outof = defaultdict(list), defaultdict(list)
    for c, seg in enumerate(segments):
        into[seg[1]].append(c)
        outof[seg[0]].append(c)

    def add(values: list[float]) -> float:
        top = max(values)
        return top + math.log(sum(math.exp(v - top) for v in values))

    fore, back = [0.0] * (n + 1), [0.0] * (n + 1)
    for t in range(1, n + 1):
        fore[t] = add([fore[t - 1], *(fore[segments[c][0]] + scores[c] for c in into[t])])
    for t in range(n - 1, -1, -1):
        back[t] = add([back[t + 1], *(back[segments[c][1]] + scores[c] for c in outof[t])])
    return [math.exp(fore[s[0]] + scores[c] + back[s[1]] - fore[n]) for c, s in enumerate(segments)]


# Labelled patterns: ``{kind:form}`` marks an entity, ``{-:form}`` a look-alike that is none. In a form,
# 0 is any digit, x a hex digit, a a lower-case letter, o a number up to 255; the rest stands for itself.
EXAMPLES = (
    "mail {email:aaaaa at aaaaaa dot com} for more",
    "write to {email:aaaa.aaaa (at) aaaaaaa (dot) org} today",
    "{email:aaaaaa[at]aaaaaaaa.net} aaa aaaa",
    "contact {email:aaa @ aaaaaa.com} or call",
    "aaaa {email:aaa00 at aaaa.aaa.com} aaa",
    "mail {email:aaaaa at aaaa dot aaaaaa dot com} for more",
    "write to {email:aaaa (at) aaaa (dot) aaaaaaa (dot) org} today",
    "aaa {email:aaaaa at aaaaaaaa dot aaa dot aaaaaa dot net} aaa",
    "write to {email:aaaa dot aaaaaa at aaaaa dot com} today",
    "mail {email:aaaaa dot aaaa dot aaaaa at aaaaaa dot org} for more",
    "mail {email:aaa at aaaaaaaaa dot aaaaaaaaaaaaaaaaaaaaaaaaaaaaa dot com} now",
    "mail {email:aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa at aaaaa dot aaaaa dot com} now",
    "we met {-:aaaaa at aaaaaa dot} then",
    "look {-:at aaaaaa. aaaa} aaaa at the aaaa. aaaaa aaa",
    "aaa aaaa at aaaaa. aaaa aa at a aaaaaa. aa",
    "aaaa at aaaaaa.aaaaa aaa",
    "aaaa aaa at aaa.Aaaa aaa aaaa",
    "server {ip:o[.]o[.]o[.]o} is down",
    "host {ip:o . o . o . o} aaaa",
    "ping {ip:o dot o dot o dot o}",
    "section {-:0. 0. 0. 0} of aaa",
    "aaa {-:000.000.000.000} aaa",
    "version {-:0 . 0 . 0 . 0} aaa",
    "card {card:0000 0000 0000 0000} exp",
    "card number {card:0000.0000.0000.0000} aaa",
    "visa {card:0000  0000  0000  0000} aaa",
    "pay with card {card:0000/0000/0000/0000}",
    "aaaa {-:0000000000000000} aaa aaaa",
    "aaa aaaa {-:0000000000000000} aaa",
    "order {-:000000000000000} aaa",
    "id {-:0000000000000} aaa",
    "call {phone:(000) 000-0000} now",
    "phone {phone:000-000-0000} aaa",
    "tel {phone:00 00 00 00 00} aaa",
    "call me at {phone:000 000 0000} today",
    "fax {phone:0000-000000} aaa",
    "tel {phone:0049 000 0000000} aaa",
    "mobile {phone:000.000.0000} aaa",
    "call {phone:000-000-0000} {-:0000-00-00} aaa",
    "aaa {phone:000-000-0000} {-:00} aaaaaa",
    "call {phone:000-000-0000} {-:0} aaaaa aaa",
    "tel {phone:000-000-0000} / {phone:000-000-0000} aaa",
    "aaa {phone:000-000-0000}, {phone:000-000-0000} aaa",
    "{phone:(000) 000-0000} {-:000} aaa",
    "card {card:0000/0000/0000/0000} {-:000} aaa",
    "card {card:0000.0000.0000.0000} {-:00/00} aaa",
    "in {-:0000-0000} we aaa",
    "on {-:0000-00-00} aaa",
    "on {-:00.00.0000} aaa",
    "aaa {-:0000000} aaa",
    "aaa {-:0000000000} aaa",
    "pages {-:000 - 000} aaa",
    "aaa {-:0 0 0 0 0 0 0} aaa",
    "{-:00 000 0000 00 000 0000} {-:00 000 0000 00 000 0000}",
    "aaa {-:00 00 00 00 000 000 00 00 0 000} aaa",
    "{-:000 000 000 000 000 000 000 000 000}",
    "aaaa {-:0000 0000 000 0000 00 0000 0000} aaa",
    "isbn {-:000-0-00-000000-0} aaa",
    'token = "{secret:xxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxx}" aaa',
    'aaa token = "{secret:xxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxx}" aaa',
    "api key : {secret:aaaa0000AAAAaaaa0000AAaa00} aaa",
    "password = {secret:aA0aA0aA0aA0aA0aA0aA0aA0} aaa",
    "secret = {secret:xxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxx}",
    'token = "{secret:aA0a0AaA0a0AaA0a0AaA0a0AaA0a0AaA0a0AaA0a0AaA0a0AaA0a0AaA0a0AaA0a0AaA0a0AaA0a0AaA0a0AaA0a0AaA0a0AaA0a0AaA0a0AaA0a0AaA0a0AaA0a0AaA0a0AaA0a0AaA0a0AaA0a0AaA0a0AaA0a0AaA0a0AaA0a0AaA0a0A}" aaa',
    "secret = {secret:xxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxx}",
    "aaa {-:aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa} aaa",
    "aaa {-:============================================================================================================================================} aaa",
    "aaa {-:aaaaaaaaaaaaaaaaaaaaaaaa} aaa",
    "aaa {-:aaaaaaaaaaaa-aaaaaaaaaaaa} aaa",
    "see {-:/aaaaaaa/aaaaaaaa/aaaaaaaa} aaa",
    "aaa {-:====================} aaa",
    "aaa {-:-----------------------------} aaa",
    "commit {-:xxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxx} aaa",
)
REPEATS, EPOCHS, RATE, DECAY = 3, 12, 0.3, 1e-3


def example(pattern: str, rng: random.Random) -> tuple[str, list[Span]]:
    pick = {"0": "0123456789", "x": "0123456789abcdef", "a": "abcdefghijklmnopqrstuvwxyz", "A": "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}

    def fill(kind: str, form: str) -> str:
        if kind == "ip":
            return re.sub(r"\bo\b", lambda m: str(rng.randint(1, 255)), form)
        keep = re.split(r"(\bat\b|\bdot\b|\bcom\b|\borg\b|\bnet\b)", form) if kind in ("email", "-") else [form]
        keep = ["".join(rng.choice(pick[c]) if c in pick else c for c in k) if i % 2 == 0 else k for i, k in enumerate(keep)]
        return "".join(keep)

    text, spans = "", []
    for part in re.split(r"(\{[^}]*\})", pattern):
        if part.startswith("{"):
            kind, _, form = part[1:-1].partition(":")
            piece = fill(kind, form)
            if kind != "-":
                spans.append((kind, len(text), len(text) + len(piece)))
            text += piece
        else:
            text += re.sub(r"\ba+\b", lambda m: "".join(rng.choice("abcdefghilmnoprstu") for _ in m.group()), part)
    return text, spans


@lru_cache(maxsize=1)
def trained(seed: int = 5) -> dict[str, float]:
    """Feature weights, the same for the same seed; a few hundred short sentences."""
    rng = random.Random(seed)
    data = []
    for _ in range(REPEATS):
        for pattern in EXAMPLES:
            text, spans = example(pattern, rng)
            taken = [] if spans else disjoint(base_spans(text))
            for s in stretches(text, taken):
                if s.segments:
                    gold = [(k, a, b) in spans for c in range(len(s.segments)) for k, a, b in s.spans([c])]
                    data.append((len(s.tokens), s.segments, gold))
    weights: dict[str, float] = defaultdict(float)
    for _ in range(EPOCHS):
        rng.shuffle(data)
        for n, segments, gold in data:
            scores = [sum(weights[f] for f in seg[3]) for seg in segments]
            for seg, p, g in zip(segments, marginals(n, segments, scores), gold):
                for f in seg[3]:
                    weights[f] += RATE * (g - p) - DECAY * weights[f]
    return {f: round(w, 4) for f, w in weights.items()}


#: A segment must be this much likelier (in log odds) than its tokens being outside.
MARGIN = 1.0


def all_spans(text: str, weights: dict[str, float]) -> tuple[list[Span], list[Span]]:
    """``(base spans, base spans and the field's)``; the field keeps clear of every base span."""
    base = base_spans(text)
    more = []
    for s in stretches(text, disjoint(base)):
        if s.segments:
            score = lambda seg: sum(weights.get(f, 0.0) for f in seg[3]) - MARGIN
            more += s.spans(best_path(len(s.tokens), s.segments, score))
    return base, base + sorted(more)


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, counts of the base kinds, a digest of the base spans, all spans as text.

    Offsets are code points, ends exclusive. Null and empty texts have no spans
    (empty strings). Repeated rows give repeated results; other columns are ignored.
    """
    weights = trained()

    def make():
        def each(cols: dict) -> dict:
            out = defaultdict(list)
            for text in cols["text"]:
                base, spans = all_spans(text or "", weights)
                for kind in BASE_KINDS:
                    out[f"n_{kind}"].append(sum(k == kind for k, _, _ in base))
                out["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
                out["spans"].append(joined(spans))
            return {"id": cols["id"]} | out

        return each

    schema = "id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string"
    found = arrow_map(docs.select(quoted(id_col).cast("bigint").alias("id"), quoted(text_col).alias("text")), schema, make)
    return found.withColumnRenamed("id", id_col)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by ``[KIND]``; overlapping spans become one, named after the longest."""
    out, at = [], 0
    merged: list[list] = []
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if merged and a < merged[-1][2]:
            if b - a > merged[-1][3]:
                merged[-1][0], merged[-1][3] = kind, b - a
            merged[-1][2] = max(merged[-1][2], b)
        else:
            merged.append([kind, a, b, b - a])
    for kind, a, b, _ in merged:
        out += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join(out) + text[at:]


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with personal data in ``text_col`` replaced; null stays null, all other columns stay."""
    weights = trained()

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t if t is None else redacted(t, all_spans(t, weights)[1]))

    return docs.withColumn(text_col, clean(quoted(text_col)))
