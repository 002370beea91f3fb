"""Personal data in texts: a semi-Markov conditional random field beside fixed patterns.

Spans that match a base pattern are always found. Around digits, at-signs and their spelled-out forms a
semi-Markov CRF then looks for more: it scores whole candidate segments (how many digits, which separators, valid octets, check
digit, what stands beside them), and dynamic programming over segments of bounded length chooses boundaries and kinds
together. It is trained here, on base spans and on spellings made from them that the patterns miss.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltmark.llm import batches as B

KINDS = ("email", "ip", "card", "phone")
#: Zones that the field is trained on at most: a quarter of them with base spans of each kind, and a quarter more without any.
SAMPLE_ZONES = 400
#: Characters of a zone that is trained on; a longer one is cut around its base spans.
ZONE_CHARS = 400
#: The longest segment, in tokens.
LONGEST = 24

Span = tuple[str, int, int]

# -- base patterns ---------------------------------------------------------------

# The same matches as the plain patterns, in time linear in the text: an at-sign is looked for
# first and digits are never given back.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """All matches of the base patterns, by kind and start."""
    found: list[Span] = []
    if "@" in text:
        end = 0
        for m in _DOMAIN.finditer(text):
            start = m.start()
            while start > end and text[start - 1] in _LOCAL:
                start -= 1
            if start < m.start():
                end = m.end()
                found.append(("email", start, end))
    found += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return found


# -- zones, candidates, features ---------------------------------------------------

_TRIGGER = re.compile(r"[0-9@]|[(\[{] ?at ?[)\]}]| dot ")
_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|\s+|.", re.DOTALL)
_AT = re.compile(r"@|\bat\b")
_SEPARATORS = frozenset(" -.()/+ ")
_REACH = 40


def zones(text: str) -> list[tuple[int, int]]:
    """Stretches around everything that may belong to personal data."""
    found: list[list[int]] = []
    for m in _TRIGGER.finditer(text):
        start, end = max(0, m.start() - _REACH), min(len(text), m.end() + _REACH)
        if found and start <= found[-1][1]:
            found[-1][1] = end
        else:
            found.append([start, end])
    return [(a, b) for a, b in found]


@dataclass
class Zone:
    """Tokens of a stretch of text (their bounds) and candidates: first token, end token, kind, features."""

    bounds: list[tuple[int, int]]
    candidates: list[tuple[int, int, int, list[str]]]


def _numeric(tokens: list[str], i: int):
    """Ends of number-like segments that begin at token i."""
    for j in range(i, min(i + LONGEST, len(tokens))):
        t = tokens[j]
        if t[0].isdigit() and t.isascii():
            yield j + 1
        elif t not in _SEPARATORS:
            return


def candidates(tokens: list[str]) -> list[tuple[int, int, int, list[str]]]:
    found = []
    for i, t in enumerate(tokens):
        before = tokens[i - 1] if i else ""
        if (t[0].isdigit() and t.isascii()) or t in ("+", "("):
            for end in _numeric(tokens, i):
                text = "".join(tokens[i:end])
                digits = _digits(text)
                if not 4 <= len(digits) <= 19:
                    continue
                beside = _beside(before, tokens[end] if end < len(tokens) else "")
                groups = [x for x in tokens[i:end] if x[0].isdigit()]
                seps = "".join(sorted({x for x in tokens[i:end] if not x[0].isdigit()}))
                shape = ".".join(str(len(g)) for g in groups)
                if len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups):
                    found.append((i, end, 1, [f"ip seps {seps}", *(f"ip {b}" for b in beside)]))
                if 13 <= len(digits) <= 19:
                    found.append((i, end, 2, [f"card luhn {luhn(digits)} {len(digits)}", f"card seps {seps}", f"card groups {len(groups)}", *(f"card {b}" for b in beside)]))
                if 7 <= len(digits) <= 15:
                    found.append((i, end, 3, [f"phone digits {len(digits)}", f"phone start {t if not t.isdigit() else 'digit'}", f"phone shape {shape}", f"phone seps {seps}", *(f"phone {b}" for b in beside)]))
        if _AT.fullmatch(t):
            found += _addresses(tokens, i)
    return found


def _beside(before: str, after: str) -> list[str]:
    def kind(x):
        return "none" if not x else "space" if x.isspace() else "letter" if x[0].isalpha() else "digit" if x[0].isdigit() else x

    return [f"before {kind(before)}", f"after {kind(after)}"]


_LEFT = frozenset("._%+-")


def _addresses(tokens: list[str], at: int):
    """Candidates for an address around an at-sign or the word ``at``, also in brackets."""
    left, right, spelled = at, at + 1, tokens[at] != "@"
    while spelled and left > 0 and (tokens[left - 1].isspace() or tokens[left - 1] in "([{"):
        left -= 1
    while spelled and right < len(tokens) and (tokens[right].isspace() or tokens[right] in ")]}"):
        right += 1
    bracket = "".join(tokens[left:right]).strip() if spelled else "@"
    starts = []
    for i in range(left - 1, max(-1, left - 9), -1):
        if not tokens[i].isalnum() and tokens[i] not in _LEFT:
            break
        starts.append(i)
    ends, j = [], right
    while True:
        end = j
        while end < min(len(tokens), right + 20) and tokens[end].isalnum() and tokens[end] != "dot":
            end += 1
        if end == j:
            break
        ends.append(end)
        k = _past(tokens, end)
        if k < len(tokens) and tokens[k] == "dot":
            j = _past(tokens, k + 1)
        elif end < len(tokens) and tokens[end] in "-.":
            j = end + 1
        else:
            break
    for i in starts:
        for n, end in enumerate(ends):
            if n and end - i <= LONGEST:
                beside = _beside(tokens[i - 1] if i else "", tokens[end] if end < len(tokens) else "")
                yield i, end, 0, [f"email at {bracket}", f"email parts {min(n, 4)}", f"email last {min(len(tokens[end - 1]), 5)} {tokens[end - 1].isalpha()}", *(f"email {b}" for b in beside)]


def _past(tokens: list[str], k: int) -> int:
    """The next token that is neither white space nor a bracket."""
    while k < len(tokens) and (tokens[k].isspace() or tokens[k] in "()[]{}"):
        k += 1
    return k


def zone_of(text: str, start: int, end: int) -> Zone:
    bounds = [m.span() for m in _TOKEN.finditer(text, start, end)]
    return Zone(bounds, candidates([text[a:b] for a, b in bounds]))


# -- the field -------------------------------------------------------------------------

OUTSIDE = len(KINDS)


class SemiMarkov:
    """Weights of segment features and of one kind of segment following another. Tokens outside
    are segments of one token."""

    def __init__(self, weights: dict[str, float] | None = None, follows: np.ndarray | None = None):
        self.weights = weights or {}
        self.follows = np.zeros((OUTSIDE + 1, OUTSIDE + 1)) if follows is None else follows

    def score(self, features: list[str]) -> float:
        return sum(self.weights.get(f, 0.0) for f in features)

    def _ending(self, zone: Zone) -> list[list[tuple[int, int, float, int]]]:
        """By end token: start token, kind, score and number of each segment that ends there."""
        ending: list[list[tuple[int, int, float, int]]] = [[] for _ in range(len(zone.bounds) + 1)]
        for j in range(1, len(ending)):
            ending[j].append((j - 1, OUTSIDE, 0.0, -1))
        for n, (i, j, kind, features) in enumerate(zone.candidates):
            ending[j].append((i, kind, self.score(features), n))
        return ending

    def decode(self, zone: Zone) -> list[int]:
        """Numbers of the candidates in the best segmentation."""
        best = np.full((len(zone.bounds) + 1, OUTSIDE + 1), -np.inf)
        best[0, OUTSIDE] = 0.0
        back: dict[tuple[int, int], tuple[int, int, int]] = {}
        for j, segments in enumerate(self._ending(zone)):
            for i, kind, score, n in segments:
                ways = best[i] + self.follows[:, kind] + score
                k = int(np.argmax(ways))
                if ways[k] > best[j, kind]:
                    best[j, kind] = ways[k]
                    back[j, kind] = (i, k, n)
        chosen, at = [], (len(zone.bounds), int(np.argmax(best[-1])))
        while at[0]:
            i, k, n = back[at]
            if n >= 0:
                chosen.append(n)
            at = (i, k)
        return chosen[::-1]

    def learn(self, zone: Zone, gold: set[int], rate: float) -> None:
        """A step up the log-likelihood of the segmentation that consists of the candidates in ``gold``."""
        ending, n = self._ending(zone), len(zone.bounds)
        forward = np.full((n + 1, OUTSIDE + 1), -np.inf)
        forward[0, OUTSIDE] = 0.0
        for j in range(1, n + 1):
            for i, kind, score, _ in ending[j]:
                forward[j, kind] = np.logaddexp(forward[j, kind], _total(forward[i] + self.follows[:, kind]) + score)
        backward = np.full((n + 1, OUTSIDE + 1), -np.inf)
        backward[n] = 0.0
        change = np.zeros_like(self.follows)
        norm = _total(forward[n])
        for j in range(n, 0, -1):
            for i, kind, score, number in ending[j]:
                after = backward[j, kind] + score
                chance = np.exp(np.minimum(forward[i] + self.follows[:, kind] + after - norm, 0))
                backward[i] = np.logaddexp(backward[i], self.follows[:, kind] + after)
                change[:, kind] -= chance
                if number >= 0:
                    step = rate * ((number in gold) - float(chance.sum()))
                    if step:
                        for f in zone.candidates[number][3]:
                            self.weights[f] = self.weights.get(f, 0.0) * (1 - 1e-4) + step
        before, at = OUTSIDE, 0
        starts = {zone.candidates[g][0]: g for g in gold}
        while at < n:
            kind = zone.candidates[starts[at]][2] if at in starts else OUTSIDE
            change[before, kind] += 1
            before, at = kind, zone.candidates[starts[at]][1] if at in starts else at + 1
        self.follows += rate * change


def _total(x: np.ndarray) -> float:
    top = x.max()
    return top if math.isinf(top) else float(top + np.log(np.exp(x - top).sum()))


def spellings(kind: str, text: str, chance: random.Random) -> str:
    """The same data, written so that base patterns don't see it."""
    if kind == "email":
        local, _, domain = text.partition("@")
        local = local.strip(".-+%_") or "name"
        if domain.count(".") > 1 and chance.random() < 0.5:
            domain = domain.partition(".")[2]
        return chance.choice([
            f"{local} (at) {domain}", f"{local} [at] {domain}", f"{local}[at]{domain}", f"{local} at {domain.replace('.', ' dot ')}",
            f"{local} (at) {domain.replace('.', ' (dot) ')}",
        ])
    digits = _digits(text)
    if kind == "card":
        return chance.choice([".", "/", "  ", " "]).join(digits[k : k + 4] for k in range(0, 16, 4)) + digits[16:]
    if kind == "phone":
        d = digits[-10:].rjust(10, "2")
        return chance.choice([f"({d[:3]}) {d[3:6]}-{d[6:]}", f"{d[:3]}-{d[3:6]}-{d[6:]}", f"{d[:3]}.{d[3:6]}.{d[6:]}", f"00{digits[:2]} {d[:3]} {d[3:]}", f"1-{d[:3]}-{d[3:6]}-{d[6:]}"])
    return text


def decoys(chance: random.Random) -> str:
    """Numbers and words that are no personal data."""
    n = lambda a, b: chance.randrange(a, b)
    return chance.choice([
        f"{n(1900, 2030)}-{n(1, 13):02}-{n(1, 29):02}", f"{n(1, 29)}.{n(1, 13)}.{n(1900, 2030)}", f"{n(1, 10)}.{n(0, 20)}.{n(0, 20)}",
        f"{n(10, 999)} {n(100, 999)} {n(100, 999)}", f"{n(0, 24):02}:{n(0, 60):02}:{n(0, 60):02}", "%040x" % chance.getrandbits(160), f"{n(10**15, 10**16)}",
        f"at {n(1, 99)} dot", f"{n(1, 10**9)}", f"{n(1, 9)},{n(100, 999)},{n(100, 999)}", f"{n(1900, 2030)}-{n(1900, 2030)}", f"{n(10**7, 10**8)}",
    ])


def samples(text: str) -> list[str]:
    """The zones of a text; a long one as the surroundings of each of its base spans, which cut no other span."""
    found = []
    for a, b in zones(text):
        zone = text[a:b]
        if b - a <= ZONE_CHARS:
            found.append(zone)
            continue
        spans = _apart(base_spans(zone))
        for n, (_, start, end) in enumerate(spans):
            low = max(start - _REACH, spans[n - 1][2] if n else 0)
            high = min(end + _REACH, spans[n + 1][1] if n + 1 < len(spans) else len(zone))
            left, right = zone.find(" ", low, start), zone.rfind(" ", end, high)
            piece = zone[left if left >= 0 else low : right if right >= 0 else high]
            if len(piece) <= ZONE_CHARS:
                found.append(piece)
    return found


def trained(docs: DataFrame, sample_zones: int = SAMPLE_ZONES) -> SemiMarkov:
    """The field for ``docs``. All documents with digits or at-signs are looked through; of the zones with a base span of
    each kind a quarter of ``sample_zones`` are learned from, and as many of those without, the ones with the smallest hashes."""
    each = max(1, sample_zones // len(KINDS))

    def cut(batches):
        least: dict[str, dict[str, int]] = {kind: {} for kind in (*KINDS, "none")}
        for batch in batches:
            for value in batch.column("text"):
                for zone in samples(value.as_py()):
                    place = int.from_bytes(hashlib.blake2b(zone.encode(), digest_size=8).digest(), "big", signed=True)
                    for kind in {s[0] for s in base_spans(zone)} or {"none"}:
                        least[kind][zone] = place
                        if len(least[kind]) >= 4 * each:
                            least[kind] = dict(sorted(least[kind].items(), key=lambda x: (x[1], x[0]))[:each])
        rows = [(kind, place, zone) for kind, some in least.items() for place, zone in sorted((p, z) for z, p in some.items())[:each]]
        columns = [pa.array([r[n] for r in rows], t) for n, t in enumerate((pa.string(), pa.int64(), pa.string()))]
        yield pa.RecordBatch.from_arrays(columns, names=["kind", "place", "zone"])

    telling = docs.where("text RLIKE '[0-9@]'").select("text")
    found = telling.mapInArrow(cut, "kind string, place long, zone string").distinct()
    rank = F.row_number().over(Window.partitionBy("kind").orderBy("place", "zone"))
    rows = found.withColumn("rank", rank).where(F.col("rank") <= each).select("place", "zone").distinct().orderBy("place", "zone")
    return fit(rows.toArrow().column("zone").to_pylist())


def fit(texts: list[str], epochs: int = 6, seed: int = 7) -> SemiMarkov:
    """Learns from zones as they are, with base spans respelled, and with decoys put in their place."""
    chance = random.Random(seed)
    examples = []
    for text in texts:
        spans = _apart(base_spans(text))
        for version in range(3):
            pieces, marks, at, size = [], [], 0, 0
            for kind, a, b in spans:
                pieces.append(text[at:a])
                size += a - at
                new = text[a:b] if version == 0 else decoys(chance) if version == 2 else spellings(kind, text[a:b], chance)
                if version < 2:
                    marks.append((kind, size, size + len(new)))
                pieces.append(new)
                size += len(new)
                at = b
            written = "".join(pieces) + text[at:]
            zone = zone_of(written, 0, len(written))
            where = {(KINDS[k], zone.bounds[i][0], zone.bounds[j - 1][1]): n for n, (i, j, k, _) in enumerate(zone.candidates)}
            if all(m in where for m in marks):
                examples.append((zone, {where[m] for m in marks}))
    field = SemiMarkov()
    for epoch in range(epochs):
        chance.shuffle(examples)
        for zone, gold in examples:
            field.learn(zone, gold, 0.3 / (1 + epoch))
    return field


def _apart(spans: list[Span]) -> list[Span]:
    """Spans that don't overlap; of two that do, the longer."""
    taken: list[Span] = []
    for s in sorted(spans, key=lambda s: (s[1] - s[2], s[1], s[0])):
        if all(s[2] <= t[1] or t[2] <= s[1] for t in taken):
            taken.append(s)
    return sorted(taken, key=lambda s: s[1])


def all_spans(text: str, field: SemiMarkov) -> tuple[list[Span], list[Span]]:
    """Base spans, and those with what the field adds where no base span is."""
    if not _TRIGGER.search(text):
        return [], []
    base = base_spans(text)
    covered = np.zeros(len(text) + 1, dtype=bool)
    for _, a, b in base:
        covered[a:b] = True
    added = []
    for a, b in zones(text):
        zone = zone_of(text, a, b)
        if not zone.candidates:
            continue
        for n in field.decode(zone):
            i, j, kind, _ = zone.candidates[n]
            start, end = zone.bounds[i][0], zone.bounds[j - 1][1]
            if not covered[start:end].any():
                added.append((KINDS[kind], start, end))
    return base, sorted(base + added, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets."""
    parts, at = [], 0
    for kind, a, b in _apart(spans):
        parts += [text[at:a], f"[{kind}]"]
        at = b
    return "".join(parts) + text[at:]


def personal_data(docs: DataFrame, field: SemiMarkov, redact: bool = False, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``n_email, n_ip, n_card, n_phone`` (base spans), ``base_sha256``, ``spans`` (all, as
    ``kind:start:end``), and with ``redact`` also ``redacted``, the text without them.

    Null and empty texts hold nothing. Whole texts are read; time grows with their length. Columns of those names are
    replaced, all others stay, ``text`` only with ``keep_text``.
    """
    sent = docs.sparkSession.sparkContext.broadcast((field.weights, field.follows))
    fields = ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string" + ", redacted string" * redact

    def compute(batch):
        field = SemiMarkov(*sent.value)
        rows = []
        for value in batch.column("text"):
            text = value.as_py() or ""
            base, spans = all_spans(text, field)
            row = [sum(s[0] == k for s in base) for k in KINDS]
            rows.append([*row, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans), *([redacted(text, spans)] if redact else [])])
        return [pa.array(c, pa.int64() if n < 4 else pa.string()) for n, c in enumerate(zip(*rows, strict=True))]

    return B.with_arrow(docs, fields, compute, consumed=() if keep_text else ("text",))
