"""Personal data: certain spans by rules, and more spans by gradient-boosted trees over candidates.

The rules find e-mail addresses, IP addresses, card and phone numbers. They take the longest run of
fitting characters and give up where it fails, so a phone number next to another number is lost, and
so are addresses that are written out ("name at host dot org", "10.0.0[.]7"). High-recall generators therefore
propose many overlapping spans, boosted trees judge each by its format and context, and spans above a threshold
that do not touch a rule's span or a better span are added.

The trees are trained here. The rules' spans cannot teach what the rules lose, so every one of them is also
rewritten in its context: addresses are written out, numbers are put beside another number; the spans meant are positive, all
other candidates there are negative, as are addresses put together from the words around, IP numbers with a
part too many or too large, and numbers standing alone that the rules refuse. Other candidates of the texts that the rules cannot judge
have no label. Equal feature rows are counted where they are made. For each kind the ``TRAIN_ROWS`` most frequent
rows of one half of the documents train the trees; the threshold is the lowest with the asked precision on
all rows of the other half, which are scored in the tasks and counted by score.

Defined cases: a null or empty text has no spans; equal rows get equal results; without
positive and negative candidates of a kind nothing is added for it; very long texts take time in proportion,
numbers of any length are numbers. Rows are judged one by one, so ties and repeated ids play no part.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .frames import discard, stored, unused, without

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, str]

# --- rules (fixed values; possessive forms of the given patterns, which match the same) ---

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ANY = re.compile(r"[0-9@]|\bat\b", re.I)


def digits_of(text: str) -> list[int]:
    return [ord(c) - 48 for c in text if "0" <= c <= "9"]


def luhn(digits: list[int]) -> bool:
    """The check sum of card numbers."""
    total = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits)))
    return total % 10 == 0


def octet(digits: str) -> bool:
    """Whether a number of any length is at most 255."""
    value = digits.lstrip("0")
    return len(value) < 3 or len(value) == 3 and value <= "255"


def emails(text: str) -> Iterator[tuple[int, int]]:
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            free = found.end()
            yield start, free
        at = text.find("@", max(at + 1, free))


def rule_spans(text: str) -> list[Span]:
    """Spans of the rules, by start and then kind."""
    out = [(s, e, "email") for s, e in emails(text)]
    out += [(*m.span(), "ip") for m in IP.finditer(text) if all(map(octet, m[0].split(".")))]
    for pattern, kind, least, most in ((CARD, "card", 14, 19), (PHONE, "phone", 10, 15)):
        for m in pattern.finditer(text):
            digits = digits_of(m[0])
            if least <= len(digits) <= most and (kind == "phone" or luhn(digits)):
                out.append((*m.span(), kind))
    return sorted(out, key=_order)


def _order(span: Span) -> tuple[int, int, int]:
    return span[0], KINDS.index(span[2]), span[1]


# --- candidates ---

NUMBERS = re.compile(r"(?<![\w.@=/-])[+(]?[0-9][0-9().+-]*(?: [(+]?[0-9][0-9().+-]*)*(?![\w@=/])")
PART = re.compile(r"[^ ]+")
GROUPS = re.compile("[0-9]+").findall
# Written forms of the sign between name and host and of the dots; names run backwards from the sign.
AT = re.compile(r" ?[\[(] ?at ?[\])] ?| at | ?@ ?", re.I)
_DOT = r"(?:\.| ?[\[(](?:dot|\.)[\])] ?| dot )"
HOST = re.compile(rf"[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)+", re.I)
EMAN = re.compile(r"[A-Za-z0-9_%+-]+(?:(?:\.| ?[\])](?:tod|\.)[\[(] ?| tod )[A-Za-z0-9_%+-]+)*", re.I)
DOT = re.compile(_DOT, re.I)
WRITTEN_IP = re.compile(rf"(?<![\w.])[0-9]+(?:{_DOT}[0-9]+){{3,}}(?!\w)", re.I)

# Words near numbers and addresses, in the languages of the documents.
CUES = {
    "email": ("mail", "email", "e-mail", "contact", "correo", "courriel", "adresse"),
    "ip": ("ip", "host", "server", "addr"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "tarjeta", "carte", "karte"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "handy", "telefono", "téléphone"),
}
FEATURES = 18


def _cues(text: str, start: int) -> dict[str, int]:
    """Whether one of the three words before is typical of a kind."""
    words = {w.strip(".:,;()") for w in text[max(0, start - 40):start].lower().split()[-3:]}
    return {kind: int(not words.isdisjoint(CUES[kind])) for kind in KINDS}


def _number_features(text: str, s: int, e: int) -> dict[str, list[int]]:
    """Features for each kind that a number of so many digits may be."""
    span = text[s:e]
    digits = digits_of(span)
    groups = [len(g) for g in GROUPS(span)]
    cues = _cues(text, s)
    shape = [len(digits), len(groups), groups[0], groups[-1], max(groups), min(groups), int(span[0] == "+"),
             int(span.count("(") == span.count(")")) + span.count("("), span.count("-"), span.count("."), span.count(" "),
             int(luhn(digits)), int(set(groups) == {4})]
    rest = [digits[0], int(span[-1].isdigit()), int(not span[1:].count("+"))]
    return {kind: [*shape, cues[kind], int(any(v for k, v in cues.items() if k != kind)), *rest]
            for kind, least, most in (("card", 12, 19), ("phone", 7, 15)) if least <= len(digits) <= most}


def _email_features(text: str, s: int, e: int, local: str, domain: str) -> list[int]:
    # What the address reads when written plainly; how it is written is no feature.
    local, labels = DOT.sub(".", local), DOT.sub(".", domain).split(".")
    return [len(local), len(labels), len(labels[-1]), len(labels[0]), int(labels[-1].isalpha()), local.count("."),
            int(any(c.isdigit() for c in local)), int(labels[-1].islower()), len("".join(labels)), _cues(text, s)["email"],
            int(labels[0].isalnum()), int(local[0].isalnum()), int("_" in local), int(labels[-1].isdigit()),
            sum(map(str.isdigit, local)), 0, 0, 0]


def _ip_features(text: str, s: int, e: int) -> list[int]:
    parts, cues = DOT.sub(".", text[s:e]).split("."), _cues(text, s)
    return [len(parts), max(map(len, parts)), min(map(len, parts)), sum(map(octet, parts)), int(parts[0].strip("0") == ""),
            sum(p != "0" and p[0] == "0" for p in parts), cues["ip"], int(any(v for k, v in cues.items() if k != "ip")),
            len(parts[0]), len(parts[-1]), *[0] * 8]


def candidates(text: str) -> Iterator[tuple[Span, list[int], bool]]:
    """Overlapping spans with their features, and whether the rules can judge them: a plain address, or a number that stands alone."""
    last = 0
    for at in AT.finditer(text):
        host = HOST.match(text, at.end())
        name = EMAN.match(text[last:at.start()][::-1]) if host else None
        if name:
            s, e = at.start() - name.end(), host.end()
            yield (s, e, "email"), _email_features(text, s, e, text[s:at.start()], host[0]), at[0] == "@" and not DOT.search(host[0].replace(".", ""))
        last = at.end()
    for m in WRITTEN_IP.finditer(text):
        yield (*m.span(), "ip"), _ip_features(text, *m.span()), not m[0].strip("0123456789.")
    for run in NUMBERS.finditer(text):
        parts = [(p.start() + run.start(), p.end() + run.start()) for p in PART.finditer(run[0])]
        for i, (s, _) in enumerate(parts):
            for j in range(i, len(parts)):  # every part has a digit
                span = text[s:parts[j][1]].rstrip(".(+-")
                n = sum(map(span.count, "0123456789"))
                if n > 19:
                    break
                e = s + len(span)
                if n >= 7:
                    alone = i == 0 and j == len(parts) - 1
                    for kind, features in _number_features(text, s, e).items():
                        yield (s, e, kind), features, alone


# --- boosted trees ---

DEPTH, TREES, SHRINK, LEVELS = 3, 40, 0.3, 32
TRAIN_ROWS = 20_000
PRECISION = 0.98
# Scores are counted in so many steps.
STEPS = 1000


class Trees:
    """Gradient-boosted trees with logistic loss over small whole-number features."""

    def __init__(self):
        self.bias, self.trees, self.threshold = 0.0, [], np.inf

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        self.bias = float(np.log(((y * weight).sum() + 1) / (((1 - y) * weight).sum() + 1)))
        margin = np.full(len(y), self.bias)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-margin))
            tree, value = self._grow(x, (p - y) * weight, p * (1 - p) * weight, np.arange(len(y)), DEPTH)
            self.trees.append(tree)
            margin += value

    def _grow(self, x: np.ndarray, g: np.ndarray, h: np.ndarray, rows: np.ndarray, depth: int) -> tuple[tuple, np.ndarray]:
        """A tree as (feature, cut, left, right) or (value,), and what it adds to each row."""
        out = np.zeros(len(x))
        leaf = -SHRINK * g[rows].sum() / (h[rows].sum() + 1)
        gain, feature, cut = 1e-6, None, None
        if depth:
            whole = g[rows].sum() ** 2 / (h[rows].sum() + 1)
            for f in range(x.shape[1]):
                left_g = np.cumsum(np.bincount(x[rows, f], g[rows], LEVELS))[:-1]
                left_h = np.cumsum(np.bincount(x[rows, f], h[rows], LEVELS))[:-1]
                right_g, right_h = g[rows].sum() - left_g, h[rows].sum() - left_h
                gains = left_g ** 2 / (left_h + 1) + right_g ** 2 / (right_h + 1) - whole
                best = int(np.argmax(gains))
                if gains[best] > gain:
                    gain, feature, cut = gains[best], f, best
        if feature is None:
            out[rows] = leaf
            return (leaf,), out
        low = x[rows, feature] <= cut
        left, a = self._grow(x, g, h, rows[low], depth - 1)
        right, b = self._grow(x, g, h, rows[~low], depth - 1)
        return (feature, cut, left, right), a + b

    def score(self, features: list[int]) -> float:
        margin = self.bias
        for tree in self.trees:
            while len(tree) == 4:
                tree = tree[2] if features[tree[0]] <= tree[1] else tree[3]
            margin += tree[0]
        return 1 / (1 + np.exp(-margin))

    def calibrate(self, counts: dict[int, tuple[int, int]]) -> None:
        """The lowest score above which at least ``PRECISION`` of held-out candidates are positive, and not under a half.

        ``counts``: negative and positive candidates by score, in whole steps of 1 / ``STEPS``.
        """
        self.threshold, wrong, right = np.inf, 0, 0
        for step in sorted(counts, reverse=True):
            if 2 * step < STEPS:
                break
            wrong, right = wrong + counts[step][0], right + counts[step][1]
            if right >= PRECISION * (right + wrong) and right:
                self.threshold = step / STEPS


class _Apart:
    """Spans that do not overlap, in order: whether another one touches them."""

    def __init__(self, spans: list[Span]):
        self.starts, self.ends = [], []
        for s, e, _ in sorted(spans):
            if self.ends and s < self.ends[-1]:
                self.ends[-1] = max(e, self.ends[-1])
            else:
                self.starts.append(s)
                self.ends.append(e)

    def touched(self, s: int, e: int) -> bool:
        i = bisect_left(self.starts, e)
        return i > 0 and self.ends[i - 1] > s

    def add(self, s: int, e: int) -> None:
        i = bisect_left(self.starts, s)
        self.starts.insert(i, s)
        self.ends.insert(i, e)


BEFORE, AFTER = 40, 20
LETTERS = re.compile(r"[^\W\d_]+")


def _rewritten(text: str, spans: list[Span]) -> Iterator[tuple[str, int, int, list[Span]]]:
    """Short texts with the rules' spans in forms that the rules lose: where the form stands, and the spans that are meant in it."""
    numbers = [x for x in spans if x[2] in ("card", "phone")]
    following = dict(zip(numbers, numbers[1:] + numbers[:1]))
    for s, e, kind in spans:
        before, own, after = text[max(0, s - BEFORE):s], text[s:e], text[e:e + AFTER]
        at = len(before)
        forms: list[tuple[str, list[Span]]] = []
        if kind == "email":
            name, _, host = own.partition("@")
            for sign, dot in ((" at ", " dot "), ("[at]", "."), (" (at) ", "[dot]")):
                form = name + sign + host.replace(".", dot)
                forms.append((form, [(at, at + len(form), kind)]))
            words = LETTERS.findall(before)[-3:]
            if len(words) == 3:
                forms += [(f"{words[0]}{sign}{words[1]}.{words[2]}", []) for sign in (" at ", "@")]
        elif kind == "ip":
            for dot in ("[.]", " dot ", "(.)"):
                form = own.replace(".", dot)
                forms.append((form, [(at, at + len(form), kind)]))
            first, *rest = own.split(".")
            for parts in ((first, *rest, rest[0]), (first, *rest[:-1], f"{rest[-1]}{rest[-1]}{rest[-1]}9"), (f"{first}999", *rest)):
                forms.append(("[.]".join(parts), []))
        else:
            a, b, other = following[s, e, kind]
            second = at + len(own) + 1
            forms.append((f"{own} {text[a:b]}", [(at, at + len(own), kind), (second, second + b - a, other)]))
        for form, meant in forms:
            yield before + form + after, at, at + len(form), meant


def _labelled(text: str) -> Iterator[tuple[str, list[int], int]]:
    spans = rule_spans(text)
    known, apart = set(spans), {k: _Apart([x for x in spans if x[2] == k]) for k in KINDS}
    for (s, e, kind), features, judged in candidates(text):
        if (s, e, kind) in known:
            yield kind, features, 1
        elif judged and not apart[kind].touched(s, e):
            yield kind, features, 0
    for form, start, end, meant in _rewritten(text, spans):
        for (s, e, kind), features, _ in candidates(form):
            if (s, e, kind) in meant:
                yield kind, features, 1
            elif s < end and start < e:
                yield kind, features, 0


def train(docs: DataFrame, text: str, most: int = TRAIN_ROWS) -> dict[str, Trees]:
    """Trees and threshold of every kind. At most ``most`` feature rows of a kind train its trees; all rows of the other half set the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = Counter()
            for t in pc.fill_null(batch.column(0), "").to_pylist():
                if ANY.search(t):
                    half = zlib.crc32(t.encode()) & 1
                    found.update((kind, tuple(min(f, LEVELS - 1) for f in x), y, half) for kind, x, y in _labelled(t))
            columns = list(zip(*found)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip((*columns, list(found.values())), (pa.string(), pa.list_(pa.int64()), pa.int32(), pa.int32(), pa.int64()))],
                ["kind", "x", "y", "half", "n"])

    rows = docs.select(text).mapInArrow(run, "kind string, x array<long>, y int, half int, n long")
    rows = stored(rows.groupBy("kind", "x", "y", "half").agg(F.sum("n").alias("n")), "candidates")
    sizes = {(r["kind"], r["half"], r["y"]): r["n"] for r in rows.groupBy("kind", "half", "y").agg(F.sum("n").alias("n")).collect()}
    out = {kind: Trees() for kind in KINDS}
    fitted = [kind for kind in KINDS if all(sizes.get((kind, half, y), 0) >= 5 for half in (0, 1) for y in (0, 1))]
    for kind in fitted:
        own = rows.where((F.col("kind") == kind) & (F.col("half") == 0)).orderBy(F.desc("n"), "x", "y").limit(most).collect()
        out[kind].fit(np.array([r["x"] for r in own], np.int64), np.array([r["y"] for r in own], float), np.array([r["n"] for r in own], float))
    shared = docs.sparkSession.sparkContext.broadcast(out)  # a fixed number of trees

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            steps = [int(shared.value[k].score(x) * STEPS) for k, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(steps, pa.int32()), batch.column(2), batch.column(3)], ["kind", "step", "y", "n"])

    if fitted:
        held_out = rows.where((F.col("half") == 1) & F.col("kind").isin(fitted)).select("kind", "x", "y", "n")
        steps = held_out.mapInArrow(score, "kind string, step int, y int, n long").groupBy("kind", "step").agg(
            F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("wrong"), F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("right")).collect()
        for kind in fitted:
            out[kind].calibrate({r["step"]: (r["wrong"], r["right"]) for r in steps if r["kind"] == kind})
    discard(rows)
    return out


def all_spans(text: str, rules: list[Span], models: dict[str, Trees]) -> list[Span]:
    """The rules' spans and the trees' spans that touch none of them; of touching ones the better, longer, earlier."""
    taken, out, proposed = _Apart(rules), list(rules), []
    for (s, e, kind), features, _ in candidates(text):
        if models[kind].threshold <= 1 and not taken.touched(s, e):
            score = models[kind].score([min(f, LEVELS - 1) for f in features])
            if score >= models[kind].threshold:
                proposed.append((-score, s - e, s, e, kind))
    for _, _, s, e, kind in sorted(proposed):
        if not taken.touched(s, e):
            taken.add(s, e)
            out.append((s, e, kind))
    return sorted(out, key=_order)


_SPANS = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32()), ("kind", pa.string())]))
_SPANS_SQL = ArrayType(StructType([StructField("s", IntegerType()), StructField("e", IntegerType()), StructField("kind", StringType())]))


def add_spans(docs: DataFrame, text: str, models: dict[str, Trees], rules: str = "rule_spans", spans: str = "spans",
              redacted: str | None = None) -> DataFrame:
    """``docs`` with the spans of the rules and all spans, as arrays of (s, e, kind) in code points.

    ``redacted`` names a column for the text with every span replaced by its kind in
    brackets (of touching spans the earlier and longer). New columns replace those of
    the same name, but for ``redacted``, which may be the text's own name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(models)  # a fixed number of trees
    kept = without(docs, rules, spans, *([redacted] if redacted else []))
    fields = [StructField(rules, _SPANS_SQL), StructField(spans, _SPANS_SQL)] + ([StructField(redacted, StringType())] if redacted else [])
    schema = StructType([*(docs.schema[c] for c in kept), *fields])

    def rows(found: list[Span]) -> list[dict]:
        return [{"s": s, "e": e, "kind": k} for s, e, k in found]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            certain, every, texts = [], [], []
            for t in batch.column(len(kept)).to_pylist():
                base = rule_spans(t) if t and ANY.search(t) else []
                found = all_spans(t, base, shared.value) if t and ANY.search(t) else []
                certain.append(rows(base))
                every.append(rows(found))
                texts.append(redact(t, found) if t and redacted else t)
            columns = [pa.array(certain, _SPANS), pa.array(every, _SPANS)] + ([pa.array(texts, pa.string())] if redacted else [])
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], *columns], schema.names)

    return docs.select(*kept, F.col(text).alias(unused(docs, "_text"))).mapInArrow(run, schema)


def redact(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind; of overlapping spans the first and longest gives the name."""
    out, at = [], 0
    for s, e, kind in sorted(spans, key=lambda x: (x[0], -x[1], KINDS.index(x[2]))):
        if s >= at:
            out += [text[at:s], f"[{kind.upper()}]"]
        at = max(at, e)
    return "".join(out) + text[at:]


def listed(spans: str) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])), ",")


def count_of(spans: str, kind: str) -> Column:
    """How many spans have the kind."""
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")
