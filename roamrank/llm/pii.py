"""Personal data by candidate gradient boosting.

Strict patterns give the base spans, which always stay. High-recall generators
propose further, overlapping spans: written-out addresses, numbers without a
country code, numbers hidden in longer runs of digits. Boosted trees score each
from its format and context; of those above their kind's calibrated threshold the
likeliest that overlap nothing chosen before are added.

Null text counts as empty and has no spans. Repeated rows are handled alike, ties
between candidates go to the earlier start and the longer span, an empty table
gives an empty result, and columns besides the text pass through untouched; the
result column replaces one of the same name. Texts of any length are scanned whole,
in time proportional to their length.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roamrank.llm.batches import bound_batches, give_back, tidy
from roamrank.llm import boosting

KINDS = ("email", "ip", "card", "phone")
SPANS = "array<struct<kind:string,start:int,end:int,base:boolean,score:double>>"
#: Documents and candidates that the trees are fitted on, at most.
SAMPLE_DOCUMENTS = 2_000
SAMPLE_CANDIDATES = 6_000
PRECISION = 0.98

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
MAYBE = re.compile(r"[0-9@]|[(\[ ]at[)\] ]")

# What the generators propose; every repetition is bounded.
LOOSE = {
    "email": re.compile(
        r"[A-Za-z0-9._%+-]{1,64}(?: ?@ ?| ?[(\[]at[)\]] ?| at )[A-Za-z0-9-]{1,63}"
        r"(?:(?:\.| ?[(\[]dot[)\]] ?| dot )[A-Za-z0-9-]{2,63}){1,4}"
    ),
    "ip": re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\[\.\]|\(\.\)| ?\. ?)(?:[0-9]{1,3}(?:\[\.\]|\(\.\)| ?\. ?)){2}[0-9]{1,3}(?![0-9])"),
    "card": re.compile(r"(?<![0-9])(?:[0-9]{14,19}|[0-9]{4}(?:[ .-][0-9]{4}){3}|[0-9]{4}[ .-][0-9]{6}[ .-][0-9]{5})(?![0-9])"),
    "phone": re.compile(r"(?:\+?[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|(?<![0-9])[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"),
}
HINTS = {
    "email": re.compile(r"mail|contact|write|address|@", re.I),
    "ip": re.compile(r"\bip\b|host|server|address|login", re.I),
    "card": re.compile(r"card|visa|amex|credit|pay", re.I),
    "phone": re.compile(r"phone|call|tel\b|fax|mobile|contact", re.I),
}
DECOYS = re.compile(r"version|\bv$|order|invoice|isbn|serial|section|page|licen[cs]e|released|ratio|build", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches; found from each ``@``, so long runs without one cost nothing."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            done = m.end()
            found.append((start, done))
        else:
            done = max(done, at + 1)
        at = text.find("@", max(at + 1, done))
    return found


def strict(kind: str, piece: str) -> bool:
    digits = re.sub("[^0-9]", "", piece)
    if kind == "ip":
        values = [x.strip().lstrip("0") for x in piece.split(".")]
        return all(len(x) <= 3 and int(x or "0") <= 255 for x in values)
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The fixed patterns' spans by start, then kind; kinds may overlap each other."""
    found = [("email", *x) for x in _emails(text)] if "@" in text else []
    for kind, pattern in (("ip", IP), ("card", CARD), ("phone", PHONE)):
        found += [(kind, *m.span()) for m in pattern.finditer(text) if strict(kind, m.group())]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def candidates(text: str) -> list[tuple[str, int, int]]:
    """What the generators propose, overlaps included."""
    digits = re.search("[0-9]", text)
    found = []
    for kind, pattern in LOOSE.items():
        if kind == "email" and not ("@" in text or re.search(r"[(\[]at[)\]]| at [^ ]+ ?(?:\.|[(\[]dot| dot )", text)):
            continue
        if kind == "email" or digits:
            found += [(kind, *m.span()) for m in pattern.finditer(text)]
    return sorted(set(found), key=lambda s: (s[1], -s[2], s[0]))


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format of the span and what stands around it."""
    piece, before, after = text[start:end], text[max(0, start - 24) : start], text[end : end + 12]
    digits = re.sub("[^0-9]", "", piece)
    groups = [len(x) for x in re.findall("[0-9]+", piece)]
    numbers = [int(x) for x in re.findall("[0-9]+", piece)] if kind == "ip" else [0]
    left, right = before[-1:], after[:1]
    return [
        KINDS.index(kind),
        len(piece),
        len(digits),
        len(groups),
        max(groups, default=0),
        min(groups, default=0),
        piece.count("."),
        piece.count("-"),
        piece.count(" "),
        "(" in piece or "[" in piece,
        piece.startswith("+"),
        bool(digits) and luhn(digits),
        int(digits[:1] or 0),
        len(set(digits)),
        max(numbers),
        left.isalnum(),
        right.isalnum(),
        left in ".-_/=#$" and bool(left),
        right in ".-_/=" and after[1:2].isalnum(),
        sum(c.isdigit() for c in before[-8:]),
        sum(c.isdigit() for c in after[:8]),
        bool(HINTS[kind].search(before)),
        bool(DECOYS.search(before)),
        "@" in piece,
        bool(re.search(r"[(\[ ](?:at|dot)[)\] ]", piece)),
        bool(re.search(r"[A-Za-z]{2,}$", piece)),
    ]


def _drawn(seed: int, n: int) -> tuple[list[list[float]], list[int]]:
    """Made-up spans in sentences, true and false, for forms that a sample may lack."""
    rng = random.Random(seed)
    num = lambda k: "".join(str(rng.randrange(10)) for _ in range(k))
    word = lambda: "".join(rng.choice("aeinorst") for _ in range(rng.randrange(2, 9)))

    def card(valid: bool, k: int = 16) -> str:
        body = rng.choice("3456") + num(k - 2)
        good = next(c for c in "0123456789" if luhn(body + c))
        return body + (good if valid else str((int(good) + rng.randrange(1, 10)) % 10))

    def shaped(s: str) -> str:
        sep = rng.choice(["", " ", "-", "."])
        return sep.join(s[i : i + 4] for i in range(0, len(s), 4)) if len(s) == 16 else s

    def true(kind: str) -> str:
        if kind == "card":
            return shaped(card(True, rng.choice([14, 15, 16, 16, 16, 19])))
        if kind == "phone":
            area, sep = num(3), rng.choice(" .-")
            lead = rng.choice(["", "+1 ", "+1-", "1 ", "+44 "])
            return f"{lead}({area}) {num(3)}{sep}{num(4)}" if rng.random() < 0.5 else f"{lead}{area}{sep}{num(3)}{sep}{num(4)}"
        if kind == "ip":
            return rng.choice([".", "[.]", "(.)"]).join(str(rng.randrange(1, 256)) for _ in range(4))
        at, dot = rng.choice([("@", "."), (" at ", " dot "), ("[at]", "[dot]"), ("(at)", "."), (" (at) ", " (dot) ")])
        return f"{word()}{rng.choice(['', '.', '_'])}{word()}{at}{word()}{dot}{rng.choice(['com', 'org', 'net', 'de'])}"

    def false(kind: str) -> str:
        if kind == "card":
            return shaped(card(False))
        if kind == "phone":
            return f"{num(3)} {num(3)}.{num(4)}" if rng.random() < 0.5 else f"{num(3)}-{num(3)}-{num(4)}"
        if kind == "ip":
            return rng.choice([". ", ".", " . "]).join(str(rng.randrange(0, 999)) for _ in range(4))
        return f"{word()} at {word()}.{word()}"

    x, y = [], []
    for i in range(n):
        kind, label = KINDS[i % 4], (i // 4) % 2
        lead = rng.choice(["", "call ", "card ", "mail ", "ip "]) if label else rng.choice(["version ", "order ", "section ", "build "])
        if not label and kind in ("card", "email"):
            lead = rng.choice(["", lead])
        tail = " " if label or kind != "phone" else rng.choice(["-" + num(3), "." + num(2), num(0) + "/" + num(2)])
        piece = true(kind) if label else false(kind)
        text = f"{word()} {lead}{piece}{tail}{word()} {word()}"
        start = text.index(piece, len(lead))
        x.append(features(text, kind, start, start + len(piece)))
        y.append(label)
    return x, y


@dataclass
class Model:
    """Trees, calibration and each kind's threshold; a few kilobytes whatever the corpus."""

    trees: boosting.Trees
    slope: float
    shift: float
    cuts: dict[str, float]

    def score(self, x: list[list[float]]) -> np.ndarray:
        margin = self.trees.margin(np.asarray(x, dtype=float))
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))


def _silver(batches):
    """Candidates of the sampled documents; the strict checks on an unbroken span label them."""
    for pdf in batches:
        out = []
        for text in pdf["text"]:
            if not text or not MAYBE.search(text):
                continue
            for kind, start, end in candidates(text):
                piece = text[start:end]
                label = strict(kind, piece) if kind in ("card", "ip") and re.fullmatch(r"[0-9. -]+", piece) else None
                if kind == "ip" and label is not None:
                    label = label and " " not in piece
                if kind == "phone":
                    label = piece.startswith("+")
                if kind == "email":
                    label = piece.count("@") == 1 and bool(re.search(r"\.[A-Za-z]{2,}$", piece)) and " " not in piece
                if label is not None:
                    out.append((features(text, kind, start, end), int(label)))
        x = pd.Series([[float(v) for v in f] for f, _ in out], dtype=object)
        yield pd.DataFrame({"x": x, "y": pd.Series([v for _, v in out], dtype="int32")})


def fit(docs: DataFrame, seed: int = 7) -> Model:
    """Fit on drawn spans and on candidates from a bounded sample of the documents.

    The sample is the SAMPLE_DOCUMENTS smallest hashes of doc_id, of whose
    candidates the SAMPLE_CANDIDATES with the smallest hashes are used.
    """
    ids = docs.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCUMENTS)
    bound_batches(docs.sparkSession)
    # At most SAMPLE_DOCUMENTS rows of one number are broadcast.
    some = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id", "left_semi").select("text")
    rows = some.mapInPandas(tidy(_silver), "x array<double>, y int")
    rows = rows.orderBy(F.xxhash64("x", "y"), "x", "y").limit(SAMPLE_CANDIDATES).collect()
    drawn_x, drawn_y = _drawn(seed, 2400)
    x = np.asarray(drawn_x + [list(r["x"]) for r in rows], dtype=float)
    y = np.asarray(drawn_y + [r["y"] for r in rows], dtype=float)
    held = np.random.default_rng(seed).random(len(y)) < 1 / 3
    trees = boosting.fit(x[~held], y[~held])
    margin = trees.margin(x[held])
    slope, shift = boosting.platt(margin, y[held])
    model = Model(trees, slope, shift, {})
    p = model.score(x[held])
    for k, kind in enumerate(KINDS):
        own = x[held][:, 0] == k
        model.cuts[kind] = boosting.threshold(p[own], y[held][own], PRECISION, least=0.7)
    return model


def spans(texts: list[str | None], model: Model) -> list[list[tuple[str, int, int, bool, float]]]:
    """All spans of each text, by start, then kind."""
    result, open_, x = [], [], []
    for i, text in enumerate(texts):
        base = base_spans(text) if text and MAYBE.search(text) else []
        result.append([(k, s, e, True, 1.0) for k, s, e in base])
        if text and MAYBE.search(text):
            starts = [s for _, s, _ in base]
            # Of the spans up to each, the furthest end.
            ends = np.maximum.accumulate([e for _, _, e in base]).tolist() if base else []
            for kind, s, e in candidates(text):
                before = bisect_left(starts, e)
                if not before or ends[before - 1] <= s:
                    open_.append((i, kind, s, e))
                    x.append(features(text, kind, s, e))
    if open_:
        score = model.score(x)
        kept = [(-p, *c) for p, c in zip(score, open_, strict=True) if p >= model.cuts[c[1]]]
        taken: dict[int, list[tuple[int, int]]] = {}
        for p, i, kind, s, e in sorted(kept, key=lambda c: (c[0], c[1], c[3], -c[4], c[2])):
            own = taken.setdefault(i, [])  # in order, and apart from each other
            at = bisect_left(own, (s, e))
            if (at == 0 or own[at - 1][1] <= s) and (at == len(own) or own[at][0] >= e):
                own.insert(at, (s, e))
                result[i].append((kind, s, e, False, float(-p)))
    return [sorted(r, key=lambda s: (s[1], KINDS.index(s[0]), s[2])) for r in result]


def find(text: Column, model: Model) -> Column:
    """The spans of a text column as an array of SPANS; positions are code points, the end exclusive."""
    bound_batches()

    @F.pandas_udf(SPANS)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        names = ("kind", "start", "end", "base", "score")

        def named(texts: pd.Series) -> pd.Series:
            return pd.Series([[dict(zip(names, s, strict=True)) for s in row] for row in spans(list(texts), model)], dtype=object)

        try:
            yield from map(named, batches)
        finally:
            give_back()

    return found(text)


def _without(text: str | None, row: list[tuple[str, int, int, bool, float]]) -> str | None:
    if not row:
        return text
    parts, done = [], 0
    for kind, start, end, _, _ in row:
        if start >= done:
            parts += [text[done:start], f"<{kind}>"]
        done = max(done, end)
    return "".join([*parts, text[done:]])


def redact(text: Column, model: Model) -> Column:
    """The text with every span, overlapping ones merged, replaced by its kind; null stays null."""
    bound_batches()

    @F.pandas_udf("string")
    def redacted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        try:
            for texts in batches:
                rows = spans(list(texts), model)
                yield pd.Series([_without(t, row) for t, row in zip(texts, rows, strict=True)], dtype=object)
        finally:
            give_back()

    return redacted(text)


def detect(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The documents with their spans in ``pii`` (null text: none)."""
    return docs.withColumn("pii", find(F.col("text"), model or fit(docs)))
