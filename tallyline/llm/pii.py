"""Personal data in texts: spans that fixed rules find, and further ones that boosted trees select among candidates.

Generators propose overlapping spans of looser formats than the rules allow. Trees score a candidate by format and context.
They are fitted on all texts: beside the rules' spans, each of these is written once more in a form that the rules
miss (spelled out, spaced, without its plus sign, run together with another number), where it stands, and the candidate
that is exactly this form is a positive; every other candidate is a negative. Per kind the threshold is the lowest that
reaches the wanted precision on held-out candidates.
"""

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm import boosting
from tallyline.llm.text import byte_slices, list_array, utf8
from tallyline.session import materialize

SLICE_BYTES = 4 << 20
KINDS = ("email", "ip", "card", "phone")
#: One text of so many is held out for the thresholds.
HELD_OUT = 4
#: Decimals of a probability: thresholds are found from counts by probability.
DECIMALS = 4

LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A run of digits matches from its first digit or not at all, so the search may start there only.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

LOOSE = (
    ("email", re.compile(r"[A-Za-z0-9._%+-]{1,64}\s?(?:[\[({]\s?at\s?[\])}]|@)\s?[A-Za-z0-9-]{1,63}"
                         r"(?:\s?(?:[\[({]\s?dot\s?[\])}]|\.)\s?[A-Za-z0-9-]{1,63}){0,4}")),
    ("email", re.compile(r"[A-Za-z0-9._%+-]{1,64} at [A-Za-z0-9-]{1,63}(?: dot [A-Za-z0-9-]{1,63}){1,4}")),
    ("ip", re.compile(r"(?<![0-9.])[0-9]{1,4}(?:\s?[.]\s?[0-9]{1,4}){3}(?![0-9])")),
    ("ip", re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")),
    ("card", re.compile(r"(?<![0-9A-Za-z])[0-9]{4}(?:[ ./_-]?[0-9]{2,6}){2,4}(?![0-9])")),
    ("card", re.compile(r"(?<![0-9A-Za-z])[0-9]{13,19}(?![0-9A-Za-z])")),
    ("phone", re.compile(r"(?<![0-9A-Za-z])(?:\+|00)?\(?[0-9]{1,4}\)?(?:[ ./-]\(?[0-9]{2,4}\)?){2,5}(?![0-9])")),
)
CUES = tuple(re.compile(p, re.IGNORECASE) for p in (
    r"mail|contact|write", r"\bip\b|host|server|addr", r"card|visa|credit|pay", r"tel|phone|call|fax|mobil",
    r"token|key|secret|hash|id\b", r"version|isbn|page|date"))
BEFORE, AFTER = 30, 10
#: Characters around a rewritten span in which candidates are looked for.
AROUND = 60


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: the name is the whole run before an @, as far as the last match leaves it."""
    end, at = 0, text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at)
        start = at
        while domain and start > end and text[start - 1] in LOCAL_CHARS:
            start -= 1
        if domain and start < at:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, stop) of the fixed rules, kinds by number, in order. Stops are exclusive; code points."""
    found = [(a, 0, b) for a, b in _emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = _digits(m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, stop) of everything the generators propose, in order."""
    return sorted({(m.start(), KINDS.index(kind), m.end()) for kind, p in LOOSE for m in p.finditer(text)})


def features(text: str, start: int, kind: int, stop: int) -> list[float]:
    """Format, number tests and context of a span."""
    span, before, after = text[start:stop], text[max(0, start - BEFORE):start], text[stop:stop + AFTER]
    groups = [len(g) for g in re.findall(r"[0-9]+", span)]
    counts = [span.count(c) for c in " .-()/:+@"]
    tail = re.findall(r"[A-Za-z]+", span)
    digits = _digits(span)
    return [
        *[float(kind == k) for k in range(len(KINDS))], len(span), sum(groups), len(groups), max(groups, default=0),
        min(groups, default=0), len(span) - sum(groups) - sum(counts), *counts, float(len(tail[-1]) if tail else 0),
        float(before[-1:].isalnum()), float(after[:1].isalnum()), float(before[-1:] in "\"'="),
        sum(c.isdigit() for c in before), sum(c.isdigit() for c in after),
        *[float(bool(cue.search(before))) for cue in CUES],
        float(12 <= len(digits) <= 19 and luhn(digits)), float(9 <= len(digits) <= 15),
        float(len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in re.findall(r"[0-9]+", span))),
        float(span[:1] == "+" or span[:2] == "00"),
    ]


def disguised(span: str, kind: int, form: int) -> str:
    """A span of the rules in a form that they miss, one of several by number."""
    if kind == 0:
        local, domain = span.split("@", 1)
        return (f"{local} [at] {domain.replace('.', ' [dot] ')}", f"{local} at {domain.replace('.', ' dot ')}",
                f"{local}(at){domain}", f"{local} @ {domain}")[form % 4]
    if kind == 1:
        return (" . ", ". ", " .")[form % 3].join(span.split("."))
    digits = _digits(span)
    if kind == 2:
        return "./_"[form % 3].join(digits[i:i + 4] for i in range(0, len(digits), 4))
    plain = re.sub(r"[ ().-]+", " ./-"[form % 4], span[1:])
    return plain if form % 2 else "00" + plain


def labelled(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[list[float], bool, int, bool]]:
    """(features, whether it is personal data, kind, whether the rules miss it) of the spans of a text: the rules' own, the loose
    candidates beside them, and those around each span of the rules once it is rewritten or stands before a further number."""
    cover = _Cover(text, base)
    for a, k, b in base:
        yield features(text, a, k, b), True, k, False
    for a, k, b in candidates(text):
        if not cover.touches(a, b):
            yield features(text, a, k, b), False, k, True
    for n, (a, k, b) in enumerate(base):
        before, after = text[max(0, a - AROUND):a], text[b:b + AROUND]
        form = a + b + n
        forms = [(disguised(text[a:b], k, form), "")]
        cards = [text[x:y] for x, c, y in base if c == 2]
        if k == 3 and cards:
            forms.append((text[a:b], " " + _digits(cards[form % len(cards)])))
        for span, more in forms:
            local = before + span + more + after
            true = {(len(before), k, len(before) + len(span))}
            if more:
                true.add((len(before) + len(span) + 1, 2, len(before) + len(span) + len(more)))
            left = _Cover(local, base_spans(local))
            for x, c, y in candidates(local):
                near = x < len(before) + len(span) + len(more) and y > len(before)
                if near and not left.touches(x, y):
                    yield features(local, x, c, y), (x, c, y) in true, c, True


@dataclass(frozen=True)
class PiiModel:
    trees: boosting.Boosted = field(default_factory=lambda: boosting.Boosted(0.0, ()))
    thresholds: tuple[float, ...] = (2.0,) * len(KINDS)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return np.round(self.trees.probability(x), DECIMALS)


class _Cover:
    """Which characters of a text some span has taken."""

    def __init__(self, text: str, spans: list[tuple[int, int, int]]):
        self.taken = bytearray(len(text))
        for start, _, stop in spans:
            self.take(start, stop)

    def take(self, start: int, stop: int) -> None:
        self.taken[start:stop] = b"\1" * (stop - start)

    def touches(self, start: int, stop: int) -> bool:
        return 1 in self.taken[start:stop]


def find(text: str, model: PiiModel) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int, float]]]:
    """The rules' spans, and the added ones with their probabilities: no overlap, the most probable first to choose."""
    base = base_spans(text)
    if min(model.thresholds) > 1:
        return base, []
    cover = _Cover(text, base)
    proposed = [c for c in candidates(text) if not cover.touches(c[0], c[2])]
    if not proposed:
        return base, []
    p = model.probability(np.array([features(text, *c) for c in proposed]))
    added = []
    for i in np.argsort(-p, kind="stable"):
        start, kind, stop = proposed[i]
        if p[i] >= model.thresholds[kind] and not cover.touches(start, stop):
            cover.take(start, stop)
            added.append((start, kind, stop, float(p[i])))
    return base, added


def _may_hold(part: pa.RecordBatch) -> np.ndarray:
    """Which texts have a byte without which no span can be: a digit, @, or a bracket or word for them."""
    offsets, data = utf8(part.column("text"))
    mark = np.zeros(256, bool)
    mark[[*range(48, 58), ord("@"), ord("["), ord("("), ord("{")]] = True
    total = np.concatenate([[0], np.cumsum(mark[data])])
    return total[offsets[1:]] > total[offsets[:-1]]


def _texts(part: pa.RecordBatch) -> Iterator[str | None]:
    """The texts that may hold a span; None for the others."""
    for text, may in zip(part.column("text").to_pylist(), _may_hold(part), strict=True):
        yield text if text and (may or " dot " in text) else None


FIT_ROW = "x array<int>, y boolean, kind int, loose boolean, held boolean"


def _fit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`labelled` of every text. Texts are held out whole, copies of one text alike."""
    for batch in batches:
        for part in byte_slices(batch, "text", SLICE_BYTES):
            rows = [(*r, held) for text in filter(None, _texts(part))
                    for held in [zlib.crc32(text.encode()) % HELD_OUT == 0] for r in labelled(text, base_spans(text))]
            if rows:
                x, y, kind, loose, held = zip(*rows, strict=True)
                x = np.array(x, np.int32)
                yield pa.RecordBatch.from_arrays(
                    [list_array(x.ravel(), np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(y, pa.bool_()),
                     pa.array(kind, pa.int32()), pa.array(loose, pa.bool_()), pa.array(held, pa.bool_())],
                    names=["x", "y", "kind", "loose", "held"])


def _probabilities(model: PiiModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)
                yield pa.RecordBatch.from_arrays([batch.column("kind"), pa.array(model.probability(x)), batch.column("y"), batch.column("n")],
                                                 names=["kind", "p", "y", "n"])

    return run


def fit(texts: DataFrame, text: str = "text", precision: float = 0.95, least: float = 0.5) -> PiiModel:
    """Fit on the candidates of all texts but those held out, every fourth by the hash of the text.

    The threshold of a kind is the lowest at which, of all held-out candidates that the
    rules miss, at least `precision` are positive, one more false one assumed, and no lower than `least`. How common rewritten forms are is unknown:
    the precision is that of a text with as many of them as the rules find.
    """
    found = texts.select(F.col(text).alias("text")).mapInArrow(_fit_rows, FIT_ROW)
    rows = materialize(found.groupBy(*found.columns).agg(F.count("*").alias("n")), "pii-rows")
    model = PiiModel(boosting.fit_table(rows.where("not held")))
    scored = rows.where("held and loose").mapInArrow(_probabilities(model), "kind int, p double, y boolean, n long")
    counts = scored.groupBy("kind", "p").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("y"), F.col("n")).otherwise(0)).alias("right")).toArrow()
    kind, p, n, right = (counts.column(c).to_numpy() for c in ("kind", "p", "n", "right"))
    thresholds = []
    for k in range(len(KINDS)):
        own = kind == k
        thresholds.append(max(least, boosting.lowest_threshold(
            np.append(p[own], 1.0), np.append(right[own], 0), precision, np.append(n[own], 1))))
    return PiiModel(model.trees, tuple(thresholds))


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("base", pa.bool_()),
                  ("probability", pa.float64())])


def personal_data(texts: DataFrame, model: PiiModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, spans and redacted of every row, in one pass over whole texts, without a shuffle.

    spans: array of (kind, start, stop, base, probability) by start, then kind in the order of KINDS; positions in code
    points, stop exclusive; base marks what the rules found, with probability 1. redacted: the text with spans replaced by
    [kind], the earlier of overlapping ones first. A null text counts as empty. Null and repeated keys are carried through;
    other columns are left out.
    """
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE_BYTES):
                spans, redacted = [], []
                for whole, may in zip(part.column("text").to_pylist(), _texts(part), strict=True):
                    base, added = find(may, known) if may else ([], [])
                    every = sorted([(*b, 1.0, True) for b in base] + [(*a, False) for a in added])
                    spans.append([dict(kind=KINDS[k], start=a, stop=b, base=r, probability=p) for a, k, b, p, r in every])
                    pieces, at = [], 0
                    for a, k, b, _, _ in every:
                        if a >= at:
                            pieces += [whole[at:a], f"[{KINDS[k]}]"]
                            at = b
                    redacted.append("".join([*pieces, whole[at:]]) if pieces else whole or "")
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(spans, pa.list_(SPAN)), pa.array(redacted, pa.string())],
                    names=["key", "spans", "redacted"])

    kind = texts.schema[key].dataType.simpleString()
    return texts.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        run, f"key {kind}, spans array<struct<kind:string,start:int,stop:int,base:boolean,probability:double>>, "
             "redacted string").withColumnRenamed("key", key)
