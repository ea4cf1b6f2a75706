"""Operator 8: personal data with a semi-Markov conditional random field.

Exact patterns give the base spans. Around digits and @ signs, *zones* of
neighbouring tokens are cut into units (runs of letters, runs of digits, single
other characters); runs of units are candidate segments of a type, scored as a
whole from features of the span. Segments hold at most ``LONGEST`` units, so the
dynamic programme that chooses boundaries and types together takes time linear
in the text. Its spans are added where they do not overlap base spans.

The model learns from zones of a bounded sample of documents, labelled with
their base spans, from rewritten forms of the phone numbers found there (without
country code, other separators), and from number forms that are no personal data.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
LONGEST = 24
MAX_ZONES, MAX_DOCS = 500, 2000
EPOCHS, RATE, DECAY = 60, 0.3, 1e-3
THRESHOLD = 1.0  # an added span must score so much above no span

# fixed values: the contract's patterns, in forms that take linear time
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_SEED = re.compile(r"[0-9@]")
_END = re.compile(r"\s|$")
_UNIT = re.compile(r"[A-Za-z]+|[0-9]+|[^A-Za-z0-9]", re.S)
NOT_PERSONAL = ("2024-01-15", "12/05/2021", "1.2.3", "3.14", "1,234,567", "10:45:30", "1999-2004", "2.0.", "4.0",
                "12345678", "1234567890", "1234567890123456", "4-6 8-10", "100 200 300 400", "v1.10.2", "0.001 0.25 17.5",
                "2024 01 15 10 30", "555", "id=48213377", "a1b2c3d4e5f60718", "3 x 450", "1-2-3-4-5")


def luhn(digits: str) -> bool:
    total = sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits))))
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping e-mail addresses, found from their @ signs."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, domain.end()))
            last = domain.end()
        at = text.find("@", max(at + 1, last))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all base spans, sorted."""
    out = [(a, 0, b) for a, b in emails(text)]
    digits = lambda m: "".join(_DIGITS.findall(m.group()))
    if _SEED.search(text):
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text)
                if all(len(y := x.lstrip("0")) <= 3 and int(y or 0) <= 255 for x in m.group().split("."))]
        out += [(m.start(), 2, m.end()) for m in _CARD.finditer(text) if 12 <= len(d := digits(m)) <= 19 and luhn(d)]
        out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return sorted(out)


def zones(text: str) -> list[tuple[int, int]]:
    """Maximal runs of tokens with a digit or @ that lie one blank apart."""
    out: list[tuple[int, int]] = []
    hit = _SEED.search(text)
    while hit:
        start = hit.start()
        while start and not text[start - 1].isspace():
            start -= 1
        end = _END.search(text, hit.end()).start()
        if out and text[out[-1][1]:start] in (" ", "\t"):
            out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
        hit = _SEED.search(text, end)
    return out


def segments(zone: str) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Units (start, end) of a zone, and its candidate segments as unit ranges."""
    units = [m.span() for m in _UNIT.finditer(zone)]
    kind = ["d" if "0" <= zone[a] <= "9" else "l" if zone[a].isascii() and zone[a].isalpha() else zone[a] for a, _ in units]
    found = []
    for i, k in enumerate(kind):
        if k in "dl+(":
            digits = signs = letters = 0
            for j in range(i, min(len(units), i + LONGEST)):
                u = kind[j]
                digits += (units[j][1] - units[j][0]) * (u == "d")
                letters += u == "l"
                signs += u == "@"
                if u.isspace() and (letters or signs) or signs > 1 or u not in "dl@+(). -_%\t" or digits > 20:
                    break
                if u in "dl" and (signs if letters or signs else digits >= 4):
                    found.append((i, j + 1))
                if letters and not signs and u.isspace():
                    break
    return units, found


FLAGS = ("bias", "at", "dotted_domain", "letter_ending", "plus_first", "parens", "parens_balanced", "dash", "blank", "dots3",
         "octets", "no_separator", "luhn", "one_separator_kind", "left_edge", "right_edge", "left_tight", "right_tight",
         "digits_4_6", "digits_7_8", "digits_9", "digits_10", "digits_11", "digits_12_15", "digits_16", "digits_17_20",
         "groups_1", "groups_2", "groups_3", "groups_4", "groups_5", "groups_3_3_4", "first_group_1_3", "last_group_4",
         "slash_or_comma", "leading_letter")


def span_features(zone: str, a: int, b: int) -> list[float]:
    """Features of the whole span ``zone[a:b]``."""
    s = zone[a:b]
    groups = _DIGITS.findall(s)
    digits = "".join(groups)
    n, left, right = len(digits), zone[a - 1:a], zone[b:b + 1]
    seps = {c for c in s if not c.isalnum()}
    size = lambda lo, hi=None: lo <= n <= (hi or lo)
    at = "@" in s
    lengths = [len(g) for g in groups]
    core = lengths[-3:]
    return [float(v) for v in (
        1, at, at and "." in s.split("@")[-1].strip("."), at and s[-1].isalpha(), s[0] == "+", "(" in s,
        "(" in s and s.count("(") == s.count(")") == 1, "-" in s, " " in s, s.count(".") == 3 and len(groups) == 4,
        len(groups) == 4 and all(len(g) < 4 and int(g) < 256 for g in groups), not seps, 12 <= n <= 19 and luhn(digits),
        len(seps) == 1, not left or left.isspace(), not right or right.isspace() or right in ".,;:!?)\"'",
        left.isalnum() or left in tuple("=\"_/#-.@"), right.isalnum() or right in tuple("=_/#-@"),
        size(4, 6), size(7, 8), size(9), size(10), size(11), size(12, 15), size(16), size(17, 20),
        *(len(groups) == k for k in (1, 2, 3, 4)), len(groups) > 4, core == [3, 3, 4],
        bool(lengths) and lengths[0] <= 3, bool(lengths) and lengths[-1] == 4, left in tuple("/,:") or right in tuple("/,:"),
        s[0].isalpha())]


@dataclass
class SegmentModel:
    weights: np.ndarray  # kinds x features

    def best(self, zone: str) -> list[tuple[int, int, int]]:
        """(start, kind, end) of the best segmentation's spans."""
        units, cands = segments(zone)
        if not cands:
            return []
        scores = np.array([span_features(zone, units[i][0], units[j - 1][1]) for i, j in cands]) @ self.weights.T - THRESHOLD
        kind = scores.argmax(1)
        by_end: dict[int, list[tuple[int, int, float]]] = {}
        for (i, j), k, s in zip(cands, kind.tolist(), scores.max(1).tolist()):
            if s > 0:
                by_end.setdefault(j, []).append((i, k, s))
        value, back = [0.0], [None]
        for j in range(1, len(units) + 1):
            top, via = value[j - 1], None
            for i, k, s in by_end.get(j, ()):
                if value[i] + s > top:
                    top, via = value[i] + s, (i, k)
            value.append(top)
            back.append(via)
        out, j = [], len(units)
        while j:
            if back[j]:
                i, k = back[j]
                out.append((units[i][0], k, units[j - 1][1]))
                j = i
            else:
                j -= 1
        return out[::-1]


def train(examples: list[tuple[str, list[tuple[int, int, int]]]]) -> SegmentModel:
    """Maximise the conditional likelihood of the gold segmentations: (zone, spans as start, kind, end)."""
    prepared, rows = [], []
    for zone, gold in examples:
        units, cands = segments(zone)
        spans = {(units[i][0], units[j - 1][1]): c for c, (i, j) in enumerate(cands)}
        if all((a, b) in spans for a, _, b in gold):
            lo = len(rows)
            rows += [span_features(zone, units[i][0], units[j - 1][1]) for i, j in cands]
            prepared.append((lo, len(units), cands, [(lo + spans[a, b], k) for a, k, b in gold]))
    x = np.array(rows, float).reshape(len(rows), len(FLAGS))
    w, seen = np.zeros((len(KINDS), len(FLAGS))), np.full((len(KINDS), len(FLAGS)), 1e-6)
    observed = np.zeros((len(rows), len(KINDS)))
    for *_, gold in prepared:
        for c, k in gold:
            observed[c, k] = 1
    for _ in range(EPOCHS if len(rows) else 0):
        scores = x @ w.T
        total = np.logaddexp.reduce(scores, axis=1)
        expected = np.zeros(len(rows))
        for lo, n, cands, _ in prepared:
            t = total[lo:lo + len(cands)].tolist()
            ahead, behind = [0.0] + [-np.inf] * n, [-np.inf] * n + [0.0]
            starts: dict[int, list] = {}
            ends: dict[int, list] = {}
            for c, (i, j) in enumerate(cands):
                starts.setdefault(i, []).append((j, t[c]))
                ends.setdefault(j, []).append((i, t[c]))
            for j in range(1, n + 1):
                ahead[j] = _log_sum([ahead[j - 1], *(ahead[i] + s for i, s in ends.get(j, ()))])
            for i in range(n - 1, -1, -1):
                behind[i] = _log_sum([behind[i + 1], *(behind[j] + s for j, s in starts.get(i, ()))])
            for c, (i, j) in enumerate(cands):
                expected[lo + c] = np.exp(ahead[i] + t[c] + behind[j] - ahead[n])
        gradient = (observed - expected[:, None] * np.exp(scores - total[:, None])).T @ x / max(1, len(prepared)) - DECAY * w
        seen += gradient ** 2
        w += RATE * gradient / np.sqrt(seen)
    return SegmentModel(w)


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top + float(np.log(sum(np.exp(v - top) for v in values)))


def training_zone(text: str, start: int, end: int, base: list[tuple[int, int, int]]) -> tuple[str, list]:
    inside = [(a - start, k, b - start) for a, k, b in base if a < end and b > start]
    return text[start:end], inside


def rewritten(zone: str, gold: list) -> list[tuple[str, list]]:
    """A phone number that fills its zone in other usual forms, each a gold span of its own."""
    out = []
    for a, k, b in gold if len(gold) == 1 else ():
        digits = "".join(_DIGITS.findall(zone[a:b]))
        if KINDS[k] == "phone" and len(digits) >= 10 and (a, b) == (0, len(zone.rstrip(".,;"))):
            x, y, z = digits[-10:-7], digits[-7:-4], digits[-4:]
            out += [(p, [(0, k, len(p))]) for p in (f"({x}) {y}-{z}", f"{x}-{y}-{z}", f"{x}.{y}.{z}", f"{digits[:-10]}-{x}-{y}-{z}")]
    return out


def fit(docs: DataFrame, max_docs: int = MAX_DOCS, max_zones: int = MAX_ZONES, id_col: str = "doc_id",
        text_col: str = "text") -> SegmentModel:
    """Learn from at most ``max_zones`` different zones (up to 400 characters) of at most ``max_docs`` documents.

    Documents with a digit or @ sign are chosen by a hash of their id and text,
    on the hashes alone; zones of the same form (letters and digits replaced)
    count once, and only the forms that are learned reach the driver.
    """
    spread = F.xxhash64(F.col(id_col), F.col(text_col), F.lit(8))
    able = docs.select(spread.alias("spread"), F.col(text_col).alias("text")).filter(F.col("text").rlike("[0-9@]"))
    chosen = able.join(able.select("spread").distinct().orderBy("spread").limit(max_docs), "spread", "left_semi").select("spread", "text")

    def run(batches):
        for batch in batches:
            first: dict[tuple[str, str], tuple[int, str]] = {}
            for spread, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                base = base_spans(text)
                for a, b in zones(text):
                    if b - a <= 400:
                        zone, inside = training_zone(text, a, b, base)
                        form = (re.sub("[a-z]+", "a", re.sub("[0-9]", "0", zone)), ",".join(f"{x}:{k}:{y}" for x, k, y in inside))
                        first[form] = min(first.get(form, (spread, zone)), (spread, zone))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in first.values()], pa.int64()), *(pa.array(x, pa.string()) for x in (
                    [x[1] for x in first.values()], [x[0] for x in first], [x[1] for x in first]))],
                names=["spread", "zone", "form", "gold"])

    rows = (chosen.mapInArrow(run, "spread long, zone string, form string, gold string").groupBy("form", "gold")
            .agg(F.min(F.struct("spread", "zone")).alias("first")).select("first.spread", "first.zone", "gold")
            .orderBy("spread", "zone", "gold").limit(max_zones).collect())
    examples = []
    for row in rows:
        gold = [tuple(map(int, g.split(":"))) for g in row.gold.split(",") if g]
        examples += [(row.zone, gold), *rewritten(row.zone, gold)]
    return train(examples + [(z, []) for z in NOT_PERSONAL])


def find_spans(text: str, model: SegmentModel) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and base plus added spans, each as sorted (start, kind, end)."""
    base = base_spans(text)
    added = []
    for a, b in zones(text):
        taken = [(x, y) for x, _, y in base if x < b and y > a]
        if sum(y - x for x, y in taken) < b - a:
            added += [(a + x, k, a + y) for x, k, y in model.best(text[a:b])
                      if not any(p < a + y and q > a + x for p, q in taken)]
    return base, sorted(base + added)


def personal_data(docs: DataFrame, model: SegmentModel | None = None, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added of every row of ``docs``.

    Counts are of base spans. ``spans`` lists base and added spans as
    ``kind:start:end`` by start, then kind as in ``KINDS`` (code points, end
    exclusive), comma-joined; ``base_sha256`` hashes the same list of the base
    spans alone. Null and empty texts have none (the hash of the empty string).
    Repeated rows get a row each, an empty table gives an empty result. Without
    a ``model`` one is fitted on ``docs`` (see ``fit``). Other columns are not read.
    """
    model = model or fit(docs, id_col=id_col, text_col=text_col)
    joined = lambda spans: ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)

    def run(batches):
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                base, spans = find_spans(text, model) if text else ([], [])
                kinds = [k for _, k, _ in base]
                out.append((*(kinds.count(k) for k in range(4)), hashlib.sha256(joined(base).encode()).hexdigest(),
                            joined(spans), len(spans) - len(base)))
            cols = list(zip(*out)) if out else [[]] * 7
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(list(c), t) for c, t in zip(cols, types))], names=names)

    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"]
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
                                "base_sha256 string, spans string, n_added long")
