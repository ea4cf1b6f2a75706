"""Small documents with every awkward case, and brute-force versions of the contracts."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from itertools import combinations

SF = "/root/testdata/sf0.001"
WORDS = [f"w{i}" for i in range(400)]


def text(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


def changed(base: str, seed: int, n: int) -> str:
    r, words = random.Random(seed), base.split()
    for _ in range(n):
        words[r.randrange(len(words))] = f"x{r.randrange(10 ** 6)}"
    return " ".join(words)


def documents() -> list[tuple]:
    """(doc_id, text, lang, source): nulls, empties, copies, near copies, ties, repeated rows, a long text."""
    base, long = text(1, 120), text(2, 30_000)
    rows = [(i, text(100 + i, 40 + 7 * i), "en", f"s{i % 4}") for i in range(12)]
    rows += [(20 + i, base, "en", "s0") for i in range(6)]
    rows += [(30 + i, changed(base, i, i % 4), "de", "s1") for i in range(25)]
    rows += [(60, None, "en", "s0"), (61, "", "de", None), (62, " \t\n ", None, "s1"), (63, "one two", "en", "s2"),
             (64, "ONE Two", "en", "s2"), (65, "one two three", None, None), (66, long, "de", "s3"),
             (67, changed(long, 5, 30), "de", "s3"), (68, "!!! ###", "en", "s1"), (69, "Straße ÑANDÚ é", "de", "s1"),
             (70, base, "en", "s0"), (70, base, "en", "s0"), (None, base, "en", "s0"), (None, None, None, None),
             (71, "a\x00b c\x1cd é", "en", "s9")]
    return rows


def frame(spark, rows=None, extra: bool = True):
    """Documents with extra columns whose names clash with those the operators use inside."""
    rows = documents() if rows is None else rows
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(*r, None if r[1] is None else len(r[1])) for r in rows]
    df = spark.createDataFrame(rows, schema)
    if extra:
        for name in ("n", "node", "key_a", "key_b", "size", "hash", "row", "h", "target", "copies", "score", "turn", "spread",
                     "marks", "label", "rank", "place", "mix_hash", "token", "component"):
            df = df.selectExpr("*", f"'clash' AS {name}")
    return df


def space_words(t: str | None) -> list[str]:
    low = (t or "").translate({i: i + 32 for i in range(65, 91)})
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def punct_words(t: str | None) -> list[str]:
    low = (t or "").translate({i: i + 32 for i in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def shingles(t: str | None, k: int) -> set:
    w = space_words(t)
    if not w:
        return set()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)}


def jaccard_brute(rows: list[tuple], k: int, num: int, den: int) -> list[tuple]:
    """(doc_id, n_shingles, component_id) of each row."""
    sets = [shingles(r[1], k) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and den * both >= num * (len(sets[i]) + len(sets[j]) - both):
            root[find(i)] = find(j)
    out = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((r[0], len(sets[i]), min(ids, default=None) if sets[i] else r[0]))
    return out


def contamination_brute(rows: list[tuple], items: list[tuple], window: int = 13) -> list[tuple]:
    out = []
    lists = [(i, punct_words(t)) for i, t in items]
    for r in rows:
        w = punct_words(r[1])
        hit, found = set(), set()
        for item, words in lists:
            m = min(window, len(words))
            grams = {tuple(words[j:j + m]) for j in range(len(words) - m + 1)} if m else set()
            for i in range(len(w) - m + 1) if m else ():
                if tuple(w[i:i + m]) in grams:
                    hit.update(range(i, i + m))
                    found.add("" if item is None else str(item))
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((r[0], len(w), len(hit), len(found), sha, bool(hit) and 20 * len(hit) >= len(w)))
    return out


def targets_brute(sizes: dict, weights=(1, 2, 3), most: float = 3) -> dict:
    """Targets by repeated sharing, as the contract words it."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = float(sum(sizes.values())), set()
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        rest = sum(weight[s] for s in names if s not in capped)
        out = {s: most * sizes[s] if s in capped else left * weight[s] / rest for s in names}
        more = {s for s in names if s not in capped and out[s] > most * sizes[s]}
        if not more:
            return out
        capped |= more


def crc_mod(doc_id, folds: int):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % folds
