"""Quality classifier, language identification and personal data: held-out accuracy, brute force, awkward rows."""

import hashlib
import re

import numpy as np

from closebook.llm import language, pii, quality

from . import cases

SF = "/root/testdata/sf0.01"


def test_quality_held_out_accuracy_and_folds(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.classify(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (cases.crc_mod(r.doc_id, 3) == 1) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert len(held) > 80 and np.mean([r.predicted == r.quality for r in held]) > 0.95
    flipped = labels.selectExpr("doc_id", f"CASE WHEN crc32(cast(doc_id AS string)) % 3 = 1 THEN 1 - quality ELSE quality END AS quality")
    again = {r.doc_id: r.score for r in quality.classify(docs, flipped).collect()}
    assert all(again[r.doc_id] == r.score for r in got)


def test_quality_awkward_rows(spark):
    docs = cases.frame(spark)
    labels = spark.createDataFrame([(i, i % 2, "x") for i in range(12)] + [(60, 1, "x"), (61, None, "x"), (999, 0, "x"), (None, 1, "x"),
                                                                         (3, 1, "x"), (5, 7, "x")], "doc_id long, quality int, text string")
    got = quality.classify(docs, labels).collect()
    assert len(got) == len(cases.documents()) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert quality.classify(cases.frame(spark, []), labels).count() == 0
    none = quality.classify(docs, labels.filter("false"))
    assert {r.score for r in none.collect()} == {0.5}
    kept = quality.remove_low_quality(docs, labels)
    assert kept.columns == docs.columns
    scores = {str(r.doc_id): r.score for r in got}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(k for k in (str(r[0]) for r in cases.documents()) if scores[k] >= 0.5)


def test_additive_model_scores_are_sums_of_table_entries():
    r = np.random.default_rng(2)
    x = r.normal(size=(3000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)  # an interaction that single features can't show
    model = quality.train(x[:2000], y[:2000])
    assert np.mean((model.score(x[2000:]) >= 0.5) == y[2000:]) > 0.9 and (1, 0) in model.pairs
    b = model.bins(x[:5])
    brute = [model.base + sum(t[b[i, j]] for j, t in enumerate(model.tables))
             + sum(t[model.coarse[p][b[i, p]], model.coarse[q][b[i, q]]] for (p, q), t in zip(model.pairs, model.pair_tables)) for i in range(5)]
    assert np.allclose(model.margin(b), brute)


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language.identify(docs).join(docs.select("doc_id", "lang", "n_chars"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (cases.crc_mod(r.doc_id, 5) == 0) for r in got)
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_language_awkward_rows(spark):
    rows = cases.documents()
    got = language.identify(cases.frame(spark, rows)).collect()
    letters = {str(r[0]): any(map(str.isalpha, r[1] or "")) for r in rows}
    assert len(got) == len(rows)
    assert all((r.lang_pred == "und") == (not letters[str(r.doc_id)]) for r in got if r.doc_id is not None)
    assert {r.lang_pred for r in got} <= {"en", "de", "und"}
    assert language.identify(cases.frame(spark, [])).count() == 0
    unknown = language.identify(cases.frame(spark, [(i, "text", None, "s") for i in range(9)]))
    assert {(r.lang_pred, r.score) for r in unknown.collect()} == {("und", 0.0)}


PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def base_brute(text):
    out = []
    for k, p in enumerate(PATTERNS):
        for m in re.finditer(p, text):
            digits = re.sub("[^0-9]", "", m.group())
            ok = (True, all(int(x) <= 255 for x in m.group().split(".")) if k == 1 else True,
                  12 <= len(digits) <= 19 and pii.luhn(digits), 9 <= len(digits) <= 15)[k]
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out)


TEXTS = ["a.b@c.de, x@y z@@w.q.r a@b@c.d é.x@ü.de é.x@u.de.", "1.2.3.4.5.6.7.8 256.1.1.1 0001.002.3.4 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1112",
         "+1 (549) 555-8300 +12 +1 234 5678 90 12 34 56 78 +1.2", "call (549) 555-8300 or 549-555-8300. v1.2.3 2024-01-15", "@ 1 a@", "9" * 3000 + "@" + "1." * 500,
         "mail: x-y_z%+q@sub-1.example.co.uk;4028005252517056,72.216.37.251"]


def test_base_spans_match_the_patterns(spark):
    texts = TEXTS + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert [pii.base_spans(t) for t in texts] == [base_brute(t) for t in texts]


def test_personal_data(spark):
    rows = cases.documents() + [(300 + i, t, "en", "s") for i, t in enumerate(TEXTS)]
    model = pii.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    got = pii.personal_data(cases.frame(spark, rows), model).collect()
    assert len(got) == len(rows)
    text = {str(r[0]): r[1] or "" for r in rows if r[0] is not None}
    for r in got:
        if r.doc_id is None:
            continue
        base = base_brute(text[str(r.doc_id)])
        listed = [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(x[1] == i for x in base) for i in range(4)]
        spans = r.spans.split(",") if r.spans else []
        assert set(listed) <= set(spans) and len(spans) == len(listed) + r.n_added
        starts = [(int(s.split(":")[1]), pii.KINDS.index(s.split(":")[0])) for s in spans]
        assert starts == sorted(starts)
    added = {r.doc_id: r.spans for r in got}[304]
    assert added.split(",") == ["phone:5:19", "phone:23:35"]


def test_the_model_adds_nothing_to_clean_text(spark):
    model = pii.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    clean = ["The GNU General Public License, version 3.", "CC BY-NC 4.0.", "In 1999 and 2004-2008, 3 of 17.", "10:45 on 2021-12-05",
             "token = \"51eeece1bee4c647570cd7e5fef5298c78158596\"", "1,234,567.89 and 0.25", "password=cd5c291ad0fad3e545"]
    assert [pii.find_spans(t, model)[1] for t in clean] == [[]] * len(clean)


def best_brute(zone, model):
    """The best segmentation's score over all subsets of segments that don't overlap."""
    units, cands = pii.segments(zone)
    scored = [(i, j, (np.array(pii.span_features(zone, units[i][0], units[j - 1][1])) @ model.weights.T - pii.THRESHOLD).max()) for i, j in cands]

    def best(at):
        return max([0.0] + [s + best(j) for i, j, s in scored if i >= at])
    return best(0)


def test_the_dynamic_programme_finds_the_best_segmentation(spark):
    model = pii.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    for zone in ("a1@b.cd 549-555-8300 1.2.3.4", "(549) 555-8300", "12 345 6789 0123"):
        units, _ = pii.segments(zone)
        score = sum((np.array(pii.span_features(zone, a, b)) @ model.weights.T - pii.THRESHOLD)[k] for a, k, b in model.best(zone))
        assert np.isclose(score, best_brute(zone, model))


def test_personal_data_empty_table(spark):
    assert pii.personal_data(cases.frame(spark, [])).count() == 0


def test_quality_fit_takes_a_document_once(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet").limit(200) for t in ("documents", "labels"))
    hot = docs.join(labels, "doc_id").filter("crc32(cast(doc_id AS string)) % 3 <> 1").orderBy("doc_id").select(docs.columns).limit(1)
    more = docs
    for _ in range(3):
        more = more.unionByName(hot.crossJoin(spark.range(100)).drop("id"))
    plain, repeated = quality.fit(docs, labels), quality.fit(more, labels)
    assert plain.base == repeated.base and all(np.array_equal(a, b) for a, b in zip(plain.tables, repeated.tables))


def test_personal_data_fit_collects_forms_only(spark, monkeypatch):
    """Many zones of few forms: only the forms reach the driver, and the model is that of all zones sorted there."""
    rows = [(i, " word ".join(f"549-555-{1000 + 40 * i + j}" if j % 2 else f"a{j}@b{i}.com" for j in range(40)), "en", "s") for i in range(30)]
    docs = cases.frame(spark, rows, extra=False)
    sizes, kind = [], type(docs)
    plain = kind.collect

    def collect(self):
        out = plain(self)
        sizes.append(len(out))
        return out

    monkeypatch.setattr(kind, "collect", collect)
    model = pii.fit(docs, max_zones=5)
    assert sizes and max(sizes) <= 5
    examples, forms = [], set()
    found = [(r.h, r.text[a:b], pii.training_zone(r.text, a, b, pii.base_spans(r.text))[1])
             for r in plain(docs.selectExpr("xxhash64(doc_id, text, 8) AS h", "text")) for a, b in pii.zones(r.text) if b - a <= 400]
    for _, zone, gold in sorted(found):
        form = re.sub("[a-z]+", "a", re.sub("[0-9]", "0", zone)), str(gold)
        if form not in forms and len(forms) < 5:
            forms.add(form)
            examples += [(zone, gold), *pii.rewritten(zone, gold)]
    assert np.array_equal(model.weights, pii.train(examples + [(z, []) for z in pii.NOT_PERSONAL]).weights)
