from closebook.llm.decontamination import contamination, remove_contaminated

from . import cases


def rows_and_items():
    rows = cases.documents()
    passage = cases.text(50, 40)
    p = passage.split()
    items = [(1, passage), (2, " ".join(p[5:30])), (3, "one, two!"), (4, None), (5, ""), (None, cases.text(51, 20)),
             (6, cases.text(52, 13)), (7, cases.text(53, 12)), (6, cases.text(52, 13)), (8, " ".join(p[10:22])), (9, "w1")]
    rows += [(200, cases.text(60, 30) + " " + passage.upper() + ". " + cases.text(61, 600), "en", "s"),
             (201, " ".join(p[3:15]), "en", "s"), (202, " ".join(p[3:16]), "en", "s"), (203, ",".join(p * 3), "en", "s"),
             (204, cases.text(62, 250) + " " + cases.text(53, 12), "en", "s"), (205, cases.text(51, 20), "en", "s"),
             (206, cases.text(63, 300) + "\n" + " ".join(p[:13]), "en", "s")]
    return rows, items


def test_matches_brute_force(spark):
    rows, items = rows_and_items()
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS words", "'x' AS marks")
    got = contamination(cases.frame(spark, rows), bench)
    got = sorted(map(str, (tuple(r)[:6] for r in got.collect())))
    assert got == sorted(map(str, cases.contamination_brute(rows, items)))
    kept = remove_contaminated(cases.frame(spark, rows), bench)
    clean = [r[0] for r in cases.contamination_brute(rows, items) if not r[5]]
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, clean))


def test_testdata_matches_brute_force(spark):
    docs, bench = (spark.read.parquet(f"{cases.SF}/{t}.parquet") for t in ("documents", "benchmark"))
    rows, items = [(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()]
    brute = cases.contamination_brute(rows, items)
    assert any(r[5] for r in brute)
    got = sorted(tuple(r)[:6] for r in contamination(docs, bench).collect())
    assert got == sorted(brute)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert contamination(cases.frame(spark, []), empty).count() == 0
    assert contamination(cases.frame(spark), empty).filter("n_hit > 0 or contaminated").count() == 0


def test_a_gram_of_every_item_and_both_sides_of_the_window(spark):
    common, p = "w1 w2 w3 w4 w5", cases.text(80, 60).split()
    items = [(i, f"{cases.text(1000 + i, 20)} {common} {cases.text(3000 + i, 20)}") for i in range(300)]
    items += [(400, " ".join(p)), (401, common), (402, " ".join(p[:13] + p[20:33]))]
    words = [x.split() for _, x in items[:300]]
    rows = [(1, f"{cases.text(81, 50)} {common} {cases.text(82, 50)}", "en", "s"),
            (2, " ".join(words[7][10:]) + " " + common + " " + " ".join(words[9][:31]), "en", "s"),
            (3, " ".join(["x"] + p[5:18] + ["y"] + p[5:17] + ["z"] + p[47:60]), "en", "s"),
            (4, " ".join(p[:13] + ["x"] + p[12:40]), "en", "s"), (5, " ".join(p[20:33] + p[:13]), "en", "s"), (6, None, "en", "s")]
    got = contamination(cases.frame(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    brute = cases.contamination_brute(rows, items)
    assert sorted(tuple(r)[:6] for r in got.collect()) == sorted(brute)
    assert {r[0]: r[3] for r in brute} == {1: 1, 2: 3, 3: 1, 4: 2, 5: 2, 6: 0}
