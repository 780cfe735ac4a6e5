import random

from tests.llm.conftest import docs_of, prose
from vitals.llm import licenses


def brute_force(rows, templates, threshold):
    known = [(n, set(licenses.bigram_set(t))) for n, texts in templates.items() for t in texts]
    out = {}
    for doc_id, text in rows:
        import re
        units = set((text or "").split("\n")) | set(re.split(r"\n[ \t\r]*\n", text or ""))
        for unit in units:
            found = set(licenses.bigram_set(unit))
            for name, template in known:
                if found and template and 2 * len(found & template) / (len(found) + len(template)) >= threshold:
                    best, all_units = out.get((doc_id, name), (0, set()))
                    out[doc_id, name] = max(best, 2 * len(found & template) / (len(found) + len(template))), all_units | {tuple(sorted(found))}
    return {k: (round(d, 9), len(u)) for k, (d, u) in out.items()}


def collected(df):
    rows = df.collect()
    assert len({(r.doc_id, r.license) for r in rows}) == len(rows)
    return {(r.doc_id, r.license): (round(r.dice, 9), r.units) for r in rows}


def test_against_brute_force(spark):
    rng, rows = random.Random(5), []
    every = [t for texts in licenses.TEMPLATES.values() for t in texts]
    for i in range(150):
        words = rng.choice(every).split()
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = rng.choice(["the", "of", "version", "license"])
        rows.append((i, "\n".join([prose(i, 30), " ".join(words), "", prose(i + 500, 20), rng.choice(every).upper()])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for threshold in (0.5, 0.8, 0.95, 1.0):
        got = collected(licenses.scan(docs, threshold=threshold))
        assert got == brute_force(rows, licenses.TEMPLATES, threshold)
        assert got


def test_paragraph_over_several_lines(spark):
    text = licenses.TEMPLATES["MIT"][3].replace(", ", ",\n")
    assert collected(licenses.scan(docs_of(spark, [f"a b\n\n{text}\n \nc d"]))) == {(0, "MIT"): (1.0, 1)}


def test_plan_has_no_python_and_no_join(spark, odd):
    plan = licenses.scan(odd)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Join", "Cartesian"))


def test_odd_rows(spark, odd, odd_rows, none):
    assert collected(licenses.scan(odd)) == {}
    more = odd.union(spark.createDataFrame([(None, "All rights reserved.", *[None] * 8), (4, "ALL RIGHTS, RESERVED\nall rights reserved", *[None] * 8)], odd.schema))
    assert collected(licenses.scan(more)) == {(None, "Proprietary"): (1.0, 1), (4, "Proprietary"): (1.0, 2)}  # the line, and both as a paragraph
    assert licenses.scan(none).count() == 0 and licenses.scan(odd, templates={}).count() == 0
    assert licenses.scan(odd, templates={"x": ["word"]}).count() == 0
