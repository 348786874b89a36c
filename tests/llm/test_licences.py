import random
import re

import pytest
from pyspark.sql import functions as F

from tuneprep.llm import licences

SCHEMA = "doc_id long, text string, line string, family string, place int"
LINES = {
    "mit": "Released under the MIT License.",
    "apache": "Licensed under the Apache License, Version 2.0.",
    "gpl": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc": "Licensed under CC BY-NC 4.0.",
    "bsd": "Use of this source code is governed by a BSD-style license that can be found in LICENSE.",
}


def documents(n=400):
    rng = random.Random(7)
    pool = "the of and work version under public er ing tion ou ha licensing is by free word la que der".split()
    rows, want = [], {}
    for i in range(n):
        lines = [" ".join(rng.choices(pool, k=rng.randint(2, 40))) for _ in range(rng.randint(1, 6))]
        if i % 5 == 0:
            family = rng.choice(list(LINES))
            lines.insert(rng.randint(0, len(lines)), LINES[family])
            want[i] = family
        rows.append((i, "\n".join(lines)))
    return rows, want


@pytest.fixture(scope="module")
def scanned(spark):
    rows, want = documents()
    odd = [(None, LINES["mit"]), (1000, None), (1001, ""), (1002, "\n \n..."), (1003, "word " * 30000 + "\n" + LINES["gpl"])]
    odd += [(1004, LINES["mit"] + "\n" + LINES["apache"])] * 2
    df = spark.createDataFrame([(*r, "clash", "clash", 1) for r in rows + odd], SCHEMA)
    return rows + odd, want, licences.scan(df)


def test_families_of_planted_lines_and_clean_documents(scanned):
    rows, want, found = scanned
    got = found.collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None and r.doc_id < 1000:
            assert list(r.families) == ([want[r.doc_id]] if r.doc_id in want else [])
    odd = [(r.doc_id, list(r.families), r.n_paragraphs) for r in got if r.doc_id is None or r.doc_id >= 1000]
    assert sorted(odd, key=repr) == sorted(
        [(None, ["mit"], 1), (1000, [], 0), (1001, [], 0), (1002, [], 0), (1003, ["gpl"], 1)]
        + [(1004, ["apache", "mit"], 2)] * 2,
        key=repr,
    )


def test_plan_has_no_python(scanned):
    plan = scanned[2]._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_empty_table(spark):
    assert licences.scan(spark.createDataFrame([], SCHEMA)).count() == 0


def test_every_paragraph_trains_or_calibrates(spark):
    """Numbers of all paragraphs, far more than a sample held, and a model that follows them."""
    lines = [f"word{i} {'licensed' if i % 3 else 'the'} thing" for i in range(9000)]
    df = spark.createDataFrame([(i, "\n".join(lines[i::3000]), "", "", 0) for i in range(3000)], SCHEMA)
    vectorizer = licences.fit_vectorizer(spark)
    stored = licences.paragraph_vectors(df, vectorizer, "text", F.col("doc_id"))
    assert stored.count() == 9000 and stored.filter("line IS NOT NULL").count() == 0
    vectors = stored.groupBy("counts").agg(
        F.count_if("trains").alias("n_train"), F.count_if(~F.col("trains")).alias("n_rest")
    )
    n_train, n_rest = vectors.agg(F.sum("n_train"), F.sum("n_rest")).first()
    assert n_train + n_rest == 9000 and min(n_train, n_rest) > 4000
    strict = licences.train(vectors, vectorizer, 0.0)
    assert strict.predict(vectors).filter("family IS NOT NULL AND n_rest > 0").count() == 0
    assert licences.scan(df).filter("n_paragraphs > 0").count() == 0
