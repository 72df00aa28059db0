"""Notices and inheritance; the SQL counterpart of the query is compared with all queries."""

import math

from telesift.llm import license_scan as ls
from tests.llm.cases import AWKWARD, LONG, prose

APACHE = "Licensed under the Apache License, Version 2.0."
MIT = "Released under the MIT License."
GPL = "This work is licensed under the GNU General Public License, version 3."


def scan(spark, rows, **extra):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(rows, "path string, text string")
    for name, value in extra.items():
        frame = frame.withColumn(name, F.lit(value))
    return ls.scan(frame)


FILES = [
    ("a/LICENSE", GPL + "\n" + prose(1, 100)), ("a/b/c/one.txt", prose(2, 60)), ("a/b/LICENSE.md", APACHE), ("a/b/c/two.txt", prose(3, 60)),
    ("a/b/d/own.txt", prose(4, 40) + "\n" + MIT), ("a/x/y.txt", prose(5, 30)), ("z/none.txt", prose(6, 30)), ("top.txt", prose(7, 30)),
    ("a/b/notice.txt", prose(8, 100) + " " + MIT + " " + prose(9, 100)), (None, APACHE), ("ab/c.txt", None), ("a/b/c/two.txt", prose(3, 60)),
]


def test_nearest_ancestor_wins(spark):
    rows = scan(spark, FILES, license="mine", extra=1).collect()
    assert len(rows) == len(FILES) and rows[0].asDict().keys() == {"path", "text", "extra", *ls.RESULT_COLUMNS}
    got = {r["path"]: (r["own_license"], r["license"], r["license_from"]) for r in rows}
    assert got["a/LICENSE"] == ("GPL-3.0", "GPL-3.0", "own")
    assert got["a/b/c/one.txt"] == got["a/b/c/two.txt"] == (None, "Apache-2.0", "a/b")
    assert got["a/b/d/own.txt"] == ("MIT", "MIT", "own")
    assert got["a/x/y.txt"] == (None, "GPL-3.0", "a")
    assert got["z/none.txt"] == got["top.txt"] == got["ab/c.txt"] == (None, None, None)
    assert got[None] == ("Apache-2.0", "Apache-2.0", "own")
    files = {r["path"]: r["is_license_file"] for r in rows}
    assert files["a/LICENSE"] and files["a/b/LICENSE.md"] and not files["a/b/notice.txt"]


def test_cosines_against_plain_python(spark):
    texts = [t for _, t in FILES if t] + [APACHE[:-4] + "3.1!", "all rights", "All rights reserved", "License license LICENSE"]
    got = {r["text"]: (r["own_license"], r["own_cosine"]) for r in scan(spark, [("d/%d" % i, t) for i, t in enumerate(texts)]).collect()}
    import re

    split = lambda t: [w for w in re.split(ls.NOT_WORD, t.lower()) if w]
    df = {}
    for t in texts:
        for w in set(split(t)):
            df[w] = df.get(w, 0) + 1
    known = {w for _, t in ls.TEMPLATES for w in split(t)}
    idf = {w: math.log((len(texts) + 1) / (df.get(w, 0) + 1)) + 1 for w in known}
    other = sum(idf.values()) / len(idf)

    def vector(words):
        raw = {w: words.count(w) * idf.get(w, other) for w in set(words)}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        return {w: x / norm for w, x in raw.items()}

    for t in texts:
        best = (0.0, "")
        for segment in re.split(ls.SEGMENT_END, t):
            v = vector(split(segment)) if split(segment) else {}
            top = max(((round(sum(x * v.get(w, 0.0) for w, x in vector(split(text)).items()), 6), name) for name, text in ls.TEMPLATES), key=lambda p: p[0])
            best = max(best, top, key=lambda p: p[0])
        if best[0] >= ls.MIN_COSINE:
            assert got[t][1] == best[0]
        else:
            assert got[t] == (None, None)


def test_awkward_and_empty(spark):
    rows = scan(spark, [(f"x/{k}", t) for k, t in AWKWARD] + [("x/long", LONG + "\n" + MIT)]).collect()
    assert len(rows) == len(AWKWARD) + 1
    assert {r["path"]: r["own_license"] for r in rows}["x/long"] == "MIT"
    assert scan(spark, []).count() == 0


def test_ties_in_a_directory(spark):
    rows = scan(spark, [("d/LICENSE.b", MIT), ("d/LICENSE.a", APACHE), ("d/x", "nothing"), ("d/LICENSE.a", APACHE)]).collect()
    assert [r["license"] for r in rows if r["path"] == "d/x"] == ["Apache-2.0"]


def test_no_python(spark):
    plan = scan(spark, FILES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
