"""Secret scan: names that were not looked at when its word list was made, and the
added spans against a plain computation."""

import math
import pkgutil
import re

import numpy as np

from conftest import SF_SMALL
from keyfold.llm import op10_secrets as op10
from keyfold.llm.queries import secret_models

#: None of these served to choose the words of ``op10.WORDS``.
HELD_OUT = ("decimal", "sqlite3", "ctypes", "zipfile", "tarfile", "xml.sax.handler", "xml.dom.minidom", "curses", "locale",
            "mimetypes", "optparse", "pickletools", "smtplib", "imaplib", "urllib.request", "concurrent.futures",
            "multiprocessing", "pyarrow", "pyarrow.compute", "pandas", "numpy", "numpy.linalg", "pytest", "hypothesis",
            "duckdb", "pyspark.sql.functions", "pyspark.sql.types", "importlib.metadata", "tracemalloc", "statistics")


def test_held_out_names_are_ordinary(spark):
    ratio = secret_models(spark, SF_SMALL)
    names = {n for m in HELD_OUT for n in dir(pkgutil.resolve_name(m)) if len(n) >= op10.SHORTEST}
    flagged = [n for n in names if op10.score(n, ratio) >= op10.MARGIN]
    print(len(names), "names,", len(flagged), "flagged:", sorted(flagged))
    assert len(names) > 300 and len(flagged) <= 0.05 * len(names)


def test_added_spans_by_a_plain_computation(spark):
    rows = [("thequickbrownfox", False), ("jumps_over_lazy_dogs", False), ("9fK2xQ7zLm4TbV8c", True),
            ("Zq81mNv0Pk3Wd6Rs", True), ("a=b", True)]
    ratio = op10.train(op10.count_labelled(spark.createDataFrame(rows, "value string, random boolean")))
    n = [[[0.0] * op10.STATES for _ in range(op10.STATES)] for _ in range(2)]
    for value, kind in rows:
        state = op10.STATES - 1
        for c in value:
            n[kind][state][op10.ALPHABET.index(c)] += 1
            state = op10.ALPHABET.index(c)
    letters = len(op10.ALPHABET)

    def share(kind, state, c):
        one = [1 + sum(n[kind][s][x] for s in range(op10.STATES)) for x in range(letters)]
        return (n[kind][state][c] + 20 * one[c] / sum(one)) / (sum(n[kind][state][:letters]) + 20)

    def score(token):
        state, total = op10.STATES - 1, 0.0
        for c in map(op10.ALPHABET.index, token):
            total += math.log(share(1, state, c)) - math.log(share(0, state, c))
            state = c
        return total / len(token)

    texts = ["x 9fK2xQ7zLm4TbV8cc and thequickbrownfoxx", "token=9fK2xQ7zLm4TbV8c9fK2", "é Zq81mNv0Pk3Wd6RsZ\njumps_over_the_lazy",
             "0123456789abcdef0123456789abcdef-9fK2xQ7z", "", "short 9fK2"]
    for text in texts:
        base, added = op10.spans(text, ratio)
        want = []
        for m in re.finditer(r"[A-Za-z0-9+/_=-]+", text):
            free = not any(a < m.end() and m.start() < b for a, _, b in base)
            if free and len(m[0]) >= op10.SHORTEST and score(m[0]) >= op10.MARGIN:
                want.append((m.start(), 3, m.end()))
        assert added == want, text
    assert op10.spans(texts[0], ratio)[1] and np.isclose(op10.score("9fK2xQ7z", ratio), score("9fK2xQ7z"))


def test_repeated_rows(spark):
    df = spark.createDataFrame([(1, "AKIA" + "A" * 16)] * 3 + [(1, None)] * 2, "doc_id long, text string")
    out = op10.scan(df, np.zeros(op10.STATES ** 2)).collect()
    assert sorted(r.n_access for r in out) == [0, 0, 1, 1, 1]
