"""Personal data: base spans, EM and classifier against plain versions, held-out recall."""

import hashlib
import random
import re
import time

import numpy as np
import pytest

from conftest import SF_SMALL
from keyfold.llm import op12_pii as op12
from keyfold.llm.queries import QUERIES

PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def valid(digits):
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(c), 10)) for c in even)) % 10 == 0


def plain_base(text):
    out = []
    for k, p in enumerate(PATTERNS):
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m[0])
            if (k == 0 or k == 1 and max(map(int, m[0].split("."))) <= 255
                    or k == 2 and 16 <= len(d) <= 19 and valid(d) or k == 3 and 8 <= len(d) <= 15):
                out.append((k, m.start(), m.end()))
    return out


def test_base_spans_by_plain_patterns():
    rng = random.Random(1)
    for _ in range(8000):
        letters = rng.choice(["a@._", "1.2 ", "0123456789 -", "+1() .-", "ab1@.-_+ ", "12.é@a "])
        text = "".join(rng.choices(letters, k=rng.randrange(60)))
        assert op12.base_spans(text) == plain_base(text), text


@pytest.mark.parametrize("piece", ["a", "1", "@", "1.", "1 ", "+1(", "a.@", "A b", "Ab ", "(", "(at)", "a-", "AB12 ", "-@"])
def test_time_grows_with_the_text(piece):
    t0 = time.perf_counter()
    op12.spans(piece * (300_000 // len(piece)), np.ones(op12.CELLS, dtype=bool))
    assert time.perf_counter() - t0 < 20  # a quadratic pattern would take hours


def test_query_by_plain_version(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    table = np.zeros(op12.CELLS, dtype="i8")
    for r in docs:
        base = op12.base_spans(r.text or "")
        for s in [*base, *op12.candidates(r.text or "", base)]:
            table[op12.cell(op12.evidence(r.text, *s))] += 1
    private = op12.train(table).probability >= op12.THRESHOLD
    out = {r.doc_id: r for r in QUERIES["op12_pii"](spark, SF_SMALL).collect()}
    assert len(out) == len(docs)
    for r in docs:
        base, got = plain_base(r.text or ""), out[r.doc_id]
        assert [got.n_email, got.n_ip, got.n_card, got.n_phone] == [sum(k == i for k, _, _ in base) for i in range(4)]
        text = ",".join(f"{op12.KINDS[k]}:{a}:{b}" for k, a, b in base)
        assert got.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        added = op12.spans(r.text or "", private)[1]
        assert got.spans == op12.joined(base + added) and got.n_added == len(added)
    assert sum(r.n_added > 0 for r in out.values()) <= 0.01 * len(out)  # no clean text is flagged


def sentence(rng):
    return " ".join(rng.choices("the report shows how river water moved along green valley stones".split(), k=6))


def planted(rng, n):
    """(text, private spans' texts, ordinary look-alikes' texts)."""
    names = sorted(op12.NAMES)
    digits = lambda k: "".join(rng.choices("123456789", k=k))
    out = []
    for _ in range(n):
        phone = rng.choice(["({}) {}-{}", "{}-{}-{}", "{} {} {}", "{}.{}.{}"]).format(digits(3), digits(3), digits(4))
        mail = f"{rng.choice(names)}.{digits(2)} [at] mail{digits(1)} [dot] {rng.choice(['com', 'org', 'de'])}"
        ssn = f"{digits(3)}-{digits(2)}-{digits(4)}"
        person = f"{rng.choice(names).title()} {rng.choice(['Miller', 'Ortega', 'Weber', 'Dubois'])}"
        private = rng.choice([("call me: phone ", phone), ("my email ", mail), ("write to ", mail), ("SSN: ", ssn),
                              ("tel. ", phone), ("Dear ", person), ("yours, signed ", person)])
        plainly = rng.choice([("order ", digits(9)), ("invoice number ", digits(8)), ("on ", f"20{digits(2)}-1{rng.randrange(3)}-2{rng.randrange(9)}"),
                              ("about ", f"{digits(5)}.{digits(4)}"), ("total $", digits(7)), ("the ", "New York University"),
                              ("in ", "Green River Valley"), ("see ", f"{digits(7)} km")])
        strict = rng.choice([f"{rng.choice(names)}@example.com", f"10.{rng.randrange(256)}.3.4", f"+1 ({digits(3)}) 555-{digits(4)}"])
        out.append((f"{sentence(rng)} {private[0]}{private[1]}. {sentence(rng)} {plainly[0]}{plainly[1]} {sentence(rng)} {strict}",
                    private[1], plainly[1]))
    return out


def test_recall_and_false_alarms_on_held_out_texts(spark):
    rng = random.Random(3)
    train, test = planted(rng, 600), planted(rng, 400)
    model = op12.train(op12.count(spark.createDataFrame([(t,) for t, _, _ in train], "text string")))
    private = model.probability >= op12.THRESHOLD
    caught = alarms = 0
    for text, wanted, other in test:
        found = [text[a:b] for _, a, b in op12.spans(text, private)[1]]
        caught += any(wanted in f or f in wanted for f in found)
        alarms += any(other in f or f in other for f in found)
    assert caught >= 0.9 * len(test) and alarms <= 0.03 * len(test), (caught, alarms)
    assert (model.reliability >= op12.BOUNDS[0]).all()


def test_em_on_cells_equals_em_on_candidates():
    rng = np.random.default_rng(5)
    cells = rng.choice(op12.CELLS, 40, replace=False)
    each = rng.choice(cells, 3000)
    counts = np.bincount(each, minlength=op12.CELLS)
    kind, vote = op12._all_evidence()[each, 0], op12.votes()[each]
    share, right = np.full(len(op12.KINDS), op12.SHARE), np.full((5, 2), op12.RIGHT)
    for _ in range(200):  # candidate by candidate
        odds = np.log(share[kind] / (1 - share[kind]))
        for j in range(5):
            odds += np.where(vote[:, j] == 1, np.log(right[j, 0] / (1 - right[j, 1])), 0)
            odds += np.where(vote[:, j] == 2, np.log((1 - right[j, 0]) / right[j, 1]), 0)
        p = 1 / (1 + np.exp(-odds))
        share = np.array([(p[kind == k].sum() + 20 * 0.2) / ((kind == k).sum() + 20) for k in range(len(share))])
        right = np.array([[(w * (vote[:, j] == v)).sum() + 18 for w, v in ((p, 1), (1 - p, 2))] for j in range(5)]) \
            / np.array([[(w * (vote[:, j] > 0)).sum() + 20 for w in (p, 1 - p)] for j in range(5)])
        right = right.clip(0.6, 0.99)
    model = op12.train(counts)
    assert np.allclose(model.share, share, atol=1e-6) and np.allclose(model.reliability, right, atol=1e-6)
    assert np.allclose(model.posterior[each], p, atol=1e-6)


def test_odd_rows(spark):
    mail = "a" * 50_000 + "@example.com"
    rows = [(1, None), (1, None), (2, ""), (None, "x@y.zz 1.2.3.4"), (3, mail), (4, "é 日本 +1 (017) 555-7713"),
            (5, "4845168114407329 4845168114407329"), (6, "00001.2.3." + "0" * 5000 + "4"), (7, "x@" * 1000 + "a.b")]
    df = spark.createDataFrame([(i, t, "s", 9) for i, t in rows], "doc_id long, text string, spans string, n_ip int")
    model = op12.train(op12.count(df))
    out = op12.scan(df, model).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    assert by[1].spans == by[2].spans == "" and by[2].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert by[None].spans == "email:0:6,ip:7:14" and by[3].spans == f"email:0:{len(mail)}"
    assert by[4].spans == "phone:5:22" and by[6].n_ip == 1 and by[7].n_email == 1
    assert by[5].n_card == 0  # one match of 32 digits, which fails
    assert op12.scan(df.limit(0), model).collect() == []
    empty = op12.train(op12.count(df.limit(0)))
    assert not (empty.probability >= op12.THRESHOLD).any()
    assert [r.n_added for r in op12.scan(df, empty).collect()] == [0] * len(rows)
