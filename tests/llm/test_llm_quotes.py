"""Quotation linking against a plain version, on conversations that do quote."""

import random

from pyspark.sql import functions as F

import plain
from keyfold.llm import op8_quotes


def conversation(rng, conv, n):
    """Messages that quote earlier ones: whole, by paragraph, line, part, re-wrapped, nested."""
    words = [f"w{i:03d}" for i in range(400)] + ["Été", "x.y", "the", "the", "the"]
    line = lambda k: " ".join(rng.choice(words) for _ in range(k))
    said = []
    for turn in range(n):
        parts = ["\n".join(line(rng.randrange(2, 9)) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(1, 4))]
        body, quoted = "\n\n".join(parts), []
        for _ in range(rng.choice([0, 1, 1, 2]) if said else 0):
            old = rng.choice(said)
            kind = rng.randrange(7)
            if kind == 0:
                text = old
            elif kind == 1:
                text = rng.choice(old.split("\n\n"))
            elif kind == 2:
                text = rng.choice(old.split("\n"))
            elif kind == 3:  # a part, across lines
                w = old.split()
                i = rng.randrange(len(w))
                text = " ".join(w[i:i + rng.randrange(2, 9)])
            elif kind == 4:  # re-wrapped, and with other capitals and spaces
                w = rng.choice(old.split("\n\n")).upper().split()
                text = "\n".join("  ".join(w[i:i + 3]) for i in range(0, len(w), 3))
            elif kind == 5:
                text = line(4)  # unknown
            else:
                text = f"> {rng.choice(said).splitlines()[0]}\n{old}"
            quoted.append("\n".join(f"> {x}" if not x.startswith(">") else f">{x}" for x in text.split("\n")))
        said.append(body)
        yield conv, turn, "\n\n".join([*quoted, body]) if rng.random() < .8 else "\n".join([body, *quoted])


def test_links_by_brute_force(spark):
    rng = random.Random(11)
    rows = [m for c, n in ((1, 40), (2, 25), (None, 12), (3, 1)) for m in conversation(rng, c, n)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, text string").withColumn("role", F.lit("u")).repartition(6)
    out = op8_quotes.link(df).collect()
    want = plain.quotes(rows)
    assert {(r.conv_id, r.turn): (r.parent_turn, r.root_turn, r.links) for r in out} == want
    assert sum(p is not None for p, _, _ in want.values()) > 30
    for conv in (1, 2, 3, None):  # every thread in turn, replies after what they reply to
        own = sorted((r.position, r.root_turn, r.turn) for r in out if r.conv_id == conv)
        assert [x[1:] for x in own] == sorted(x[1:] for x in own) and [x[0] for x in own] == list(range(1, len(own) + 1))


def test_a_line_that_very_many_quote_and_a_very_long_text(spark):
    long = "\n".join(f"line {i} of a very long message" for i in range(3_000))
    rows = [(1, 0, "please read this line", "u"), (1, 1, long, "a")]
    rows += [(1, 2 + i, f"> please read this line\nanswer {i}", "u") for i in range(300)]
    rows += [(1, 5000, "> line 1234 of a very long message\nfound", "u"), (1, 5001, "> 777 of a very long message line 778\nacross", "u")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, text string, role string")
    out = {r.turn: r for r in op8_quotes.link(df).collect()}
    assert len(out) == len(rows) and all(out[2 + i].parent_turn == 0 for i in range(300))
    assert out[5000].parent_turn == out[5001].parent_turn == 1 and out[1].text == long
