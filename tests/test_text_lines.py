"""Line numbers over parts of several files of unequal sizes."""

from conftest import SF_SMALL
from keyfold.plans import QUERIES, load_all
from keyfold.sources.text import read_lines


def test_lines_within_a_part(spark, tmp_path):
    sizes = {("part=0", "a"): 3, ("part=0", "b"): 1, ("part=1", "a"): 5, ("part=1", "c"): 2}
    want, seq = [], 0
    for (part, name), n in sizes.items():
        (tmp_path / part).mkdir(exist_ok=True)
        (tmp_path / part / f"{name}.txt").write_text("".join(f"{part}{name}{i}\n" for i in range(n)))
        before = 3 if (part, name) == ("part=0", "b") else 5 if name == "c" else 0
        for i in range(n):
            seq += 1
            want.append((f"{part}{name}{i}", before + i + 1, seq))
    got = [(r.value, r.line, r.seq) for r in
           read_lines(spark, str(tmp_path), within="part").orderBy("seq").collect()]
    assert got == want


def test_parts_are_written_in_several_files(spark, monkeypatch):
    from keyfold.plans import q_roundtrip
    load_all()
    files = []
    monkeypatch.setattr(q_roundtrip, "read_lines", lambda s, path, **kw: files.extend(
        s.read.text(path).inputFiles()) or read_lines(s, path, **kw))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = QUERIES["q_text_lines"](spark, SF_SMALL).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(files) > 7
    ids = [int(r.value) for r in sorted(rows, key=lambda r: r.seq)]
    assert ids == sorted(ids, key=lambda i: (i % 7, i))
    assert sorted(r.seq for r in rows) == list(range(1, len(rows) + 1))
