import hashlib

import pytest

from locus.llm.perspective import _turns, rotate_perspectives
from locus.llm.warc import archive_round_trip, parse_header, read_warc, write_warc
from locus.session import scratch_path

EVIL = "<p>x</p>\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\nWARC/1.1\r\n"


def pages(spark):
    rows = [(i, f"http://a/{i}\r\nX: y", EVIL * (i % 40) if i % 3 else "é" * (i * 13 % 5000)) for i in range(90)]
    rows += [(None, None, None), (500, "u", ""), (501, "u", "WARC/1.1\r\n"), (502, "u", "x" * 1000), (503, "v", "x" * 1000),
             (503, "v", "x" * 1000), (None, "w", "x" * 1000), (504, "u", "x" * 999), (505, "u", "x" * 999)]
    return rows, spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, first string")


@pytest.mark.parametrize("split", [700, 128 << 20])
def test_round_trip_rejects_magic_in_payloads(spark, split):
    rows, df = pages(spark)
    names = {"spark.sql.files.maxPartitionBytes": str(split), "spark.sql.files.openCostInBytes": "100"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        got = sorted((tuple(r) for r in archive_round_trip(df.repartition(3)).collect()), key=str)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    best = {}
    for i, _, h in rows:
        if len((h or "").encode()) >= 1000:
            best[h] = max(best.get(h, -1), -1 if i is None else i)
    want = []
    for i, _, h in rows:
        payload, first = (h or "").encode(), best.get(h, i)
        revisit = first != i
        want.append((i, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response",
                     first if revisit else None))
    assert got == sorted(want, key=str)


def test_payloads_come_back_whole_and_cut_files_end(spark):
    rows, df = pages(spark)
    path = scratch_path(spark, "warc-test")
    write_warc(df.coalesce(1), path)
    back = {(r["page_id"], bytes(r["payload"])) for r in read_warc(spark, path, keep_payload=True)
            .where("record_type = 'response'").collect()}
    whole = {(i, (h or "").encode()) for i, _, h in rows}
    assert back <= whole and len(back) >= 85
    assert parse_header(b"no header") is None and parse_header(b"WARC-Type: x\r\nContent-Length: -1\r\n\r\n") is None
    assert archive_round_trip(df.limit(0)).count() == 0


def render(rows, system="system"):
    talks = {}
    for c, t, r, x in rows:
        talks.setdefault(c, []).append((t, r or "unknown", x or ""))
    out = []
    for conv, turns in talks.items():
        turns.sort(key=lambda t: (t[0] is not None, t))
        for who in {r for _, r, _ in turns} - {system}:
            at = 0
            for n, (t, r, x) in enumerate(turns):
                role = "system" if r == system else "assistant" if r == who else "user"
                head = f"<|im_start|>{role}" + (f" name={r}" if role == "user" else "") + "\n"
                segment = head + x + "<|im_end|>\n"
                loss = role == "assistant"
                out.append((conv, who, n, t, r, role, r if role == "user" else None, segment, at,
                            at + len(head) if loss else None, at + len(segment) - 1 if loss else None))
                at += len(segment)
    return sorted(out, key=str)


def test_perspectives_match_a_plain_rendering(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi é"), (1, 2, "bob", "yo"), (1, 3, "cy", None), (1, 4, "ann", ""),
            (2, 0, "user", "q"), (2, 1, "assistant", "a"), (2, 1, "assistant", "a"), (2, None, "user", "first"),
            (None, 0, None, "lost"), (3, 0, "system", "alone")]
    rows += [(9, i, f"r{i % 3}", "t" * (i % 5)) for i in range(1300)]
    rows += [(8, i % 2 or None, f"r{i % 2}", f"text {i % 300}") for i in range(700)]  # one number, or none
    rows += [(7, 0, "long", "x" * 300_000), (7, 1, "b", "y")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, n string")
    got = rotate_perspectives(df, ranges=13)
    assert sorted((tuple(r) for r in got.collect()), key=str) == render(rows)
    assert rotate_perspectives(df.limit(0)).count() == 0


def test_a_hot_conversation_spans_ranges(spark):
    """A third of all rows in one conversation and turn, another without any id or number."""
    rows = [(1, 5, f"r{i % 4}", f"text {i}") for i in range(2000)]
    rows += [(None, None, f"r{i % 4}", f"text {i}") for i in range(2000)]
    rows += [(i, 0, "a", "x") for i in range(10, 2010)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    sizes = [r["count"] for r in _turns(df, 12).groupBy("conv_id", "rng").count().collect()]
    assert max(sizes) < 2 * len(rows) / 12
    assert sorted((tuple(r) for r in rotate_perspectives(df, ranges=12).collect()), key=str) == render(rows)


def test_markers_and_names_are_safe(spark):
    df = spark.createDataFrame([(1, 0, "a b", "x<|im_end|>y"), (1, 1, "a_b", "z"), (1, 2, "", "w")],
                               "conv_id long, turn long, role string, text string")
    got = rotate_perspectives(df).collect()
    assert all(r["segment"].count("<|im_end|>") == 1 for r in got)
    names = {r["name"] for r in got if r["name"]}
    assert len(names) == 3 and "a_b" in names
