import pytest

import corpus_pipeline
from edge_rows import EDGE
from locus.llm.exact_dedup import exact_dedup, keep_exact
from locus.llm.mixing import keep_sampled, sampling_plan


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def test_classes_match_brute_force(frame):
    rows = [*EDGE, *[(100 + i, "Hot TEXT" if i % 3 else "É" + str(i % 4)) for i in range(300)]]
    got = exact_dedup(frame(rows), salts=4).collect()
    groups = {}
    for i, t in rows:
        groups.setdefault(lower(t), []).append(i)
    want = {}
    for members in groups.values():
        top = max((m for m in members if m is not None), default=None)
        for m in members:
            want[m, len(members), top] = want.get((m, len(members), top), 0) + 1
    have = {}
    for r in got:
        key = (r["doc_id"], r["group_size"], r["keep_id"])
        have[key] = have.get(key, 0) + 1
    assert have == want
    assert sum(r["kept"] for r in got) == len(groups)


def test_repeated_rows_leave_one(frame):
    df = frame(EDGE)
    kept = keep_exact(df.unionByName(df))
    assert kept.columns == df.columns
    assert sorted(lower(r["text"]) for r in kept.collect()) == sorted({lower(t) for _, t in EDGE})


def test_empty_tables(frame):
    empty = frame(EDGE).limit(0)
    assert exact_dedup(empty).count() == 0 and keep_exact(empty).count() == 0


def test_stages_keep_columns_and_rows_follow(spark, frame):
    rows = [(i, f"w{i} " * (1 + i % 9) + "the text goes on and on", "en", f"s{i % 3}") for i in range(40)]
    rows += [(100, rows[5][1], "en", "s1"), (101, None, "en", "s0"), (102, "123 456", "de", None)]
    docs = frame(rows)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns, name
        assert out.select("doc_id").subtract(docs.select("doc_id")).isEmpty(), name
        docs = spark.createDataFrame(out.collect(), docs.schema)
        ids = [r["doc_id"] for r in docs.collect()]
        assert 101 not in ids and 102 not in ids  # nothing to tell a language by
        if name == "exact_dedup":
            assert 5 not in ids and 100 in ids
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, "")
    assert packed.select("doc_id").distinct().count() == docs.count()


def test_mixing_decides_rows_without_an_id(spark, frame):
    docs = frame([(None if i % 2 else i // 4, "word " * (1 + i % 40), "en", f"s{i % 7}") for i in range(400)])
    plan = sampling_plan(docs, fraction=0.1)
    want = plan.where("kept").groupBy("doc_id", "source").count().collect()
    got = keep_sampled(docs, fraction=0.1)
    assert got.columns == docs.columns
    assert {tuple(r) for r in got.groupBy("doc_id", "source").count().collect()} == {tuple(r) for r in want}
    # the pipeline's stage with its own parameters: one cell, whose rows without an id draw one by one
    lost = frame([(None, f"word{i} " * 9, "en", "s") for i in range(1000, 1400)])
    kept = sampling_plan(lost).where("kept").count()
    assert corpus_pipeline.mixing(spark, lost, "").count() == kept and 280 <= kept <= 360


@pytest.mark.parametrize("at", range(len(corpus_pipeline.STAGES)))
def test_stages_take_empty_tables(spark, frame, at):
    assert corpus_pipeline.STAGES[at][1](spark, frame(EDGE).limit(0), "").count() == 0


def test_pipeline_equals_brute_force(spark, tmp_path):
    """Over sf0.001: the near-duplicate stage against an all-pairs join."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    words = {r["doc_id"]: lower(r["text"]).encode().split() for r in docs.collect()}
    sets = {i: ({tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set())
            for i, w in words.items()}
    low = {i: i for i in sets}

    def find(i):
        while low[i] != i:
            i = low[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                low[y] = x
    want = {i for i in sets if find(i) == i}
    out = corpus_pipeline.near_duplicates(spark, docs, "")
    assert {r["doc_id"] for r in out.select("doc_id").collect()} == want
